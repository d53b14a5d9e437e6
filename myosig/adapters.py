"""Adapters from the driver's test tables to the signal shapes the operators use.

* ``signal``  (events)     -- one channel per sample: subject, activity, reps, gait %, x
* ``grid``    (embeddings) -- a 64-electrode row per sample, labelled
* ``reps``    (lineitem)   -- order-free 4-channel rows with activity / rep / subject
* ``preds``   (lineitem)   -- deterministic truth / prediction pairs for metrics
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from myosig.session import table

# Global sample order of the signal adapter: the concatenation by activity, then
# subject, then time; event_id breaks ties so the order is total.
SIGNAL_ORDER = ["activity", "subject", "ts", "event_id"]
SUBJECT_ORDER = ["ts", "event_id"]


def signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        "ts",
        F.col("user_id").alias("subject"),
        F.col("event_type").alias("activity"),
        F.col("user_id").cast("int").alias("reps"),
        F.get_json_object("props", "$.k").cast("double").alias("gait"),
        F.col("value").alias("x"),
    )


def signal_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signal with weighted-variant activity names (every 4th event gets a trailing '_')."""
    s = signal(spark, sf_dir)
    return s.withColumn(
        "activity",
        F.concat("activity", F.when(F.col("event_id") % 4 == 0, F.lit("_")).otherwise(F.lit(""))),
    )


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("idx"),
        F.col("embedding").alias("emg_ta"),
        F.col("label"),
        F.col("label").cast("string").alias("activity"),
    )


REPS_CHANNELS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def reps(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        *REPS_CHANNELS,
        F.concat("l_returnflag", "l_linestatus").alias("activity"),
        F.col("l_linenumber").alias("reps"),
        (F.col("l_suppkey") % 6).alias("subject"),
    )


def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-target regression results: (truth, pred) for price and for tax."""
    r = reps(spark, sf_dir)
    return r.select(
        "l_orderkey",
        "l_linenumber",
        "activity",
        "subject",
        F.col("l_extendedprice").alias("y_price"),
        (F.col("l_quantity") * 1500.0).alias("p_price"),
        F.col("l_tax").alias("y_tax"),
        (F.col("l_discount") * 0.8).alias("p_tax"),
    )
