"""Queries: quantiles and distinct counts from sketches stored per recording, held against exact ranks and counts."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from myosig import adapters
from myosig.functions import broadcast_if_small
from myosig.operators import profile as pf
from myosig.operators import sketches as sk
from myosig.plans.registry import query
from myosig.streaming.feed import scratch_folder


def _stored(spark, name, sketches):
    """All recordings, added to the store in two parts."""
    path = os.path.join(scratch_folder(spark, name), "sketches")
    late = F.pmod(F.xxhash64("recording"), F.lit(2)) == 1
    sk.add_recordings(sketches.where(~late), path)
    return sk.add_recordings(sketches, path)


@query(
    "sketch_bad_channels",
    ["AGG-21"],
    sql="""
WITH long AS (SELECT CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS ch, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
SELECT ch, count(*) AS n, true AS within FROM long WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY ch
""",
)
def q_sketch_bad_channels(spark, sf_dir):
    """``within``: the true rank of the sketched median is at most twice the stated error off a half."""
    grid = adapters.grid(spark, sf_dir)
    found = sk.bad_channels(_stored(spark, "sketch_channels", sk.channel_sketches(grid, "emg_ta", "activity")))
    long = pf.channel_long(grid, "emg_ta").withColumn("v", F.col("v").cast("double")).where("v IS NOT NULL AND NOT isnan(v)")
    at = long.join(broadcast_if_small(found.select(F.col("ch").alias("_ch"), "n", "median_sq")), F.col("ch") == F.col("_ch"))
    square, mid = F.col("v") * F.col("v"), F.col("median_sq")
    ranks = at.groupBy("ch", "n").agg(F.avg((square < mid).cast("double")).alias("lo"), F.avg((square <= mid).cast("double")).alias("hi"))
    off = 2 * sk.rank_error()
    return ranks.select("ch", "n", ((F.col("lo") <= 0.5 + off) & (F.col("hi") >= 0.5 - off)).alias("within"))


@query(
    "sketch_cardinality",
    ["AGG-25"],
    sql="SELECT count(DISTINCT user_id) AS n_subject, count(DISTINCT event_id) AS n_event_id, true AS within FROM events",
)
def q_sketch_cardinality(spark, sf_dir):
    """Exact counts, and whether the merged sketches come within four standard errors of them."""
    s, cols = adapters.signal(spark, sf_dir), ["subject", "event_id"]
    found = sk.merged_cardinality(_stored(spark, "sketch_counts", sk.distinct_sketches(s, cols, "activity")), cols)
    exact = pf.cardinality(s, cols)
    near = [F.abs(F.col(f"_{c}") - F.col(f"n_{c}")) <= 4 * sk.count_error() * F.col(f"n_{c}") for c in cols]
    both = exact.join(F.broadcast(found.select(*[F.col(f"n_{c}").alias(f"_{c}") for c in cols])))  # one row each
    return both.select(*[f"n_{c}" for c in cols], (near[0] & near[1]).alias("within"))
