"""AGG-21 / AGG-25 at scale: quantile and distinct-count sketches that are stored per recording and merged.

The exact operators of :mod:`myosig.operators.profile` read every row whenever a recording is
added.  Here each recording is read once: KLL sketches of a channel's squares and HyperLogLog
sketches of a column are kept as binary columns, one row per recording and channel (or one per
recording), and any set of recordings is answered by merging their sketches.  The sketches are
Spark's own aggregates, built per task and merged after the shuffle, so a recording of any
size moves one small sketch per task and channel.

Both answers are approximate with a stated error: ranks within :func:`rank_error` and
distinct counts within :func:`count_error` (relative standard error).  Nulls and NaN are
skipped, as by the exact operators; an empty table has no sketches and gives no channels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from myosig.operators.profile import channel_long

#: Size parameter of the quantile sketches: about 3 k doubles each, however many values.
QUANTILE_K = 800
#: Binary logarithm of the buckets of the distinct-count sketches.
COUNT_LG_K = 14


def rank_error(k: int = QUANTILE_K) -> float:
    """Largest error of a quantile's rank, as a share of the values, with 99 % confidence (KLL, published fit)."""
    return 2.296 / k**0.9723


def count_error(lg_k: int = COUNT_LG_K) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / 2 ** (lg_k / 2)


def channel_sketches(df: DataFrame, arr: str, recording: str, k: int = QUANTILE_K) -> DataFrame:
    """(recording, ch, sketch): the distribution of the squares of every channel of every recording."""
    long = channel_long(df, arr, [recording]).withColumn("v", F.col("v").cast("double"))
    square = F.when(~F.isnan("v"), F.col("v") * F.col("v"))
    return long.groupBy(F.col(recording).alias("recording"), "ch").agg(F.kll_sketch_agg_double(square, k).alias("sketch"))


def distinct_sketches(df: DataFrame, cols: Sequence[str], recording: str, lg_k: int = COUNT_LG_K) -> DataFrame:
    """(recording, one sketch per column): the distinct values of every recording."""
    sketch = [F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(c) for c in cols]
    return df.groupBy(F.col(recording).alias("_recording")).agg(*sketch).withColumnRenamed("_recording", "recording")


def add_recordings(sketches: DataFrame, path: str) -> DataFrame:
    """Append the sketches of recordings that the store at ``path`` does not hold yet; returns the whole store.

    A recording that is there already is left as it is, so a repeated call counts nothing twice.
    """
    spark = sketches.sparkSession
    try:
        stored = spark.read.schema(sketches.schema).parquet(path).select(F.col("recording").alias("_stored")).distinct()
        sketches = sketches.join(stored, F.col("recording").eqNullSafe(F.col("_stored")), "left_anti")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    sketches.write.mode("append").parquet(path)
    return spark.read.schema(sketches.schema).parquet(path)


def merged_quantile(sketches: DataFrame, q: float = 0.5, out: str = "quantile") -> DataFrame:
    """(ch, n, quantile) over all recordings; ``n`` counts the values exactly."""
    m = sketches.groupBy("ch").agg(F.kll_merge_agg_double("sketch").alias("s")).withColumn("n", F.kll_sketch_get_n_double("s"))
    return m.where("n > 0").select("ch", "n", F.kll_sketch_get_quantile_double("s", F.lit(q)).alias(out))


def bad_channels(sketches: DataFrame, z: float = 3.0, eps: float = 1e-6) -> DataFrame:
    """AGG-21 from stored sketches: median of squares per channel, z-scored over channels."""
    med = merged_quantile(sketches, 0.5, "median_sq")
    of = med.agg(F.avg("median_sq").alias("_m"), F.stddev_samp("median_sq").alias("_s"))  # one row
    zc = (F.col("median_sq") - F.col("_m")) / (F.col("_s") + F.lit(eps))
    return med.join(F.broadcast(of)).select("ch", "n", "median_sq", zc.alias("z"), (F.abs(zc) > z).alias("is_bad"))


def merged_cardinality(sketches: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG-25 from stored sketches: one row, the distinct count of each column over all recordings."""
    return sketches.agg(*[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).alias(f"n_{c}") for c in cols])
