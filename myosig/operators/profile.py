"""AGG-19..21: distribution profiles of labels and channels, and an exact distributed median.

``exact_quantile`` replaces ``percentile``/``median`` (which hold every distinct
value of a group in one task) with bracket refinement: each pass counts the
values of every (group, target rank) in ``buckets`` equal-width buckets of the
current bracket -- a partial aggregate, so the shuffle carries at most
``buckets`` rows per group -- then narrows the bracket to the bucket holding the
target rank.  When every bracket holds at most ``max_final`` values (or one
distinct value) the remaining candidates are ranked exactly.  Work per task is
bounded by ``max_final`` whatever the group size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from myosig.functions import broadcast_if_small


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """AGG-19: counts per value, most frequent first (ties by value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col)


def channel_long(df: DataFrame, arr: str, keys: Sequence[str] = (), ch: str = "ch", value: str = "v") -> DataFrame:
    """Array channels -> long rows (keys, ch, v) with ``posexplode`` (no collect)."""
    return df.select(*keys, F.posexplode(arr).alias(ch, value))


def activity_activation(df: DataFrame, arr: str, activity: str = "activity") -> DataFrame:
    """AGG-20: mean raw value per channel per activity (partial aggregate per task)."""
    long = channel_long(df, arr, [activity])
    return long.groupBy(activity, "ch").agg(F.avg("v").alias("mean_v"))


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys``, null keys included; the right side's keys go."""
    names = {k: f"_k{i}" for i, k in enumerate(keys)}
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(F.col(n)) for k, n in names.items()], F.lit(True))
    return left.join(right.withColumnsRenamed(names), same, how).drop(*names.values())


def _inside(data: DataFrame, brackets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Values within the brackets of their group (two rows per group: broadcast after a size check,
    so the values are counted where they lie, whatever the share of one group)."""
    return _match(data, broadcast_if_small(brackets), keys).where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))


def exact_quantile(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    q: float = 0.5,
    buckets: int = 4096,
    max_final: int = 100_000,
    out: str = "quantile",
) -> DataFrame:
    """Exact linear-interpolated quantile per group (``percentile_cont`` / pandas ``quantile``).

    NULL and NaN values are skipped (pandas ``median``).
    """
    keys = list(keys)
    data = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    stats = data.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )
    pos = F.lit(q) * (F.col("_n") - 1)
    ranks = F.array(
        F.struct(F.lit(0).alias("t"), F.floor(pos).cast("bigint").alias("rank")),
        F.struct(F.lit(1).alias("t"), F.ceil(pos).cast("bigint").alias("rank")),
    )
    # _need: rank of the wanted value inside the current bracket; _cnt: values in the bracket.
    targets = (
        stats.select(*keys, "_lo", "_hi", "_n", (pos - F.floor(pos)).alias("_frac"), F.explode(ranks).alias("_tr"))
        .select(
            *keys,
            "_lo",
            "_hi",
            "_frac",
            F.col("_tr.t").alias("_t"),
            F.col("_tr.rank").alias("_need"),
            F.col("_n").alias("_cnt"),
        )
        .checkpoint()
    )

    # every pass takes at least the outermost values off an open bracket, and usually all but 1/buckets of its width
    while True:
        big = targets.where((F.col("_cnt") > max_final) & (F.col("_lo") < F.col("_hi")))
        if big.limit(1).count() == 0:
            break
        j = _inside(data, big.select(*keys, "_t", "_lo", "_hi", "_need"), keys)
        # halves: the width of a bracket may exceed the largest double
        width = F.col("_hi") / 2 - F.col("_lo") / 2
        b = F.least(F.floor((F.col("_v") / 2 - F.col("_lo") / 2) / width * buckets), F.lit(buckets - 1)).cast("int")
        h = j.groupBy(*keys, "_t", "_need", b.alias("_b")).agg(
            F.count(F.lit(1)).alias("_bc"), F.min("_v").alias("_bmin"), F.max("_v").alias("_bmax")
        )
        wb = Window.partitionBy(*keys, "_t").orderBy("_b")
        h = h.withColumn("_cum", F.sum("_bc").over(wb.rowsBetween(Window.unboundedPreceding, 0)))
        h = h.withColumn("_prev", F.col("_cum") - F.col("_bc"))
        chosen = h.where((F.col("_prev") <= F.col("_need")) & (F.col("_need") < F.col("_cum"))).select(
            *keys,
            "_t",
            F.col("_bmin").alias("_lo2"),
            F.col("_bmax").alias("_hi2"),
            (F.col("_need") - F.col("_prev")).alias("_need2"),
            F.col("_bc").alias("_cnt2"),
        )
        targets = (
            _match(targets, chosen, [*keys, "_t"], "left")
            .select(
                *keys,
                "_t",
                "_frac",
                F.coalesce("_lo2", "_lo").alias("_lo"),
                F.coalesce("_hi2", "_hi").alias("_hi"),
                F.coalesce("_need2", "_need").alias("_need"),
                F.coalesce("_cnt2", "_cnt").alias("_cnt"),
            )
            .checkpoint()
        )

    # A bracket of one distinct value is its own answer; the rest are ranked
    # (each holds at most max_final values).
    direct = targets.where(F.col("_lo") == F.col("_hi")).select(*keys, "_t", F.col("_lo").alias("_v"))
    open_t = targets.where(F.col("_lo") < F.col("_hi")).select(*keys, "_t", "_lo", "_hi", "_need")
    cand = _inside(data, open_t, keys)
    wr = Window.partitionBy(*keys, "_t").orderBy("_v")
    ranked = (
        cand.withColumn("_r", F.row_number().over(wr) - 1)
        .where(F.col("_r") == F.col("_need"))
        .select(*keys, "_t", "_v")
    )
    picked = (
        ranked.unionByName(direct)
        .groupBy(*keys)
        .agg(F.max(F.when(F.col("_t") == 0, F.col("_v"))).alias("_v0"), F.max(F.when(F.col("_t") == 1, F.col("_v"))).alias("_v1"))
    )
    fr = targets.where(F.col("_t") == 0).select(*keys, "_frac")
    res = _match(picked, fr, keys).select(
        *keys, (F.col("_v0") + (F.col("_v1") - F.col("_v0")) * F.col("_frac")).alias(out)
    )
    return res


def bad_channels(df: DataFrame, arr: str, z: float = 3.0, eps: float = 1e-6) -> DataFrame:
    """AGG-21: per channel median of x^2, z-scored over channels (sample std + eps).

    The z-score step runs over one row per channel (a bounded table).
    """
    long = channel_long(df, arr).withColumn("sq", F.col("v").cast("double") * F.col("v").cast("double"))
    med = exact_quantile(long, ["ch"], "sq", 0.5, out="median_sq")
    med = med.checkpoint()
    st = med.agg(F.avg("median_sq").alias("m"), F.stddev_samp("median_sq").alias("s")).first()
    zc = (F.col("median_sq") - F.lit(st["m"])) / (F.lit(st["s"]) + eps)
    return med.select("ch", "median_sq", zc.alias("z"), (F.abs(zc) > z).alias("is_bad"))


def cardinality(df: DataFrame, cols: Sequence[str], approximate: bool = False, rsd: float = 0.01) -> DataFrame:
    """AGG-25: distinct count of each column (``approx_count_distinct`` when ``approximate``)."""
    f = (lambda c: F.approx_count_distinct(c, rsd)) if approximate else F.countDistinct
    return df.agg(*[f(c).alias(f"n_{c}") for c in cols])
