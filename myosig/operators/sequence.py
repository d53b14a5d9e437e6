"""WIN-04..12: operators over ordered sequences (per series), without one-task windows.

Ordered frames are cut into blocks of consecutive positions.  A frame that needs
neighbours (moving average, lags, Kalman) gets halo rows copied from the
adjacent blocks; a running total gets per-block sums plus block offsets.  Task
size is bounded by the block size, so a series holding a third of the data is
spread over many tasks like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from myosig.functions import broadcast_if_small
from myosig.operators.index import with_row_index


def elapsed_time(
    df: DataFrame, hz: float = 2048.0, activity: str = "activity", order: Sequence[str] = ("idx",), out: str = "t"
) -> DataFrame:
    """WIN-04: position within the activity divided by the sampling rate."""
    pos = with_row_index(df, list(order), series=[activity], name="_apos")
    return pos.withColumn(out, F.col("_apos") / F.lit(float(hz))).drop("_apos")


def _halo_blocks(df: DataFrame, idx: str, block: int, before: int, after: int) -> DataFrame:
    base = df.withColumn("_blk", F.floor(F.col(idx) / block)).withColumn("_halo", F.lit(False))
    parts = [base]
    off = F.pmod(F.col(idx), F.lit(block))
    if before:
        parts.append(base.where(off >= block - before).withColumn("_blk", F.col("_blk") + 1).withColumn("_halo", F.lit(True)))
    if after:
        parts.append(base.where(off < after).withColumn("_blk", F.col("_blk") - 1).withColumn("_halo", F.lit(True)))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u


def rolling(
    df: DataFrame,
    aggs: Mapping[str, Column],
    frame: tuple[int, int],
    idx: str = "idx",
    series: Sequence[str] = (),
    block: int = 1 << 16,
) -> DataFrame:
    """Row-frame aggregates ``rowsBetween(lo, hi)`` per series, computed block-wise with halos.

    ``aggs`` are aggregate expressions (e.g. ``F.avg('x')``), evaluated over the frame.
    """
    lo, hi = frame
    before, after = max(0, -lo), max(0, hi)
    if before > block or after > block:
        raise ValueError("frame wider than a block")
    u = _halo_blocks(df, idx, block, before, after)
    w = Window.partitionBy(*series, "_blk").orderBy(idx).rowsBetween(lo, hi)
    for name, a in aggs.items():
        u = u.withColumn(name, a.over(w))
    return u.where(~F.col("_halo")).drop("_blk", "_halo")


def moving_average(
    df: DataFrame, col: str, w: int = 10, idx: str = "idx", series: Sequence[str] = (), out: str | None = None
) -> DataFrame:
    """WIN-07: centred moving average with ``min_periods=1`` (pandas ``rolling(center=True)``).

    For even ``w`` the frame is ``[i - w//2, i + w//2 - 1]``.
    """
    lo = -(w // 2)
    hi = w - 1 + lo
    return rolling(df, {out or f"{col}_ma": F.avg(col)}, (lo, hi), idx=idx, series=series)


def fill_curve(df: DataFrame, key: Sequence[str], pos: str, value: str, out: str | None = None) -> DataFrame:
    """WIN-08: linear interpolation by position, then forward and back fill.

    Runs per curve (key); curves are bounded tables (bins x joints).
    """
    out = out or value
    w_prev = Window.partitionBy(*key).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    w_next = Window.partitionBy(*key).orderBy(pos).rowsBetween(0, Window.unboundedFollowing)
    valid_pos = F.when(F.col(value).isNotNull() & ~F.isnan(value), F.col(pos))
    valid_val = F.when(F.col(value).isNotNull() & ~F.isnan(value), F.col(value))
    d = (
        df.withColumn("_pp", F.last(valid_pos, ignorenulls=True).over(w_prev))
        .withColumn("_pv", F.last(valid_val, ignorenulls=True).over(w_prev))
        .withColumn("_np", F.first(valid_pos, ignorenulls=True).over(w_next))
        .withColumn("_nv", F.first(valid_val, ignorenulls=True).over(w_next))
    )
    lerp = F.col("_pv") + (F.col("_nv") - F.col("_pv")) * (F.col(pos) - F.col("_pp")) / (F.col("_np") - F.col("_pp"))
    filled = (
        F.when(F.col("_pp") == F.col(pos), F.col("_pv"))
        .when(F.col("_pp").isNull(), F.col("_nv"))
        .when(F.col("_np").isNull(), F.col("_pv"))
        .otherwise(lerp)
    )
    return d.withColumn(out, filled).drop("_pp", "_pv", "_np", "_nv")


# ---------------------------------------------------------------- WIN-09 Kalman
def kalman_gains(n: int, q_ratio: float) -> np.ndarray:
    """Gain sequence K_1..K_n of the scalar filter with P0 = R, Q = q*R (independent of R)."""
    k = np.empty(n + 1)
    k[0] = 1.0
    p = 1.0
    for i in range(1, n + 1):
        k[i] = (p + q_ratio) / (p + q_ratio + 1.0)
        p = k[i]
    return k


def _kalman_halo(q_ratio: float) -> int:
    k_inf = kalman_gains(200, q_ratio)[-1]
    # Start-up error decays as (1-K)^h: take h with (1-K)^h below 1e-18.
    return int(np.ceil(np.log(1e-18) / np.log(1.0 - k_inf))) + 1


def kalman_smooth(
    df: DataFrame,
    value: str,
    idx: str = "idx",
    series: Sequence[str] = (),
    q_ratio: float = 0.4,
    out: str | None = None,
    block: int = 1 << 16,
    rows_per_group: int = 1 << 16,
) -> DataFrame:
    """WIN-09: scalar Kalman filter x_i = x_{i-1} + K_i (z_i - x_{i-1}), x_0 = z_0.

    With P0 = R and Q = q*R the gains depend only on i and q, and the effect of
    the starting state dies out geometrically.  Each block of a series therefore
    restarts the recurrence ``halo`` rows early (copied from the same series'
    previous block) and reproduces the sequential result to double precision.
    Tasks are keyed by (hash bucket of the series, block), so many short series
    share one pandas call while a long series is still cut into blocks.  A
    constant series (R = 0, where the source divides 0/0) is returned unchanged.
    """
    out = out or f"{value}_kalman"
    series = list(series)
    halo = _kalman_halo(q_ratio)
    if halo >= block:
        raise ValueError("block too small for the filter's memory")
    if series:
        names = {c: f"_s{i}" for i, c in enumerate(series)}
        var = df.groupBy(*[F.col(c).alias(n) for c, n in names.items()]).agg(F.var_pop(value).alias("_var"))
        same = reduce(lambda x, y: x & y, [df[c].eqNullSafe(F.col(n)) for c, n in names.items()])
        d = df.join(broadcast_if_small(var), same).drop(*names.values())
        n = df.count()  # one scalar: sizes the number of buckets
        buckets = max(1, int(np.ceil(n / rows_per_group)))
        d = d.withColumn("_bkt", F.pmod(F.xxhash64(*series), F.lit(buckets)))
    else:
        v = df.agg(F.var_pop(value)).first()[0]
        d = df.withColumn("_var", F.lit(float(v) if v is not None else 0.0)).withColumn("_bkt", F.lit(0).cast("bigint"))
    u = _halo_blocks(d, idx, block, halo, 0)
    gains = kalman_gains(block + halo + 1, q_ratio)
    schema = T.StructType([*u.schema.fields, T.StructField(out, T.DoubleType())])
    skeys = list(series)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in [*skeys, idx]])
        z = table[value].cast(pa.float64()).to_numpy()
        const = ~(np.nan_to_num(table["_var"].to_numpy()) > 0)
        start = np.zeros(len(z), dtype=bool)
        start[:1] = True
        for c in skeys:
            code = table[c].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
            start[1:] |= code[1:] != code[:-1]
        x = _filter(z, table[idx].to_numpy(), start, const, gains)
        return table.append_column(out, pa.array(x, pa.float64(), mask=np.isnan(x)))

    res = u.groupBy("_bkt", "_blk").applyInArrow(run, schema)
    return res.where(~F.col("_halo")).drop("_blk", "_halo", "_var", "_bkt")


def _filter(z: np.ndarray, pos: np.ndarray, start: np.ndarray, const: np.ndarray, gains: np.ndarray) -> np.ndarray:
    """x_i = a_i x_{i-1} + b_i for all series of a group at once.

    Steps compose, so a doubling scan gives every x in log2 passes over the arrays; it
    ends when no start-up weight is left.  A missing sample keeps the state; before a
    series' first sample there is none (NaN).
    """
    n = len(z)
    known = ~np.isnan(z)
    run = np.cumsum(start) - 1
    seen = np.cumsum(known)
    before = np.concatenate([[0], seen])[np.flatnonzero(start)] if n else seen
    first = known & (seen - before[run] == 1) if n else known
    k = gains[np.minimum(pos, len(gains) - 1)]
    reset = first | (const & known)
    a = np.where(reset, 0.0, np.where(known, 1.0 - k, 1.0))
    b = np.where(reset, z, np.where(known, k * np.nan_to_num(z), 0.0))
    # no state yet: nothing to carry into these rows
    void = seen - before[run] == 0 if n else known
    a[void] = 0.0
    s = 1
    while s < n and np.abs(a).max() > 1e-18:
        pa_, pb = a[:-s].copy(), b[:-s].copy()
        b[s:] += a[s:] * pb
        a[s:] *= pa_
        s *= 2
    return np.where(void, np.nan, b)


# ---------------------------------------------------------------- WIN-10/11/12
def jitter(df: DataFrame, value: str, idx: str = "idx", series: Sequence[str] = (), out: str = "jitter") -> DataFrame:
    """WIN-10: population std of successive differences, per series."""
    from myosig.operators.index import with_lags

    lagged = with_lags(df, [value], idx=idx, series=series, lags=1)
    d = F.col(value) - F.col(f"{value}_lag1")
    return lagged.groupBy(*series).agg(F.stddev_pop(d).alias(out))


def jitter_reduction(before: Column, after: Column) -> Column:
    """(a - b) / a * 100."""
    return (before - after) / before * 100.0


def cumulative_sums(
    df: DataFrame, cols: Sequence[str], idx: str = "idx", series: Sequence[str] = (), block: int = 1 << 18, suffix: str = "_cum"
) -> DataFrame:
    """Running sums by position: within-block running sum plus the sum of earlier blocks."""
    series = list(series)
    d = df.withColumn("_blk", F.floor(F.col(idx) / block))
    sums = d.groupBy(*series, "_blk").agg(*[F.sum(c).alias(f"_bs_{c}") for c in cols])
    wb = Window.partitionBy(*series).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    for c in cols:
        sums = sums.withColumn(f"_bo_{c}", F.coalesce(F.sum(f"_bs_{c}").over(wb), F.lit(0)))
    sums = sums.select(*series, "_blk", *[f"_bo_{c}" for c in cols])
    wr = Window.partitionBy(*series, "_blk").orderBy(idx).rowsBetween(Window.unboundedPreceding, 0)
    for c in cols:
        d = d.withColumn(f"{c}{suffix}", F.sum(c).over(wr))
    d = d.join(sums, [*series, "_blk"])
    for c in cols:
        d = d.withColumn(f"{c}{suffix}", F.col(f"{c}{suffix}") + F.col(f"_bo_{c}"))
    return d.drop("_blk", *[f"_bo_{c}" for c in cols])


def running_rmse(
    df: DataFrame, err: str, idx: str = "idx", series: Sequence[str] = (), every: int = 20, out: str = "rmse"
) -> DataFrame:
    """WIN-11: RMSE of all errors up to each row, reported every ``every`` cycles (1-based)."""
    d = df.withColumn("_e2", F.col(err) * F.col(err))
    d = cumulative_sums(d, ["_e2"], idx=idx, series=series)
    d = d.withColumn("cycle", F.col(idx) + 1).withColumn(out, F.sqrt(F.col("_e2_cum") / F.col("cycle")))
    return d.where(F.col("cycle") % every == 0).drop("_e2", "_e2_cum")


def last_n(df: DataFrame, n: int, order: Sequence[str | Column], series: Sequence[str] = ()) -> DataFrame:
    """WIN-12: the most recent ``n`` rows per series.

    ``row_number() <= n`` lets Spark insert a partial per-task top-n
    (WindowGroupLimit) before the shuffle, so at most n rows per task and
    series move.
    """
    ords = [F.col(o).desc() if isinstance(o, str) else o for o in order]
    w = Window.partitionBy(*series).orderBy(*ords)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
