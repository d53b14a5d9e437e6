"""WIN-02 / WIN-03: row-count sliding and tumbling windows as grouped aggregates.

A window ``k`` covers positions ``[k*step, k*step + size)`` of its series (the
whole frame for global alignment).  Each row is sent to the few windows that
contain it (``ceil(size/step)`` at most) with ``explode(sequence(first, last))``
and the windows are then ordinary ``groupBy`` groups.  Because positions are
range-partitioned, consecutive rows -- and therefore most copies of a window --
sit in the same task, so the partial (map-side) aggregate collapses them before
the shuffle: what crosses the network is about one partial row per window per
task, never the raw samples.  No window is ever collected as a list.

Inside a group ``_rel`` is the row's offset in its window; difference features
use it to ignore the first (or first two) rows, whose predecessors lie outside.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from myosig.functions import MAX_BROADCAST_BYTES, frame_bytes

REL = "_rel"


def _vocabulary(df: DataFrame, col: str) -> tuple[DataFrame, bool]:
    """Distinct values of ``col`` with dense codes in sorted order (code order = value order)."""
    from myosig.operators.index import with_row_index

    d = df.select(col).where(F.col(col).isNotNull()).distinct()
    v = with_row_index(d, [col], name=f"_code_{col}").withColumn(f"_code_{col}", F.col(f"_code_{col}").cast("int"))
    return v, frame_bytes(v) <= MAX_BROADCAST_BYTES


def _side(v: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(v) if small else v


def window_bounds(idx: Column, n: Column, size: int, step: int, inclusive_end: bool = True):
    """First and last window ids that contain position ``idx`` (may be empty: first > last).

    ``inclusive_end`` keeps a window starting at ``n - size`` (``range(0, n-size+1, step)``);
    the exclusive variant stops before it (``range(0, n-size, step)``).
    """
    tail = n - size if inclusive_end else n - size - 1
    last_valid = F.floor(tail / F.lit(step))
    first = F.greatest(F.lit(0).cast("bigint"), F.ceil((idx - size + 1) / F.lit(step)))
    last = F.least(F.floor(idx / F.lit(step)), last_valid)
    return first.cast("bigint"), last.cast("bigint")


def assign_windows(
    df: DataFrame,
    size: int,
    step: int,
    idx: str = "idx",
    n: str = "n_rows",
    inclusive_end: bool = True,
    window_col: str = "window_id",
) -> DataFrame:
    """JOI-04: window membership -- one row per (row, window containing it)."""
    first, last = window_bounds(F.col(idx), F.col(n), size, step, inclusive_end)
    out = (
        df.withColumn("_wf", first)
        .withColumn("_wl", last)
        .where(F.col("_wf") <= F.col("_wl"))  # sequence() would count down otherwise
        .withColumn(window_col, F.explode(F.sequence("_wf", "_wl")))
        .withColumn(REL, F.col(idx) - F.col(window_col) * step)
        .drop("_wf", "_wl")
    )
    return out


def sliding_windows(
    df: DataFrame,
    size: int,
    step: int,
    aggs: Mapping[str, Column] | None = None,
    series: Sequence[str] = (),
    idx: str = "idx",
    n: str = "n_rows",
    inclusive_end: bool = True,
    purity: Sequence[str] | None = None,
    labels: Mapping[str, tuple[str, str]] | None = None,
    window_col: str = "window_id",
) -> DataFrame:
    """Aggregate every full window of ``size`` rows starting each ``step`` rows.

    ``aggs`` maps output names to numeric aggregate expressions (see
    :mod:`myosig.functions.features`).  ``labels`` maps output names to
    ``(column, 'last' | 'majority')``.  ``purity`` drops windows in which any of
    the listed columns takes more than one value (training drops boundary
    windows, live inference keeps them: pass ``None`` for parity with a stream).

    String label / purity columns are dictionary-encoded first (codes follow
    the value order, so ties and min/max behave as on the strings): with only
    fixed-width buffers Spark runs a hash aggregate with map-side partial
    aggregation instead of sorting every exploded row.
    Output: series columns, ``window_id``, ``start_idx``, ``end_idx``, ``aggs``, ``labels``.
    """
    aggs = dict(aggs or {})
    labels = dict(labels or {})
    purity = list(purity or [])
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    coded = sorted(({c for c, _ in labels.values()} | set(purity)) & strings)
    vocab = {}
    base = df
    for c in coded:
        v, small = _vocabulary(df, c)
        vocab[c] = (v, small)
        base = base.join(_side(v, small), c, "left")

    def key(c):
        return f"_code_{c}" if c in vocab else c

    members = assign_windows(base, size, step, idx=idx, n=n, inclusive_end=inclusive_end, window_col=window_col)
    exprs = [a.alias(k) for k, a in aggs.items()]
    for out, (c, mode) in labels.items():
        col = F.col(key(c))
        if mode == "last":
            exprs.append(F.max_by(col, F.col(idx)).alias(f"_lbl_{out}"))
        elif mode == "majority":
            exprs.append(F.mode(col, deterministic=True).alias(f"_lbl_{out}"))
        else:
            raise ValueError(f"unknown label mode {mode!r}")
    checks = [(F.min(key(c)) == F.max(key(c))).alias(f"_pure_{c}") for c in purity]
    grouped = members.groupBy(*series, window_col).agg(*exprs, *checks)
    for c in purity:
        grouped = grouped.where(F.col(f"_pure_{c}")).drop(f"_pure_{c}")
    for out, (c, _) in labels.items():
        if c in vocab:
            v, small = vocab[c]
            dec = v.select(F.col(f"_code_{c}").alias(f"_lbl_{out}"), F.col(c).alias(out))
            grouped = grouped.join(_side(dec, small), f"_lbl_{out}", "left").drop(f"_lbl_{out}")
        else:
            grouped = grouped.withColumnRenamed(f"_lbl_{out}", out)
    grouped = grouped.withColumn("start_idx", (F.col(window_col) * step).cast("bigint")).withColumn(
        "end_idx", (F.col(window_col) * step + size - 1).cast("bigint")
    )
    front = [*series, window_col, "start_idx", "end_idx"]
    return grouped.select(*front, *aggs.keys(), *labels.keys())


def tumbling_windows(
    df: DataFrame,
    size: int,
    aggs: Mapping[str, Column],
    series: Sequence[str] = (),
    idx: str = "idx",
    window_col: str = "chunk",
) -> DataFrame:
    """WIN-03: non-overlapping chunks of ``size`` rows; the short tail is dropped.

    No explode is needed: a row belongs to exactly chunk ``idx div size``.
    """
    rows = df.withColumn(window_col, F.floor(F.col(idx) / size).cast("bigint")).withColumn(
        REL, F.col(idx) - F.col(window_col) * size
    )
    grouped = rows.groupBy(*series, window_col).agg(
        *[a.alias(k) for k, a in aggs.items()], F.count(F.lit(1)).alias("_cnt")
    )
    return grouped.where(F.col("_cnt") == size).select(*series, window_col, *aggs.keys())


def align_truth(windows: DataFrame, samples: DataFrame, cols: Sequence[str], idx: str = "idx", end: str = "end_idx", series: Sequence[str] = ()) -> DataFrame:
    """JOI-03: attach sample values at each window's last position (equi-join end_idx = idx)."""
    s = samples.select(*series, F.col(idx).alias(end), *cols)
    return windows.join(s, [*series, end], "left")


def end_time(windows: DataFrame, samples: DataFrame, hz: float, activity: str = "activity", idx: str = "idx", end: str = "end_idx", out: str = "t") -> DataFrame:
    """WIN-05: time of each kept window: position inside its activity at its last sample, by the rate."""
    from myosig.operators.sequence import elapsed_time

    t = elapsed_time(samples.select(idx, activity), hz, activity, (idx,), out)
    return align_truth(windows, t, [out], idx=idx, end=end)


def prediction_time(window: Column, step: int, hz: float) -> Column:
    """WIN-05: the live step clock k * step / hz."""
    return window * F.lit(step) / F.lit(float(hz))
