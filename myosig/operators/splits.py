"""SPL-01..09, JOI-01, JOI-06, JOI-07, AGG-18, AGG-24, SRT-01..06, SET-01.

Splits are expressed as a ``split`` column (one pass, one table) rather than two
materialised frames.  Per-group rankings use the distributed row index, so a
class or activity holding a third of the rows is numbered by many tasks.
Membership tables ((activity, rep) pairs, label maps, class counts) are small
aggregates joined back; a side is broadcast only after its row count has been
checked (``broadcast_if_small``), otherwise the join strategy is left to Spark/AQE.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from myosig.functions import broadcast_if_small
from myosig.operators.index import with_row_index

TRAIN, TEST = "train", "test"


def stable_hash(col: str | Column, seed: int = 0) -> Column:
    """Sortable 128-bit hash of (id, seed) as a hex string: stable under re-execution, another
    order for every seed, and the same in any engine that has md5."""
    c = F.col(col) if isinstance(col, str) else col
    return F.md5(F.concat_ws(":", c.cast("string"), F.lit(str(seed))).cast("binary"))


def _cut(rank: Column, n: Column, ratio: float) -> Column:
    """Python ``int(n * ratio)`` cut: the first floor(n*ratio) ranks are train."""
    return F.when(rank < F.floor(n * F.lit(ratio)), F.lit(TRAIN)).otherwise(F.lit(TEST))


# ---------------------------------------------------------------- SPL-01/02 + JOI-01
def rep_split_table(
    df: DataFrame, ratio: float = 0.8, order: str = "sorted", activity: str = "activity", reps: str = "reps", idx: str = "idx"
) -> DataFrame:
    """(activity, reps, split): per activity the first floor(ratio * n_reps) reps are train.

    ``order='sorted'`` ranks reps by value, ``'first_seen'`` by first appearance (min ``idx``).
    The table has one row per distinct (activity, rep): small by nature.
    """
    if order == "sorted":
        pairs = df.select(activity, reps).distinct()
        by = [reps]
    elif order == "first_seen":
        pairs = df.groupBy(activity, reps).agg(F.min(idx).alias("_seen"))
        by = ["_seen", reps]
    else:
        raise ValueError(order)
    # distributed ranking: an activity with very many reps is still numbered by many tasks
    ranked = with_row_index(pairs, by, series=[activity], name="_rk", count_name="_n")
    return ranked.select(activity, reps, _cut(F.col("_rk"), F.col("_n"), ratio).alias("split"))


def split_by_reps(df: DataFrame, ratio: float = 0.8, order: str = "sorted", activity: str = "activity", reps: str = "reps", idx: str = "idx") -> DataFrame:
    """SPL-01/02: add ``split`` to every row by its (activity, rep)."""
    table = rep_split_table(df, ratio, order, activity, reps, idx)
    t = broadcast_if_small(table.select(F.col(activity).alias("_a"), F.col(reps).alias("_r"), "split"))
    return df.join(t, df[activity].eqNullSafe(F.col("_a")) & df[reps].eqNullSafe(F.col("_r"))).drop("_a", "_r")


def semi_reps(df: DataFrame, pairs: DataFrame, activity: str = "activity", reps: str = "reps") -> DataFrame:
    """JOI-01: rows whose (activity, rep) is in ``pairs`` (left semi join)."""
    return df.join(broadcast_if_small(pairs.select(activity, reps).distinct()), [activity, reps], "left_semi")


def split_distribution(df: DataFrame, activity: str = "activity", reps: str = "reps", split: str = "split") -> DataFrame:
    """AGG-18: distinct reps per activity in each split (pivoted)."""
    g = df.groupBy(activity).pivot(split, [TRAIN, TEST]).agg(F.countDistinct(reps))
    return g.select(
        activity,
        F.coalesce(F.col(TRAIN), F.lit(0)).cast("bigint").alias("train_reps"),
        F.coalesce(F.col(TEST), F.lit(0)).cast("bigint").alias("test_reps"),
    )


def union_splits(parts: Sequence[DataFrame]) -> DataFrame:
    """SET-01: concatenate parts (same columns by name)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- SPL-03 / SRC-05
def split_by_time(
    df: DataFrame, ratio: float = 0.8, gap: int = 410, window: int = 410, idx: str = "idx", n: str = "n_rows", series: Sequence[str] = ()
) -> DataFrame:
    """SPL-03: per series, rows before floor(n*ratio) are train, rows from train_end+gap are test.

    Length guards (the source raises): n >= 3*window, train_end >= window,
    n - test_start >= window.  Rows of a series that fails them get split NULL;
    :func:`split_info` reports the flag per series.
    """
    train_end = F.floor(F.col(n) * F.lit(ratio))
    test_start = train_end + gap
    ok = (F.col(n) >= 3 * window) & (train_end >= window) & (F.col(n) - test_start >= window)
    split = F.when(~ok, F.lit(None)).when(F.col(idx) < train_end, TRAIN).when(F.col(idx) >= test_start, TEST).otherwise(F.lit("gap"))
    return df.withColumn("split", split)


def split_info(df: DataFrame, ratio: float, gap: int, window: int, series: Sequence[str], n: str = "n_rows", step: int = 1) -> DataFrame:
    """SRC-05: one row per series with cut positions, and in ``train_rows`` / ``test_rows`` the
    numbers of feature windows (``window`` samples every ``step``) that each part holds.

    The column names are fixed values: those of the stored split record.
    """
    g = df.groupBy(*series).agg(F.max(n).alias("rows_total"))
    train_end = F.floor(F.col("rows_total") * F.lit(ratio)).cast("bigint")
    test_start = train_end + gap

    def windows(samples: Column) -> Column:
        return F.when(samples >= window, F.floor((samples - window) / F.lit(step)) + 1).otherwise(0).cast("bigint")

    ok = (F.col("rows_total") >= 3 * window) & (train_end >= window) & (F.col("rows_total") - test_start >= window)
    return g.select(
        *series,
        "rows_total",
        F.lit(float(ratio)).alias("train_ratio"),
        F.lit(gap).cast("bigint").alias("gap_samples"),
        train_end.alias("train_end"),
        test_start.cast("bigint").alias("test_start"),
        windows(train_end).alias("train_rows"),
        windows(F.col("rows_total") - test_start).alias("test_rows"),
        ok.alias("valid"),
    )


# ---------------------------------------------------------------- SPL-04/05/06/07/08/09
def split_by_class(df: DataFrame, label: str, order: Sequence[str], ratio: float = 0.8) -> DataFrame:
    """SPL-04: chronological split inside each class (first floor(ratio*n) of the class are train)."""
    r = with_row_index(df, list(order), series=[label], name="_crk", count_name="_cn")
    return r.withColumn("split", _cut(F.col("_crk"), F.col("_cn"), ratio)).drop("_crk", "_cn")


def split_sequential(df: DataFrame, ratio: float = 0.8, idx: str = "idx", n: str = "n_rows") -> DataFrame:
    """SPL-05: first floor(ratio*n) positions train, the rest test."""
    return df.withColumn("split", _cut(F.col(idx), F.col(n), ratio))


def split_stratified(df: DataFrame, id_col: str, label: str, test: float = 0.2, seed: int = 0) -> DataFrame:
    """SPL-06: per class, the ceil(test*n) rows with the smallest stable hash are test (exact counts)."""
    h = df.withColumn("_h", stable_hash(id_col, seed))
    r = with_row_index(h, ["_h", id_col], series=[label], name="_crk", count_name="_cn")
    is_test = F.col("_crk") < F.ceil(F.col("_cn") * F.lit(test))
    return r.withColumn("split", F.when(is_test, TEST).otherwise(TRAIN)).drop("_h", "_crk", "_cn")


def sample_balanced(df: DataFrame, id_col: str, label: str, total: int = 100, seed: int = 0) -> DataFrame:
    """SPL-07: equal quota per class (remainder to the first classes in sorted order),
    capped by availability, chosen by stable hash, then shuffled (``pos``)."""
    classes = df.select(label).distinct()
    k = classes.count()  # number of classes: one scalar
    if k == 0:
        return df.withColumn("pos", F.lit(None).cast("bigint")).limit(0)
    base, rem = divmod(total, k)
    cr = with_row_index(classes, [label], name="_cr")
    quota = cr.select(label, (F.lit(base) + F.when(F.col("_cr") < rem, 1).otherwise(0)).alias("_q"))
    h = df.withColumn("_h", stable_hash(id_col, seed))
    r = with_row_index(h, ["_h", id_col], series=[label], name="_crk")
    picked = r.join(broadcast_if_small(quota), label).where(F.col("_crk") < F.col("_q"))
    # the sample in a second, unrelated stable order
    out = with_row_index(picked.withColumn("_h2", stable_hash(id_col, seed + 1)), ["_h2", id_col], name="pos")
    return out.drop("_h", "_h2", "_crk", "_q")


def sample_rows(df: DataFrame, fraction: float, id_col: str | Column, seed: int = 0) -> DataFrame:
    """SPL-08: Bernoulli sample (approximate count): rows whose hash lies in the first ``fraction``
    of its range, so a re-run task keeps the same rows."""
    if fraction >= 1:
        return df
    return df.where(F.substring(stable_hash(id_col, seed), 1, 8) < F.lit(f"{int(fraction * 2**32):08x}"))


def sample_n(df: DataFrame, n: int, id_col: str, seed: int = 0) -> DataFrame:
    """SPL-08: exactly ``n`` rows -- the smallest stable hashes (per-task top-n, then merge)."""
    return df.orderBy(stable_hash(id_col, seed), id_col).limit(n)


def take_windows(df: DataFrame, n: int, window_col: str = "window_id") -> DataFrame:
    """SPL-09 / SRT-07: first ``n`` windows (or chunks); 0 keeps all."""
    return df if n <= 0 else df.where(F.col(window_col) < n)


def shuffle(df: DataFrame, id_col: str, seed: int = 0) -> DataFrame:
    """SRT-06: stable shuffled order."""
    return df.orderBy(stable_hash(id_col, seed), id_col)


# ---------------------------------------------------------------- AGG-24 / SRT-01/02/04/05
def class_guard(df: DataFrame, label: str, min_count: int = 2) -> DataFrame:
    """AGG-24: drop rows of classes with fewer than ``min_count`` rows."""
    keep = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_count).select(label)
    return df.join(broadcast_if_small(keep), label, "left_semi")


def sorted_distinct(df: DataFrame, col: str) -> DataFrame:
    """SRT-01."""
    return df.select(col).distinct().orderBy(col)


def first_seen_order(df: DataFrame, col: str, idx: str = "idx") -> DataFrame:
    """SRT-02: distinct values in order of first appearance."""
    return df.groupBy(col).agg(F.min(idx).alias("first_idx")).orderBy("first_idx")


def best_of(candidate: str | Column, score: str | Column, order: str | Column) -> Column:
    """SRT-04: candidate with the strictly greatest score; an earlier candidate keeps ties."""
    s = F.col(score) if isinstance(score, str) else score
    o = F.col(order) if isinstance(order, str) else order
    c = F.col(candidate) if isinstance(candidate, str) else candidate
    return F.max_by(c, F.struct(s, -o))


def argmax_class(scores: str | Column) -> Column:
    """SRT-05: 0-based index of the first maximum."""
    s = F.col(scores) if isinstance(scores, str) else scores
    return (F.array_position(s, F.array_max(s)) - 1).cast("int")


# ---------------------------------------------------------------- JOI-06 / JOI-07
def group_folds(df: DataFrame, group: str) -> DataFrame:
    """JOI-06: fold id = rank of the group in sorted order (one fold per group)."""
    g = df.select(group).distinct()
    return with_row_index(g, [group], name="fold").withColumn("fold", F.col("fold").cast("int"))


def leave_one_group_out(df: DataFrame, group: str) -> DataFrame:
    """JOI-06: per fold, its held-out group with test and train row counts (no fold x row join)."""
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("n_test"))
    folds = group_folds(df, group)
    total = F.sum("n_test").over(Window.partitionBy())
    return folds.join(counts, group).select("fold", group, "n_test", (total - F.col("n_test")).alias("n_train"))


def label_map(df: DataFrame, label: str) -> DataFrame:
    """Sorted distinct labels -> dense ids 0..k-1 (one row per label, ranked by the distributed index)."""
    d = df.select(label).distinct()
    return with_row_index(d, [label], name="id").withColumn("id", F.col("id").cast("int"))


def encode_labels(df: DataFrame, mapping: DataFrame, label: str, out: str = "label_id", default: int | None = None) -> DataFrame:
    """JOI-07: label -> id with a left join on the (bounded) label map; unknown -> ``default``."""
    m = broadcast_if_small(mapping.select(F.col(label).alias("_lbl"), F.col("id").alias(out)))
    j = df.join(m, df[label] == m["_lbl"], "left").drop("_lbl")
    if default is not None:
        j = j.withColumn(out, F.coalesce(F.col(out), F.lit(default)))
    return j
