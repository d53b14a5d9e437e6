"""PRJ-02..22: projection, filtering and schema rules for recordings.

Everything here is a narrow transformation (no shuffle) except the few that need
one scalar from the data (``seek_activity``, ``cap_duration``,
``coerce_numeric``): those run a global aggregate whose result is a single
bounded row, read it on the driver, and continue with a literal predicate --
which Spark can push into the Parquet scan.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must match the source behaviour.
FLOAT32_MAX = 3.4028234663852886e38
FLOAT64_MAX = 1.7976931348623157e308
VARIANT_MARKER = "_"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- PRJ-07/08/09/10/11/12/22
def drop_variants(df: DataFrame, col: str = "activity", how: str = "endswith") -> DataFrame:
    """PRJ-07 (``how='endswith'``) / PRJ-08 (``how='contains'``): drop weighted variants."""
    c = F.col(col)
    if how == "endswith":
        return df.where(~c.endswith(VARIANT_MARKER))
    if how == "contains":
        return df.where(~c.contains(VARIANT_MARKER))
    raise ValueError(f"unknown rule {how!r}")


def merge_variants(df: DataFrame, col: str = "activity") -> DataFrame:
    """PRJ-09: strip trailing markers so variants join their base class."""
    return df.withColumn(col, F.regexp_replace(F.col(col), "_+$", ""))


def keep_activities(df: DataFrame, allowed: Iterable[str], col: str = "activity") -> DataFrame:
    """PRJ-10: keep listed activities (one activity is the same operator)."""
    return df.where(F.col(col).isin(list(allowed)))


def slice_rep(df: DataFrame, activity: str, rep: int, activity_col: str = "activity", rep_col: str = "reps") -> DataFrame:
    """PRJ-11: one repetition of one activity (a conjunctive predicate, pushed to the scan)."""
    return df.where((F.col(activity_col) == activity) & (F.col(rep_col) == rep))


def drop_missing_target(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """PRJ-12: drop rows whose target is NULL or NaN (pandas ``dropna``)."""
    cond = F.lit(True)
    for t in targets:
        c = F.col(t)
        dt = df.schema[t].dataType
        bad = c.isNull() | F.isnan(c) if isinstance(dt, (T.DoubleType, T.FloatType)) else c.isNull()
        cond = cond & ~bad
    return df.where(cond)


def skip_unlabelled(df: DataFrame, label: str = "label") -> DataFrame:
    """PRJ-22: drop windows whose majority label is missing."""
    return df.where(F.col(label).isNotNull())


# ---------------------------------------------------------------- PRJ-13/14
def gait_column(df: DataFrame, candidates: Sequence[str] = ("gait", "gait_pct")) -> str:
    """PRJ-13: the first existing gait column (schema lookup, not ``coalesce``)."""
    lower = {f.name.lower(): f.name for f in df.schema.fields}
    for c in candidates:
        if c.lower() in lower:
            return lower[c.lower()]
    raise ValueError(f"no gait column among {list(candidates)}")


def phase_encode(df: DataFrame, col: str, prefix: str = "phase") -> DataFrame:
    """PRJ-14: circular encoding of a 0-100 % phase."""
    theta = F.col(col) / 100.0 * 2.0 * F.pi()
    return df.withColumn(f"{prefix}_x", F.cos(theta)).withColumn(f"{prefix}_y", F.sin(theta))


# ---------------------------------------------------------------- PRJ-15
def pool_channels(df: DataFrame, col: str, group: int = 16, out: str | None = None, n_channels: int = 64, keep: bool = False) -> DataFrame:
    """PRJ-15: mean of each run of ``group`` neighbouring electrodes (NaN skipped, like pandas);
    the pooled channels go unless ``keep``.

    Higher-order array functions keep this inside whole-stage codegen.
    """
    n_pools = n_channels // group

    def pooled(k):
        part = F.slice(F.col(col), k * group + 1, group)
        valid = F.filter(part, lambda v: ~F.isnan(v) & v.isNotNull())
        total = F.aggregate(valid, F.lit(0.0), lambda s, v: s + v.cast("double"))
        return F.when(F.size(valid) > 0, total / F.size(valid))

    res = df.withColumn(out or f"{col}_pooled", F.array(*[pooled(k) for k in range(n_pools)]))
    return res if keep or out == col else res.drop(col)


# ---------------------------------------------------------------- PRJ-04/05/06/21
def downcast_float(df: DataFrame) -> DataFrame:
    """PRJ-04: every DOUBLE column to FLOAT."""
    return df.select(
        *[
            F.col(f.name).cast("float").alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def nan_to_num(c, max_value: float = FLOAT32_MAX) -> Column:
    """NaN -> 0, +inf -> max, -inf -> -max (numpy ``nan_to_num``)."""
    x = _c(c)
    return (
        F.when(F.isnan(x), F.lit(0.0))
        .when(x == F.lit(float("inf")), F.lit(max_value))
        .when(x == F.lit(float("-inf")), F.lit(-max_value))
        .otherwise(x)
    )


def sanitize(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """PRJ-21: ``nan_to_num`` on float/double columns and float arrays."""
    out = df
    for f in df.schema.fields:
        if cols is not None and f.name not in cols:
            continue
        dt = f.dataType
        if isinstance(dt, T.FloatType):
            out = out.withColumn(f.name, nan_to_num(f.name, FLOAT32_MAX).cast("float"))
        elif isinstance(dt, T.DoubleType):
            out = out.withColumn(f.name, nan_to_num(f.name, FLOAT64_MAX))
        elif isinstance(dt, T.ArrayType) and isinstance(dt.elementType, (T.FloatType, T.DoubleType)):
            mx = FLOAT32_MAX if isinstance(dt.elementType, T.FloatType) else FLOAT64_MAX
            out = out.withColumn(
                f.name, F.transform(F.col(f.name), lambda v: nan_to_num(v, mx).cast(dt.elementType))
            )
    return out


def coerce_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """PRJ-05: cast a text column to DOUBLE only when every non-null value parses.

    One aggregate pass counts the failures of all candidate columns at once.
    """
    cand = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and (cols is None or f.name in cols)]
    if not cand:
        return df
    fails = df.agg(
        *[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).alias(c) for c in cand]
    ).first()
    good = {c for c in cand if fails[c] == 0}
    return df.select(*[F.col(c).cast("double").alias(c) if c in good else F.col(c) for c in df.columns])


def profile_types(df: DataFrame) -> DataFrame:
    """PRJ-06: numeric vs categorical column counts and row count (shape)."""
    numeric = sum(isinstance(f.dataType, T.NumericType) for f in df.schema.fields)
    other = len(df.schema.fields) - numeric
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.schema.fields)).cast("bigint").alias("n_columns"),
        F.lit(numeric).cast("bigint").alias("n_numeric"),
        F.lit(other).cast("bigint").alias("n_categorical"),
    )


# ---------------------------------------------------------------- PRJ-02
def validate_channels(df: DataFrame, expected: dict[str, int], mode: str = "raise") -> DataFrame:
    """PRJ-02: count rows whose channel arrays do not have the expected length.

    Returns one row of counts; with ``mode='raise'`` a non-zero count raises,
    with ``mode='warn'`` it warns, with ``mode='report'`` it is only returned.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.coalesce(F.size(c), F.lit(-1)) != n).cast("bigint").alias(f"bad_{c}") for c, n in expected.items()],
    )
    if mode in ("raise", "warn"):
        row = counts.first()
        bad = {c: row[f"bad_{c}"] for c in expected if row[f"bad_{c}"]}
        if bad and mode == "raise":
            raise ValueError(f"channel count mismatch: {bad}")
        if bad:
            warnings.warn(f"channel count mismatch: {bad}", stacklevel=2)
    return counts


# ---------------------------------------------------------------- PRJ-18
def label_text(c) -> Column:
    """PRJ-18: Python ``str.capitalize`` (first letter upper, rest lower)."""
    x = _c(c)
    return F.concat(F.upper(F.substr(x, F.lit(1), F.lit(1))), F.lower(F.substr(x, F.lit(2))))


def short_joint(c) -> Column:
    """PRJ-18: joint target name -> short label (drop the ``_Target`` suffix)."""
    return F.replace(_c(c), F.lit("_Target"), F.lit(""))


# ---------------------------------------------------------------- PRJ-19/20
def seek_activity(df: DataFrame, name: str, idx: str = "idx", col: str = "activity") -> DataFrame:
    """PRJ-19: rows from the first case-insensitive match of ``name``; no match -> from row 0."""
    start = df.where(F.lower(F.col(col)) == name.lower()).agg(F.min(idx)).first()[0]
    return df.where(F.col(idx) >= F.lit(start if start is not None else 0))


def cap_duration(
    df: DataFrame,
    time_col: str,
    n_act: int = 2,
    seconds: float = 5.0,
    idx: str = "idx",
    col: str = "activity",
) -> DataFrame:
    """PRJ-20: drop rows later than ``seconds`` in the first ``n_act`` activities (first-seen order)."""
    first = (
        df.groupBy(col).agg(F.min(idx).alias("_first")).orderBy("_first").limit(n_act).collect()
    )
    acts = [r[col] for r in first]
    return df.where(~(F.col(col).isin(acts) & (F.col(time_col) > seconds)))


# ---------------------------------------------------------------- PRJ-16/17 (schema only, driver side)
def split_columns(
    df: DataFrame, meta: Sequence[str], targets: Sequence[str] | None = None, target_suffix: str = "_Target"
) -> tuple[list[str], list[str], list[str]]:
    """PRJ-16: (features, targets, metadata) by name; targets default to ``*_Target`` columns.

    Raises when no target or no feature remains, or a requested target is absent.
    """
    cols = list(df.columns)
    tg = list(targets) if targets is not None else [c for c in cols if c.endswith(target_suffix)]
    missing = [t for t in tg if t not in cols]
    if missing:
        raise ValueError(f"targets not found: {missing}")
    if not tg:
        raise ValueError("no target columns")
    md = [c for c in cols if c in set(meta)]
    feats = [c for c in cols if c not in set(tg) and c not in set(md)]
    if not feats:
        raise ValueError("no feature columns")
    return feats, tg, md


def assert_same_columns(train: DataFrame, test: DataFrame) -> None:
    """PRJ-17: train and test must have the same columns (names and types, in order)."""
    a = [(f.name, f.dataType.simpleString()) for f in train.schema.fields]
    b = [(f.name, f.dataType.simpleString()) for f in test.schema.fields]
    if a != b:
        raise ValueError(f"column mismatch: only in train {sorted(set(a) - set(b))}, only in test {sorted(set(b) - set(a))}")
