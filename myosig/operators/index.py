"""WIN-01 / WIN-06: dense row positions and neighbour values without a one-task window.

``row_number()`` over the whole frame (or over one hot series) sends every row of
that frame (series) to a single task.  Here positions are built the way a
distributed sort numbers rows:

1. range-partition on ``(series..., order...)`` and sort inside each partition;
2. ``monotonically_increasing_id`` after the sort gives (partition id, local
   position) -- high bits and low 33 bits;
3. per (partition, series) we keep the first local position and the row count,
   a table whose size is bounded by partitions + series;
4. a running sum of those counts per series gives each piece its offset;
5. optionally, lags of some columns: an Arrow pass over each sorted partition,
   then a fix-up of every partition's first rows from a small edge table.

The order key must be total (ties broken by a unique column).  The range
bounds Spark samples depend on the RDD id, so two separately planned branches
would cut the data differently: the range-partitioned frame is therefore
persisted (memory and disk) and both the count branch and the data branch read
that one physical partitioning.  A lost cached block is recomputed from the same
exchange (same partitioner object), so positions stay identical.  ``stable=True``
writes it to the reliable checkpoint folder instead (cuts lineage; survives the
loss of the executors holding the cache).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from myosig.functions import broadcast_if_small

#: Frames that :func:`with_row_index` holds for its lazy results, until :func:`release_caches`.
_HELD: list[DataFrame] = []
_LOCAL_BITS = 33
_LOCAL_MASK = (1 << _LOCAL_BITS) - 1


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def with_row_index(
    df: DataFrame,
    order: Sequence[str | Column],
    series: Sequence[str] = (),
    name: str = "idx",
    count_name: str | None = None,
    num_partitions: int | None = None,
    stable: bool = False,
    lag_cols: Sequence[str] = (),
    lags: int = 1,
) -> DataFrame:
    """Add a dense 0-based position ``name`` in ``order`` (per ``series`` if given).

    ``count_name`` adds the number of rows of the row's series (the whole frame
    when ``series`` is empty), which window bounds need.  ``lag_cols`` adds
    ``<c>_lag1 .. <c>_lag{lags}`` (NULL across a series start) in the same pass:
    see :func:`_local_lags` and :func:`_fix_partition_edges` -- no extra shuffle.
    """
    spark = df.sparkSession
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = _cols(series) + _cols(order)
    ranged = (
        df.repartitionByRange(n_parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_rix_mid", F.monotonically_increasing_id())
        .withColumn("_rix_pid", F.shiftright("_rix_mid", _LOCAL_BITS))
        .withColumn("_rix_loc", F.col("_rix_mid").bitwiseAND(F.lit(_LOCAL_MASK)))
        .drop("_rix_mid")
    )
    lag_cols = list(lag_cols)
    if lag_cols:
        # in-partition lags before persisting: the Arrow pass runs once per partition
        ranged = _local_lags(ranged, lag_cols, lags, list(series))
    if stable:
        ranged = ranged.checkpoint(eager=True)
    else:
        # memory and disk: Spark evicts to disk under memory pressure
        ranged = ranged.persist(StorageLevel.MEMORY_AND_DISK)
        _HELD.append(ranged)

    series = list(series)
    pieces = ranged.groupBy("_rix_pid", *series).agg(
        F.min("_rix_loc").alias("_rix_first"), F.count(F.lit(1)).alias("_rix_n")
    )
    w = Window.partitionBy(*series).orderBy("_rix_pid")
    pieces = pieces.withColumn(
        "_rix_off",
        F.coalesce(F.sum("_rix_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )
    if count_name:
        pieces = pieces.withColumn(count_name, F.sum("_rix_n").over(Window.partitionBy(*series)))
    # null series are series too: keys get names of their own and match null-safe
    names = {s: f"_rix_s{i}" for i, s in enumerate(series)}
    pieces = pieces.select(
        F.col("_rix_pid").alias("_rix_p"), *[F.col(s).alias(n) for s, n in names.items()], "_rix_first", "_rix_off", *([count_name] if count_name else [])
    )
    # one row per partition and series: broadcast after a size check, so the rows stay where they are
    pieces = broadcast_if_small(pieces) if series else F.broadcast(pieces)
    src = _fix_partition_edges(ranged, lag_cols, lags, series) if lag_cols else ranged
    same = F.col("_rix_pid") == F.col("_rix_p")
    for s, n in names.items():
        same = same & F.col(s).eqNullSafe(F.col(n))
    out = src.join(pieces, same, "inner")
    out = out.withColumn(name, (F.col("_rix_loc") - F.col("_rix_first") + F.col("_rix_off")).cast("bigint"))
    return out.drop("_rix_pid", "_rix_loc", "_rix_first", "_rix_off", "_rix_p", *names.values())


def release_caches() -> int:
    """Release the frames held for earlier row indexes (only those; the caller's own caches stay).

    Call it when the results built on them have been written; a result used later is
    still right, it reads its input again.
    """
    n = len(_HELD)
    while _HELD:
        _HELD.pop().unpersist()
    return n


def _local_lags(ranged: DataFrame, cols: list[str], lags: int, series: list[str], suffix: str = "_lag") -> DataFrame:
    """Lags on the range-partitioned, sorted frame without another shuffle (step 1 of 2).

    Inside each partition rows are already in order: an Arrow pass appends the
    lags to the columns as they are (no value is converted, a null stays null),
    carrying the last ``lags`` rows from one batch to the next.  Rows with
    no predecessor in their partition get NULL; :func:`_fix_partition_edges`
    fills them.  A lag is NULL when the previous row belongs to another series.
    """
    added = [(c, k) for c in cols for k in range(1, lags + 1)]
    schema = T.StructType([*ranged.schema.fields, *[T.StructField(f"{c}{suffix}{k}", T.DoubleType()) for c, k in added]])

    def run(batches):
        # the last rows of the batch before, as Arrow columns: values keep their type and nulls
        carry: pa.Table | None = None
        for batch in batches:
            here = pa.Table.from_batches([batch.select([*series, *cols])])
            both = here if carry is None else pa.concat_tables([carry, here])
            m, n = (0 if carry is None else len(carry)), len(batch)
            out = list(batch.columns)
            same = {}
            for k in range(1, lags + 1):
                src = np.arange(m, m + n) - k
                ok = src >= 0
                take = pa.array(np.where(ok, src, 0), pa.int64(), mask=~ok)
                keep = pa.array(ok)
                for s in series:
                    a, b = both[s].take(take).combine_chunks(), batch.column(s)
                    eq = pc.or_kleene(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
                    keep = pc.and_(keep, eq)
                same[k] = (take, keep)
            for c, k in added:
                take, keep = same[k]
                v = both[c].take(take).combine_chunks().cast(pa.float64())
                out.append(pc.if_else(keep, v, pa.scalar(None, pa.float64())))
            yield pa.RecordBatch.from_arrays(out, [*batch.schema.names, *[f"{c}{suffix}{k}" for c, k in added]])
            carry = both.slice(max(0, len(both) - lags)).combine_chunks()

    local = ranged.mapInArrow(run, schema)
    # rows without an in-partition predecessor get NULL, then the fix-up fills them
    local = local.select(
        *[F.col(c) for c in ranged.columns],
        *[F.when(F.col("_rix_loc") >= k, F.col(f"{c}{suffix}{k}")).alias(f"{c}{suffix}{k}") for c in cols for k in range(1, lags + 1)],
    )
    return local


def _fix_partition_edges(ranged: DataFrame, cols: list[str], lags: int, series: list[str], suffix: str = "_lag") -> DataFrame:
    """Step 2 of 2: the first ``lags`` rows of a partition take their predecessors
    from earlier partitions.  The first and last ``lags`` rows of every partition
    form a table of at most 2 x lags x partitions rows; ordered by (partition,
    position) it holds every such predecessor, so one small window gives the
    missing lags, which a broadcast join puts back (the big side is not moved).
    """
    last = ranged.groupBy("_rix_pid").agg(F.max("_rix_loc").alias("_rix_last"))  # one row per partition
    edge = (
        ranged.join(F.broadcast(last), "_rix_pid")
        .where((F.col("_rix_loc") < lags) | (F.col("_rix_loc") > F.col("_rix_last") - lags))
        .select("_rix_pid", "_rix_loc", *series, *cols)
    )
    w = Window.orderBy("_rix_pid", "_rix_loc")  # over the edge table only: <= 2 x lags x partitions rows
    skey = F.struct(*series) if series else F.lit(0)
    fix = edge.withColumn("_rix_skey", skey)
    for c in cols:
        for k in range(1, lags + 1):
            fix = fix.withColumn(
                f"_rix_fix_{c}{k}", F.when(F.lag("_rix_skey", k).over(w) == F.col("_rix_skey"), F.lag(c, k).over(w).cast("double"))
            )
    fix = fix.where(F.col("_rix_loc") < lags).select("_rix_pid", "_rix_loc", *[f"_rix_fix_{c}{k}" for c in cols for k in range(1, lags + 1)])
    j = ranged.join(F.broadcast(fix), ["_rix_pid", "_rix_loc"], "left")
    for c in cols:
        for k in range(1, lags + 1):
            lc = f"{c}{suffix}{k}"
            j = j.withColumn(lc, F.when(F.col("_rix_loc") < k, F.col(f"_rix_fix_{c}{k}")).otherwise(F.col(lc)))
    return j.drop(*[f"_rix_fix_{c}{k}" for c in cols for k in range(1, lags + 1)])


def with_lags(
    df: DataFrame,
    cols: Sequence[str],
    idx: str = "idx",
    series: Sequence[str] = (),
    lags: int = 1,
    block: int = 1 << 16,
    suffix: str = "_lag",
) -> DataFrame:
    """Add ``<c>_lag1 .. <c>_lag{lags}`` (previous rows by ``idx`` within ``series``).

    Rows are grouped into blocks of ``block`` consecutive positions; the last
    ``lags`` rows of each block are copied into the next block as halo rows, so
    a window partitioned by (series, block) sees every predecessor it needs.
    Work per task is bounded by ``block + lags`` rows however skewed a series is.
    """
    series = list(series)
    base = df.withColumn("_blk", F.floor(F.col(idx) / block)).withColumn("_halo", F.lit(False))
    halo = (
        base.where(F.pmod(F.col(idx), F.lit(block)) >= block - lags)
        .withColumn("_blk", F.col("_blk") + 1)
        .withColumn("_halo", F.lit(True))
    )
    u = base.unionByName(halo)
    w = Window.partitionBy(*series, "_blk").orderBy(idx)
    for c in cols:
        for k in range(1, lags + 1):
            prev = F.lag(c, k).over(w)
            # lag must come from position idx-k exactly (gaps never happen for a dense idx).
            u = u.withColumn(f"{c}{suffix}{k}", prev)
    return u.where(~F.col("_halo")).drop("_blk", "_halo")
