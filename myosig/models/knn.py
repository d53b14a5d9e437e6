"""JOI-05, SRT-03, ML-12: exact k nearest neighbours with a pivot index.

The method of block joins pruned by pivots (Lu et al., VLDB 2012):

1. at most ``PIVOTS`` train vectors (the first by a hash of their id) are pivots; every train
   row joins its nearest one.  A pivot's rows are cut by a hash of their id into blocks of at
   most about ``BLOCK_BYTES`` and ``BLOCK_ROWS``; the index is one count and one radius a pivot;
2. every test row first meets the blocks of its nearest pivots that hold ``k`` rows, which
   bounds its k-th distance; the index alone gives another bound, and the smaller one counts;
3. by the triangle inequality a pivot further than that bound plus its radius cannot hold a
   neighbour: the test row is copied to the blocks of the remaining pivots only.

Blocks meet test rows in a shuffle by block: the task holds one block and streams its test
rows.  A block asked for by more than ``CHUNK_ROWS`` test rows is copied once per chunk of
them.  Only k candidates per test row and block are shuffled again.  No vector but the pivots
passes through the driver.

Distances are ranked by a matrix product, and the rows that may be among the k nearest
are measured again by differences, so results and ties do not depend on its rounding.
Rows whose vector is null, empty or holds a null or NaN have and are no neighbours; with no
train rows the result is empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from myosig.functions import broadcast_if_small
from myosig.session import ensure_checkpoint_dir

PIVOTS = 256
BLOCK_BYTES, BLOCK_ROWS, CHUNK_ROWS = 8 << 20, 16_384, 100_000
SUB = 512  # test rows per product (bounds the distance matrix)
#: Relative rounding allowed to a distance from a matrix product before a pivot is skipped.
_SLACK = 1e-6


def _nearest(tid: np.ndarray, tv: np.ndarray, rid: np.ndarray, rv: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(test id, place in rv, squared distance) of the k nearest train rows of every test row; ties: smaller train id."""
    order = np.argsort(rid, kind="stable")
    r, norm = rv[order], (rv[order] ** 2).sum(1)
    kk = min(k, len(r))
    out_t, out_p, out_d = [], [], []
    for s in range(0, len(tv), SUB):
        x = tv[s : s + SUB]
        d = (x**2).sum(1)[:, None] + norm[None, :] - 2 * (x @ r.T)
        far = np.partition(d, kk - 1, axis=1)[:, kk - 1]
        slack = 1e-9 * (1 + (x**2).sum(1) + norm.max())
        for i in range(len(x)):
            near = np.flatnonzero(d[i] <= far[i] + slack[i])
            exact = ((x[i] - r[near]) ** 2).sum(1)
            best = np.argsort(exact, kind="stable")[:kk]
            out_t.append(np.full(len(best), tid[s + i]))
            out_p.append(order[near[best]])
            out_d.append(exact[best])
    return np.concatenate(out_t), np.concatenate(out_p), np.concatenate(out_d)


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sound(v: Column) -> Column:
    return v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda c: c.isNull() | F.isnan(c))


class _Index:
    """Pivots with their rows, radii and numbers of blocks; what tasks need to place and prune rows."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = np.unique(pivots, axis=0)
        self.norms = (self.pivots**2).sum(1)

    def distances(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum((x**2).sum(1)[:, None] + self.norms - 2 * (x @ self.pivots.T), 0.0))

    def measure(self, rows: dict[int, tuple[int, float]], block_rows: int) -> None:
        """``rows``: {pivot: (train rows, radius)}."""
        n = len(self.pivots)
        self.count = np.array([rows.get(p, (0, 0.0))[0] for p in range(n)])
        self.radius = np.array([rows.get(p, (0, 0.0))[1] for p in range(n)])
        self.blocks = -(-self.count // block_rows)
        self.first = np.concatenate([[0], np.cumsum(self.blocks)])

    def all_of(self, pivots: np.ndarray) -> list[int]:
        return [b for p in pivots for b in range(self.first[p], self.first[p + 1])]

    def home(self, d: np.ndarray, k: int) -> list[int]:
        """Blocks of the nearest pivots that hold ``k`` rows; one block of a pivot with several."""
        out, held = [], 0
        for p in np.argsort(d, kind="stable"):
            if self.count[p]:
                out.append(int(self.first[p]))
                held += self.count[p] // self.blocks[p]
            if held >= k:
                break
        return out

    def bound(self, d: np.ndarray, k: int) -> float:
        """No k-th neighbour is further than this, by the index alone."""
        reach = np.where(self.count > 0, d + self.radius, np.inf)
        order = np.argsort(reach)
        enough = np.flatnonzero(np.cumsum(self.count[order]) >= k)
        return float(reach[order[enough[0]]]) if len(enough) else math.inf

    def near(self, x: np.ndarray, d: np.ndarray, bound: float) -> np.ndarray:
        slack = _SLACK * (1 + math.sqrt((x**2).sum()) + math.sqrt(self.norms.max()) + self.radius)
        return np.flatnonzero((self.count > 0) & (d - self.radius <= bound + slack))


def _meet(wanted: DataFrame, placed: DataFrame, k: int, lbl: str, stats: dict | None) -> DataFrame:
    """(tid, rid, lbl, dist2): the k nearest rows of each block for the test rows (id, v, block) that ask for it."""
    asked = wanted.groupBy("block").agg(F.count(F.lit(1)).alias("rows"))
    asked = asked.select("block", "rows", F.ceil(F.col("rows") / CHUNK_ROWS).cast("int").alias("chunks")).checkpoint()
    side = broadcast_if_small(asked)
    if stats is not None:
        sizes = placed.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
        stats["measured"] = stats.get("measured", 0) + (sizes.join(side, "block").agg(F.sum(F.col("n") * F.col("rows"))).first()[0] or 0)
    test = wanted.join(side, "block").select("block", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int").alias("chunk"), F.lit(1).alias("side"), "id", "v", F.lit(None).cast(lbl).alias("lbl"))
    chunks = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    train = placed.join(side, "block").select("block", chunks.alias("chunk"), F.lit(0).alias("side"), "id", "v", "lbl")
    both = train.unionByName(test).repartition("block", "chunk").sortWithinPartitions("block", "chunk", "side", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, ready = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            marks = np.stack([b.column(i).to_numpy() for i in range(3)], axis=1)
            starts = np.concatenate([[0], np.flatnonzero((marks[1:] != marks[:-1]).any(1)) + 1, [len(marks)]])
            for start, end in zip(starts[:-1], starts[1:]):
                block, chunk, from_test = marks[start].tolist()
                if (block, chunk) != key:
                    key, held, ready = (block, chunk), [], None
                ids, v, names = b.column(3)[start : end], b.column(4)[start : end], b.column(5)[start : end]
                if not from_test:
                    held.append((ids.to_numpy(), _vectors(v), names))
                    continue
                if ready is None:
                    ready = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), pa.concat_arrays([h[2] for h in held])
                    held = []
                t, place, d = _nearest(ids.to_numpy(), _vectors(v), ready[0], ready[1], k)
                yield pa.RecordBatch.from_arrays([pa.array(t, pa.int64()), pa.array(ready[0][place], pa.int64()), ready[2].take(pa.array(place)), pa.array(d, pa.float64())], ["tid", "rid", "lbl", "dist2"])

    return both.mapInArrow(run, f"tid bigint, rid bigint, lbl {lbl}, dist2 double")


def knn_topk(
    test: DataFrame,
    train: DataFrame,
    k: int,
    test_id: str = "test_id",
    train_id: str = "train_id",
    vec: str = "vec",
    label: str = "label",
    block_bytes: int = BLOCK_BYTES,
    stats: dict | None = None,
) -> DataFrame:
    """(test_id, train_id, label, dist2, rank) for the k nearest train rows (ties: smaller train_id).

    ``stats`` receives the number of ``pairs`` of rows and how many were ``measured``.
    """
    ensure_checkpoint_dir(test.sparkSession)
    v = F.col(vec).cast("array<double>")
    te = test.where(_sound(v)).select(F.col(test_id).cast("bigint").alias("id"), v.alias("v"))
    tr = train.where(_sound(v)).select(F.col(train_id).cast("bigint").alias("id"), v.alias("v"), F.col(label).alias("lbl"))
    lbl = tr.schema["lbl"].dataType.simpleString()
    n = tr.count()
    pivots = tr.orderBy(F.xxhash64("id"), "id").limit(min(PIVOTS, math.isqrt(n) + 1)).select("v").collect()  # at most PIVOTS vectors
    if not pivots:
        return test.sparkSession.createDataFrame([], f"{test_id} bigint, {train_id} bigint, {label} {lbl}, dist2 double, rank int")
    index = _Index(np.array([r.v for r in pivots]))

    def place(batches):
        for b in batches:
            if b.num_rows:
                d = index.distances(_vectors(b.column(1)))
                at = d.argmin(1)
                cols = [*b.columns, pa.array(at.astype(np.int32)), pa.array(d[np.arange(len(at)), at])]
                yield pa.RecordBatch.from_arrays(cols, ["id", "v", "lbl", "pivot", "far"])

    placed = tr.mapInArrow(place, f"id bigint, v array<double>, lbl {lbl}, pivot int, far double").checkpoint()
    rows = placed.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("r")).collect()  # one row a pivot
    index.measure({r.pivot: (r.n, r.r) for r in rows}, max(1, min(BLOCK_ROWS, block_bytes // (8 * index.pivots.shape[1]))))
    own = F.get(F.array(*map(F.lit, index.blocks.tolist())), F.col("pivot"))
    first = F.get(F.array(*map(F.lit, index.first.tolist())), F.col("pivot"))
    placed = placed.select("id", "v", "lbl", (first + F.pmod(F.xxhash64("id", F.lit(1)), own)).cast("int").alias("block"))

    def homes(batches):
        for b in batches:
            if b.num_rows:
                d = index.distances(_vectors(b.column(1)))
                blocks = pa.array([index.home(one, k) for one in d], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*b.columns, blocks, pa.array([index.bound(one, k) for one in d], pa.float64())], ["id", "v", "blocks", "bound"])

    def others(batches):
        for b in batches:
            if b.num_rows:
                x, seen, bound = _vectors(b.column(1)), b.column(2).to_pylist(), b.column(3).to_numpy()
                d = index.distances(x)
                left = [sorted(set(index.all_of(index.near(x[i], d[i], bound[i]))) - set(seen[i])) for i in range(len(x))]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(left, pa.list_(pa.int32()))], ["id", "v", "blocks"])

    asking = te.mapInArrow(homes, "id bigint, v array<double>, blocks array<int>, bound double").checkpoint()
    if stats is not None:
        stats["pairs"], stats["measured"] = n * asking.count(), 0
    near = _meet(asking.select("id", "v", F.explode("blocks").alias("block")), placed, k, lbl, stats).checkpoint()
    kth = near.groupBy("tid").agg(F.get(F.sort_array(F.collect_list("dist2")), F.lit(k - 1)).alias("kth"))  # k rows a home block
    known = asking.join(kth, F.col("id") == F.col("tid"), "left")
    known = known.select("id", "v", "blocks", F.least("bound", F.coalesce(F.sqrt("kth"), F.lit(math.inf))).alias("bound"))
    more = known.mapInArrow(others, "id bigint, v array<double>, blocks array<int>").select("id", "v", F.explode("blocks").alias("block")).checkpoint()
    cand = near.unionByName(_meet(more, placed, k, lbl, stats))
    w = Window.partitionBy("tid").orderBy("dist2", "rid")
    top = cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return top.select(F.col("tid").alias(test_id), F.col("rid").alias(train_id), F.col("lbl").alias(label), "dist2", "rank")


def best_k(votes: DataFrame, truth: str, k: str = "k", pred: str = "pred") -> DataFrame:
    """ML-12: accuracy of every k, best first (ties: the smaller k)."""
    hit = (F.col(pred).eqNullSafe(F.col(truth))).cast("double")
    return votes.groupBy(k).agg(F.avg(hit).alias("accuracy")).orderBy(F.desc("accuracy"), k)


def knn_vote(top: DataFrame, ks: list[int], test_id: str = "test_id", label: str = "label") -> DataFrame:
    """SRT-03: majority label among the k nearest, for several k from one top-max(k) table."""
    exp = top.withColumn("k", F.explode(F.array(*[F.lit(k) for k in ks]))).where(F.col("rank") <= F.col("k"))
    return exp.groupBy(test_id, "k").agg(F.mode(label, deterministic=True).alias("pred"))
