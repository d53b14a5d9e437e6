"""ML-03 (joint form): multi-output regression forests grown level by level on Spark.

Every tree shares one structure for all targets, as the source's forests do.
Growth follows the histogram method of distributed tree learners (PLANET,
Panda et al., VLDB 2009; Spark's own tree learner works the same way):

1. candidate thresholds per feature from ``approxQuantile`` (``bins - 1`` edges);
   a row's bin is the number of edges below its value, so ``x <= edge_j`` is
   ``bin <= j`` and the tree keeps the usual "``<=`` goes left" rule;
2. rows are kept once, as blocks of one byte a feature, their targets and a hash
   of their id; bootstrap weights per (row, tree) are Poisson(1) draws from that
   hash -- deterministic on re-execution, no sampling pass;
3. per level every task adds its rows to one dense array (node, feature, bin,
   [weight, weighted targets]) with numpy: no row is copied per tree or feature,
   and a row's node is found by walking the grown trees, so nothing is rewritten
   between levels and a lost executor costs its blocks only.  Nodes are dealt to
   passes so that a task's array stays within ``HIST_BYTES``;
4. the arrays are added per (tree, node) after a shuffle, in the order of their
   tasks, so results do not depend on arrival; where they meet, the split with the
   largest summed variance reduction over all targets is chosen (``min_leaf`` on
   the weighted count; ties: the first feature, the lowest edge).  One row a
   frontier node comes back, with both children's sums, so leaves need no pass.

The result is a node table for :mod:`myosig.models.trees` (``value`` holds the
per-target leaf means), scored with :func:`trees.score_forest` or
:func:`trees.forest_expr`.  Like Spark's forests it bins features, so trees are
not identical to exhaustive-split trees; quality is the goal.

Rows with a null or NaN in a feature or target are left out; without rows every
tree is one leaf of zeros.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from myosig.models import trees as tr
from myosig.models.boosting import Tree

#: Bytes of histograms that a task holds in one pass, that a reducer reads, and of rows kept a partition.
HIST_BYTES, REDUCE_BYTES, PARTITION_BYTES = 64 << 20, 32 << 20, 16 << 20
_POISSON = np.cumsum([math.exp(-1.0) / math.factorial(k) for k in range(12)])
_LEAST_GAIN = 1e-12


def _weights(h: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Poisson(1) draws from the rows' hashes (inverse distribution of a mixed 53-bit uniform)."""
    step = ((tree + 1) * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF
    z = h.view(np.uint64) + np.uint64(step)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    u = ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / float(1 << 53)
    return np.searchsorted(_POISSON, u, side="right").astype(float)


def _packed(edges: list[np.ndarray], t: int) -> Callable:
    """Rows of (hash, features, targets) to blocks of (codes, targets, hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            codes = np.stack([np.searchsorted(e, x) for e, x in zip(edges, cols[1:])], axis=1).astype(np.uint8)
            values = [codes.tobytes(), np.stack(cols[-t:], axis=1).tobytes(), cols[0].astype(np.int64).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in values], names=["codes", "y", "h"])

    return run


def _add(hist: np.ndarray, codes: np.ndarray, slot: np.ndarray, w: np.ndarray, y: np.ndarray) -> None:
    """Add rows to (node, feature, bin, [weight, weighted targets]); ``slot`` is their node's place or -1."""
    here = (slot >= 0) & (w > 0)
    nodes, d, bins, _ = hist.shape
    slot, w, codes = slot[here], w[here], codes[here]
    parts = [w, *(w[:, None] * y[here]).T]
    for f in range(d):
        key = slot * bins + codes[:, f]
        for j, v in enumerate(parts):
            hist[:, f, :, j] += np.bincount(key, v, nodes * bins).reshape(nodes, bins)


def best_split(hist: np.ndarray, min_leaf: float) -> tuple[float, int, int, np.ndarray, np.ndarray]:
    """(gain, feature, bin, left sums, all sums) of one node's (feature, bin, [weight, weighted targets])."""
    total = hist[0].sum(0)
    left = np.cumsum(hist, axis=1)[:, :-1]
    right = total - left
    with np.errstate(divide="ignore", invalid="ignore"):
        # SSE = sum(w y^2) - (sum w y)^2 / sum w; the sum(w y^2) terms cancel in the gain
        gain = ((left[..., 1:] ** 2).sum(-1) / left[..., 0]) + ((right[..., 1:] ** 2).sum(-1) / right[..., 0]) - (total[1:] ** 2).sum() / total[0]
    gain = np.where(np.minimum(left[..., 0], right[..., 0]) >= min_leaf, gain, -np.inf)
    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
    return float(gain[f, b]), int(f), int(b), left[f, b], total


def _level(blocks: DataFrame, tasks: int, forest: list[Tree], nodes: list[tuple[int, int]], shape: tuple[int, int, int], seed: int | None, min_leaf: float) -> dict:
    """{(tree, node): best split} of the frontier ``nodes`` (one pass over the blocks)."""
    d, bins, t = shape
    own: dict[int, list[int]] = {}
    for k, node in nodes:
        own.setdefault(k, []).append(node)
    grown = {k: forest[k] for k in own}
    width = d * bins * (1 + t) * 8

    def count(batches):
        hists = {k: np.zeros((len(at), d, bins, 1 + t)) for k, at in own.items()}
        for b in batches:
            for codes, y, h in zip(*(c.to_pylist() for c in b.columns)):
                h = np.frombuffer(h, np.int64)
                codes, y = np.frombuffer(codes, np.uint8).reshape(len(h), d), np.frombuffer(y).reshape(len(h), t)
                for k, at in own.items():
                    slots = np.full(len(grown[k].feature), -1)
                    slots[at] = np.arange(len(at))
                    w = np.ones(len(h)) if seed is None else _weights(h, k, seed)
                    _add(hists[k], codes, slots[grown[k].nodes(codes)], w, y)
        part = TaskContext.get().partitionId()
        for k, at in own.items():
            found = np.flatnonzero(hists[k][:, 0, :, 0].sum(1) > 0)
            for i in range(0, len(found), step := max(1, REDUCE_BYTES // 4 // width)):
                some = found[i : i + step]
                data = [[k] * len(some), [at[n] for n in some], [part] * len(some), [hists[k][n].tobytes() for n in some]]
                yield pa.RecordBatch.from_arrays([pa.array(v, a) for v, a in zip(data, (pa.int32(), pa.int32(), pa.int32(), pa.binary()))], names=["tree", "node", "part", "hist"])

    def choose(batches):
        def result(key, hist):
            gain, f, b, left, total = best_split(hist.reshape(d, bins, 1 + t), min_leaf)
            return {"tree": key[0], "node": key[1], "gain": gain, "f": f, "b": b, "lhs": left.tolist(), "whole": total.tolist()}

        key, hist, out = None, None, []
        for b in batches:
            for k, node, more in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3)):
                if (k, node) != key:
                    if key is not None:
                        out.append(result(key, hist))
                    key, hist = (k, node), np.zeros(d * bins * (1 + t))
                hist += np.frombuffer(more.as_buffer())
        if key is not None:
            out.append(result(key, hist))
            yield pa.RecordBatch.from_pylist(out, pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("gain", pa.float64()), ("f", pa.int32()), ("b", pa.int32()), ("lhs", pa.list_(pa.float64())), ("whole", pa.list_(pa.float64()))]))

    reducers = min(len(nodes), math.ceil(tasks * len(nodes) * width / REDUCE_BYTES))
    sums = blocks.mapInArrow(count, "tree int, node int, part int, hist binary").repartition(reducers, "tree", "node").sortWithinPartitions("tree", "node", "part")
    found = sums.mapInArrow(choose, "tree int, node int, gain double, f int, b int, lhs array<double>, whole array<double>").collect()  # one row a node
    return {(r.tree, r.node): (r.gain, r.f, r.b, np.array(r.lhs), np.array(r.whole)) for r in found}


def fit_multi_forest(
    df: DataFrame,
    features: Sequence[str],
    targets: Sequence[str],
    id_col: str,
    trees: int = 10,
    depth: int = 5,
    min_leaf: int = 10,
    bins: int = 32,
    seed: int = 42,
    bootstrap: bool = True,
) -> list[tr.Node]:
    """Grow a joint multi-output regression forest; returns its node list."""
    if min_leaf < 1:
        raise ValueError("min_leaf must be >= 1")
    if not 2 <= bins <= 256:
        raise ValueError("bins must be 2 to 256")
    d, t = len(features), len(targets)
    x, y = [f"_x{i}" for i in range(d)], [f"_y{j}" for j in range(t)]
    data = df.select(F.xxhash64(F.col(id_col)).alias("_h"), *[F.col(c).cast("double").alias(a) for c, a in zip([*features, *targets], x + y)]).dropna()
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    edges = [np.array(sorted(set(e))) for e in data.approxQuantile(x, [(j + 1) / bins for j in range(bins - 1)], 0.001)]
    blocks = data.mapInArrow(_packed(edges, t), "codes binary, y binary, h binary").persist(StorageLevel.MEMORY_AND_DISK)
    size = blocks.agg(F.sum(F.octet_length("codes") + F.octet_length("y") + F.octet_length("h"))).first()[0] or 0
    data.unpersist()
    tasks = max(1, math.ceil(size / PARTITION_BYTES))

    forest = [Tree(value=[np.zeros(t)]) for _ in range(trees)]
    frontier = [(k, 0) for k in range(trees)] if size else []
    at_once = max(1, HIST_BYTES // (d * bins * (1 + t) * 8))
    for level in range(max(1, depth)):
        found = {}
        for i in range(0, len(frontier), at_once):
            found |= _level(blocks.coalesce(tasks), tasks, forest, frontier[i : i + at_once], (d, bins, t), seed if bootstrap else None, min_leaf)
        frontier = []
        for (k, node), (gain, f, b, left, whole) in sorted(found.items()):
            tree = forest[k]
            tree.value[node] = whole[1:] / whole[0]
            if level >= depth or gain <= _LEAST_GAIN or b >= len(edges[f]):
                continue
            tree.feature[node], tree.bin[node], tree.child[node] = f, b, len(tree.feature)
            for side in (left, whole - left):
                frontier.append((k, len(tree.feature)))
                tree.feature.append(-1)
                tree.bin.append(0)
                tree.child.append(0)
                tree.value.append(side[1:] / side[0])
        if not frontier:
            break
    blocks.unpersist()
    return [
        tr.leaf(k, n, value.tolist()) if f < 0 else tr.Node(k, n, f, float(edges[f][b]), c, c + 1, tuple(value.tolist()))
        for k, tree in enumerate(forest)
        for n, (f, b, c, value) in enumerate(zip(tree.feature, tree.bin, tree.child, tree.value))
    ]
