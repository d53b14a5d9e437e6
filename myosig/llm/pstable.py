"""Embedding near-duplicates by Euclidean p-stable hashing (operator 12).

Vectors of equal label (and length) are linked if their cosine is ``THRESHOLD`` or more.

Search: vectors are normalised, so a cosine is a distance; a table quantises ``bits`` random
Gaussian projections in steps of ``WIDTH`` (each moved by a random offset), and vectors that agree
in all of them share a bucket.  ``shape`` chooses the projections per table so that a bucket holds
about one unrelated vector of the largest label, and the tables so that a pair exactly at the
threshold meets in one with probability ``TARGET_RECALL``; closer pairs meet more surely.  Both
follow from the collision probability of the hash, for every size.  Buckets are first read with
a sketch of 64 signs per vector; only vectors whose sketch is close to another of the bucket are
moved.  Cosines within a bucket are exact, and what comes out is a spanning forest of its
links, not its pairs.

Counts: the forests' components are the near-duplicate classes.  Within a component all cosines are
computed again, so links that no bucket found are found here.  ``_compare`` does both steps.
A group of at most ``GROUP`` vectors is one task's matrix product.  In a larger one, vectors
within half the threshold's angle of the group's mean direction are linked to each other by
the triangle inequality, without a product; only the others are compared with the whole group, in pairs
of blocks.  So a large group of tight copies costs its size, and a loose one its size times
the vectors outside that cap over a block.

Equal vectors of a label are folded by a pre-aggregated group-by before any comparison.

Result: a row per vector: vec_id, n_links (other vectors linked directly), component_id (least
vec_id reachable), kept (vec_id = component_id).

Edge cases: vectors that are null, empty, zero or hold null or non-finite components, and those
without a label, link with nothing; vectors of different length neither; rows that repeat (also
in vec_id) are vectors of their own, so each counts as the others' link; a null vec_id counts
as a vector but names no component, and is kept only if its component has no id; cosines within
1e-9 of the threshold are computed again in exactly rounded sums, so both directions agree; components of any
size (1e300 or 1e-300) are scaled first; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from myosig.functions import broadcast_if_small
from myosig.llm.common import written
from myosig.llm.components import components

THRESHOLD = 0.93
WIDTH = 2.0
TARGET_RECALL = 0.9999
#: Vectors that one task compares with each other at a time, and a block of larger groups.
GROUP = 4096
BLOCK = 2048
_CHUNK = 512
#: Signs of as many random projections as a long has bits; vectors of a bucket that differ in more than
#: ``FAR_BITS`` are not compared.  A pair at the threshold differs in more with probability 1e-6.
FAR_BITS = 22
_CLOSE = 1e-9
SEED = 12


def collision(cosine: float, width: float = WIDTH) -> float:
    """Probability that one quantised projection of two unit vectors agrees."""
    r = width / math.sqrt(2 - 2 * cosine)
    return math.erf(r / math.sqrt(2)) - math.sqrt(2 / math.pi) / r * (1 - math.exp(-r * r / 2))


def shape(n: int, target: float = TARGET_RECALL) -> tuple[int, int]:
    """(projections per table, tables) for labels of at most ``n`` vectors."""
    bits = max(1, math.ceil(math.log(max(2, n)) / -math.log(collision(0.0))))
    return bits, math.ceil(math.log(1 - target) / math.log(1 - collision(THRESHOLD) ** bits))


def _projections(dim: int, bits: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, dim])
    return rng.normal(size=(dim, bits * tables)), rng.uniform(0, WIDTH, bits * tables)


_VECTOR = pa.schema([("vec_id", pa.int64()), ("node", pa.binary()), ("label", pa.int64()), ("vec", pa.binary())])


def _vector_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, embedding) as float64 bytes, scaled by a power of two; node (a hash of label and vector) is null for those that link with nothing."""
    for b in batches:
        for at in range(0, len(b), 2000):
            part = b.slice(at, 2000)
            labels = part.column(1).to_pylist()
            lists = part.column(2)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False)  # a null component becomes NaN
            nodes, vecs, start = [], [], 0
            for label, size in zip(labels, sizes.tolist()):
                v = flat[start : start + size]
                start += size
                top = float(np.abs(v).max()) if size else 0.0
                if label is None or not 0 < top < math.inf:
                    nodes.append(None)
                    vecs.append(None)
                    continue
                # -0.0 + 0.0 is 0.0: equal vectors have equal bytes
                data = (np.ldexp(v, -math.frexp(top)[1]) + 0.0).tobytes()
                nodes.append(hashlib.blake2b(f"{label}:".encode() + data, digest_size=16).digest())
                vecs.append(data)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(nodes, pa.binary()), part.column(1), pa.array(vecs, pa.binary())], schema=_VECTOR)


def _matrix(vecs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vecs), np.float64).reshape(len(vecs), -1)


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.linalg.norm(m, axis=1, keepdims=True)


_BUCKET = np.dtype([("label", "<i8"), ("dim", "<u4"), ("key", "<u8")])


def _key_batches(bits: int, tables: int):
    """(node, sketch, keys): the signs of 64 projections and the bucket of every vector in each table."""
    made: dict[int, tuple] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 1000):
                part = b.slice(at, 1000)
                vecs, labels = part.column(2).to_pylist(), np.array(part.column(1).to_pylist(), np.int64)
                size = np.array([len(v) for v in vecs])
                for s in np.unique(size):
                    own = np.flatnonzero(size == s)
                    dim = int(s) // 8
                    if dim not in made:
                        made[dim] = *_projections(dim, bits, tables), np.random.default_rng([SEED, dim, 64]).normal(size=(dim, 64))
                    a, offset, planes = made[dim]
                    unit = _unit(_matrix([vecs[i] for i in own]))
                    sketch = np.packbits(unit @ planes > 0, axis=1).view(np.int64)[:, 0]
                    steps = np.floor((unit @ a + offset) / WIDTH).astype(np.int64).astype(np.uint64).reshape(len(own), tables, bits)
                    key = np.tile(np.arange(1, tables + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), (len(own), 1))
                    for k in range(bits):
                        key = (key ^ steps[:, :, k]) * np.uint64(0xBF58476D1CE4E5B9)
                        key ^= key >> np.uint64(29)
                    # label and length stand in the name, so a chance collision of hashes never mixes them
                    name = np.empty(key.shape, _BUCKET)
                    name["label"], name["dim"], name["key"] = labels[own][:, None], dim, key
                    names = pa.Array.from_buffers(pa.binary(_BUCKET.itemsize), name.size, [None, pa.py_buffer(name.tobytes())]).cast(pa.binary())
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(own) + 1) * tables, tables), pa.int32()), names)
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(own)), pa.array(sketch), lists], names=["node", "sketch", "keys"])

    return run


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (group, n, node, sketch) sorted by group, those whose sketch is close to another one of the bucket."""
    held = None
    for b in batches:
        held = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
        name = np.frombuffer(b"".join(held["group"].to_pylist()), _BUCKET)
        new = np.flatnonzero(np.r_[True, name[1:] != name[:-1]])
        # the last bucket may go on in the next batch
        yield from _close_rows(held.slice(0, new[-1]), np.repeat(np.arange(len(new)), np.diff(np.r_[new, len(name)]))[: new[-1]])
        held = held.slice(new[-1])
    if held is not None:
        yield from _close_rows(held, np.zeros(len(held), np.int64))


def _close_rows(rows: pa.Table, bucket: np.ndarray) -> Iterator[pa.RecordBatch]:
    sketch, kept = rows["sketch"].to_numpy().view(np.uint64), np.zeros(len(rows), bool)
    for step in range(1, len(rows)):
        pair = np.flatnonzero(bucket[step:] == bucket[:-step])
        if not len(pair):
            break
        pair = pair[np.bitwise_count(sketch[pair] ^ sketch[pair + step]) <= FAR_BITS]
        kept[pair] = kept[pair + step] = True
    if kept.any():
        yield from rows.select(["group", "n", "node"]).filter(pa.array(kept)).combine_chunks().to_batches()


def _exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    dot, aa, bb = (math.fsum((x * y).tolist()) for x, y in ((a, b), (a, a), (b, b)))
    return dot / math.sqrt(aa * bb)


def linked(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which rows of the two matrices are linked (a row with itself or its equal, too)."""
    u, v = _unit(left), _unit(right)
    out = np.empty((len(u), len(v)), bool)
    for at in range(0, len(u), _CHUNK):
        cos = u[at : at + _CHUNK] @ v.T
        out[at : at + _CHUNK] = cos >= THRESHOLD
        for i, j in zip(*np.nonzero(np.abs(cos - THRESHOLD) < _CLOSE)):
            out[at + i, j] = _exact_cosine(left[at + i], right[j]) >= THRESHOLD
    return out


def _forest(adjacent: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of a symmetric boolean matrix."""
    left, out = np.ones(len(adjacent), bool), []
    for root in range(len(adjacent)):
        if not left[root]:
            continue
        left[root] = False
        todo = [root]
        while todo:
            i = todo.pop()
            new = np.flatnonzero(adjacent[i] & left).tolist()
            left[new] = False
            todo += new
            out += [(i, j) for j in new]
    return out


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """(key, rows) of rows sorted by their first ``keys`` columns."""
    key, held = None, []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if row[:keys] != key:
                if held:
                    yield key, held
                key, held = row[:keys], []
            held.append(row[keys:])
    if held:
        yield key, held


_FOUND = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("links", pa.int64())])
_FOUND_DDL = "a binary, b binary, links long"


def _found(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for row in rows:
        out.append(row)
        if len(out) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _FOUND)], schema=_FOUND)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _FOUND)], schema=_FOUND)


def _counts(names: list, links: np.ndarray) -> Iterator[tuple]:
    return ((names[i], None, int(links[i])) for i in np.flatnonzero(links))


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links and forest of groups (group; node, copies, vec)."""

    def rows():
        for _, members in _groups(batches, 1):
            names, copies, vecs = zip(*members)
            if len(names) > 1:
                m = _matrix(vecs)
                adjacent = linked(m, m)
                np.fill_diagonal(adjacent, False)
                yield from _counts(names, adjacent @ np.array(copies, np.int64))
                yield from ((names[i], names[j], 0) for i, j in _forest(adjacent))

    return _found(rows())


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the outer vectors (side 0) of a block and a block of the whole group (side 1): rows (group, i, j; side, node, inner, copies, vec)."""

    def rows():
        for _, members in _groups(batches, 3):
            left, right = ([r[1:] for r in members if r[0] == side] for side in (0, 1))
            if left and right:
                (l_names, _, _, l_vecs), (r_names, r_inner, r_copies, r_vecs) = zip(*left), zip(*right)
                adjacent = linked(_matrix(l_vecs), _matrix(r_vecs))
                adjacent &= np.array(l_names, object)[:, None] != np.array(r_names, object)[None, :]
                yield from _counts(l_names, adjacent @ np.array(r_copies, np.int64))
                # two outer vectors count each other from the left, an inner one counts the outer ones here
                own = np.array([r[2] for r in left], np.int64)
                yield from _counts(r_names, (own @ adjacent) * np.array(r_inner, bool))
                both = np.zeros((len(left) + len(right),) * 2, bool)
                both[: len(left), len(left) :] = adjacent
                both[len(left) :, : len(left)] = adjacent.T
                names = [*l_names, *r_names]
                yield from ((names[i], names[j], 0) for i, j in _forest(both))

    return _found(rows())


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of the unit vectors (group; vec) of each group among a task's rows."""
    total: dict[bytes, np.ndarray] = {}
    for b in batches:
        for group, vec in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            u = _unit(np.frombuffer(vec, np.float64)[None])[0]
            total[group] = total[group] + u if group in total else u
        if len(total) > 20_000:
            yield _sum_record(total)
            total = {}
    if total:
        yield _sum_record(total)


def _sum_record(total: dict[bytes, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["group", "pivot"])


def _add_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per group from the tasks' sums, sorted by group."""
    for (group,), rows in _groups(batches, 1):
        yield _sum_record({group: np.sum([np.frombuffer(r[0], np.float64) for r in rows], axis=0)})


def _inner_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (group, n, node, copies, vec, pivot), the pivot replaced by whether the vector lies in the cap around it."""
    half = math.acos(THRESHOLD) / 2 - 1e-6  # two of the cap are linked, rounding included
    for b in batches:
        inner = []
        for vec, pivot in zip(b.column(4).to_pylist(), b.column(5).to_pylist()):
            v, p = np.frombuffer(vec, np.float64), np.frombuffer(pivot, np.float64)
            length = np.linalg.norm(v) * np.linalg.norm(p)
            inner.append(bool(length > 0 and v @ p >= math.cos(half) * length))
        yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(inner, pa.bool_())], names=["group", "n", "node", "copies", "vec", "inner"])


def _compare(rows: DataFrame, limit: int = GROUP, block: int = BLOCK) -> DataFrame:
    """Rows (group, n, node, copies, vec), n the size of the group, to rows (a, b, links): with ``b`` a
    link of a spanning forest of the group's links, without it a part of the links of ``a``."""
    small = rows.where(F.col("n") <= limit).select("group", "node", "copies", "vec")
    out = small.repartition("group").sortWithinPartitions("group").mapInArrow(_whole_groups, _FOUND_DDL)
    large = rows.where(F.col("n") > limit)
    sums = large.select("group", "vec").mapInArrow(_sums, "`group` binary, pivot binary")
    pivots = written(sums.repartition("group").sortWithinPartitions("group").mapInArrow(_add_sums, "`group` binary, pivot binary"), "pivots")
    if pivots.isEmpty():
        return out
    placed = large.join(broadcast_if_small(pivots), "group").select("group", "n", "node", "copies", "vec", "pivot")
    placed = written(placed.mapInArrow(_inner_batches, "`group` binary, n long, node binary, copies long, vec binary, inner boolean"), "placed")
    is_in = F.col("inner")
    caps = placed.groupBy("group").agg(
        F.min(F.when(is_in, F.col("node"))).alias("star"), F.sum(F.when(is_in, F.col("copies")).otherwise(0)).alias("weight"), F.sum(F.when(is_in, 0).otherwise(1)).alias("n_outer")
    )
    caps = broadcast_if_small(written(caps, "caps"))
    inner = placed.where(is_in).select("group", "node", "copies").join(caps, "group")
    stars = inner.where("node != star").select(F.col("star").alias("a"), F.col("node").alias("b"), F.lit(0).cast("long").alias("links"))
    counts = inner.select(F.col("node").alias("a"), F.lit(None).cast("binary").alias("b"), (F.col("weight") - F.col("copies")).alias("links"))
    # outer blocks against all blocks of the group
    todo = placed.join(caps.where("n_outer > 0").select("group", "n_outer"), "group")
    n_left, n_right = (F.ceil(F.col(c) / block).cast("int") for c in ("n_outer", "n"))
    own = lambda salt, n: F.pmod(F.xxhash64("node", F.lit(salt)), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    columns = ["group", "i", "j", "side", "node", "inner", "copies", "vec"]
    left = todo.where(~is_in).withColumn("i", own(1, n_left)).withColumn("j", every(n_right)).withColumn("side", F.lit(0))
    right = todo.withColumn("j", own(2, n_right)).withColumn("i", every(n_left)).withColumn("side", F.lit(1))
    pairs = left.select(*columns).unionByName(right.select(*columns)).repartition("group", "i", "j").sortWithinPartitions("group", "i", "j")
    return out.unionByName(stars).unionByName(counts).unionByName(pairs.mapInArrow(_block_pairs, _FOUND_DDL))


def link(vectors: DataFrame, target: float = TARGET_RECALL, limit: int = GROUP, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding, label)."""
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = written(plain.mapInArrow(_vector_batches, "vec_id long, node binary, label long, vec binary"), "vectors")
    able = rows.where("node is not null").groupBy("node").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("vec").alias("vec"))
    classes = written(able, "classes")
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = shape(most, target)
    keys = written(classes.select("node", "label", "vec").mapInArrow(_key_batches(bits, tables), "node binary, sketch long, keys array<binary>"), "keys")
    keyed = keys.select("node", "sketch", F.explode("keys").alias("group"))
    shared = written(keyed.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    met = keyed.join(broadcast_if_small(shared), "group").select("group", "n", "node", "sketch")
    # vectors travel only for buckets in which sketches are close; a bucket beyond the limit is not held in one task
    few = met.where(F.col("n") <= limit).repartition("group").sortWithinPartitions("group").mapInArrow(_alike, "`group` binary, n long, node binary")
    close = written(few.unionByName(met.where(F.col("n") > limit).drop("sketch")), "close")
    found = written(_compare(close.join(classes.select("node", "copies", "vec"), "node").select("group", "n", "node", "copies", "vec"), limit, block).where("b is not null").select("a", "b").distinct(), "edges")
    member = written(components(found), "members")
    size = member.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    groups = member.join(broadcast_if_small(size), "label").withColumnRenamed("label", "group")
    exact = _compare(groups.join(classes.select("node", "copies", "vec"), "node").select("group", "n", "node", "copies", "vec"), limit, block)
    links = exact.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    named = classes.select("node", "rep", "copies").join(member, "node", "left").join(links, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = written(named, "named")
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    result = named.join(least, "label").select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.select("vec_id", "node").join(broadcast_if_small(result), "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS k, vec_id, label, CAST(embedding AS DOUBLE[]) AS e,
         coalesce(label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS able
  FROM embeddings),
p AS (
  SELECT a.k AS a, b.k AS b
  FROM v a JOIN v b ON a.able AND b.able AND a.label = b.label AND len(a.e) = len(b.e) AND a.k <> b.k
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT k AS a, k AS b FROM v UNION SELECT reach.a, p.b FROM reach JOIN p ON reach.b = p.a),
c AS (SELECT reach.a AS k, min(v.vec_id) AS component_id FROM reach JOIN v ON reach.b = v.k GROUP BY 1),
l AS (SELECT a AS k, count(*) AS n FROM p GROUP BY 1)
SELECT v.vec_id, coalesce(l.n, 0) AS n_links, c.component_id, v.vec_id IS NOT DISTINCT FROM c.component_id AS kept
FROM v JOIN c USING (k) LEFT JOIN l USING (k)
"""
