r"""N-gram Jaccard join by chosen paths (operator 8).

A document is its set of five-word shingles (words: ``\w+``, lower-cased; a text of one to
four words is one shingle).  Documents with equal sets form a class and only one set per
class is joined.

Chosen path: a class's set is embedded in ``COORDINATES`` minhash values.  In every run, a
node of the tree samples one coordinate (sometimes two, so that a pair at the threshold
keeps about one common child) from a hash of its path, and splits its sets on the token
that each holds there.  Nodes with at most ``LEAF`` sets are compared by brute force on 8-bit
sketches; larger ones split again, up to ``LEVELS`` times.  All runs go through the same jobs;
their number follows from the target recall for a pair exactly at the threshold.

Leaves emit a spanning forest of their similar sets, not pairs.  Within a component of that
forest every pair is compared exactly, on whole sets, in blocks of at most ``BLOCK`` sets a
side, and what comes out is a count of links per set and again a spanning forest.  So no task
holds more than two blocks, and rows stay proportional to documents (times blocks in a
component).  The components of exact links are the near-duplicate classes.

Hot groups: equal texts fold into one class by a pre-aggregated group-by; the paths that
hold many sets are counted by a pre-aggregated group-by and told to the tasks as a broadcast
list (beyond ``BROADCAST_PATHS`` of them, by a join), so their sets never meet in one task.

Result: one row per document: ``class_id`` (least doc_id of its near-duplicate class) and
``n_links`` (other documents with Jaccard similarity of 0.8 or more, copies included).

Edge cases: null texts and texts without a word have no shingles: such a document is a class
of its own (its doc_id) without links; rows that repeat count as documents of one class; a
class without any doc_id is named by a negative hash; an empty table gives no rows; texts of
any length are shingled whole; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from myosig.functions import broadcast_if_small
from myosig.llm.common import lean, written
from myosig.llm.components import components

SHINGLE_WORDS = 5
THRESHOLD = (4, 5)  # similarity of 4/5, compared in whole numbers
TARGET_RECALL = 0.9999
COORDINATES = 64
LEVELS = 4
LEAF = 200
SECOND_CHILD = 0.25
#: Sketch similarity from which sets go to the exact check: five standard deviations below the threshold.
CANDIDATE = 0.55
BLOCK = 256
BROADCAST_PATHS = 500_000

_WORD = re.compile(r"\w+")
_U64 = np.uint64
_MULTIPLIERS = np.random.default_rng(8).integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * _U64(2) + _U64(1)
_SHINGLE = np.random.default_rng(5).integers(1, 1 << 63, SHINGLE_WORDS, dtype=np.uint64) * _U64(2) + _U64(1)


def runs(target: float = TARGET_RECALL, levels: int = LEVELS) -> int:
    """Runs until a pair at the threshold meets in a leaf with probability ``target``, also at the last level."""
    s, q = THRESHOLD[0] / THRESHOLD[1], 1.0
    for _ in range(levels):
        q = 1 - (1 - SECOND_CHILD) * (1 - s * q) - SECOND_CHILD * (1 - s * q) ** 2
    return math.ceil(math.log(1 - target) / math.log(1 - q))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U64(27))) * _U64(0x94D049BB133111EB)
    return h ^ (h >> _U64(31))


class _Words(dict):
    """64-bit hash of a word; starts anew when it has grown large."""

    def __missing__(self, word: str) -> int:
        if len(self) > 400_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


_HASHED = _Words()


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = _WORD.findall((text or "").lower())
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(_HASHED.__getitem__, words), np.uint64, len(words))
    k = min(SHINGLE_WORDS, len(w))
    h = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        h += w[i : i + len(h)] * _SHINGLE[i]
    return np.unique(_mix(h))


def minhash(s: np.ndarray) -> np.ndarray:
    """The embedding: per coordinate the least token of a random order."""
    out = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(s), 4096):
        out = np.minimum(out, _mix(s[at : at + 4096, None] * _MULTIPLIERS).min(0) >> _U64(32))
    return out.astype(np.uint32)


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The set of every text: its name (``node``), its embedding and its tokens; nulls without a word."""
    schema = pa.schema([("doc_id", pa.int64()), ("key1", pa.int64()), ("key2", pa.int64()), ("node", pa.binary()), ("coords", pa.binary()), ("tokens", pa.binary())])
    for b in batches:
        for at in range(0, len(b), 1000):
            part, sets = b.slice(at, 1000), []
            for text in part.column(1).to_pylist():
                s = shingles(text)
                if not len(s):
                    sets.append((None, None, None))
                    continue
                # 32 bits of each shingle: a chance collision moves a similarity by about 1 / size
                t = np.unique((s >> _U64(32)).astype(np.uint32))
                sets.append((hashlib.blake2b(s.tobytes(), digest_size=16).digest(), minhash(s).tobytes(), t.tobytes()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(3), *(pa.array(c, pa.binary()) for c in zip(*sets))], schema=schema)
    _HASHED.clear()


def _children(coords: np.ndarray, row: np.ndarray, path: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, child path) of every (row, path): the sampled coordinates and what the row's set holds there."""
    choice = _mix(path + _U64(0x9E3779B97F4A7C15))
    second = (choice >> _U64(40)).astype(np.float64) / (1 << 24) < SECOND_CHILD
    c1 = (choice % _U64(COORDINATES)).astype(np.int64)
    c2 = (c1 + 1 + ((choice >> _U64(8)) % _U64(COORDINATES - 1)).astype(np.int64)) % COORDINATES
    row, path, c = np.r_[row, row[second]], np.r_[path, path[second]], np.r_[c1, c2[second]]
    return row, _mix(path * _U64(31) + c.astype(np.uint64) * _U64(0xD6E8FEB86659FD93) + coords[row, c].astype(np.uint64))


def _expand(n_runs: int | None, large=None, keep: str = "rows"):
    """Children of (node, coords, paths) rows; without paths, of the roots of ``n_runs`` trees.

    ``large``: a broadcast sorted array of paths.  keep "counts": (path, n), summed per batch;
    "rows": rows (path, node, sketch) of all but the large paths; "seeds": (node, coords,
    paths) with the large ones, a row per node.
    """
    counts_schema = pa.schema([("path", pa.int64()), ("n", pa.int64())])
    rows_schema = pa.schema([("path", pa.int64()), ("node", pa.binary()), ("sketch", pa.binary())])
    seeds_schema = pa.schema([("node", pa.binary()), ("coords", pa.binary()), ("paths", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = None if large is None else large.value
        for b in batches:
            for at in range(0, len(b), 4096):
                part = b.slice(at, 4096)
                n = len(part)
                coords = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(n, COORDINATES)
                if n_runs is not None:
                    row, path = np.repeat(np.arange(n), n_runs), np.tile(_mix(np.arange(1, n_runs + 1, dtype=np.uint64)), n)
                else:
                    lists = part.column(2)
                    row, path = np.repeat(np.arange(n), lists.value_lengths().to_numpy()), lists.flatten().to_numpy().view(np.uint64)
                row, child = _children(coords, row, path)
                child = child.view(np.int64)
                if split is not None and len(split):
                    inside = split[np.minimum(np.searchsorted(split, child), len(split) - 1)] == child
                    inside = inside if keep == "seeds" else ~inside
                    row, child = row[inside], child[inside]
                elif keep == "seeds":
                    row, child = row[:0], child[:0]
                if keep == "counts":
                    own, times = np.unique(child, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(times)], schema=counts_schema)
                elif keep == "rows":
                    low = pa.array([x.tobytes() for x in coords.astype(np.uint8)], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(child), part.column(0).take(pa.array(row)), low.take(pa.array(row))], schema=rows_schema)
                elif len(row):
                    order = np.lexsort((child, row))
                    row, child = row[order], child[order]
                    own, first = np.unique(row, return_index=True)
                    paths = pa.ListArray.from_arrays(pa.array(np.r_[first, len(row)], pa.int32()), pa.array(child))
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(own)), part.column(1).take(pa.array(own)), paths], schema=seeds_schema)

    return lean(run)


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of a symmetric boolean matrix."""
    left, out = set(range(len(linked))), []
    while left:
        todo = [left.pop()]
        while todo:
            i = todo.pop()
            new = left.intersection(np.flatnonzero(linked[i]).tolist())
            left -= new
            todo += new
            out += [(i, j) for j in new]
    return out


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[list]]]:
    """(key, columns) of each group in rows that are sorted by their first ``keys`` columns."""
    key, held = None, []
    for b in batches:
        columns = [c.to_pylist() for c in b.columns]
        for row in zip(*columns):
            if row[:keys] != key:
                if held:
                    yield key, held
                key, held = row[:keys], []
            held.append(row[keys:])
    if held:
        yield key, held


_EDGES = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _leaf_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Brute force within each path's rows (path, node, sketch)."""
    out: list[tuple] = []
    for _, rows in _grouped(batches, 1):
        rows = list(dict(rows).items())  # a node may reach a path twice
        if len(rows) > 1:
            s = np.frombuffer(b"".join(x for _, x in rows), np.uint8).reshape(len(rows), COORDINATES)
            same = np.stack([(s == x).mean(1) for x in s]) >= CANDIDATE
            out += [(rows[i][0], rows[j][0]) for i, j in _forest(same)]
        if len(out) >= 5000:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)], schema=_EDGES)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)], schema=_EDGES)


def candidates(classes: DataFrame, n_runs: int, leaf: int = LEAF, levels: int = LEVELS) -> DataFrame:
    """Edges (a, b) that connect all classes which met in a leaf and look similar.

    ``classes`` (node, coords) is read at every level: pass a written table.  A node of the
    edges that is no class stands for a path that still holds many sets after the last
    split: its sets are taken for similar here and compared exactly later.
    """
    spark, ddl = classes.sparkSession, "path long, node binary, sketch binary"
    found, seeds, roots = [], classes.select("node", "coords"), n_runs
    for level in range(1, levels + 1):
        counts = seeds.mapInArrow(_expand(roots, keep="counts"), "path long, n long")
        large = written(counts.groupBy("path").agg(F.sum("n").alias("n")).where(F.col("n") > leaf).select("path"), "paths")
        n = large.count()
        if n <= BROADCAST_PATHS:
            split = spark.sparkContext.broadcast(np.sort(np.array([r.path for r in large.collect()], np.int64)))
            small = seeds.mapInArrow(_expand(roots, split), ddl)
            deeper = seeds.mapInArrow(_expand(roots, split, "seeds"), "node binary, coords binary, paths array<long>")
        else:
            rows = seeds.mapInArrow(_expand(roots), ddl)
            small = rows.join(large, "path", "left_anti")
            paths = rows.join(large, "path").groupBy("node").agg(F.collect_set("path").alias("paths"))  # at most a few per run
            deeper = paths.join(classes.select("node", "coords"), "node").select("node", "coords", "paths")
        found.append(written(small.repartition("path").sortWithinPartitions("path").mapInArrow(lean(_leaf_batches), "a binary, b binary").distinct(), "leaf-edges"))
        if not n:
            break
        deeper = written(deeper, "seeds")
        if level == levels:
            found.append(deeper.select("node", F.explode("paths").alias("p")).select(F.encode(F.col("p").cast("string"), "utf-8").alias("a"), F.col("node").alias("b")))
        seeds, roots = deeper, None
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.where("a != b")


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the pairwise intersections, by products of blocks of the incidence matrix."""
    n = len(sets)
    out = np.zeros((n, n), np.float32)
    token, of = np.concatenate(sets), np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(token, kind="stable")
    token, of = token[order], of[order]
    new = np.r_[True, token[1:] != token[:-1]]
    number = np.cumsum(new) - 1
    shared = np.bincount(number)[number] > 1
    number, of = number[shared], of[shared]
    if not len(number):
        return out
    number = np.cumsum(np.r_[True, number[1:] != number[:-1]]) - 1
    width = 8192
    for at in range(0, int(number[-1]) + 1, width):
        lo, hi = np.searchsorted(number, [at, at + width])
        m = np.zeros((n, width), np.float32)
        m[of[lo:hi], number[lo:hi] - at] = 1
        out += m @ m.T
    return out


def _similar(sets: list[np.ndarray]) -> np.ndarray:
    size = np.array([len(s) for s in sets], np.int64)
    inter = _intersections(sets).astype(np.int64)
    union = size[:, None] + size[None, :] - inter
    linked = inter * THRESHOLD[1] >= union * THRESHOLD[0]
    np.fill_diagonal(linked, False)
    return linked


def _exact_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of every block pair (label, i, j; node, block, copies, tokens): counts (b null) and a spanning forest."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("links", pa.int64())])
    out: list[tuple] = []
    for (_, i, j), rows in _grouped(batches, 3):
        linked = _similar([np.frombuffer(r[3], np.uint32) for r in rows])
        if i != j:
            block = np.array([r[1] for r in rows])
            linked &= block[:, None] != block[None, :]
        links = linked.astype(np.int64) @ np.array([r[2] for r in rows], np.int64)
        out += [(r[0], None, int(n)) for r, n in zip(rows, links) if n]
        out += [(rows[x][0], rows[y][0], 0) for x, y in _forest(linked)]
        if len(out) >= 5000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def _name(rep: Column, node: Column) -> Column:
    return F.coalesce(rep, -F.abs(F.xxhash64(node) % F.lit(1 << 62)) - 1)


def _row_key() -> list[Column]:
    """Two 64-bit hashes that tell rows apart by id and text."""
    text = F.col("text").cast("string")
    return [F.xxhash64(F.lit(n), F.col("doc_id").cast("long"), text).alias(f"key{n}") for n in (1, 2)]


def _named_classes(docs: DataFrame, target: float, leaf: int, block: int) -> tuple[DataFrame, DataFrame]:
    """(sets, classes): a row per document, and a row per class of equal sets with its near-duplicate label and links."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *_row_key())
    sets = written(plain.mapInArrow(lean(_set_batches), "doc_id long, key1 long, key2 long, node binary, coords binary, tokens binary"), "sets")
    # the least row of a class: by id, null last, then by key
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key1", "key2"))
    classes = written(sets.where("node is not null").groupBy("node").agg(rep.alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("coords").alias("coords")), "classes")
    met = components(candidates(classes, runs(target), leaf))
    # without the nodes that stand for paths, and with the class's weight
    near = written(met.join(classes.select("node", "copies"), "node"), "candidates")
    # components of several blocks are few: a task holds two blocks, whatever the component's size
    several = near.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block).select(F.col("label").alias("many"), F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    members = near.join(broadcast_if_small(several), F.col("label") == F.col("many"), "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).drop("many")
    members = members.withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int"))
    # one set per class that has a candidate
    tokens = sets.where("node is not null").join(broadcast_if_small(near.select("node")), "node", "left_semi").groupBy("node").agg(F.first("tokens").alias("tokens"))
    spread = members.join(tokens, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = spread.select(
        "label", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "block", "copies", "tokens"
    ).repartition("label", "i", "j").sortWithinPartitions("label", "i", "j")
    exact = written(pairs.mapInArrow(lean(_exact_batches), "a binary, b binary, links long"), "links")
    links = exact.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    groups = components(exact.where("b is not null").select("a", "b"))
    named = classes.join(groups, "node", "left").join(links, "node", "left")
    return sets, written(named.select("node", F.coalesce("label", "node").alias("label"), "rep", "copies", F.coalesce("links", F.lit(0)).alias("links")), "named")


def join(docs: DataFrame, target: float = TARGET_RECALL, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """doc_id, class_id, n_links of every document."""
    sets, named = _named_classes(docs, target, leaf, block)
    least = named.groupBy("label").agg(F.min("rep").alias("class_rep"))
    result = written(named.join(least, "label").select("node", _name(F.col("class_rep.doc_id"), F.col("label")).alias("class_id"), (F.col("copies") - 1 + F.col("links")).alias("n_links")), "classes")
    rows = sets.select("doc_id", "node").join(result, "node", "left")
    return rows.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def distinct(docs: DataFrame, target: float = TARGET_RECALL, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """``docs`` with all columns, one row per near-duplicate class: the one of the least doc_id.

    Of rows that repeat in id and text one stays.  Rows without a word are no duplicates of
    each other; of those, too, only repeated rows go.
    """
    sets, named = _named_classes(docs, target, leaf, block)
    keys = ["key1", "key2"]
    least = named.groupBy("label").agg(F.min("rep").alias("rep")).select("rep.key1", "rep.key2")
    kept = least.unionByName(sets.where("node is null").select(*keys).distinct())
    # whether a key names several rows is counted on the narrow table; texts are neither sorted nor, if the keys are small, moved
    named_rows = sets.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    kept = written(kept.join(named_rows, keys).select(*keys, (F.col("n") > 1).alias("repeated")), "kept")
    rows = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)), *_row_key())
    of = lambda some: rows.join(broadcast_if_small(kept.where(some).select(*keys)), keys, "left_semi")
    names = [f"c{i}" for i in range(len(docs.columns))]  # columns of docs may be named like the keys
    once = of(~F.col("repeated")).select(*(F.col(n).alias(c) for n, c in zip(names, docs.columns)))
    if kept.where("repeated").isEmpty():
        return once
    first = of(F.col("repeated")).groupBy(*keys).agg(F.first(F.struct(*names)).alias("row"))
    return once.unionByName(first.select(*(F.col(f"row.{n}").alias(c) for n, c in zip(names, docs.columns))))
