r"""Ranked lexical search by dense matrix products (operator 11).

Items (queries) are ranked against all documents.  A term is a maximal run of letters, digits and
non-ASCII characters, only A-Z lower-cased.  With N documents that have a term, L terms in all, n
terms in the document, df documents with the term and tf places in the document, a document's
score is the sum over the item's terms, repeats included, of

    w * ((10^9 * tf) div (1000 * tf + 8 * m)),  w = floor(1000 ln((2N + 2) / (2df + 1))),
    m = 25 + (75 * n * N) div L

all but w in whole numbers.

One pass over the texts keeps, per tile of ``TILE_DOCS`` documents, the places of the items'
vocabulary; document frequencies are counts over those tiles.  A second pass multiplies: the
items, in blocks of ``BLOCK_ITEMS``, have a compact vocabulary, cut into tiles of at most
``TILE_TERMS`` terms; a tile's item weights times the documents' impacts (only of terms that
occur in both) is one product of float64 matrices.  A tile ends before the weights of an item
reach 2^53 / 10^6 in it: an impact is below 10^6, so every partial sum is a whole number below
2^53, exact in any order of addition; tiles are added as 64-bit integers.  Every task keeps its
k best documents per item, ties by ascending doc_id, and only those are shuffled and merged, in
two steps.

Items are a stated query set, collected to the driver and broadcast in groups of about
``GROUP_BYTES`` bytes of text (checked; beyond it, groups by hash are searched one after
another, a scan of the documents each), so memory does not grow with them.

Result: item_id, rank (from 1, unique, highest score first), doc_id, score of the k best documents with a
score above 0, or all if they are fewer.

Edge cases: a null text has no term, and neither has one of punctuation: such documents count
nowhere and are never found, such items find nothing; documents that repeat are ranked each for
itself; a null doc_id comes after other ids of the same score; items that repeat in id and
text count once, items of one id with different texts are ranked each for itself, a null item_id
is an id like others; an empty table on either side gives no rows; texts of any length are
read whole, in pieces of ``PIECE`` bytes cut between terms; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from myosig.llm.common import written

BEST = 10
TILE_DOCS = 2048
TILE_TERMS = 2048
BLOCK_ITEMS = 256
GROUP_BYTES = 16 << 20
PIECE = 1 << 20
#: An item's weights in one tile stay below this, so sums of weight * impact stay below 2^53.
WEIGHT_LIMIT = (1 << 53) // 10**6 - 1
#: The tasks' best are merged in so many parts an item before the last step.
_PARTS = 64

#: Term bytes as they are, A-Z lower-cased, all others to a blank.
_FOLD = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def terms(data: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, in lists of about ``piece`` bytes."""
    at = 0
    while at < len(data):
        stop = at + piece
        part = data[at:stop].translate(_FOLD)
        while stop < len(data) and not part.endswith(b" "):
            # on to the next blank: a term longer than a piece is read piece by piece
            more = data[stop : stop + 4096].translate(_FOLD)
            blank = more.find(b" ")
            taken = more if blank < 0 else more[: blank + 1]
            part += taken
            stop += len(taken)
        yield part.split()
        at = stop


_TILE = pa.schema(
    [("n_docs", pa.int64()), ("n_terms", pa.int64()), *((c, pa.binary()) for c in ("ids", "known", "lengths", "row", "term", "tf"))]
)
_TILE_DDL = "n_docs long, n_terms long, ids binary, known binary, lengths binary, row binary, term binary, tf binary"


def _tile_batches(vocabulary: Broadcast):
    """Tiles of documents: of those with a term of the vocabulary, ids, lengths and (row, term, tf)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        for b in batches:
            for at in range(0, len(b), TILE_DOCS):
                part = b.slice(at, TILE_DOCS)
                lengths, rows, found = np.zeros(len(part), np.int64), [np.empty(0, np.int64)], [np.empty(0, np.int64)]
                for i in range(len(part)):
                    data = part.column(1)[i].as_buffer()
                    for words in terms(data.to_pybytes() if data is not None else b""):
                        lengths[i] += len(words)
                        known = list(filter(None, map(number, words)))
                        found.append(np.array(known, np.int64))
                        rows.append(np.full(len(known), i, np.int64))
                key, tf = np.unique(np.concatenate(rows) << 32 | np.concatenate(found), return_counts=True)
                kept, row = np.unique(key >> 32, return_inverse=True)
                docs = part.column(0).take(pa.array(kept))
                ids, known = docs.fill_null(0).to_numpy(zero_copy_only=False), docs.is_valid().to_numpy(zero_copy_only=False)
                columns = [ids.astype(np.int64), known, lengths[kept], row.astype(np.int32), ((key & 0xFFFFFFFF) - 1).astype(np.int32), tf.astype(np.int64)]
                head = [pa.array([int((lengths > 0).sum())]), pa.array([int(lengths.sum())])]
                yield pa.RecordBatch.from_arrays([*head, *(pa.array([c.tobytes()], pa.binary()) for c in columns)], schema=_TILE)

    return run


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, documents) of a task's tiles: a document's terms are distinct in its tile."""
    total = Counter()
    for b in batches:
        for data in b.column(0).to_pylist():
            own, n = np.unique(np.frombuffer(data, np.int32), return_counts=True)
            total.update(dict(zip(own.tolist(), n.tolist())))
    yield pa.RecordBatch.from_arrays([pa.array(list(total.keys()), pa.int32()), pa.array(list(total.values()), pa.int64())], names=["term", "n"])


def vocabulary_tiles(weights: list[dict[int, int]], limit: int = WEIGHT_LIMIT, width: int = TILE_TERMS) -> list[tuple]:
    """Cut the vocabulary of a block of items into tiles (terms, item, column, weight).

    ``weights``: per item the weight (w times repeats) of its terms.  Within a tile no item's weights sum up to
    more than ``limit``; a weight beyond it goes to several tiles.
    """
    by_term: dict[int, list] = {}
    for item, own in enumerate(weights):
        for term, weight in own.items():
            by_term.setdefault(term, []).append((item, weight))
    out, load, columns, entries = [], np.zeros(len(weights), np.int64), [], []

    def close() -> None:
        nonlocal columns, entries
        if columns:
            item, column, weight = (np.array(c, np.int64) for c in zip(*entries))
            out.append((np.array(columns, np.int32), item, column, weight.astype(np.float64)))
        load[:] = 0
        columns, entries = [], []

    for term in sorted(by_term):
        left = by_term[term]
        while left:
            if len(columns) == width or any(load[i] + min(w, limit) > limit for i, w in left):
                close()
            entries += [(i, len(columns), min(w, limit)) for i, w in left]
            for i, w in left:
                load[i] += min(w, limit)
            columns.append(term)
            left = [(i, w - limit) for i, w in left if w > limit]
    close()
    return out


def _length_norm(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    if not len(n) or 75 * int(n.max()) * n_docs < 1 << 63:
        return 25 + (75 * n * n_docs) // n_terms
    return np.array([25 + (75 * int(x) * n_docs) // n_terms for x in n], np.int64)  # the product is over 64 bits


class _Best:
    """The k best documents (score, id, known id) of every item, ties by ascending id, null last."""

    def __init__(self, n_items: int, k: int):
        self.k, self.rows = k, [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))] * n_items

    def add(self, item: int, score: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        own = self.rows[item]
        least = max(1, own[0][-1] if len(own[0]) == self.k else 1)
        if len(score) > self.k:
            # all that tie with the k-th are kept until ids are compared
            least = max(least, int(np.partition(score, -self.k)[-self.k]))
        at = np.flatnonzero(score >= least)
        if len(at):
            s, i, z = np.r_[own[0], score[at]], np.r_[own[1], ids[at]], np.r_[own[2], known[at]]
            order = np.lexsort((i, ~z, -s))[: self.k]
            self.rows[item] = s[order], i[order], z[order]


def _best_batches(model: Broadcast, k: int):
    """A task's k best documents per item: (item, item_id, doc_id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, blocks, n_docs, n_terms = model.value
        best = _Best(len(names), k)
        for b in batches:
            for at in range(len(b)):
                ids, known, lengths, row, term, tf = (np.frombuffer(b.column(c)[at].as_py(), t) for c, t in enumerate((np.int64, bool, np.int64, np.int32, np.int32, np.int64)))
                if not len(row):
                    continue
                impact = ((10**9 * tf) // (1000 * tf + 8 * _length_norm(lengths, n_docs, n_terms)[row])).astype(np.float64)
                order = np.argsort(term, kind="stable")
                row, term, impact = row[order], term[order], impact[order]
                for first, size, tiles in blocks:
                    score = np.zeros((size, len(ids)), np.int64)
                    for columns, item, column, weight in tiles:
                        lo, hi = np.searchsorted(term, columns, "left"), np.searchsorted(term, columns, "right")
                        held = np.flatnonzero(hi > lo)  # only terms that occur in both tiles
                        if not len(held):
                            continue
                        place = np.full(len(columns), -1, np.int64)
                        place[held] = np.arange(len(held))
                        ours = place[column] >= 0
                        left = np.zeros((size, len(held)))
                        left[item[ours], place[column[ours]]] = weight[ours]
                        right = np.zeros((len(held), len(ids)))
                        of = np.repeat(np.arange(len(held)), (hi - lo)[held])
                        entry = np.arange(len(of)) - np.repeat(np.cumsum((hi - lo)[held]) - (hi - lo)[held], (hi - lo)[held]) + np.repeat(lo[held], (hi - lo)[held])
                        right[of, row[entry]] = impact[entry]
                        score += (left @ right).astype(np.int64)
                    for i in range(size):
                        best.add(first + i, score[i], ids, known)
        for i, (s, d, z) in enumerate(best.rows):
            if len(s):
                columns = [pa.array([i] * len(s), pa.int32()), pa.array([names[i]] * len(s), pa.int64()), pa.array(d, pa.int64(), mask=~z), pa.array(s, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["item", "item_id", "doc_id", "score"])

    return run


def _ranked(items: list, docs: DataFrame, k: int) -> DataFrame:
    """The search for one group of items [(item_id, text), ...]."""
    spark = docs.sparkSession
    counts = []
    for _, text in items:
        own = Counter()
        for words in terms((text or "").encode()):
            own.update(words)
        counts.append(own)
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counts)), 1)}
    sent = spark.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    tiles = written(rows.mapInArrow(_tile_batches(sent), _TILE_DDL), "tiles")
    n_docs, n_terms = (int(x or 0) for x in tiles.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    # at most one row a term of the vocabulary
    seen = tiles.select("term").mapInArrow(_frequencies, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    weight = {r.term + 1: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r.n + 1))) for r in seen}
    weighed = []
    for own in counts:
        numbered = ((vocabulary[t], c) for t, c in own.items())
        weighed.append({t - 1: weight[t] * c for t, c in numbered if weight.get(t)})
    blocks = [(at, len(weighed[at : at + BLOCK_ITEMS]), vocabulary_tiles(weighed[at : at + BLOCK_ITEMS])) for at in range(0, len(items), BLOCK_ITEMS)]
    model = spark.sparkContext.broadcast(([r[0] for r in items], blocks, n_docs, max(1, n_terms)))
    best = tiles.select("ids", "known", "lengths", "row", "term", "tf").mapInArrow(_best_batches(model, k), "item int, item_id long, doc_id long, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    parts = best.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(_PARTS)))
    parts = parts.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("rank") <= k)
    return parts.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def search(items: DataFrame, docs: DataFrame, k: int = BEST, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score of every item's ``k`` best documents."""
    asked = written(items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct(), "items")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, math.ceil(size / group_bytes))
    if groups == 1:
        return _ranked(asked.orderBy("item_id", "text").collect(), docs, k)
    out = None
    for g in range(groups):
        own = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g).orderBy("item_id", "text").collect()
        if own:
            found = written(_ranked(own, docs, k), "found")
            out = found if out is None else out.unionByName(found)
    return out


ORACLE = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS k,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents),
d AS (SELECT doc_id, k, t, len(t) AS n FROM words WHERE len(t) > 0),
s AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM d),
f AS (SELECT doc_id, k, n, term, count(*) AS tf FROM (SELECT doc_id, k, n, unnest(t) AS term FROM d) GROUP BY ALL),
i AS (SELECT DISTINCT item_id, text FROM benchmark),
q AS (
  SELECT item_id, text, term, count(*) AS c
  FROM (SELECT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM i)
  GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(big_n) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, s WHERE term IN (SELECT term FROM q) GROUP BY term),
r AS (
  SELECT item_id, text, doc_id, k,
         CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l)))) AS BIGINT) AS score
  FROM q JOIN f USING (term) JOIN w USING (term), s
  GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id ASC NULLS LAST) AS INT) AS rank, doc_id, score
FROM r WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id ASC NULLS LAST) <= 10
"""
