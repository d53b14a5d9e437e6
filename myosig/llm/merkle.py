"""Document fingerprints: a Merkle tree over sections, paragraphs and their pieces (operator 1).

A paragraph is a line.  A long paragraph is cut into sentences (and a sentence over
``PIECE_CHARS`` at word ends), a short one into groups of three words, a text of at most
``TINY_TEXT`` code points into those; these pieces are the leaves.  A
section is a run of paragraphs that ends where the paragraph's own hash says so, or before
a heading, so an insertion moves no later boundary.  A parent hashes its children's hashes.

The root hashes its sections' hashes, a section its paragraphs' hashes, and a paragraph's hash is
over its exact text, so white space that no leaf holds counts and equal roots mean equal texts.

The fingerprint is the root (128 bits) and, below it, the tree at 24 bits a node in base64:
``root|section:paragraph,paragraph/section:paragraph``, a paragraph being its leaves (each with one
more character for its size), ``.`` and its own hash; ``, / : .`` are in no hash.  A paragraph
without leaves (blank) is part of its section.  :func:`differing_branches` descends only where
hashes differ, aligns the children in order and names what was replaced, deleted, inserted and
moved, by place on both sides; :func:`likeness` is the Dice coefficient of the leaves, weighted
by size, where equal branches count whole.

Edge cases: a null text is empty; an empty text has no leaves (likeness 1 to another empty
text, else 0).  Texts of any length are hashed whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_CHARS = 100
SHORT_PARAGRAPH = 160
TINY_TEXT = 24
#: One paragraph in so many ends a section.
SECTION_PARAGRAPHS = 4

_PIECE = re.compile(r"\s*(?:.{1,%d}?(?:[.!?]+(?=\s|\Z)|\Z)|.{1,%d}(?=\s|\Z)|.{1,%d})" % (PIECE_CHARS, PIECE_CHARS, PIECE_CHARS))
_GROUP = re.compile(r"\S+(?:\s+\S+){0,2}")
_HEADING = re.compile(r"#{1,6} |=+ ?\w|[0-9]+(?:\.[0-9]+)*\.? \S{1,40}$")
_NODE = 16


def _hash(data: bytes, size: int) -> bytes:
    return hashlib.blake2b(data, digest_size=size).digest()


#: Sizes are held in units of four code points, up to 64 of them.
_SIZES = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"
_WEIGHT = {c: i + 1 for i, c in enumerate(_SIZES)}
_LEAF = 5


def _leaf(piece: str) -> str:
    return _short(_hash(piece.encode("utf-8", "surrogatepass"), 3)) + _SIZES[min(len(piece) // 4, 63)]


def _short(node: bytes) -> str:
    """24 bits of a hash."""
    return base64.b64encode(node[-3:], b"-_").decode()


def pieces(paragraph: str) -> list[str]:
    """The leaves' texts of a paragraph."""
    return (_GROUP if len(paragraph) <= SHORT_PARAGRAPH else _PIECE).findall(paragraph)


def fingerprint(text: str | None) -> str:
    text = text or ""
    sections: list[list[tuple[bytes, str]]] = [[]]
    for paragraph in text.split("\n"):
        leaves = "".join(map(_leaf, paragraph if len(text) <= TINY_TEXT else pieces(paragraph)))
        node = _hash(paragraph.encode("utf-8", "surrogatepass"), _NODE)
        if leaves and sections[-1] and _HEADING.match(paragraph):
            sections.append([])
        sections[-1].append((node, f"{leaves}.{_short(node)}"))
        if leaves and node[0] % SECTION_PARAGRAPHS == 0:
            sections.append([])
    sections = [s for s in sections if s]
    nodes = [_hash(b"".join(node for node, _ in s), _NODE) for s in sections]
    root = _hash(b"".join(nodes), _NODE).hex()
    return f"{root}|" + "/".join(f"{_short(n)}:" + ",".join(p for _, p in s) for n, s in zip(nodes, sections))


def _leaves(branch: str) -> list[str]:
    return [branch[i : i + _LEAF] for i in range(0, len(branch), _LEAF)]


def _weight(branch: str) -> int:
    return sum(map(_WEIGHT.__getitem__, branch[_LEAF - 1 :: _LEAF]))


def _tree(fp: str) -> tuple[str, list[str]]:
    root, _, body = fp.partition("|")
    return root, body.split("/")


def _paragraphs(section: str) -> list[str]:
    return section.partition(":")[2].split(",")


def _leaves_of(paragraph: str) -> str:
    return paragraph.partition(".")[0]


def likeness(a: str, b: str) -> float:
    """0 (no leaf in common) to 1 (equal texts)."""
    (root_a, tree_a), (root_b, tree_b) = _tree(a), _tree(b)
    if root_a == root_b:
        return 1.0
    paras_a = Counter(x for s in tree_a for p in _paragraphs(s) if (x := _leaves_of(p)))
    paras_b = Counter(x for s in tree_b for p in _paragraphs(s) if (x := _leaves_of(p)))
    if not paras_a or not paras_b:
        return 0.0
    same = paras_a & paras_b  # equal branches count whole
    common = sum(n * _weight(p) for p, n in same.items())
    total = sum(n * _weight(p) for c in (paras_a, paras_b) for p, n in c.items())
    rest_a = Counter(x for p, n in (paras_a - same).items() for x in _leaves(p) * n)
    rest_b = Counter(x for p, n in (paras_b - same).items() for x in _leaves(p) * n)
    common += sum(n * _weight(x) for x, n in (rest_a & rest_b).items())
    return min(2 * common / total, 1 - 1e-9)  # 1 is for equal roots


def _differing(a: list[str], b: list[str]) -> list[tuple[int, int, int, int]]:
    """Ranges of ``a`` and ``b`` that differ when both are aligned in order."""
    head = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    tail = next((i for i, (x, y) in enumerate(zip(a[head:][::-1], b[head:][::-1])) if x != y), min(len(a), len(b)) - head)
    rest = SequenceMatcher(None, a[head : len(a) - tail], b[head : len(b) - tail]).get_opcodes()
    return [(i + head, j + head, k + head, m + head) for tag, i, j, k, m in rest if tag != "equal"]


Branch = tuple[str, tuple[int, int] | None, tuple[int, int] | None, list[int], list[int]]


def differing_branches(a: str, b: str) -> list[Branch]:
    """What makes ``b`` of ``a``: kind, place in ``a``, place in ``b`` (section, paragraph in it), pieces of each.

    Kinds: ``delete`` and ``insert`` (a place on one side only), ``move`` (the same paragraph on both),
    ``replace`` with the pieces lost from ``a`` and new in ``b``, and ``space`` (a paragraph whose
    white space alone differs).  Sections are aligned by their hashes; only in those that differ
    paragraphs are, and only in paired paragraphs pieces.
    """
    (root_a, tree_a), (root_b, tree_b) = _tree(a), _tree(b)
    if root_a == root_b:
        return []
    gone, new, regions = [], [], []
    for i, j, k, m in _differing(tree_a, tree_b):
        old_at = [((s, n), p) for s in range(i, j) for n, p in enumerate(_paragraphs(tree_a[s]))]
        new_at = [((s, n), p) for s in range(k, m) for n, p in enumerate(_paragraphs(tree_b[s]))]
        for g, h, x, y in _differing([p for _, p in old_at], [p for _, p in new_at]):
            regions.append((old_at[g:h], new_at[x:y]))
            gone += old_at[g:h]
            new += new_at[x:y]
    out: list[Branch] = []
    places: dict[str, list] = {}
    for at, p in reversed(new):
        places.setdefault(p, []).append(at)
    moved: dict[tuple[int, int], tuple[int, int]] = {}
    for at, p in gone:
        if _leaves_of(p) and places.get(p):
            moved[at] = places[p].pop()
            out.append(("move", at, moved[at], [], []))
    there = set(moved.values())
    for olds, news in regions:
        olds, news = [x for x in olds if x[0] not in moved], [x for x in news if x[0] not in there]
        for (at, p), (to, q) in zip(olds, news):
            x, y = _leaves(_leaves_of(p)), _leaves(_leaves_of(q))
            ranges = _differing(x, y)
            out.append(("replace" if ranges else "space", at, to, [n for i, j, _, _ in ranges for n in range(i, j)], [n for _, _, i, j in ranges for n in range(i, j)]))
        out += [("delete", at, None, [], []) for at, _ in olds[len(news) :]]
        out += [("insert", None, to, [], []) for to, _ in news[len(olds) :]]
    # boundaries can fall alike only by 24 equal bits; the roots still differ
    return out or [("replace", (0, 0), (0, 0), [], [])]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars and fingerprint of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(len, texts), pa.int64()), pa.array(map(fingerprint, texts), pa.string())], ["doc_id", "n_chars", "fingerprint"])

    return _plain(docs).mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def edit(text: str, following: str) -> str:
    """The last third of the code points, replaced by the first as many of another text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_PLACE = pa.struct([("section", pa.int32()), ("paragraph", pa.int32())])
_EDITS = pa.list_(pa.struct([("kind", pa.string()), ("old", _PLACE), ("new", _PLACE), ("old_pieces", pa.list_(pa.int32())), ("new_pieces", pa.list_(pa.int32()))]))
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("edits", _EDITS)])
_RESULT_DDL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, edits array<struct<kind: string, old: struct<section: int, paragraph: int>, new: struct<section: int, paragraph: int>, old_pieces: array<int>, new_pieces: array<int>>>"


def _place(at: tuple[int, int] | None) -> dict | None:
    return at and {"section": at[0], "paragraph": at[1]}


def _result(doc_id: int | None, text: str, fp: str, next_text: str, next_fp: str) -> dict:
    edited = edit(text, next_text)
    edited_fp = fp if edited == text else fingerprint(edited)
    return {
        "doc_id": doc_id, "n_chars": len(text), "edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), "fingerprint": fp, "edited_fingerprint": edited_fp,
        "near_edited": likeness(fp, edited_fp), "near_next": likeness(fp, next_fp),
        "edits": [{"kind": kind, "old": _place(i), "new": _place(j), "old_pieces": x, "new_pieces": y} for kind, i, j, x, y in differing_branches(fp, edited_fp)],
    }


def _sorted_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of sorted rows (bucket, guest, doc_id, text); a bucket's guest only follows its last row."""
    bucket, last = None, None
    for b in batches:
        for start in range(0, len(b), 500):
            done = []
            for now, guest, doc_id, text in zip(*(c.to_pylist() for c in b.slice(start, 500).columns)):
                if now != bucket:
                    bucket, last = now, None
                fp = fingerprint(text)
                if last is not None:
                    done.append(_result(*last, text, fp))
                last = None if guest else (doc_id, text, fp)
            yield pa.RecordBatch.from_pylist(done, schema=_RESULT)


def edit_report(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprint each text and its edited text, whose end comes from the next document, and
    name the branches that the edit changed (``edits``).

    Next: the row after it in descending doc_id (nulls last, ties by text hash, so of equal
    rows each but the last has its own copy next); the first row follows the last; a single
    row follows itself.  Rows are cut into buckets at approximate percentiles of the id (rows
    without an id by their text hash), drawn once and then constants.  Every bucket gets as a
    guest the first row of the bucket after it, found by two small aggregates, so one
    shuffle of the texts suffices and a task streams its buckets with one row in hand.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or 4 * n
    rows = _plain(docs).select("doc_id", "text", F.xxhash64("text").alias("h"))
    bounds = sorted(set(docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), [k / buckets for k in range(1, buckets)] or [0.5], 10_000)).first()[0] or []))
    above = F.size(F.filter(F.array(*map(F.lit, bounds)) if bounds else F.array().cast("array<long>"), lambda x: F.col("doc_id") > x))
    unnamed = F.lit(len(bounds) + 1) + F.floor((F.shiftright("h", 32) + F.lit(1 << 31)) * buckets / float(1 << 32))
    rows = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), unnamed).otherwise(F.lit(len(bounds)) - above).cast("long"))
    first = F.min(F.struct(F.bitwise_not("doc_id").alias("key"), "h")).alias("first")
    heads = sorted(rows.groupBy("bucket").agg(first).collect())  # one row per bucket
    if not heads:
        return spark.createDataFrame([], _RESULT_DDL)
    followed = [(b.first.key, b.first.h, a.bucket) for a, b in zip(heads, heads[1:] + heads[:1])]
    wanted = F.broadcast(spark.createDataFrame(followed, "head long, head_h long, host long"))
    guests = rows.join(wanted, F.bitwise_not("doc_id").eqNullSafe(F.col("head")) & (F.col("h") == F.col("head_h"))).groupBy("host").agg(F.first("text").alias("text"))
    both = rows.select("bucket", F.lit(0).alias("guest"), "doc_id", "h", "text").unionByName(
        guests.select(F.col("host").alias("bucket"), F.lit(1).alias("guest"), F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("h"), "text")
    )
    order = ["bucket", "guest", F.col("doc_id").desc_nulls_last(), "h"]
    return both.repartition(n, "bucket").sortWithinPartitions(*order).select("bucket", "guest", "doc_id", "text").mapInArrow(_sorted_pass, _RESULT_DDL)
