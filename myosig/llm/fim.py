r"""Fill-in-middle transformation (operator 13).

A text's units are its words, each with the white space before it, and a last unit of the white
space that ends it.  Two cuts between units, drawn from a hash of the doc_id, make three parts
(prefix, middle, suffix); the result is the text itself ("plain"), ``<P>prefix<S>suffix<M>middle``
("psm") or ``<S>suffix<P>prefix<M>middle`` ("spm").

Cuts are found by a Fenwick tree: the UTF-8 text is seen as blocks of ``BLOCK`` bytes, and the tree
stores how many units end and how many code points begin in them.  A descent by powers of two
finds the block in which unit number k ends and what lies before it; only that block is searched
for the boundary.  So a text of any length costs one pass for the tree and one block a cut.

``transform`` returns the new texts; ``restored`` rebuilds the source from such a text and its form
with Spark functions.  No marker has a proper prefix that is also its suffix, and texts with a marker
stay plain, so the first occurrence of each marker is the one that was put in.

Edge cases: a null text is an empty one; empty texts stay plain; a null doc_id is hashed as the
empty string; rows with the same doc_id and text get the same result; texts without a word are
one unit; every row gives one row, an empty table none; columns other than doc_id and text are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: markers of the parts
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
#: Percent of the documents that are cut, and of those the percent that put the suffix first.
RATE, SPM = 50, 80
BLOCK = 4096
#: Blocks whose bytes one numpy pass handles; bounds a worker's memory beside the text.
_RUN = 256
#: Bytes of text in one Arrow batch of results, unless one text is longer.
_OUT_BYTES = 8 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class UnitTree:
    """Fenwick tree over the blocks of a UTF-8 text, with unit ends and code points per block."""

    def __init__(self, data: bytes, block: int = BLOCK):
        self.bytes, self.block = np.frombuffer(data, np.uint8), block
        units, chars, run = [], [], block * _RUN
        for at in range(0, len(data), run):
            stop = min(len(data), at + run)
            starts = np.arange(0, stop - at, block)
            units += np.add.reduceat(self._ends(at, stop), starts, dtype=np.int64).tolist()
            chars += np.add.reduceat(self._begins(at, stop), starts, dtype=np.int64).tolist()
        self.n, self.n_chars = sum(units), sum(chars)
        self.units, self.chars = [0, *units], [0, *chars]
        for tree in (self.units, self.chars):
            for i in range(1, len(tree)):
                above = i + (i & -i)
                if above < len(tree):
                    tree[above] += tree[i]

    def _ends(self, lo: int, hi: int) -> np.ndarray:
        """Which bytes of [lo, hi) are the last of a unit."""
        space = _SPACE[self.bytes[lo : hi + 1]]
        if hi < len(self.bytes):
            return ~space[:-1] & space[1:]
        last = ~space
        last[:-1] &= space[1:]
        last[-1] = True  # of the last word, or of the white space that ends the text
        return last

    def _begins(self, lo: int, hi: int) -> np.ndarray:
        """Which bytes of [lo, hi) begin a code point."""
        return (self.bytes[lo:hi] & 0xC0) != 0x80

    def cut(self, k: int) -> tuple[int, int]:
        """(bytes, code points) of the first ``k`` units, 0 <= k <= n."""
        if k == 0:
            return 0, 0
        at = units = chars = 0
        step = 1 << (len(self.units) - 1).bit_length()
        while step := step >> 1:
            if at + step < len(self.units) and units + self.units[at + step] < k:
                at += step
                units += self.units[at]
                chars += self.chars[at]
        lo = at * self.block
        hi = min(lo + self.block, len(self.bytes))
        end = lo + int(np.flatnonzero(self._ends(lo, hi))[k - units - 1]) + 1
        return end, chars + int(self._begins(lo, end).sum())


def _draws(doc_id: int | None, seed: int) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


_MARKS = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]


def rearranged(doc_id: int | None, data: bytes, seed: int = SEED, rate: int = RATE, spm: int = SPM, block: int = BLOCK) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one UTF-8 text."""
    tree = UnitTree(data, block)
    h1, h2, h3, h4 = _draws(doc_id, seed)
    if not data or h3 % 100 >= rate or any(m in data for m in _MARKS):
        return tree.n, "plain", None, None, data
    first, second = sorted((h1 % (tree.n + 1), h2 % (tree.n + 1)))
    (a, a_chars), (b, b_chars) = tree.cut(first), tree.cut(second)
    p, s, m = _MARKS
    if h4 % 100 < spm:
        form, out = "spm", b"".join((s, data[b:], p, data[:a], m, data[a:b]))
    else:
        form, out = "psm", b"".join((p, data[:a], s, data[b:], m, data[a:b]))
    return tree.n, form, a_chars, b_chars - a_chars, out


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]
)


def _record(rows: list[tuple]) -> pa.RecordBatch:
    columns = [*zip(*rows)]
    arrays = [pa.array(c, f.type) for c, f in zip(columns[:-1], _SCHEMA)]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(columns[-1], pa.binary()).cast(pa.string())], schema=_SCHEMA)


def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (null if plain) and output of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, held = [], 0
            for at in range(0, len(b), 256):
                part = b.slice(at, 256)
                for doc_id, data in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                    rows.append((doc_id, *rearranged(doc_id, data or b"", seed, rate, spm)))
                    held += len(rows[-1][-1])
                    if held > _OUT_BYTES:
                        yield _record(rows)
                        rows, held = [], 0
            if rows:
                yield _record(rows)

    ddl = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, ddl)


def restored(output: Column, form: Column) -> Column:
    """The source text of an output of the given form."""

    def after(text: Column, mark: str) -> Column:
        # all that follows the first mark
        return F.substring(text, F.instr(text, F.lit(mark)) + F.lit(len(mark)), F.length(text))

    def between(first: str, second: str) -> Column:
        return F.substring_index(after(output, first), second, 1)

    middle = after(output, MIDDLE)
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(changed: DataFrame) -> DataFrame:
    """The digest form of :func:`transform`'s result."""
    back = restored(F.col("output"), F.col("form"))
    return changed.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(back.cast("binary"), 256).alias("restored_sha256"),
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents),
g AS (
  SELECT *, len(u) AS n,
         [CAST('0x' || substr(h, 1, 8) AS BIGINT), CAST('0x' || substr(h, 9, 8) AS BIGINT), CAST('0x' || substr(h, 17, 8) AS BIGINT), CAST('0x' || substr(h, 25, 8) AS BIGINT)] AS r
  FROM d),
c AS (
  SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 50 THEN 'plain'
              WHEN r[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM g),
p AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid, coalesce(array_to_string(u[b + 1:n], ''), '') AS suf
  FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
