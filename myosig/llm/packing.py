"""Best-fit packing of token sequences with swap-based local search (operator 3).

Texts are tokenised in Arrow batches: a text is cut where the tokenizer cuts it (no token of
the vocabulary crosses a cut), and each distinct run of letters or marks is encoded once per
worker and kept in a bounded table.  A document's ids end in ``END_ID``; only one longer than a sequence is
cut, into full pieces and a rest.

Full pieces are sequences by themselves.  The rests are dealt at random into groups of about
``GROUP_PIECES``, as many groups as the corpus needs, and each group is packed by itself:
best fit in decreasing order, then local search that moves documents, or exchanges them
one-for-one and two-for-one, between underfull bins as long as the sum of squared fills rises,
the emptiest bin first, until bins are empty and go.  It ends at the group's lower bound
where no change between any two bins improves, or after ``SEARCH_STEPS`` tries.  A group is a few thousand pairs of numbers
whatever the corpus; the loss to grouping is below one sequence per group.

Edge cases: a null or empty text is the end id alone; repeated rows are packed each; an empty
table gives no rows; very long texts are tokenised whole, piece by piece; extra columns are
ignored.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from myosig.llm.common import lean, written

SEQUENCE = 4096
END_ID = 1
GROUP_PIECES = 6000
#: Changes that the local search of a group tries at most.
SEARCH_STEPS = 4000
#: Runs that a worker keeps encoded; beyond, a new table begins and the last one is kept beside it.
CACHED_WORDS = 400_000
#: Bytes of a text whose runs are taken at a time, about.
STRETCH = 1 << 20
#: How the tokenizer must lower and cut texts for them to be cut here ...
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": _CUT}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]}
#: ... and the same on Latin-1 bytes of these characters, letters in lower case.
_PLAIN = bytes([*b"\t\n\r", *range(0x20, 0x7F), *(i for i in range(0xC0, 0x100) if i not in (0xD7, 0xF7))])
_LOWER = bytes(i + 32 if i in _PLAIN and chr(i).isupper() else i for i in range(256))
_RUN = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xff]+|[0-9]|[^\sa-z\xdf-\xff0-9]+")
_GROUP_BITS = 24

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Token ids of whole texts: every distinct run of letters, digit and run of marks is encoded once and kept.

    A text of Latin-1 letters, digits and common marks is lowered and cut by the tokenizer's own rule into
    these runs, which its model spells one by one.  Other texts go word by word: a word of such characters
    in the same way, any other alone through the whole tokenizer.  So does every word if the tokenizer cuts otherwise.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        rules = json.loads(self.tokenizer.to_str())
        self.cuts = (rules["normalizer"], rules["pre_tokenizer"]) == (_NORMALIZER, _PRE_TOKENIZER)
        self.special = tuple(t["content"] for t in rules["added_tokens"])
        spelled = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelled = {i: spelled.pre_tokenize_str(chr(i))[0][0] for i in _PLAIN if i > 127}
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {"": b""}

    def _one(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, run: bytes) -> bytes:
        """Ids of a run that is not in ``known``; when that is full, what was not used since it last was is dropped."""
        if len(self.known) >= CACHED_WORDS:
            self.known, self.older = {}, self.known
        if (ids := self.older.get(run)) is None:
            found = [t.id for t in self.model.tokenize(run.decode("latin-1").translate(self.spelled))]
            ids = struct.pack(f"<{len(found)}I", *found)
        self.known[run] = ids
        return ids

    def _runs(self, text: str) -> bytes | None:
        """The lowered bytes of a text that may be cut into runs, else None."""
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        if not self.cuts or raw.translate(None, _PLAIN) or any(t in text for t in self.special):
            return None
        return raw.translate(_LOWER)

    def _joined(self, raw: bytes) -> list[bytes]:
        """Ids of the runs of ``raw``, cut at spaces into stretches of about ``STRETCH`` bytes."""
        out, at = [], 0
        while at < len(raw):
            to = raw.find(b" ", at + STRETCH)
            runs = _RUN.findall(raw, at, to if to >= 0 else len(raw))
            coded = list(map(self.known.get, runs))
            if None in coded:
                coded = [x or self.known.get(r) or self._learn(r) for r, x in zip(runs, coded)]
            out.append(b"".join(coded))
            at = to if to >= 0 else len(raw)
        return out

    def _word(self, word: str) -> bytes:
        if (ids := self.words.get(word)) is None:
            if len(self.words) >= CACHED_WORDS:
                self.words = {"": b""}
            ids = self.words[word] = self._one(word) if (raw := self._runs(word)) is None else b"".join(self._joined(raw))
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers, the end id included."""
        end, out = END_ID.to_bytes(4, "little"), []
        for text in texts:
            raw = self._runs(text)
            out.append(b"".join([*(map(self._word, text.replace("\n", " ").split(" ")) if raw is None else self._joined(raw)), end]))
        return out

    def ids(self, text: str) -> bytes:
        return self.encode([text])[0]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, tokenizer: str | None = None, with_ids: bool = False, sequence: int = SEQUENCE) -> DataFrame:
    """The pieces of every document: place, length, checksum, and the ids themselves on demand."""
    path, size = tokenizer or default_tokenizer(), 4 * sequence
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for b in batches:
            for at in range(0, len(b), 512):
                part, out = b.slice(at, 512), []
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode([t or "" for t in part.column(1).to_pylist()])):
                    for k, start in enumerate(range(0, len(ids), size)):
                        x = ids[start : start + size]
                        out.append((doc_id, k, start // 4, len(x) // 4, zlib.crc32(x)) + ((x,) if with_ids else ()))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(lean(run), _PIECES + ", ids binary" * with_ids)


class _Bins:
    """Bins under local search; ``items[b]`` holds the numbers of bin b's pieces, ascending by length."""

    def __init__(self, lengths: list[int], capacity: int) -> None:
        self.lengths, self.capacity = lengths, capacity
        self.items: list[list[int]] = []
        self.fill: list[int] = []

    def best_fit(self) -> None:
        """Best fit, longest first: the fullest bin that still has room."""
        open_: list[tuple[int, int]] = []  # (room, bin), ascending
        for i in sorted(range(len(self.lengths)), key=lambda i: (-self.lengths[i], i)):
            n = self.lengths[i]
            k = bisect_left(open_, (n, -1))
            if k < len(open_):
                room, b = open_.pop(k)
            else:
                room, b = self.capacity, len(self.items)
                self.items.append([])
                self.fill.append(0)
            self.items[b].append(i)
            self.fill[b] += n
            if room > n:
                insort(open_, (room - n, b))

    def _exchange(self, a: int, give: list[int], b: int, take: list[int]) -> None:
        for i in give:
            self.items[a].remove(i)
        for i in take:
            self.items[b].remove(i)
        self.items[a] += take
        self.items[b] += give
        gain = sum(self.lengths[i] for i in give) - sum(self.lengths[i] for i in take)
        self.fill[a] -= gain
        self.fill[b] += gain

    def _step(self, a: int) -> bool:
        """One improving change that empties bin ``a`` further; False if there is none.

        Moving d tokens from a to a bin of fill f raises the sum of squares by 2d(f + d - fill a).
        """
        lengths, cap = self.lengths, self.capacity
        own = sorted(self.items[a], key=lambda i: -lengths[i])
        under = [b for b in range(len(self.items)) if b != a and self.items[b] and self.fill[b] < cap]
        if not under or not own:
            return False
        room = np.array([cap - self.fill[b] for b in under])
        # move: the longest document that fits somewhere, into the fullest bin that takes it
        for i in own:
            fits = np.flatnonzero(room >= lengths[i])
            fits = fits[[self.fill[under[k]] + lengths[i] > self.fill[a] for k in fits]] if len(fits) else fits
            if len(fits):
                self._exchange(a, [i], under[fits[np.argmin(room[fits])]], [])
                return True
        flat = [(i, k) for k, b in enumerate(under) for i in self.items[b]]
        theirs, where = np.array([lengths[i] for i, _ in flat]), np.array([k for _, k in flat])
        limit = room[where]
        fills = np.array([self.fill[b] for b in under])[where]

        def best(n: int) -> tuple[int, int]:
            d = n - theirs
            d = np.where((d > 0) & (d <= limit) & (fills + d > self.fill[a]), d, 0)
            k = int(d.argmax())
            return int(d[k]), k

        # one for one, and two of ours for one of theirs
        offers = [([i], lengths[i]) for i in own] + [([i, j], lengths[i] + lengths[j]) for x, i in enumerate(own) for j in own[x + 1 :]]
        gain, k, give = max(((*best(n), g) for g, n in offers), key=lambda x: x[0])
        if gain:
            self._exchange(a, give, under[where[k]], [flat[k][0]])
            return True
        # one of ours for two of theirs
        for k, b in enumerate(under):
            its = self.items[b]
            if len(its) < 2:
                continue
            x = np.array([lengths[i] for i in its])
            pair = np.triu(x[:, None] + x[None, :], 1)
            for i in own:
                d = lengths[i] - pair
                d = np.where((pair > 0) & (d > 0) & (d <= room[k]) & (self.fill[b] + d > self.fill[a]), d, 0)
                if d.max() > 0:
                    p, q = np.unravel_index(int(d.argmax()), d.shape)
                    self._exchange(a, [i], b, [its[p], its[q]])
                    return True
        return False

    def bound(self) -> int:
        """No packing has fewer bins (Martello and Toth's L2).

        With a threshold k up to half a bin: lengths over capacity - k stand alone, those over half a bin
        up to it share none among themselves, and what lengths from k to half need beyond their room adds bins.
        """
        x, cap = np.sort(np.array(self.lengths, np.int64)), self.capacity
        total = np.concatenate([[0], np.cumsum(x)])
        half = np.searchsorted(x, cap // 2, side="right")
        k = np.unique(np.concatenate([[0], x[:half]]))
        alone, low = np.searchsorted(x, cap - k, side="right"), np.searchsorted(x, k)
        room = (alone - half) * cap - (total[alone] - total[half])
        return int((len(x) - half + np.maximum(0, -((room - (total[half] - total[low])) // cap))).max())

    def search(self, bound: int, steps: int = SEARCH_STEPS) -> None:
        """Empty bins, emptiest first, until the lower bound, a round over all bins that changes nothing, or ``steps`` tries.

        A bin that is stuck is left for the next emptiest one: every change raises the sum of squared fills, and
        one between two other bins may open the room that the emptiest needs, so rounds begin with it again.
        """
        changed = True
        while changed:
            changed = False
            left = [b for b in range(len(self.items)) if self.items[b] and self.fill[b] < self.capacity]
            for a in sorted(left, key=lambda b: (self.fill[b], b)):
                while self.items[a]:
                    if steps == 0 or sum(map(bool, self.items)) <= bound:
                        return
                    steps -= 1
                    if not self._step(a):
                        break
                    changed = True


def pack(lengths: list[int], capacity: int = SEQUENCE) -> tuple[list[int], list[int]]:
    """Bin and offset of every length."""
    bins = _Bins(list(map(int, lengths)), capacity)
    bins.best_fit()
    bins.search(bins.bound())
    number, offset = [0] * len(lengths), [0] * len(lengths)
    for n, items in enumerate(x for x in bins.items if x):
        at = 0
        for i in items:
            number[i], offset[i] = n, at
            at += bins.lengths[i]
    return number, offset


def assign(parts: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """Adds sequence_id and offset to pieces; ``parts`` is a written table (its row order numbers the rows)."""
    rest = parts.where(F.col("length") < sequence)
    groups = max(1, -(-rest.count() // GROUP_PIECES))
    names = parts.columns
    dealt = rest.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "ids_crc32", "doc_id", "piece"], ascending=False, kind="stable", ignore_index=True)
        number, offset = pack(pdf["length"].tolist(), sequence)
        out = pdf[names].copy()
        out["sequence_id"] = (int(key[0]) << _GROUP_BITS) + np.asarray(number, np.int64)
        out["offset"] = np.asarray(offset, np.int64)
        return out

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema) + ", sequence_id long, offset long"
    packed = dealt.groupBy("_group").applyInPandas(run, ddl)
    full = parts.where(F.col("length") >= sequence).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    return packed.unionByName(full)


def best_fit(docs: DataFrame, tokenizer: str | None = None, with_ids: bool = False, sequence: int = SEQUENCE) -> DataFrame:
    """Every piece with its sequence and offset."""
    return assign(written(pieces(docs, tokenizer, with_ids, sequence), "packing"), sequence)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids of every sequence, from pieces packed ``with_ids``."""

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("offset")
        return pd.DataFrame({"sequence_id": pdf["sequence_id"].iloc[:1], "ids": [np.frombuffer(b"".join(pdf["ids"]), "<u4").astype(np.int64).tolist()]}, index=pdf.index[:1])

    return packed.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInPandas(join, "sequence_id long, ids array<long>")
