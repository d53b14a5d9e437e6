r"""Masked pseudo-likelihood scoring by a bidirectional window network (operator 5).

Tokens are lower-cased words and single marks.  The most frequent words of the corpus have an
id each (:func:`vocabulary_size`: ``VOCABULARY``, more as the corpus has more distinct words);
any other is rare and shares one of ``OOV_SLOTS`` ids of its suffix class.  The
``OWN_CLASS`` most frequent words are output classes by themselves, the rest falls into
``SUFFIX_CLASSES`` by a hash of its last two letters.

The network predicts each token from ``WINDOW`` tokens on either side, itself masked:
``hidden = tanh(sum of per-position embeddings + b)``, ``class = softmax(hidden W + c)``, and
P(token) = P(class | both sides) * P(token | class), the latter from the counts of every word
of the corpus: a rare word has (its count + S(word)) of its class, S a spelling model (a product
of character probabilities) that is all an unseen word has, so the words of a class sum to at
most 1.  A task looks no rare word up: it puts out, per block, each one with its rows, and a
shuffle by the word joins them with the table of counts.  A
document's score is the sum of log P over all of its tokens (its pseudo-log-likelihood), and
``mean_log_prob`` its mean.

Texts are tokenised once: :func:`blocks` writes runs of whole documents as numbers of their words,
with the words and their counts, and what follows reads these and looks every word of a block up once.

Everything is gathered from the whole corpus: word counts by a shuffle, and the weights by
``ROUNDS`` passes in which every task trains in numpy (Adagrad, minibatches) on all tokens of
its texts, starting from the same weights; the tasks' weights are averaged by their numbers
of tokens, in two levels of groups.  What is broadcast (vocabulary, weights) grows with the
square root of the number of distinct words; the table of counts is never broadcast by us.

Edge cases: null texts and texts without a token have 0 tokens and score 0; very long texts
are streamed in chunks; a document's context ends at its own ends; repeated rows train and
score each time; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from myosig.llm.common import written

#: Words with an id of their own, at least; beyond, so many times the root of the distinct words.
VOCABULARY = 2000
ROOTS = 4
OWN_CLASS = 47
SUFFIX_CLASSES = 16
OOV_SLOTS = 16
WINDOW = 2
HIDDEN = 16
ROUNDS = 1
RATE = 0.1
BATCH = 2048
#: Tokens that a task holds at a time.
CHUNK = 32_768
#: Task weights averaged in one group of the first level.
AVERAGED = 16

CLASSES = 1 + OWN_CLASS + SUFFIX_CLASSES
#: Shared ids are 1 to ``SLOTS``, words of the vocabulary follow.
SLOTS = SUFFIX_CLASSES * OOV_SLOTS
IDS = 1 + SLOTS + VOCABULARY
_WIDTH = 2 * WINDOW * HIDDEN
_OFFSETS = [*range(-WINDOW, 0), *range(1, WINDOW + 1)]
_TOKEN = re.compile(r"\w+|[^\w\s]")
#: Characters of the spelling model (any code point, and the end), and the share that any of them has alike.
_CHARACTERS = 0x110000 + 1
_ALIKE = 0.01
#: A block ends at a document with so many tokens or distinct words.
_BLOCK_TOKENS, _BLOCK_WORDS = 4_000_000, 300_000


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def suffix_class(word: str) -> int:
    return zlib.crc32(word[-2:].encode("utf-8", "surrogatepass")) % SUFFIX_CLASSES


def oov_id(word: str) -> int:
    return 1 + suffix_class(word) * OOV_SLOTS + zlib.crc32(word.encode("utf-8", "surrogatepass")) % OOV_SLOTS


class _Suffixes(dict):
    """Suffix classes by the last two letters."""

    def __missing__(self, end: str) -> int:
        c = self[end] = suffix_class(end)
        return c


def oov_ids(words: list[str]) -> np.ndarray:
    """:func:`oov_id` of many words."""
    whole = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.int64, len(words))
    ends = np.fromiter(map(_Suffixes().__getitem__, (w[-2:] for w in words)), np.int64, len(words))
    return 1 + ends * OOV_SLOTS + whole % OOV_SLOTS


def vocabulary_size(distinct: int) -> int:
    return max(VOCABULARY, ROOTS * math.isqrt(distinct))


class Vocabulary:
    """Ids by word (0 is the edge of a text), the class of each id, and log P(id | class).

    ``rest`` is -log of the counts that the words of a shared id have (0 for other ids), ``table``
    the counts of all words and ``characters`` the spelling model's counts (of distinct words).
    """

    def __init__(self, words: list[str], counts: np.ndarray, table: DataFrame | None = None, characters: dict[str, int] | None = None) -> None:
        self.words = words
        self.column = pa.array(words, pa.string())
        self.table = table
        self.ids = {w: 1 + SLOTS + i for i, w in enumerate(words)}
        self.classes = np.zeros(len(counts), np.int64)
        for i, w in enumerate(words):
            self.classes[1 + SLOTS + i] = 1 + i if i < OWN_CLASS else 1 + OWN_CLASS + suffix_class(w)
        self.classes[1 : 1 + SLOTS] = 1 + OWN_CLASS + np.arange(SLOTS) // OOV_SLOTS
        smooth = counts + 1.0
        smooth[0] = 1.0
        smooth[1 + SLOTS + len(words) :] = 0.0
        self.rest = np.zeros(len(counts))
        self.rest[1 : 1 + SLOTS] = -np.log(smooth[1 : 1 + SLOTS])
        whole = sum((characters or {}).values())
        alike = _ALIKE / _CHARACTERS if whole else 1 / _CHARACTERS
        self.characters = {c: math.log((1 - _ALIKE) * n / whole + alike) for c, n in (characters or {}).items()}
        self.other = math.log(alike)
        whole = np.bincount(self.classes, smooth, CLASSES)
        with np.errstate(divide="ignore"):
            self.within = np.log(smooth / np.maximum(whole[self.classes], 1e-12))
        self.seen: dict[str, int] = {}

    def encode(self, words: list[str]) -> np.ndarray:
        if len(self.seen) > 400_000:
            self.seen = {}
        seen = self.seen
        if not seen:
            seen.update(self.ids)
        for w in words:
            if w not in seen:
                seen[w] = oov_id(w)
        return np.fromiter(map(seen.__getitem__, words), np.int64, len(words))

    def spelling(self, word: str) -> float:
        """log S(word): its characters and its end, each by itself."""
        get, other = self.characters.get, self.other
        return sum(get(c, other) for c in word) + get("", other)

    def spellings(self, words: pa.Array) -> np.ndarray:
        """:meth:`spelling` of many words."""
        logs = np.full(_CHARACTERS, self.other)
        for c, x in self.characters.items():
            logs[ord(c) if c else -1] = x
        sums = np.concatenate([[0.0], np.cumsum(logs[np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), "<u4")])])
        ends = np.cumsum(pc.utf8_length(words).to_numpy())
        return np.diff(sums[np.concatenate([[0], ends])]) + logs[-1]

    def __getstate__(self) -> dict:
        return self.__dict__ | {"seen": {}, "table": None}


_BLOCKS = pa.schema([
    ("rows", pa.list_(pa.int64())), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
    ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("slots", pa.binary()), ("low", pa.binary()), ("high", pa.binary()),
])
_BLOCKS_DDL = "rows array<long>, doc_ids array<long>, sizes array<long>, words array<string>, counts array<long>, slots binary, low binary, high binary"


class _Numbers(dict):
    """Numbers of words by first appearance."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def _block_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents; the numbers of their tokens' words in two halves, which compress well."""
    numbers, codes, rows, doc_ids, held = _Numbers(), [], [], [], 0

    def flush() -> pa.RecordBatch:
        x = np.concatenate(codes)
        words = list(numbers)
        lists = (rows, doc_ids, list(map(len, codes)), words, np.bincount(x, minlength=len(numbers)))
        halves = (oov_ids(words).astype("<u2").tobytes(), (x & 0xFFFF).astype("<u2").tobytes(), (x >> 16).astype("<u2").tobytes())
        return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((*lists, *halves), _BLOCKS)], schema=_BLOCKS)

    for b in batches:
        for row, doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            words = tokens(text.as_py())
            codes.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
            rows.append(row)
            doc_ids.append(doc_id)
            held += len(words)
            if held >= _BLOCK_TOKENS or len(numbers) >= _BLOCK_WORDS:
                yield flush()
                numbers, codes, rows, doc_ids, held = _Numbers(), [], [], [], 0
    if rows:
        yield flush()


def blocks(docs: DataFrame) -> DataFrame:
    """The tokens of ``docs`` (text, and doc_id if there is one), written."""
    doc_id = F.col("doc_id").cast("long") if "doc_id" in docs.columns else F.lit(None).cast("long")
    plain = docs.select(F.monotonically_increasing_id().alias("row"), doc_id.alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(plain.mapInArrow(_block_batches, _BLOCKS_DDL), "tokens", compression="zstd")


class _Block:
    """A record of :func:`blocks` read under a vocabulary: ``ids`` of its tokens, document after document."""

    def __init__(self, b: pa.RecordBatch, k: int, v: Vocabulary) -> None:
        get = {f.name: b.column(i)[k] for i, f in enumerate(_BLOCKS)}
        self.rows, self.doc_ids, sizes = (get[c].values for c in ("rows", "doc_ids", "sizes"))
        self.sizes, self.words = sizes.to_numpy(), get["words"].values
        slots, low, high = (np.frombuffer(get[c].as_py(), "<u2") for c in ("slots", "low", "high"))
        self.codes = low | high.astype(np.uint32) << 16
        at = pc.index_in(self.words, value_set=v.column).fill_null(-1).to_numpy(zero_copy_only=False)
        self.table = np.where(at >= 0, 1 + SLOTS + at.astype(np.int64), slots)
        self.ids = self.table[self.codes]

    def documents(self) -> Iterator[np.ndarray]:
        ends = np.cumsum(self.sizes)
        return (self.ids[a:e] for a, e in zip((ends - self.sizes).tolist(), ends.tolist()))

    def rare(self) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """The rare words, where the documents of each begin in the following, documents, and how often."""
        number = np.cumsum(self.table <= SLOTS) - 1
        own, width = np.flatnonzero(self.ids <= SLOTS), max(1, len(self.sizes))
        at = np.repeat(np.arange(len(self.sizes)), self.sizes)[own]
        both, n = np.unique(number[self.codes[own]] * width + at, return_counts=True)
        words = self.words.filter(pa.array(self.table <= SLOTS))
        return words, np.searchsorted(both // width, np.arange(len(words) + 1)), both % width, n


def _read(batches: Iterator[pa.RecordBatch], v: Vocabulary) -> Iterator[_Block]:
    return (_Block(b, k, v) for b in batches for k in range(len(b)))


def _character_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()
    for b in batches:
        held[""] += len(b)
        for word in b.column(0).to_pylist():
            held.update(word)
    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["c", "n"])


def vocabulary(texts: DataFrame) -> Vocabulary:
    """Count every word of the corpus and keep the most frequent; ties by the word itself."""
    return _vocabulary(blocks(texts))


def _vocabulary(parts: DataFrame) -> Vocabulary:
    each = parts.select(F.explode(F.arrays_zip("words", "counts")).alias("w")).select(F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    counts = written(each.groupBy("word").agg(F.sum("n").alias("n")), "words")
    size = vocabulary_size(counts.count())
    top = counts.orderBy(F.desc("n"), "word").limit(size).collect()
    slot = F.lit(1) + (F.crc32(F.substring("word", -2, 2).cast("binary")) % SUFFIX_CLASSES) * OOV_SLOTS + F.crc32(F.col("word").cast("binary")) % OOV_SLOTS
    rows = counts.groupBy(slot.alias("id")).agg(F.sum("n").alias("n")).collect()  # one row per shared id
    characters = counts.select("word").mapInArrow(_character_batches, "c string, n long").groupBy("c").agg(F.sum("n").alias("n")).collect()  # one row per character
    n = np.zeros(1 + SLOTS + size)
    for r in rows:
        n[r.id] = r.n
    for i, r in enumerate(top):
        n[1 + SLOTS + i] = r.n
        n[oov_id(r.word)] -= r.n
    return Vocabulary([r.word for r in top], n, counts, {r.c: r.n for r in characters})


def _sums(x: np.ndarray) -> np.ndarray:
    """Sum of each column: eight partial sums, then pairs of them."""
    parts = x[:8].copy()
    for k in range(8, len(x), 8):
        parts += x[k : k + 8]
    while len(parts) > 1:
        parts = parts[0::2] + parts[1::2]
    return parts[0]


class Network:
    """Weights in numpy, with the squared-gradient sums of Adagrad while training."""

    def __init__(self, flat: np.ndarray | None = None, seed: int = 0, ids: int = IDS) -> None:
        if flat is not None:
            ids = (len(flat) - HIDDEN - (HIDDEN + 1) * CLASSES) // _WIDTH
        self.table = np.zeros((ids, _WIDTH), np.float32)
        self.bias = np.zeros(HIDDEN, np.float32)
        self.out = np.zeros((HIDDEN, CLASSES), np.float32)
        self.base = np.zeros(CLASSES, np.float32)
        if flat is None:
            rng = np.random.default_rng(seed)
            self.table[:] = rng.normal(0, 0.3, self.table.shape)
            self.out[:] = rng.normal(0, 0.1, self.out.shape)
        else:
            at = 0
            for w in self.weights():
                w[...] = flat[at : at + w.size].reshape(w.shape)
                at += w.size
        self.sums = None

    def weights(self) -> list[np.ndarray]:
        return [self.table, self.bias, self.out, self.base]

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights()])

    def _hidden(self, ids: np.ndarray) -> np.ndarray:
        """Hidden layer of ids[WINDOW:-WINDOW]."""
        x = self.table[ids]
        n = len(ids) - 2 * WINDOW
        pre = np.tile(self.bias, (n, 1))
        for k, o in enumerate(_OFFSETS):
            pre += x[WINDOW + o : WINDOW + o + n, k * HIDDEN : (k + 1) * HIDDEN]
        return np.tanh(pre, out=pre)

    def _logits(self, hidden: np.ndarray) -> np.ndarray:
        """A row per class: numpy is slow along short rows."""
        out = self.out.T @ hidden.T
        out += self.base[:, None]
        return out

    def log_classes(self, ids: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """log P(class | both sides) of ids[WINDOW:-WINDOW]."""
        logits = self._logits(self._hidden(ids))
        own = logits[classes, np.arange(len(classes))]
        top = logits.max(0)
        logits -= top
        np.exp(logits, out=logits)
        return own - top - np.log(_sums(logits))

    def train(self, ids: np.ndarray, classes: np.ndarray, real: np.ndarray) -> None:
        """One step on ids[WINDOW:-WINDOW]; edges (not ``real``) are context only."""
        if self.sums is None:
            self.sums = [np.full(len(self.table), 1e-2, np.float32)] + [np.full(w.shape, 1e-2, np.float32) for w in self.weights()[1:]]
        h = self._hidden(ids)
        p = self._logits(h)
        p -= p.max(0)
        np.exp(p, out=p)
        p /= _sums(p)
        p[classes, np.arange(len(classes))] -= 1
        p *= (real / max(1.0, real.sum())).astype(np.float32)
        p = np.ascontiguousarray(p.T)
        g_out, g_base = h.T @ p, p.sum(0)
        d = (p @ self.out.T) * (1 - h * h)
        order = np.argsort(ids.astype(np.uint16) if len(self.table) <= 1 << 16 else ids, kind="stable")
        ranked = ids[order]
        first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
        around = np.zeros((len(ids) + 2 * WINDOW, HIDDEN), np.float32)
        around[2 * WINDOW : 2 * WINDOW + len(d)] = d
        spread = np.take(around, order[:, None] + (WINDOW - np.array(_OFFSETS)), axis=0, mode="clip").reshape(len(ids), _WIDTH)
        g_table, at = np.add.reduceat(spread, first, axis=0), ranked[first]
        self.sums[0][at] += (g_table * g_table).mean(1) * len(d)
        self.table[at] -= (RATE * np.sqrt(len(d)) / np.sqrt(self.sums[0][at]))[:, None] * g_table
        for w, s, g in zip(self.weights()[1:], self.sums[1:], (d.sum(0), g_out, g_base)):
            s += g * g
            w -= RATE * g / np.sqrt(s)


def _streams(texts: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks of ids with ``WINDOW`` edges around every text, and the row of each token (-1: an edge).

    ``texts`` are the ids of each text.  A chunk begins and ends with ``WINDOW`` context tokens that belong to its neighbours.
    """
    edge = np.zeros(WINDOW, np.int64)
    none = np.full(WINDOW, -1)
    ids, rows, held = [edge], [none], WINDOW
    for i, text in enumerate(texts):
        for at in range(0, len(text), CHUNK):
            x = text[at : at + CHUNK]
            ids.append(x)
            rows.append(np.full(len(x), i))
            held += len(x)
            if held >= CHUNK:
                both = np.concatenate(ids), np.concatenate(rows)
                ahead = np.r_[text[at + CHUNK : at + CHUNK + WINDOW], edge][:WINDOW]
                yield np.r_[both[0], ahead], np.r_[both[1], none]
                # the last tokens stay as context of what follows
                ids, rows, held = [both[0][-WINDOW:]], [none], WINDOW
        if len(text):
            ids.append(edge)
            rows.append(none)
            held += WINDOW
    if held > 2 * WINDOW:
        yield np.concatenate([*ids, edge]), np.concatenate([*rows, none])


def _train_batches(vocabulary, flat):
    schema = pa.schema([("part", pa.int32()), ("n", pa.int64()), ("weights", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        net, v, n = Network(flat.value), vocabulary.value, 0
        for ids, rows in _streams(x for b in _read(batches, v) for x in b.documents()):
            for at in range(WINDOW, len(ids) - WINDOW, BATCH):
                to = min(at + BATCH, len(ids) - WINDOW)
                real = rows[at:to] >= 0
                if real.any():
                    net.train(ids[at - WINDOW : to + WINDOW], v.classes[ids[at:to]], real)
                    n += int(real.sum())
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([n], pa.int64()), pa.array([net.flat().astype(np.float32).tobytes()], pa.binary())], schema=schema)

    return run


def _average(pdf: pd.DataFrame) -> pd.DataFrame:
    n, total = 0, None
    for k, w in zip(pdf["n"], pdf["weights"]):
        x = np.frombuffer(w, np.float32).astype(np.float64) * k
        total = x if total is None else total + x
        n += k
    return pd.DataFrame({"part": [int(pdf["part"].iloc[0])], "n": [n], "weights": [(total / n).astype(np.float32).tobytes()]})


def train(texts: DataFrame, v: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Train on all tokens of all texts; returns the flat weights."""
    return _train(blocks(texts), v, rounds)


def _train(tokenised: DataFrame, v: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    sc, ddl = tokenised.sparkSession.sparkContext, "part int, n long, weights binary"
    words, flat = sc.broadcast(v), Network(ids=len(v.classes)).flat()
    for _ in range(rounds):
        parts = written(tokenised.mapInArrow(_train_batches(words, sc.broadcast(flat)), ddl), "weights")
        n = parts.count()
        while n > 1:
            parts = written(parts.groupBy(F.floor(F.col("part") / AVERAGED).alias("part")).applyInPandas(_average, ddl).withColumn("part", F.floor(F.col("part") / AVERAGED).cast("int")), "weights")
            n = parts.count()
        got = parts.first()
        if got is None:
            break
        flat = np.frombuffer(got.weights, np.float32)
    return flat


_SCORED = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("log_prob", pa.float64()),
    ("word", pa.string()), ("spelling", pa.float64()), ("rows", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())),
])
_SCORED_DDL = "row long, doc_id long, n_tokens long, log_prob double, word string, spelling double, rows array<long>, times array<long>"


def _score_batches(vocabulary, flat):
    """A record for every document, and one for every rare word of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, v = Network(flat.value), vocabulary.value
        for b in _read(batches, v):
            total, count = _score_ids(net, v, b.documents(), len(b.sizes))
            yield _record(len(b.sizes), row=b.rows, doc_id=b.doc_ids, n_tokens=pa.array(count), log_prob=pa.array(total))
            words, first, at, n = b.rare()
            if len(words):
                lists = [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(x, pa.int64())) for x in (b.rows.to_numpy()[at], n)]
                yield _record(len(words), word=words, spelling=pa.array(v.spellings(words)), rows=lists[0], times=lists[1])

    return run


def _record(n: int, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in _SCORED], schema=_SCORED)


def score_texts(net: Network, v: Vocabulary, texts: Iterator[str | None], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of log P and numbers of tokens of ``n`` texts.

    For the rare words, log(count + S(word)) is still to be added.
    """
    return _score_ids(net, v, (v.encode(tokens(t)) for t in texts), n)


def _score_ids(net: Network, v: Vocabulary, texts: Iterator[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    total, count = np.zeros(n), np.zeros(n, np.int64)
    for ids, rows in _streams(texts):
        for at in range(WINDOW, len(ids) - WINDOW, BATCH):
            to = min(at + BATCH, len(ids) - WINDOW)
            r = rows[at:to]
            x = ids[at:to]
            p = net.log_classes(ids[at - WINDOW : to + WINDOW], v.classes[x]) + v.within[x] + v.rest[x]
            own = r >= 0
            total += np.bincount(r[own], p[own], n)
            count += np.bincount(r[own], minlength=n)
    return total, count


def score(docs: DataFrame, v: Vocabulary | None = None, flat: np.ndarray | None = None) -> DataFrame:
    """doc_id, n_tokens, log_prob and mean_log_prob of every document; fits on ``docs`` unless given a model."""
    sc = docs.sparkSession.sparkContext
    tokenised = blocks(docs)
    v = v or _vocabulary(tokenised)
    flat = _train(tokenised, v) if flat is None else flat
    out = written(tokenised.mapInArrow(_score_batches(sc.broadcast(v), sc.broadcast(flat)), _SCORED_DDL), "scored")
    counts = v.table if v.table is not None else docs.sparkSession.createDataFrame([], "word string, n long")
    rare = out.where(F.col("word").isNotNull()).select("word", "spelling", "rows", "times").join(counts, "word", "left")
    log_n = F.when(F.col("n").isNull(), F.col("spelling")).otherwise(F.log(F.col("n") + F.exp("spelling")))
    added = rare.select(log_n.alias("log_n"), F.explode(F.arrays_zip("rows", "times")).alias("at")).select(
        F.col("at.rows").alias("row"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_tokens"), (F.col("log_n") * F.col("at.times")).alias("log_prob")
    )
    base = out.where(F.col("word").isNull()).select("row", "doc_id", "n_tokens", "log_prob")
    sums = base.unionByName(added).groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"), F.sum("log_prob").alias("log_prob"))
    return sums.select("doc_id", "n_tokens", "log_prob", (F.col("log_prob") / F.greatest("n_tokens", F.lit(1))).alias("mean_log_prob"))
