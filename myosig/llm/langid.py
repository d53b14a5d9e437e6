"""Language identification by language-bitmask n-gram filters (operator 4).

Training: from a bounded, hash-chosen sample of labelled texts per language, count hashed
character n-grams; a language *contains* an n-gram if its rate there is at least
``CONTAINS`` of the highest rate over all languages (and it was seen twice).  All languages
share one bit-sliced Bloom filter: slot ``h`` of the table holds one bit per language, so
one lookup, the AND of ``PROBES`` slots, returns every language that contains the n-gram.

Prediction: per-language popcounts over all n-grams of the whole text, corrected for the
filter's false positives: a language whose slots are filled to ``f`` answers yes by chance
with ``f ** PROBES``; (observed - n p) / (1 - p) estimates the true count.  The language
with the highest count wins, ties by name; with no hit at all the commonest language does.
``score`` is the winner's corrected share of the text's n-grams.

The model is a table of ``2 ** SLOT_BITS`` masks (one 64-bit word per 64 languages) whose
size doesn't depend on the corpus; it is broadcast.  One pass over the table, no shuffle.

Edge cases: null texts and texts without a letter are ``und`` with score 0; very long texts
are counted in segments; null ids, sources or langs don't matter to a prediction (a null
lang teaches nothing); an empty or unlabelled table predicts ``und`` everywhere; extra
columns are kept out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from myosig.llm.common import code_points, held_out, lean, segments, teachable

UNKNOWN = "und"
ORDERS = (3, 5)
SLOT_BITS = 20
PROBES = 2
CONTAINS = 0.25
#: Labelled texts per language that the filter is fitted on, at most about so many.
SAMPLE_PER_LANGUAGE = 800
#: A text with fewer of its n-grams in the winning language is taken for none of them.
REJECT_BELOW = 0.2

_BMP = 0x10000
_MIXED = np.uint32(0x9E3779B1)


def _letters() -> np.ndarray:
    """Code point to itself if a letter, else to a space; one slot for all beyond the BMP."""
    table = np.full(_BMP + 1, 32, np.uint32)
    for i in range(_BMP):
        if chr(i).isalpha():
            table[i] = i
    table[_BMP] = _BMP
    return table


_LETTERS: np.ndarray | None = None


def hashed_ngrams(piece: str) -> list[np.ndarray]:
    """Hashes of the n-grams of each order; those that begin and end in no letter are left out."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = _letters()
    c = _LETTERS[np.minimum(code_points(f" {piece} "), _BMP)]
    gap = c == 32
    out = []
    for n in ORDERS:
        if len(c) < n:
            out.append(np.empty(0, np.uint32))
            continue
        h = np.full(len(c) - n + 1, n, np.uint32)
        for k in range(n):
            h *= np.uint32(0x01000193)
            h ^= c[k : len(c) - n + 1 + k]
        keep = ~gap[1 : len(c) - n + 2]  # the second character: " ab" stays, "  a" and "a b" go
        h = h[keep]
        h ^= h >> np.uint32(15)
        h *= _MIXED
        h ^= h >> np.uint32(13)
        out.append(h)
    return out


class Filter:
    """The fitted tables: ``masks`` per slot and 64 languages, and each language's chance of a false yes."""

    def __init__(self, languages: list[str], masks: np.ndarray, chance: np.ndarray, commonest: int) -> None:
        self.languages, self.masks, self.chance, self.commonest = languages, masks, chance, commonest

    def _slots(self, h: np.ndarray) -> list[np.ndarray]:
        return [(h * np.uint32(m)) >> np.uint32(32 - SLOT_BITS) for m in (0x85EBCA6B, 0xC2B2AE35)[:PROBES]]

    def counts(self, h: np.ndarray) -> np.ndarray:
        """Popcount of each language's bit over the hashes."""
        out = np.zeros(len(self.languages))
        for w in range(self.masks.shape[1]):
            table = self.masks[:, w]
            first, *more = self._slots(h)
            bits = table[first]
            for s in more:
                bits &= table[s]
            for k in range(64 * w, min(64 * w + 64, len(self.languages))):
                out[k] = np.count_nonzero(bits & table.dtype.type(1 << (k - 64 * w)))
        return out


def fit(texts: list[str], labels: list[str]) -> Filter:
    """Fit the filter on labelled texts (driver, bounded sample)."""
    languages = sorted(set(labels))
    index = {x: i for i, x in enumerate(languages)}
    words = max(1, -(-len(languages) // 64))
    dtype = np.uint8 if len(languages) <= 8 else np.uint64
    masks = np.zeros((1 << SLOT_BITS, words), dtype)
    if not languages:
        return Filter([], masks, np.zeros(0), 0)
    totals = np.zeros(len(languages))
    filled = Filter(languages, masks, np.zeros(len(languages)), 0)
    pairs = []
    for k, language in enumerate(languages):  # one language's n-grams at a time
        own = [h for t, g in zip(texts, labels) if g == language for _, parts in segments([t.lower()], max(ORDERS) - 1) for p in parts for h in hashed_ngrams(p)]
        values, n = np.unique(np.concatenate(own or [np.empty(0, np.uint32)]), return_counts=True)
        del own
        totals[k] = max(1, n.sum())
        pairs.append((values[n >= 2], n[n >= 2] / totals[k]))
    every, inverse = np.unique(np.concatenate([v for v, _ in pairs]), return_inverse=True)
    top, at = np.zeros(len(every)), 0
    for v, rate in pairs:
        np.maximum.at(top, inverse[at : at + len(v)], rate)
        at += len(v)
    at = 0
    for k, (v, rate) in enumerate(pairs):
        own = v[rate >= CONTAINS * top[inverse[at : at + len(v)]]]
        at += len(v)
        for s in filled._slots(own):
            masks[s, k // 64] |= dtype(1 << (k % 64))
    full = np.array([np.count_nonzero(masks[:, k // 64] & dtype(1 << (k % 64))) for k in range(len(languages))]) / len(masks)
    return Filter(languages, masks, np.minimum(full**PROBES, 0.99), int(np.argmax(np.bincount([index[x] for x in labels]))))


def predict(model: Filter, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and score of each text."""
    hits = np.zeros((len(texts), max(1, len(model.languages))))
    total = np.zeros(len(texts))
    letters = np.zeros(len(texts), bool)
    for rows, parts in segments([t.lower() if t else "" for t in texts], max(ORDERS) - 1):
        for i, p in zip(rows, parts):
            letters[i] |= any(map(str.isalpha, p))
            if model.languages:
                h = np.concatenate(hashed_ngrams(p))
                total[i] += len(h)
                hits[i] += model.counts(h)
    if not model.languages:
        return [(UNKNOWN, 0.0)] * len(texts)
    true = np.clip((hits - total[:, None] * model.chance) / (1 - model.chance), 0, None)
    best = true.argmax(1)
    score = np.clip(true.max(1) / np.maximum(total, 1), 0, 1)
    best[true.max(1) == 0] = model.commonest
    return [(model.languages[b], float(s)) if ok else (UNKNOWN, 0.0) for b, s, ok in zip(best, score, letters)]


def sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """Teachable labelled texts: about ``per_language`` of each language, chosen by a hash of the id."""
    known = docs.where(teachable() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("doc_id"), F.lit(17)).alias("h"))
    sizes = known.groupBy("lang").count()
    share = F.lit(float(per_language)) / F.col("count")
    return known.join(F.broadcast(sizes), "lang").where(F.pmod("h", F.lit(1_000_000)) < share * 1_000_000).select("lang", "text")


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Filter:
    rows = sample(docs, per_language).collect()  # at most about per_language texts of each language
    return fit([r.text for r in rows], [r.lang for r in rows])


def predictor(docs: DataFrame, model: Filter):
    """A column function: text to struct<lang_pred, score>."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def identify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for s in batches:
                yield pd.DataFrame(predict(shared.value, [t if isinstance(t, str) else None for t in s]), columns=["lang_pred", "score"])

        yield from lean(found)(batches)

    return identify


def identify(docs: DataFrame, model: Filter | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    udf = predictor(docs, model or train(docs))
    out = docs.select(F.col("doc_id"), held_out().alias("held_out"), udf(F.col("text").cast("string")).alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score")


def accepted(p: Column) -> Column:
    """The filter's verdict on a prediction: a known language that explains enough of the text."""
    return (p["lang_pred"] != UNKNOWN) & (p["score"] >= REJECT_BELOW)
