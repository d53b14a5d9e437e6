"""Quality classifier by nearest-neighbour voting in a latent-semantic space (operator 9).

Terms are hashed: trigrams of the text's *shape* (case, digits, white space and each mark,
letters left out) and lower-cased character 4-grams.  Training weighs a bounded,
hash-chosen sample of labelled texts by sublinear tf and idf and takes a truncated SVD of
it; the labelled latent vectors (at most ``SAMPLE``) and the projection are broadcast, both
of a size that doesn't depend on the corpus.  Scoring projects every whole text and computes
its exact cosine to every labelled vector, in blocks of documents by matrix products; the
``NEIGHBOURS`` nearest vote for their label with weight ``similarity ** SHARPNESS``.

``score`` is the weighted share of label 1, with the base rate as one more weak vote, so an
empty text (zero vector, no similarity) scores the base rate.

Edge cases: null and empty texts score the base rate; ties in similarity are broken by the
labelled row's place (rows sorted by label and text hash); long texts are counted in
segments; rows with several or null labels teach by their first non-null label only if
all agree; without any labelled row every score is 0.5; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from myosig.llm.common import code_points, held_out, lean, segments, teachable

SHAPE_BITS, CHAR_BITS = 11, 12
TERMS = (1 << SHAPE_BITS) + (1 << CHAR_BITS)
RANK = 48
#: Labelled texts that are broadcast, at most about so many of each label.
SAMPLE = 1000
NEIGHBOURS = 25
SHARPNESS = 4
PRIOR_VOTES = 0.05
#: A score from which on a document is predicted to be of quality 1.
ACCEPT = 0.7
#: A score below which a filter drops a document; between the two a document is doubtful and stays.
REJECT_BELOW = 0.3
#: Documents per block of the cosine product.
BLOCK = 512

_BMP = 0x10000
_SHAPES: np.ndarray | None = None


def _shapes() -> np.ndarray:
    """Code point to a small class: lower, upper and other letters, digits, space, line end, and marks by code."""
    table = np.full(_BMP + 1, 7, np.uint32)
    for i in range(_BMP):
        c = chr(i)
        if c.isalpha():
            table[i] = 1 if c.islower() else 2 if c.isupper() else 3
        elif c.isdigit():
            table[i] = 4
        elif c == "\n":
            table[i] = 6
        elif c.isspace():
            table[i] = 5
        else:
            table[i] = 8 + i % 1009
    return table


def _hash(c: np.ndarray, n: int, bits: int) -> np.ndarray:
    h = np.full(max(0, len(c) - n + 1), 0x811C9DC5, np.uint32)
    for k in range(n):
        h ^= c[k : k + len(h)]
        h *= np.uint32(0x01000193)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    return h >> np.uint32(32 - bits)


def term_counts(texts: list[str | None]) -> np.ndarray:
    """Counts of the hashed terms, one row per text."""
    global _SHAPES
    if _SHAPES is None:
        _SHAPES = _shapes()
    out = np.zeros((len(texts), TERMS), np.float32)
    split = 1 << SHAPE_BITS
    for rows, parts in segments([t or "" for t in texts], 3):
        for i, p in zip(rows, parts):
            if not p:
                continue
            s = _SHAPES[np.minimum(code_points(p), _BMP)]
            # runs of one class count once: words of any length look alike
            s = s[np.r_[True, s[1:] != s[:-1]]]
            out[i, :split] += np.bincount(_hash(s, 3, SHAPE_BITS), minlength=split)
            out[i, split:] += np.bincount(_hash(code_points(p.lower()), 4, CHAR_BITS), minlength=TERMS - split)
    return out


class Model:
    def __init__(self, idf: np.ndarray, projection: np.ndarray, vectors: np.ndarray, labels: np.ndarray, rate: float) -> None:
        self.idf, self.projection, self.vectors, self.labels, self.rate = idf, projection, vectors, labels, rate

    def latent(self, counts: np.ndarray) -> np.ndarray:
        """Unit vectors in the latent space; a zero row stays zero."""
        return _unit(_weigh(counts, self.idf) @ self.projection)

    def score(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        near = np.clip(self.latent(counts) @ self.vectors.T, 0, 1)
        k = min(NEIGHBOURS, near.shape[1])
        top = _nearest(near, k)
        w = np.take_along_axis(near, top, 1).astype(np.float64) ** SHARPNESS
        return (w * self.labels[top]).sum(1) / (w.sum(1) + PRIOR_VOTES) + PRIOR_VOTES * self.rate / (w.sum(1) + PRIOR_VOTES)


def _nearest(near: np.ndarray, k: int) -> np.ndarray:
    """Columns of each row's k largest values; of equal ones at the k-th place the first columns."""
    least = np.partition(near, -k, axis=1)[:, -k, None]
    above, equal = near > least, near == least
    # equal ones fill the places that the larger ones leave, from the left
    kept = above | (equal & (np.cumsum(equal, axis=1) <= k - above.sum(1, keepdims=True)))
    return np.nonzero(kept)[1].reshape(len(near), k)


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Sublinear tf by idf; the two families of terms count alike, whatever the text's length."""
    split = 1 << SHAPE_BITS
    out = np.empty_like(counts)
    for part in (slice(0, split), slice(split, TERMS)):
        x = counts[:, part]
        x = np.log1p(100 * x / np.maximum(x.sum(1, keepdims=True), 1)) * idf[part]
        out[:, part] = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    return out


def fit(texts: list[str], labels: list[int], rate: float | None = None, seed: int = 0) -> Model:
    """LSA of the labelled texts (driver, bounded): randomized subspace iteration in numpy."""
    if not texts:
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, RANK), np.float32), np.zeros((0, RANK), np.float32), np.zeros(0), 0.5)
    counts = np.vstack([term_counts(texts[i : i + 256]) for i in range(0, len(texts), 256)])
    idf = np.log((1 + len(texts)) / (1 + (counts > 0).sum(0))).astype(np.float32) + 0.1
    for i in range(0, len(counts), 256):
        counts[i : i + 256] = _weigh(counts[i : i + 256], idf)  # in place: the driver holds the matrix once
    rank = min(RANK, len(texts))
    q = np.linalg.qr(counts.T @ np.random.default_rng(seed).standard_normal((len(texts), rank)).astype(np.float32))[0]
    for _ in range(4):
        q = np.linalg.qr(counts.T @ (counts @ q))[0]
    model = Model(idf, np.ascontiguousarray(q, np.float32), np.zeros((0, rank), np.float32), np.asarray(labels, np.float64), 0.0)
    model.vectors = np.vstack([_unit(counts[i : i + 256] @ model.projection) for i in range(0, len(counts), 256)])
    model.rate = float(np.mean(labels)) if rate is None else rate
    return model


def sample(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE) -> DataFrame:
    """Teachable labelled texts: about ``per_label`` of each label, chosen by a hash of the id."""
    agreed = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("lo"), F.max("quality").alias("hi"))
        .where("lo = hi").select("doc_id", F.col("lo").cast("int").alias("quality"))
    )
    agreed = agreed.where(teachable()).withColumn("h", F.pmod(F.xxhash64(F.col("doc_id"), F.lit(29)), F.lit(1_000_000)))
    sizes = agreed.groupBy("quality").count()
    chosen = agreed.join(F.broadcast(sizes), "quality").where(F.col("h") < F.lit(per_label * 1e6) / F.col("count")).select("doc_id", "quality", F.col("count").alias("n"))
    texts = docs.where(teachable() & F.col("text").isNotNull()).select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")  # at most about per_label rows of each label


def train(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE) -> Model:
    rows = sorted(sample(docs, labels, per_label).collect(), key=lambda r: (r.quality, r.doc_id, r.text))
    n = {r.quality: r.n for r in rows}
    return fit([r.text for r in rows], [r.quality for r in rows], n.get(1, 0) / sum(n.values()) if n else None)


def scores(model: Model, texts: list[str | None]) -> np.ndarray:
    return np.concatenate([model.score(term_counts(texts[i : i + BLOCK])) for i in range(0, len(texts), BLOCK)] or [np.zeros(0)])


def scorer(docs: DataFrame, model: Model):
    """A column function: text to score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def voted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for s in batches:
                yield pd.Series(scores(shared.value, [t if isinstance(t, str) else None for t in s]))

        yield from lean(voted)(batches)

    return score


def classify(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    udf = scorer(docs, model or train(docs, labels))
    out = docs.select(F.col("doc_id"), held_out().alias("held_out"), udf(F.col("text").cast("string")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))
