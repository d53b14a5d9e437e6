r"""Quality rules by hashed n-gram log-likelihood ratio (operator 10), DataFrame functions only.

Tokens are lower-cased runs of letters and digits, and runs of marks; unigrams and bigrams
are hashed into ``BUCKETS``.  Two add-one smoothed multinomials are counted over all whole
texts: the trusted target (documents whose label says quality 1) and the raw corpus (all).
A document's verdict is the mean of log(target / raw) over its n-grams against a fixed
threshold, the same for every document: no sampling, no top-k.

The counting job shuffles at most two rows per bucket and task.  The log ratios (``BUCKETS``
doubles, whatever the corpus) come to the driver and go out as a constant of the scoring
plan, which reads the table once more and shuffles nothing.  Trusted ids are broadcast up
to ``BROADCAST_IDS`` of them; beyond that the texts are joined by a shuffle.

Base rules: word and line counts as in :func:`base_rules`; a document fails if it has under
50 words or more than half of them lie in 3-word windows found twice or more.

Edge cases: null texts count as empty, have no words and fail; a document without tokens
has ratio 0; repeated rows count each time they stand in the table; a null label or id
trusts nothing, and with no trusted document every ratio is 0; extra columns are ignored.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 10_000
THRESHOLD = -0.25
BROADCAST_IDS = 2_000_000
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

_SPACE = r"[\x20\x09-\x0D]+"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, _SPACE), lambda w: w != "")


def _tokens(text: Column) -> Column:
    """Tokens of a text."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}\p{M}]+|[^\s\p{L}\p{N}\p{M}]+"), F.lit(0))


def _buckets(tokens: str) -> Column:
    """Buckets of the unigrams and bigrams of a column of tokens."""
    t = F.col(tokens)
    one = F.transform(t, lambda x: F.pmod(F.xxhash64(x), F.lit(BUCKETS)).cast("int"))
    two = F.transform(F.slice(t, 2, F.greatest(F.size(t), F.lit(1))), lambda x, i: F.pmod(F.xxhash64(F.get(t, i), x), F.lit(BUCKETS)).cast("int"))
    return F.concat(one, two)


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def log_ratios(docs: DataFrame, trusted_ids: DataFrame) -> list[float]:
    """log(target / raw) of every bucket, counted over all documents."""
    ids = trusted_ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct().withColumn("trusted", F.lit(True))
    side = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    tokens = _plain(docs).join(side, "doc_id", "left").select(F.coalesce("trusted", F.lit(False)).alias("trusted"), _tokens(F.col("text")).alias("t"))
    counts = (
        tokens.select("trusted", F.explode(_buckets("t")).alias("bucket")).groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("raw"), F.sum(F.col("trusted").cast("long")).alias("target"))
    )
    rows = counts.collect()  # one row per bucket
    raw, target = [1] * BUCKETS, [1] * BUCKETS
    for r in rows:
        raw[r.bucket] += r.raw
        target[r.bucket] += r.target
    if sum(target) == BUCKETS:
        return [0.0] * BUCKETS
    shift = math.log(sum(raw)) - math.log(sum(target))
    return [math.log(t) - math.log(r) + shift for t, r in zip(target, raw)]


def base_rules(docs: DataFrame) -> DataFrame:
    """Adds the word and line counts to (doc_id, text); ``_w`` holds the words."""
    text, w, h = F.col("text"), F.col("_w"), F.col("_h")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.select(
        "*", _words(text).alias("_w"), lines.alias("_l"),
        F.length(F.regexp_replace(text, _SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
    )
    # hash of the 3-word window that begins at each place
    windows = F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    out = out.select("*", windows.alias("_h")).withColumn(
        "_s", F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    )
    s = F.col("_s")
    again = F.filter(s, lambda x, i: (F.get(s, i + 1)["h"] == x["h"]) | ((i > 0) & (F.get(s, F.greatest(i - 1, F.lit(0)))["h"] == x["h"])))
    places = F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    return out.select(
        *docs.columns, F.size("_w").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.when(s.isNull(), F.lit(0)).otherwise(F.size(places)).cast("long").alias("n_repeat_words"),
    )


def score(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """Adds ``llr``: the mean log ratio over the text's n-grams, 0 for a text without any."""
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    b = F.col("_b")
    total = F.aggregate(b, F.lit(0.0), lambda acc, x: acc + F.coalesce(F.get(table, x), F.lit(0.0)))
    return (
        docs.withColumn("_t", _tokens(F.col("text"))).withColumn("_b", _buckets("_t")).withColumn("_n", F.size("_b"))
        .withColumn("llr", F.when(F.col("_n") > 0, total / F.col("_n")).otherwise(F.lit(0.0))).drop("_t", "_b", "_n")
    )


def trusted(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("quality") == 1).select("doc_id")


def judge(docs: DataFrame, trusted_ids: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Base counts, base_failed, llr and kept of every document."""
    ratios = log_ratios(docs, trusted_ids)
    out = score(base_rules(_plain(docs)), ratios)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.col("llr") >= threshold)).alias("kept"), "llr",
    )
