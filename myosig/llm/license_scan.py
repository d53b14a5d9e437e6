"""License scan by ordered signature rules (operator 2).

Each text is lower-cased in A-Z, cut into words and joined by single spaces.  A rule is
tried only where the text holds all of its keywords; matches are intervals of words.  They
are accepted in order of priority, then length, then place, and one that lies inside an
accepted interval is suppressed, so overlapping detections resolve to the most specific.

One Arrow pass over the table, no shuffle; a worker holds one batch.

Edge cases: null and empty texts have no words, no labels and score 0; very long texts are
scanned whole; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from myosig.llm.license_rules import RULES, Rule

#: Phrases that always count, and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
_BASE = [(re.compile(f"(?<![^ ]){p}(?![^ ])"), frozenset(p.split()), len(p.split()), label) for p, label in BASE.items()]
_SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,kind:string,start:long,words:int>>"

#: bytes.translate table: A-Z to a-z, ASCII that is no letter or digit to a space, the rest as it is
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(text: str | None) -> list[str]:
    # only spaces separate after the translation; bytes.split() would also split at \x85 or \xa0 of nothing: it knows ASCII only
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).decode("utf-8", "surrogatepass").split(" ")


def normalise(text: str | None) -> tuple[list[str], str]:
    words = [w for w in words_of(text) if w]
    return words, " ".join(words)


def _gate(rules: list[Rule]) -> dict[str, list[Rule]]:
    """Rules under their longest keyword: the word that opens them."""
    out = defaultdict(list)
    for r in rules:
        out[max(r.keywords, key=lambda w: (len(w), w), default="")].append(r)
    return dict(out)


_GATE = _gate(RULES)
_OPENERS = frozenset(_GATE)


def _places(joined: str, starts: list[int]) -> list[int]:
    """Word numbers of ascending character offsets."""
    out, at, n = [], 0, 0
    for s in starts:
        n += joined.count(" ", at, s)
        at = s
        out.append(n)
    return out


def detect(words: list[str], joined: str) -> list[tuple[Rule, int, int]]:
    """Accepted detections: rule, first word, number of words."""
    present = set(words)
    opened = [r for w in (_OPENERS & present) | ({""} & _OPENERS) for r in _GATE[w] if r.keywords <= present]
    found = []
    for r in opened:
        spans = [m.span() for m in r.pattern.finditer(joined)]
        for (a, b), place in zip(spans, _places(joined, [a for a, _ in spans])):
            found.append((r, place, joined.count(" ", a, b) + 1))
    found.sort(key=lambda x: (-x[0].priority, -x[2], x[1], x[0].label, x[0].kind))
    return _uncontained(found)


def _uncontained(found: list[tuple[Rule, int, int]]) -> list[tuple[Rule, int, int]]:
    kept: list[tuple[Rule, int, int]] = []
    reach: dict[int, int] = {}  # first word of an accepted interval: its furthest end
    longest = max((n for _, _, n in found), default=0)
    for r, start, n in found:
        if any(reach.get(s, 0) >= start + n for s in range(max(0, start - longest), start + 1)):
            continue
        kept.append((r, start, n))
        reach[start] = max(reach.get(start, 0), start + n)
    return sorted(kept, key=lambda x: (x[1], -x[2]))


def scan_text(text: str | None) -> dict:
    words, joined = normalise(text)
    present = set(words)
    places, labels = [], set()
    for pattern, need, _, label in _BASE:
        if need <= present and (hits := [m.start() for m in pattern.finditer(joined)]):
            places += _places(joined, hits)
            labels.add(label)
    found = detect(words, joined)
    doubt = 1.0
    for confidence in {r.label: r.confidence for r, _, _ in sorted(found, key=lambda x: x[0].confidence)}.values():
        doubt *= 1 - min(confidence, 0.999)
    if labels:
        doubt *= 0.05
    return {
        "n_words": len(words), "n_base": len(places), "first_word": min(places, default=None), "last_word": max(places, default=None),
        "base_labels": ",".join(sorted(labels)), "labels": ",".join(sorted(labels | {r.label for r, _, _ in found})), "score": 1 - doubt if found or labels else 0.0,
        "spans": [{"label": r.label, "kind": r.kind, "start": s, "words": n} for r, s, n in found],
    }


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
        ("spans", pa.list_(pa.struct([("label", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("words", pa.int32())]))),
    ])
    for b in batches:
        ids = b.column(0).to_pylist()
        yield pa.RecordBatch.from_pylist([{"doc_id": i, **scan_text(t.as_py())} for i, t in zip(ids, b.column(1))], schema=schema)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: base places, labels of the accepted detections, and their spans."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_scan_batches, _SCHEMA)
