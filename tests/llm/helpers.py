"""Small tables with every awkward row, and brute-force versions."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, taken string, label string, node string, key string, h string, bucket string, piece string, row string, score string, `p` string"
EXTRAS = 11
SYLLABLES = {"en": "th er on an re he in ed nd ha at en es of or nt ea ti to it st is ou".split(), "fr": "ai eau eux que le re ment tion es ou ch an oi é è ê ç la de".split(), "de": "sch ung ein ch ie keit er en be ge ver au st tz pf ä ö ü ß".split()}


def word(rng, lang="en"):
    return "".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4)))


def prose(rng, n=80, lang="en"):
    out = []
    while len(out) < n:
        s = [word(rng, lang) for _ in range(min(rng.randint(4, 14), n - len(out)))]
        out += [s[0].capitalize(), *s[1:-1], s[-1] + "."] if len(s) > 1 else [s[0] + "."]
    lines = [" ".join(out[i : i + 30]) for i in range(0, len(out), 30)]
    return "\n".join(lines)


def junk(rng, n=80):
    return " ".join(word(rng) + rng.choice(["%%%", "***", "$$$", "&&&"]) for _ in range(n))


def awkward(rng):
    """Rows (doc_id, text, lang, source): nulls anywhere, empty, one word, blanks, very long, repeated, tied ids."""
    text = prose(rng, 120)
    return [
        (1, None, None, None), (2, "", "en", "b"), (None, text, "en", "a"), (None, None, None, None), (3, "word", "en", None), (4, " \n\t ", "en", "a"),
        (5, prose(rng, 9000), "en", "a"), (6, text, "en", "a"), (6, text, "en", "a"), (6, text, "en", "a"), (7, prose(rng, 30), "en", "c"), (7, prose(rng, 40), "fr", "c"),
        (8, "x" * 5000, "de", "b"), (9, "\U0001f600 é ß \u0000 tab\there", "de", "b"), (10, "0 1 2 3", "de", "z"), (-5, prose(rng, 60, "fr"), "fr", "é"),
    ]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, s, None if t is None else len(t), *["x"] * EXTRAS) for i, t, g, s in rows], SCHEMA)


def shingle_set(text):
    w = re.findall(r"\w+", (text or "").lower())
    k = min(5, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def rng(seed=0):
    return random.Random(seed)
