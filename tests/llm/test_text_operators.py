"""Operators 1, 2, 6 and 10 against brute force, and their edge cases."""

import hashlib
import random
import re
from collections import Counter

import helpers as H
from hypothesis import given, settings
from hypothesis import strategies as st

from myosig.llm import chat, license_scan, merkle, quality_rules
from myosig.llm.license_rules import RULES


# ---- 1: fingerprints


def ring(rows):
    key = lambda r: (r[0] is None, -(r[0] or 0))
    return sorted(rows, key=key)


def test_edit_report_matches_brute_force(spark):
    rng = H.rng(1)
    rows = [(i, H.prose(rng, rng.randint(1, 200)), "en", "a") for i in rng.sample(range(10_000), 120)] + [(-3, None, None, None), (20_000, "", "en", "a")]
    got = {r.doc_id: r for r in merkle.edit_report(H.frame(spark, rows), buckets=7).collect()}
    order = ring(rows)
    assert len(got) == len(rows)
    for (i, text, *_), (_, after, *_) in zip(order, order[1:] + order[:1]):
        text, after, r = text or "", after or "", got[i]
        edited = text[: len(text) - len(text) // 3] + after[: len(text) // 3]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == merkle.fingerprint(text) and r.edited_fingerprint == merkle.fingerprint(edited)
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    long = [r for r in got.values() if r.n_chars > 300]
    assert sum(r.near_edited for r in long) / len(long) > 0.5
    assert max(r.near_next for r in long) < 0.2


def test_edit_report_awkward_rows(spark):
    rows = H.awkward(H.rng(2))
    for buckets in (1, 3, 40):
        got = merkle.edit_report(H.frame(spark, rows), buckets=buckets).collect()
        assert len(got) == len(rows)
        assert sorted(r.n_chars for r in got) == sorted(len(t or "") for _, t, *_ in rows)
    # of three equal rows two have their own copy next
    assert sum(r.near_next == 1 for r in got if r.doc_id == 6) == 2
    assert merkle.edit_report(H.frame(spark, [])).count() == 0
    only = merkle.edit_report(H.frame(spark, [(1, "one two three", "en", "a")])).collect()
    assert len(only) == 1 and only[0].near_next == 1


def test_merkle_tree():
    rng = H.rng(3)
    a = H.prose(rng, 400)
    lines = a.split("\n")
    b = "\n".join(lines[:5] + [H.prose(rng, 25).replace("\n", " ")] + lines[6:])
    fa, fb = merkle.fingerprint(a), merkle.fingerprint(b)
    assert fa == merkle.fingerprint(a) and fa.split("|")[0] != fb.split("|")[0]
    assert 0.8 < merkle.likeness(fa, fb) < 1
    assert merkle.likeness(fa, fa) == 1 and merkle.likeness(fa, merkle.fingerprint("")) == 0
    assert merkle.likeness(merkle.fingerprint(""), merkle.fingerprint(None)) == 1
    assert merkle.fingerprint("a b") != merkle.fingerprint("a  b")  # the root covers white space
    assert merkle.differing_branches(fa, fa) == []
    assert len(merkle.differing_branches(fa, fb)) == 1  # the one edited line
    c = "\n".join([H.prose(rng, 20).replace("\n", " "), *lines])
    assert merkle.likeness(fa, merkle.fingerprint(c)) > 0.9  # an insertion moves nothing else


def _apply(a, b, edits):
    """The lines of ``a``, rebuilt into those of ``b`` from what the branches say."""

    def places(text):
        sections = merkle._tree(merkle.fingerprint(text))[1]
        at = [(i, j) for i, s in enumerate(sections) for j in range(len(merkle._paragraphs(s)))]
        return dict(zip(at, text.split("\n")))

    old, new = places(a), places(b)
    kept = [x for at, x in old.items() if at not in {e[1] for e in edits}]
    named = {e[2]: old[e[1]] if e[0] == "move" else new[e[2]] for e in edits if e[2]}
    rest = iter(kept)
    return [named[at] if at in named else next(rest) for at in new] + list(rest)


def test_differing_branches_of_edits():
    rng = H.rng(31)
    lines = [H.prose(rng, 25).replace("\n", " ") for _ in range(30)]
    a = "\n".join(lines)
    diff = lambda b: merkle.differing_branches(merkle.fingerprint(a), merkle.fingerprint("\n".join(b)))
    kinds = lambda b: [e[0] for e in diff(b)]
    assert kinds(lines[:7] + lines[8:]) == ["delete"]
    assert kinds(lines[:3] + lines[4:20] + [lines[3]] + lines[20:]) == ["move"]
    assert kinds(lines[:5] + [lines[4]] + lines[5:]) == ["insert"]  # repeated
    assert kinds(lines[:9] + ["", *lines[9:]]) == ["insert"]
    assert kinds([*lines[:9], lines[9].replace(" ", "  ", 1), *lines[10:]])[0] in ("space", "replace")
    short = ["one two three four five six", *lines]
    spaced = merkle.differing_branches(merkle.fingerprint("\n".join(short)), merkle.fingerprint("\n".join(["one two three  four five six", *lines])))
    assert [e[0] for e in spaced] == ["space"]
    lost = merkle.differing_branches(merkle.fingerprint("\n".join(short)), merkle.fingerprint("\n".join(["one two three", *lines])))
    assert [(e[0], e[3], e[4]) for e in lost] == [("replace", [1], [])]  # a piece lost
    twice = merkle.differing_branches(merkle.fingerprint("\n".join(short)), merkle.fingerprint("\n".join([short[0] + " four five six", *lines])))
    assert [(e[0], e[3]) for e in twice] == [("replace", [])] and len(twice[0][4]) == 1  # a piece repeated
    for _ in range(60):
        b = list(lines)
        for _ in range(rng.randint(1, 6)):
            k = rng.randrange(len(b))
            rng.choice([lambda: b.pop(k), lambda: b.insert(rng.randrange(len(b)), b.pop(k)), lambda: b.insert(k, rng.choice(b)), lambda: b.insert(k, ""), lambda: b.__setitem__(k, H.prose(rng, 8).replace("\n", " "))])()
        edits = diff(b)
        assert bool(edits) == (b != lines)
        assert _apply(a, "\n".join(b), edits) == b


def test_edit_report_names_the_edits(spark):
    rng = H.rng(32)
    rows = [(i, H.prose(rng, 200), "en", "a") for i in range(12)]
    texts = {i: t for i, t, *_ in rows}
    for r in merkle.edit_report(H.frame(spark, rows)).collect():
        edited = merkle.edit(texts[r.doc_id], texts[(r.doc_id - 1) % 12])
        want = merkle.differing_branches(merkle.fingerprint(texts[r.doc_id]), merkle.fingerprint(edited))
        assert want and [(e.kind, e.old and tuple(e.old), e.new and tuple(e.new), e.old_pieces, e.new_pieces) for e in r.edits] == want


def test_fingerprints_of_table(spark):
    rows = H.awkward(H.rng(4))
    got = merkle.fingerprints(H.frame(spark, rows)).collect()
    assert Counter(r.fingerprint for r in got) == Counter(merkle.fingerprint(t) for _, t, *_ in rows)


# ---- 2: licenses


def test_license_words_and_base():
    for text, base in (("Released under the MIT License.", "mit"), ("the Apache License, Version 2.0", "apache-2"), ("CC-BY-NC 4.0", "cc-by-nc"), ("under the mitt license", "")):
        assert license_scan.scan_text(text)["base_labels"] == base
    r = license_scan.scan_text("x under the MIT license y under the mit license")
    assert (r["n_base"], r["first_word"], r["last_word"]) == (2, 1, 6)
    assert license_scan.scan_text(None)["n_words"] == 0 and license_scan.scan_text(None)["first_word"] is None


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["Under", "the", "MIT", "license", "CC", "by", "nc", "apache", "version", "2", "é", "\u00a0", "-", "\n", "x"]), max_size=40))
def test_license_base_matches_brute_force(parts):
    text = " ".join(parts)
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    places = [i for p in license_scan.BASE for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    r = license_scan.scan_text(text)
    assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(w), len(places), min(places, default=None), max(places, default=None))


def test_license_containment_and_priority():
    def labels(t):
        return license_scan.scan_text(t)["labels"]

    assert labels("Licensed under the GNU Lesser General Public License, version 2.1 or later") == "lgpl-2.1"
    assert labels("This work is licensed under the GNU General Public License, version 3.") == "gpl-3"
    assert labels("Licensed under the Apache License, Version 2.0") == "apache-2"
    assert labels("SPDX-License-Identifier: BSD-3-Clause") == "bsd-3-clause"
    assert labels("all rights reserved. CC BY-SA 4.0 license") == "all-rights-reserved,cc-by-sa"
    assert labels("the general public was there") == ""


def test_license_gate_loses_no_rule():
    """Every rule matches only texts that hold its keywords: the prefilter is sound."""
    assert len(RULES) >= 300
    rng = random.Random(5)
    words = sorted({w for r in RULES for w in re.findall(r"[a-z0-9]+", r.pattern.pattern)})
    heads = ["licensed under the terms of the", "spdx license identifier", "under the", "license", ""]
    for _ in range(4000):
        text = " ".join([rng.choice(heads), *rng.choices(words, k=rng.randint(1, 4)), "license", "2 0"]).strip()
        present = set(text.split(" "))
        for r in rng.sample(RULES, 40):
            if r.pattern.search(text):
                assert r.keywords <= present, (r, text)


def test_license_scan_of_table(spark):
    rows = H.awkward(H.rng(6)) + [(50, "Under the MIT license", "en", "a")] * 2
    got = license_scan.scan(H.frame(spark, rows)).collect()
    assert len(got) == len(rows) and sum(r.n_base for r in got) == 2
    assert {(r.doc_id, r.score) for r in got if r.n_words == 0} == {(1, 0.0), (2, 0.0), (None, 0.0), (4, 0.0)}
    assert license_scan.scan(H.frame(spark, [])).count() == 0


# ---- 6: chat

_PARTS = st.lists(st.sampled_from(["\\", "### ", "</turn>", "\n", ": ", "a", "#", " ", "</turn", "user", "assistant"]), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(_PARTS, _PARTS), max_size=4))
def test_chat_round_trip(turns):
    s = "".join(chat.render(*t) for t in turns)
    assert [t[:2] for t in chat.parse(s)] == turns


def test_chat_plain_text_stays_plain():
    assert chat.render("user", "a ## b \\ c") == "### user: a ## b \\ c</turn>\n"
    assert chat.render("user", "a </turn> b") == "### user: a \\</turn> b</turn>\n"


def test_chat_digests(spark):
    rows = [(1, 1, "assistant", "yes </turn>\\"), (1, 0, "user", "q"), (2, None, None, None), (2, 0, "assistant", None), (None, 0, "user", "x"), (3, 0, "assistant", "z" * 50_000), (3, 0, "assistant", "a"), (3, 0, "assistant", "a")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, formatted string, loss_start string").select("conv_id", "turn", "role", "text", "formatted", "loss_start")
    got = {r.conv_id: r for r in chat.conversation_digests(chat.format_turns(df.unionByName(chat.probe(spark), allowMissingColumns=True))).collect()}
    assert set(got) == {1, 2, 3, None, -7}
    for c, r in got.items():
        turns = [(t if t is not None else -1, role or "", x or "") for i, t, role, x in rows if i == c]
        turns += [(k, role, r"\### Assistant: </turn> ok") for k, role in enumerate(["user", "assistant"])] if c == -7 else []
        turns.sort()
        loss = "".join(x for _, role, x in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars == sum(len(chat.render(a, b)) for _, a, b in turns)
    assert chat.conversation_digests(chat.format_turns(df.limit(0))).count() == 0


def test_chat_loss_spans(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "abc"), (1, 1, "user", "q")], "conv_id long, turn long, role string, text string")
    a, b = chat.format_turns(df).orderBy("turn").collect()
    assert a.formatted[a.loss_start : a.loss_end] == "abc" and b.loss_start is None


# ---- 10: quality rules


def base_of(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(tri)
    places = {p for i, t in enumerate(tri) if n[t] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(places)


def test_quality_rules(spark):
    rng = H.rng(7)
    rows = [(100 + i, H.prose(rng, rng.randint(55, 200)), "en", "a") for i in range(150)] + [(300 + i, H.junk(rng), "en", "a") for i in range(40)]
    rows += [(400, "a b c d a b c x a b c", "en", "a"), (401, "one line\none line\n\n \none line", "en", "a"), (402, " ".join(["spam and eggs"] * 40), "en", "a")]
    rows += H.awkward(rng)
    docs = H.frame(spark, rows)
    trusted = spark.createDataFrame([(i,) for i in range(100, 200)] + [(None,), (100,)], "doc_id long")
    got = quality_rules.judge(docs, trusted).collect()
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == sorted((str(i), *base_of(t)) for i, t, *_ in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    by = {r.doc_id: r for r in got}
    assert all(by[100 + i].kept for i in range(150)) and not any(by[300 + i].kept for i in range(40)) and by[402].base_failed
    # the ratios themselves, by hand
    ratios = quality_rules.log_ratios(docs, trusted)
    joined = quality_rules.BROADCAST_IDS
    try:
        quality_rules.BROADCAST_IDS = 0  # beyond the broadcast bound: same counts by a shuffle
        assert quality_rules.log_ratios(docs, trusted) == ratios
    finally:
        quality_rules.BROADCAST_IDS = joined
    tokens = spark.createDataFrame([("ab cd ab!",)], "text string")
    assert abs(quality_rules.score(tokens, [1.0] * quality_rules.BUCKETS).first().llr - 1) < 1e-9


def test_quality_rules_empty(spark):
    none = spark.createDataFrame([], "doc_id long")
    assert quality_rules.judge(H.frame(spark, []), none).count() == 0
    got = quality_rules.judge(H.frame(spark, [(1, None, None, None), (2, H.prose(H.rng(8), 60), "en", "a")]), none).collect()
    assert {(r.doc_id, r.kept, r.llr) for r in got} == {(1, False, 0.0), (2, True, 0.0)}
