"""Operators 11 to 13 against brute force, and their edge cases."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import helpers as H
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from myosig.llm import dense_search, fim, pstable

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
UPPER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


# ---- 11: ranked search


def plain_terms(text):
    return TERM.findall((text or "").translate(UPPER))


def ranked(items, docs, k=10):
    """{(item_id, text): [(doc_id, score)]} by the formula, term by term."""
    held = [(i, Counter(plain_terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = {}
    for item in set(items):
        rows = []
        for i, c, n in held:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in plain_terms(item[1]) if c[t])
            if score > 0:
                rows.append((i, score))
        out[item] = sorted(rows, key=lambda r: (-r[1], r[0] is None, r[0] or 0))[:k]
    return out


def check_search(spark, items, docs, **options):
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in items], "item_id long, text string, score string, rank string")
    got = dense_search.search(frame, H.frame(spark, [(i, t, None, None) for i, t in docs]), **options).collect()
    want = ranked(items, docs, options.get("k", 10))
    expected = Counter((item, r, d, s) for (item, _), rows in want.items() for r, (d, s) in enumerate(rows, 1))
    assert Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == expected
    return expected


@pytest.mark.parametrize("group_bytes", [16 << 20, 120])
def test_search_by_brute_force(spark, group_bytes):
    rng = H.rng(3)
    docs = [(i, t) for i, t, _, _ in H.awkward(rng)] + [(100 + i, H.prose(rng, rng.randint(1, 60))) for i in range(150)]
    docs += [(500 + i, docs[40][1]) for i in range(30)]  # ties over the k-th place
    items = [(i, H.prose(rng, 12)) for i in range(8)] + [(8, docs[40][1]), (9, None), (10, ""), (11, "?! ;"), (None, "word"), (12, "Word WORD word é"), (12, "another th er"), (13, docs[40][1]), (13, docs[40][1])]
    assert check_search(spark, items, docs, group_bytes=group_bytes)
    check_search(spark, items, docs, k=3, group_bytes=group_bytes)


def test_search_of_empty_tables(spark):
    assert not check_search(spark, [], [(1, "a")])
    assert not check_search(spark, [(1, "a")], [])
    assert not check_search(spark, [(1, "a")], [(1, None), (2, "!!")])


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from("aZ9 é\x7f{[@!\n 漢"), max_size=60), st.integers(1, 20))
def test_terms_whatever_the_pieces(text, piece):
    got = [w.decode() for part in dense_search.terms(text.encode(), piece) for w in part]
    assert got == plain_terms(text)


@pytest.mark.parametrize("limit,width", [(7, 3), (100, 2), (5, 1000)])
def test_vocabulary_tiles_stay_below_the_limit(limit, width):
    rng = H.rng(4)
    weights = [{rng.randrange(20): rng.randrange(1, 30) for _ in range(9)} for _ in range(5)]
    total = defaultdict(int)
    for columns, item, column, weight in dense_search.vocabulary_tiles(weights, limit, width):
        assert len(columns) <= width and len(set(columns.tolist())) == len(columns) and (np.diff(columns) > 0).all()
        assert max(Counter({i: int(weight[item == i].sum()) for i in set(item.tolist())}).values()) <= limit
        for i, c, w in zip(item.tolist(), column.tolist(), weight.tolist()):
            total[i, int(columns[c])] += int(w)
    assert total == {(i, t): w for i, own in enumerate(weights) for t, w in own.items()}
    assert dense_search.WEIGHT_LIMIT * 10**6 < 1 << 53


def test_length_norm_beyond_64_bits():
    n = np.array([10**9, 5], np.int64)
    assert dense_search._length_norm(n, 10**12, 10**14).tolist() == [25 + 75 * int(x) * 10**12 // 10**14 for x in n]


def test_best_keeps_ties_by_id():
    rng = H.rng(5)
    rows = [(rng.randrange(4), rng.randrange(50), rng.random() < 0.9) for _ in range(300)]
    best = dense_search._Best(1, 10)
    for at in range(0, 300, 37):
        s, i, z = (np.array(c) for c in zip(*rows[at : at + 37]))
        best.add(0, s, i, z)
    want = sorted(((s, i, z) for s, i, z in rows if s > 0), key=lambda r: (-r[0], not r[2], r[1]))[:10]
    assert [(a, b, c) for a, b, c in zip(*(x.tolist() for x in best.rows[0]))] == want


# ---- 12: embedding near-duplicates


def near(rng, center, cosine):
    """A unit vector of just this cosine to ``center``."""
    c = center / np.linalg.norm(center)
    r = rng.normal(size=len(c))
    r -= (r @ c) * c
    return cosine * c + math.sqrt(1 - cosine * cosine) * r / np.linalg.norm(r)


def by_pairs(rows):
    """(vec_id, n_links, component_id, kept) of every row, all pairs compared."""
    able = []
    for _, e, label in rows:
        able.append(label is not None and bool(e) and all(x is not None and math.isfinite(x) for x in e) and any(e))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    unit = [np.array(e) / np.linalg.norm(e) if a else None for (_, e, _), a in zip(rows, able)]
    for i in range(len(rows)):
        for j in range(i):
            if able[i] and able[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.93:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        least[find(i)] += [r[0]] if r[0] is not None else []
    component = [min(least[find(i)], default=None) for i in range(len(rows))]
    return Counter((r[0], n, c, r[0] == c) for r, n, c in zip(rows, links, component))


def vectors(seed, n, dim=16):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n // 10):
        center, label = rng.normal(size=dim), int(rng.integers(0, 3))
        rows += [(near(rng, center, rng.uniform(0.9, 0.9999)).tolist(), label) for _ in range(10)]
    tight = rng.normal(size=dim)
    rows += [(near(rng, tight, 0.999).tolist(), 1) for _ in range(60)] + [(near(rng, tight, 0.95).tolist(), 1) for _ in range(25)]
    rows += [(tight.tolist(), 1)] * 12 + [(rng.normal(size=dim).tolist(), None)] * 3
    return [(i, e, label) for i, (e, label) in enumerate(rows)]


def links_of(spark, rows, **options):
    df = spark.createDataFrame([(i, e, label, "x", "y") for i, e, label in rows], "vec_id long, embedding array<double>, label int, n_links string, node string")
    return Counter(tuple(r) for r in pstable.link(df, **options).collect())


@pytest.mark.parametrize("limit,block", [(4096, 2048), (8, 4), (40, 16)])
def test_links_by_brute_force(spark, limit, block):
    rows = vectors(limit, 200)
    assert links_of(spark, rows, limit=limit, block=block) == by_pairs(rows)


def test_links_of_awkward_vectors(spark):
    a, b = [1.0, 2.0, 3.0], [1.0, 2.0, 3.01]
    rows = [
        (1, a, 0), (2, b, 0), (2, b, 0), (3, a, 1), (4, a, None), (5, None, 0), (6, [], 0), (7, [0.0, 0.0, 0.0], 0), (8, [-0.0, 0.0, 0.0], 0),
        (9, [1.0, None, 3.0], 0), (10, [float("nan"), 2.0, 3.0], 0), (11, [float("inf"), 2.0, 3.0], 0), (None, a, 0), (None, [9.0, -1.0, 0.0], 0), (12, [1.0, 2.0], 0),
        (13, [x * 1e-300 for x in a], 0), (14, [x * 1e150 for x in a], 0), (0, [-x for x in a], 0), (15, a * 100, 0), (16, b * 100, 0), (None, [0.0, 0.0, 5.0, 1.0], 3), (None, [0.0, 0.0, 5.0, 1.0], 3),
    ]
    want = by_pairs([(i, e if e is None or None in e else [x / 1e149 if abs(x) > 1e140 and math.isfinite(x) else x * 1e149 if 0 < abs(x) < 1e-140 else x for x in e], z) for i, e, z in rows])
    assert links_of(spark, rows) == want
    assert not links_of(spark, [])


def test_cosine_at_the_threshold():
    v = np.array([[1.0, 0.0]])
    for step in (-1e-12, 0.0, 1e-12):
        w = np.array([[0.93 + step, math.sqrt(1 - (0.93 + step) ** 2)]])
        assert pstable.linked(v, w)[0, 0] == pstable.linked(w, v)[0, 0]
    assert pstable.linked(v, np.array([[0.94, math.sqrt(1 - 0.94**2)]]))[0, 0] and not pstable.linked(v, np.array([[0.92, math.sqrt(1 - 0.92**2)]]))[0, 0]


def test_recall_at_the_threshold():
    """Pairs at a cosine of exactly 0.93 share a bucket as often as stated."""
    rng = np.random.default_rng(0)
    n, dim = 4000, 64
    bits, tables = pstable.shape(5000)
    a = rng.normal(size=(n, dim))
    b = np.array([near(rng, x, 0.93) for x in a])
    w, offset = pstable._projections(dim, bits, tables)
    same = [np.floor((pstable._unit(m) @ w + offset) / pstable.WIDTH).reshape(n, tables, bits) for m in (a, b)]
    each = (same[0] == same[1]).all(2)
    assert each.any(1).mean() >= 0.999
    assert abs(each.mean() - pstable.collision(0.93) ** bits) < 0.02


def test_links_of_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, list(map(float, r.embedding)), r.label) for r in df.collect()]
    assert Counter(tuple(r) for r in pstable.link(df).collect()) == by_pairs(rows)


# ---- 13: fill in the middle


def moved(doc_id, text, seed=42):
    """The contract, unit by unit."""
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab é\n\t\x0b漢\U0001f600<P>SM"), max_size=80), st.integers(-5, 400), st.sampled_from([1, 2, 3, 8, 4096]))
def test_cuts_whatever_the_blocks(text, doc_id, block):
    got = fim.rearranged(doc_id, text.encode(), block=block)
    assert (*got[:4], got[4].decode()) == moved(doc_id, text)


@given(st.text(alphabet=st.sampled_from("ab é\n漢"), max_size=60), st.sampled_from([1, 3, 7, 64]))
@settings(max_examples=100, deadline=None)
def test_tree_finds_every_unit(text, block):
    tree, units = fim.UnitTree(text.encode(), block), UNIT.findall(text)
    assert tree.n == len(units) and tree.n_chars == len(text)
    for k in range(len(units) + 1):
        part = "".join(units[:k])
        assert tree.cut(k) == (len(part.encode()), len(part))


def test_transform_and_restore(spark):
    rng = H.rng(6)
    rows = H.awkward(rng) + [(100 + i, H.prose(rng, rng.randint(0, 50)) + rng.choice(["", " ", "<", "<S", "\n"]), None, None) for i in range(200)]
    rows += [(400 + i, f"a {m} b", None, None) for i, m in enumerate(["<P>", "<S>", "<M>", "<P", "M>"] * 6)]
    docs = H.frame(spark, rows)
    changed = fim.transform(docs)
    got = Counter(tuple(r) for r in changed.collect())
    assert got == Counter((i, *moved(i, t)) for i, t, _, _ in rows)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = Counter((i, *moved(i, t)[:4], digest(moved(i, t)[4]), digest(t or "")) for i, t, _, _ in rows)
    assert Counter(tuple(r) for r in fim.digests(changed).collect()) == want
    assert fim.transform(docs.limit(0)).count() == 0


def test_other_rates(spark):
    docs = H.frame(spark, [(i, "one two three", None, None) for i in range(300)])
    forms = Counter(r.form for r in fim.transform(docs, rate=100, spm=0).collect())
    assert forms == {"psm": 300}
    assert Counter(r.form for r in fim.transform(docs, rate=0).collect()) == {"plain": 300}


def test_sketches_keep_close_rows_across_batches():
    rng = H.rng(9)
    rows = sorted((rng.randrange(12), rng.choice([0, 1, -1, 1 << 62, -(1 << 63), 0x5555555555555555])) for _ in range(200))
    name = lambda g: np.array([(1, 2, g)], pstable._BUCKET).tobytes()
    table = pa.table({"group": pa.array([name(g) for g, _ in rows], pa.binary()), "n": [9] * 200, "node": pa.array([str(i).encode() for i in range(200)], pa.binary()), "sketch": [s for _, s in rows]})
    bits = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1")
    want = [i for i, (g, s) in enumerate(rows) if any(j != i and h == g and bits(s, r) <= pstable.FAR_BITS for j, (h, r) in enumerate(rows))]
    for size in (1, 7, 200):
        got = [int(x) for b in pstable._alike(iter(table.to_batches(size))) for x in b.column(2).to_pylist()]
        assert got == want
    assert not list(pstable._alike(iter([])))
