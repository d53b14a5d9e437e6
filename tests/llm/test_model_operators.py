"""Operators 3, 4, 5, 7, 8 and 9 against brute force or held-out rows, and their edge cases."""

import math
import re
import zlib
from collections import Counter, defaultdict

import helpers as H
import numpy as np
import pyarrow as pa
import pytest

from myosig.llm import chosen_path, common, components, langid, masked_lm, mixing, packing, quality_knn


def remainder(i):
    return zlib.crc32(str(i).encode()) % 4


# ---- helpers of the subpackage


def test_held_out(spark):
    df = spark.createDataFrame([(i,) for i in [*range(200), None, -7]], "doc_id long")
    for r in df.select("doc_id", common.held_out().alias("h"), common.teachable().alias("t")).collect():
        assert r.h == (r.doc_id is not None and remainder(r.doc_id) == 2)
        assert r.t == (r.doc_id is not None and remainder(r.doc_id) != 2)


@pytest.mark.parametrize("limit", [1, 3, 10, 1000])
def test_segments_hold_every_ngram_once(limit):
    texts = ["", "a", "abcdefghijk", "xyz" * 20, "q" * 7]
    got = Counter()
    for rows, parts in common.segments(texts, 2, limit):
        for i, p in zip(rows, parts):
            got.update((i, p[k : k + 3]) for k in range(len(p) - 2))
    assert got == Counter((i, t[k : k + 3]) for i, t in enumerate(texts) for k in range(len(t) - 2))


def test_components(spark):
    rng = H.rng(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 560)]
    parent = list(range(600))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for e in edges if e[0] != e[1] for n in e}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- 3: packing


def test_pack_is_tight():
    rng = np.random.default_rng(0)
    for lengths in (rng.integers(1, 4096, 800), rng.integers(900, 1500, 800), np.minimum(4095, rng.lognormal(6, 1, 900).astype(int) + 1), np.array([], int), np.array([4095])):
        number, offset = packing.pack(lengths.tolist())
        fill = Counter()
        seen = defaultdict(list)
        for n, b, o in zip(lengths, number, offset):
            fill[b] += int(n)
            seen[b].append((o, int(n)))
        assert max(fill.values(), default=0) <= 4096
        for items in seen.values():
            items.sort()
            assert [o for o, _ in items] == [sum(n for _, n in items[:k]) for k in range(len(items))]
        # no two bins would fit into one
        low = sorted(fill.values())[:2]
        assert len(low) < 2 or sum(low) > 4096


def test_local_search_beats_best_fit():
    lengths = [5, 5, 4, 4, 3, 3, 3, 3] * 3  # best fit leaves holes that exchanges close
    best, full = packing._Bins(lengths, 10), packing._Bins(lengths, 10)
    best.best_fit()
    full.best_fit()
    full.search(-(-sum(lengths) // 10))
    squares = lambda b: sum(f * f for f in b.fill)
    assert squares(full) >= squares(best) and len([x for x in full.items if x]) <= len([x for x in best.items if x])
    bins = packing._Bins([6, 4, 5, 3], 10)
    bins.items, bins.fill = [[0, 3], [1, 2], []], [9, 9, 0]
    assert bins._step(0)  # 6 for 5: the other bin gets full
    assert sorted(bins.fill) == [0, 8, 10]


def test_search_goes_on_where_the_emptiest_bin_is_stuck():
    """Groups in which best fit and a search of the emptiest bin alone both need a sequence more."""
    rng, saved = np.random.default_rng(1), 0
    for _ in range(25):
        part = sorted(np.minimum(4095, rng.lognormal(7, 0.7, 200).astype(int) + 1).tolist(), reverse=True)
        only, full = packing._Bins(part, 4096), packing._Bins(part, 4096)
        only.best_fit()
        plain = sum(map(bool, only.items))
        bound = only.bound()
        while sum(map(bool, only.items)) > bound:
            a = min((b for b in range(len(only.items)) if only.items[b]), key=lambda b: only.fill[b])
            while only.items[a] and only._step(a):
                pass
            if only.items[a]:
                break
        full.best_fit()
        full.search(bound)
        n, m = sum(map(bool, full.items)), sum(map(bool, only.items))
        assert bound <= n <= m <= plain and sorted(i for x in full.items for i in x) == list(range(200))
        assert all(sum(part[i] for i in x) == f <= 4096 for x, f in zip(full.items, full.fill))
        saved += n < m
    assert saved >= 5


def test_lower_bound_holds():
    def least(items, bins):
        if not items:
            return len(bins)
        tried = {b for b in bins if b + items[0] <= 20}
        return min([least(items[1:], [*bins, items[0]])] + [least(items[1:], sorted([*bins[: bins.index(b)], *bins[bins.index(b) + 1 :], b + items[0]])) for b in tried])

    rng = np.random.default_rng(2)
    for _ in range(60):
        items = rng.integers(1, 21, 7).tolist()
        exact = least(items, [])
        assert -(-sum(items) // 20) <= packing._Bins(items, 20).bound() <= exact
    assert packing._Bins([11, 11, 11], 20).bound() == 3 and packing._Bins([], 20).bound() == 0


def test_packing_of_table(spark):
    from tokenizers import Tokenizer

    rng = H.rng(2)
    rows = [(100 + i, H.prose(rng, rng.randint(1, 300)), "en", "a") for i in range(80)] + H.awkward(rng) + [(300, "It's the <|endoftext|> End OF it now İ é 3.14 we'll\ttab", "en", "a")]
    docs = H.frame(spark, rows)
    packed = packing.best_fit(docs, with_ids=True, sequence=256)
    got = packed.collect()
    t = Tokenizer.from_file(packing.default_tokenizer())
    want = Counter()
    for i, text, *_ in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        for k, s in enumerate(range(0, len(ids), 256)):
            x = ids[s : s + 256]
            want[(i, k, s, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length, bytes(r.ids)))
    for items in seqs.values():
        items.sort()
        assert [o for o, *_ in items] == [sum(x[1] for x in items[:k]) for k in range(len(items))]
        assert sum(x[1] for x in items) <= 256
    assert len(seqs) <= math.ceil(sum(r.length for r in got) / 256) * 1.02 + 1
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert {k: np.array(v, "<u4").tobytes() for k, v in whole.items()} == {k: b"".join(x[2] for x in v) for k, v in seqs.items()}
    assert packing.best_fit(H.frame(spark, [])).count() == 0


def test_encoder_cache_turnover(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 5)
    rng = H.rng(3)
    e, fresh = packing.Encoder(packing.default_tokenizer()), packing.Encoder(packing.default_tokenizer())
    for _ in range(20):
        text = H.prose(rng, 30)
        assert e.ids(text) == np.array([*fresh.tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4").tobytes()


def test_encoder_spells_a_run_once(monkeypatch):
    """Forms of a word share its runs, and a full table keeps what is in use."""
    monkeypatch.setattr(packing, "CACHED_WORDS", 40)
    monkeypatch.setattr(packing, "STRETCH", 50, raising=False)
    e, asked = packing.Encoder(packing.default_tokenizer()), Counter()
    whole, model = e.tokenizer, e.tokenizer.model

    class Asked:
        def tokenize(self, run):
            asked[run] += 1
            return model.tokenize(run)

        def encode(self, text, **kw):
            asked.update(text.lower().split())
            return whole.encode(text, **kw)

    e.model, e.tokenizer = Asked(), Asked()
    rng = H.rng(8)
    for _ in range(30):
        text = " ".join(["Straße", "STRASSE?!", "Été", "l'ÉTÉ", "we'll", "2024", *(w + m for w in ("word", "Word", "WORD") for m in (".", ",", "?!"))] + ["".join(rng.choice("abcdeé") for _ in range(7)) for _ in range(10)])
        assert e.ids(text) == np.array([*whole.encode(text, add_special_tokens=False).ids, 1], "<u4").tobytes()
    assert asked["word"] == 1 and not any(w.startswith("word") for w in asked - Counter(["word"])) and asked["strasse"] == 1


# ---- 4: language


def test_language_id(spark):
    rng = H.rng(4)
    rows = [(i, H.prose(rng, rng.randint(20, 60), g), g, "a") for i, g in enumerate(["en", "fr", "de"] * 150)]
    rows += [(900 + i, t, None, None) for i, t in enumerate([None, "", "12 34", "!!", H.prose(rng, 60, "fr")])]
    rows += H.awkward(rng)
    got = langid.identify(H.frame(spark, rows)).collect()
    assert len(got) == len(rows)
    truth = {i: g for i, _, g, _ in rows[:450]}
    held = [r for r in got if r.held_out and r.doc_id in truth and 11 <= r.doc_id < 450]
    assert len(held) > 60 and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    by = {r.doc_id: r for r in got}
    assert all((by[900 + i].lang_pred, by[900 + i].score) == ("und", 0.0) for i in range(4)) and by[904].lang_pred == "fr"
    assert all(0 <= r.score <= 1 for r in got)
    assert langid.identify(H.frame(spark, [])).count() == 0
    unlabelled = langid.identify(H.frame(spark, [(1, "some words", None, None)])).collect()
    assert unlabelled[0].lang_pred == "und"


def test_language_filter_matches_sets():
    """The bit-sliced filter answers yes wherever the sets do, and rarely elsewhere."""
    rng = H.rng(5)
    texts = [(H.prose(rng, 60, g), g) for g in ["en", "fr"] * 40]
    model = langid.fit([t for t, _ in texts], [g for _, g in texts])
    grams = {g: Counter(int(h) for t, x in texts if x == g for a in langid.hashed_ngrams(t.lower()) for h in a) for g in ("en", "fr")}
    total = {g: sum(c.values()) for g, c in grams.items()}
    for k, g in enumerate(model.languages):
        other = "fr" if g == "en" else "en"
        own = [h for h, n in grams[g].items() if n >= 2 and n / total[g] >= langid.CONTAINS * max(n / total[g], grams[other][h] / total[other] if grams[other][h] >= 2 else 0)]
        assert model.counts(np.array(own, np.uint32))[k] == len(own)
    random = np.random.default_rng(0).integers(0, 1 << 32, 50_000, dtype=np.uint32)
    assert np.all(model.counts(random) / 50_000 <= model.chance * 1.5 + 1e-3)


def test_language_long_text_in_segments(monkeypatch):
    rng = H.rng(6)
    model = langid.fit([H.prose(rng, 80, g) for g in ("en", "fr")] * 5, ["en", "fr"] * 5)
    text = H.prose(rng, 3000, "fr")
    whole = langid.predict(model, [text])[0]
    monkeypatch.setattr(common.segments, "__defaults__", (500,))
    cut = langid.predict(model, [text])[0]
    assert whole[0] == cut[0] == "fr" and abs(whole[1] - cut[1]) < 0.01


# ---- 5: LM


def test_masked_lm(spark):
    rng = H.rng(7)
    vocab = [H.word(rng) for _ in range(60)]
    follow = {w: rng.sample(vocab, 3) for w in vocab}

    def chain(n):
        out = [rng.choice(vocab)]
        while len(out) < n:
            out.append(rng.choice(follow[out[-1]]))
        return " ".join(out)

    rows = [(i, chain(rng.randint(50, 300)), "en", "a") for i in range(250)]
    mixed = []
    for i, t, *_ in rows[:60]:
        w = t.split(" ")
        rng.shuffle(w)
        mixed.append((10_000 + i, " ".join(w), "en", "a"))
    docs = H.frame(spark, rows)
    texts = docs.select("text")
    v = masked_lm.vocabulary(texts)
    counts = Counter(w for _, t, *_ in rows for w in masked_lm.tokens(t))
    assert v.words == sorted(counts, key=lambda w: (-counts[w], w))[: masked_lm.VOCABULARY]
    flat = masked_lm.train(texts, v, rounds=2)
    got = {r.doc_id: r for r in masked_lm.score(H.frame(spark, rows + mixed), v, flat).collect()}
    assert all(got[i].n_tokens == len(masked_lm.tokens(t)) for i, t, *_ in rows)
    assert np.mean([got[i].log_prob > got[10_000 + i].log_prob for i in range(60)]) > 0.95  # order matters, from both sides
    assert got[1].n_tokens > 0 and got[2].log_prob < 0
    # by hand: one text, token by token
    net, (_, text, *_) = masked_lm.Network(flat), rows[0]
    ids = np.r_[0, 0, v.encode(masked_lm.tokens(text)), 0, 0]
    total = 0.0
    for at in range(2, len(ids) - 2):
        pre = net.bias + sum(net.table[ids[at + o], k * masked_lm.HIDDEN : (k + 1) * masked_lm.HIDDEN] for k, o in enumerate(masked_lm._OFFSETS))
        z = np.tanh(pre) @ net.out + net.base
        total += z[v.classes[ids[at]]] - np.log(np.exp(z).sum()) + v.within[ids[at]]
    assert abs(total - got[0].log_prob) < 0.05
    assert abs(np.exp(v.within[1:])[v.classes[1:] == masked_lm.CLASSES - 1].sum() - 1) < 1e-6


def test_masked_lm_reads_texts_once(spark, monkeypatch):
    rng = H.rng(12)
    rows = [(i, H.prose(rng, rng.randint(0, 60)), "en", "a") for i in range(40)] + [(i, None, None, None) for i in range(40, 43)] + [(None, "one two", None, None)]
    read = spark.sparkContext.accumulator(0)

    def counted(frames):
        for x in frames:
            read.add(len(x))
            yield x

    docs = H.frame(spark, rows).coalesce(1)
    got = masked_lm.score(docs.mapInPandas(counted, docs.schema)).collect()
    assert read.value == len(rows)
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((i, len(masked_lm.tokens(t))) for i, t, *_ in rows)
    # any cut into blocks gives the same
    one = masked_lm.blocks(docs).toPandas()
    monkeypatch.setattr(masked_lm, "_BLOCK_WORDS", 30)
    ids = pa.array([r[0] for r in rows], pa.int64())
    cut = list(masked_lm._block_batches(iter([pa.RecordBatch.from_arrays([pa.array(range(len(rows))), ids, pa.array([r[1] for r in rows])], ["row", "doc_id", "text"])])))
    assert len(one) == 1 < len(cut)
    v = masked_lm.Vocabulary(["one", "two"], np.ones(1 + masked_lm.SLOTS + 2))
    found = [x.tolist() for b in masked_lm._read(iter(cut), v) for x in b.documents()]
    assert found == [v.encode(masked_lm.tokens(t)).tolist() for _, t, *_ in rows]
    rare, want = Counter(), Counter()
    for b in masked_lm._read(iter(cut), v):
        words, first, at, n = b.rare()
        assert np.allclose(v.spellings(words), list(map(v.spelling, words.to_pylist())))
        for w, s, e in zip(words.to_pylist(), first, first[1:]):
            rare.update({(w, b.rows[int(k)].as_py()): int(m) for k, m in zip(at[s:e], n[s:e])})
    for k, (_, t, *_) in enumerate(rows):
        want.update((w, k) for w in masked_lm.tokens(t) if w not in v.ids)
    assert rare == want


def test_masked_lm_edges(spark):
    rows = H.awkward(H.rng(8))
    got = masked_lm.score(H.frame(spark, rows)).collect()
    assert sorted(r.n_tokens for r in got) == sorted(len(masked_lm.tokens(t)) for _, t, *_ in rows)
    assert all(r.log_prob == 0 for r in got if r.n_tokens == 0)
    assert masked_lm.score(H.frame(spark, [])).count() == 0
    assert masked_lm.score(H.frame(spark, [(1, None, None, None)])).collect()[0].log_prob == 0


def test_masked_lm_chunks(monkeypatch):
    rng = H.rng(9)
    texts = [H.prose(rng, 500), "", H.prose(rng, 20), None, H.prose(rng, 3), H.prose(rng, 200)]
    v, net = masked_lm.Vocabulary([], np.zeros(masked_lm.IDS)), masked_lm.Network()
    whole = masked_lm.score_texts(net, v, iter(texts), len(texts))
    monkeypatch.setattr(masked_lm, "CHUNK", 37)
    monkeypatch.setattr(masked_lm, "BATCH", 11)
    cut = masked_lm.score_texts(net, v, iter(texts), len(texts))
    assert (whole[1] == cut[1]).all() and np.allclose(whole[0], cut[0], rtol=1e-5)


def test_masked_lm_rare_words(spark, monkeypatch):
    """P(word | class) of all words, rare ones by their own counts, sums to at most 1; unseen ones have next to nothing."""
    monkeypatch.setattr(masked_lm, "VOCABULARY", 20)
    monkeypatch.setattr(masked_lm, "ROOTS", 1)
    rng = H.rng(31)
    common_words = [H.word(rng) for _ in range(30)]
    rows = [(i, " ".join(rng.choices(common_words, k=60) + [H.word(rng) for _ in range(20)]), "en", "a") for i in range(60)]
    counts = Counter(w for _, t, *_ in rows for w in masked_lm.tokens(t))
    v = masked_lm.vocabulary(H.frame(spark, rows).select("text"))
    assert len(v.words) == max(20, int(len(counts) ** 0.5))  # grows with the distinct words
    flat = masked_lm.train(H.frame(spark, rows).select("text"), v)
    net = masked_lm.Network(flat)
    words = [*counts, "zzqqxx", "qzqzqzqzqz"]
    got = {r.doc_id: r.log_prob for r in masked_lm.score(H.frame(spark, [(i, w, "en", "a") for i, w in enumerate(words)]), v, flat).collect()}
    sums = np.zeros(masked_lm.CLASSES)
    for i, w in enumerate(words):
        x = v.encode([w])
        in_class = got[i] - net.log_classes(np.r_[0, 0, x, 0, 0], v.classes[x])[0]
        if w not in v.ids:
            s = np.exp(v.spelling(w))
            whole = v.within[x[0]] + v.rest[x[0]]
            assert abs(in_class - whole - np.log(counts[w] + s)) < 1e-4
        sums[v.classes[x[0]]] += np.exp(in_class)
    assert sums.max() < 1 + 1e-4
    seen = [got[i] for i, w in enumerate(words) if w not in v.ids and counts[w]]
    assert max(got[len(words) - 1], got[len(words) - 2]) < min(seen) - 5
    # whole documents, with repeated rare words
    doc = "zzqqxx " + rows[0][1] + " zzqqxx"
    one = masked_lm.score(H.frame(spark, [(1, doc, "en", "a"), (1, doc, "en", "a")]), v, flat).collect()
    base = masked_lm.score_texts(net, v, iter([doc]), 1)[0][0]
    want = base + sum(np.log(counts[w] + np.exp(v.spelling(w))) for w in masked_lm.tokens(doc) if w not in v.ids)
    assert len(one) == 2 and all(abs(r.log_prob - want) < 1e-3 for r in one)


# ---- 7: mixing


def water(sizes, weights, cap):
    """Targets by the contract's own words: share, stop, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), float(sum(sizes.values())), set(names)
    while left > 1e-9 and free:
        unit = left / sum(w[s] for s in free)
        left = 0.0
        for s in sorted(free, key=str):
            target[s] += unit * w[s]
        for s in list(free):
            if target[s] >= cap * sizes[s]:
                left += target[s] - cap * sizes[s]
                target[s] = float(cap * sizes[s])
                free.discard(s)
    return target


def test_mix(spark):
    rng = H.rng(10)
    rows = [(i, H.prose(rng, rng.randint(1, 60)) if i % 3 else H.junk(rng, 20), "en", rng.choice(["a"] * 6 + ["b", "c", "d", None, "é", "tiny"])) for i in range(600)]
    rows = [r for r in rows if r[3] != "tiny"] + [(900, "one two three", "en", "tiny"), (901, None, "en", "a"), (902, "", None, None)]
    docs = H.frame(spark, rows)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    n = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in rows}
    source = {i: s for i, _, _, s in rows}
    sizes = Counter()
    for i in n:
        sizes[source[i]] += n[i]
    target = water(sizes, mixing.WEIGHTS, 3)
    taken = Counter()
    for r in got:
        assert r["size"] == n[r.doc_id] and r.source_size == sizes[source[r.doc_id]]
        assert abs(r.target - target[source[r.doc_id]]) < 1e-6 * sum(sizes.values())
        assert r.taken == r["size"] * r.times and 0 <= r.times <= 3
        taken[source[r.doc_id]] += r.taken
    assert target["tiny"] == 9 and taken["tiny"] == 9
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 0.5 * max(n[i] for i in n if source[i] == s) + 1e-6
        # complete epochs first: no two documents of a source differ by more than one
        times = {r.times for r in got if source[r.doc_id] == s and n[r.doc_id]}
        assert max(times) - min(times) <= 1
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    # the fraction is that of the smallest keys, by brute force
    keys = {r.doc_id: (r.key, r.h) for r in mixing._slim(docs, None, mixing.SEED).collect()}
    for s in sizes:
        own = sorted((r for r in got if source[r.doc_id] == s and n[r.doc_id]), key=lambda r: keys[r.doc_id])
        assert [r.times for r in own] == sorted((r.times for r in own), reverse=True)
    # better documents come first more often
    slim = {r.doc_id: r for r in docs.select("doc_id", mixing.quality_weight(docs.text).alias("w")).collect()}
    assert slim[0].w < slim[1].w
    mixed = mixing.repeated(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({r.doc_id: r.times for r in got if r.times})


def test_mix_spans_stay_small_for_any_weight(spark):
    """A million rows of low weights: what is ordered stays within its bound, the cut is that of a full sort."""
    import numpy as np
    from pyspark.sql import functions as F

    weight = {"low": 0.05, "mid": 0.2, None: 1.0}
    source = F.when(F.col("id") % 2 == 0, "low").when(F.col("id") % 3 == 0, "mid")
    docs = spark.range(1_000_000).select(F.col("id").alias("doc_id"), source.alias("source"), F.lit("t").alias("text"), (F.col("id") % 7).alias("size"))
    key, h = mixing._keys(F.col("doc_id"), F.col("text"), F.when(F.col("source") == "low", 0.05).when(F.col("source") == "mid", 0.2).otherwise(1.0), 3)
    rows = common.written(docs.select("source", "size", key.alias("key"), h.alias("h")), "rows")
    sizes = {r.source: r.n for r in rows.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    plan = spark.createDataFrame([(s, n, n * share) for (s, n), share in zip(sorted(sizes.items(), key=str), (0.37, 1.62, 0.0004))], "source string, source_size long, target double")
    plan = plan.withColumn("budget", F.col("target") - F.floor(F.col("target") / F.col("source_size")) * F.col("source_size"))
    spans = mixing.brackets(rows, plan).collect()
    assert {r.source for r in spans} == set(weight) and max(r.n for r in spans) <= mixing.BUCKET_ROWS
    budget = {r.source: r.budget for r in plan.collect()}
    for c in mixing.cuts(rows, plan.drop("budget")).collect():
        own = rows.where(F.col("source").eqNullSafe(c.source)).toPandas().sort_values(["key", "h"])
        upto = own["size"].cumsum().to_numpy()
        n = int(np.flatnonzero(upto - own["size"].to_numpy() / 2 <= budget[c.source])[-1])
        # rows of size 0 behind the edge may fall on either side of it
        taken = own[(own.key < c.cut_key) | ((own.key == c.cut_key) & (own.h <= (c.cut_h if c.cut_h is not None else -(1 << 63))))]
        assert taken["size"].sum() == upto[n]


def test_mix_repeated_rows_share_one_key(spark):
    """Thousands of copies of one row end the cutting of spans and are taken together."""
    rows = [(1, "same words here", "en", "a")] * 5000 + [(i, "other words", "en", "a") for i in range(2, 50)] + [(99, "b b", "en", "b")]
    got = mixing.mix(H.frame(spark, rows)).collect()
    assert len(got) == len(rows) and len({r.times for r in got if r.doc_id == 1}) == 1


def test_mix_edges(spark):
    rows = H.awkward(H.rng(11))
    got = mixing.mix(H.frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert mixing.mix(H.frame(spark, [])).count() == 0
    assert [r.taken for r in mixing.mix(H.frame(spark, [(1, None, "en", None), (2, " ", "en", "a")])).collect()] == [0, 0]
    assert mixing.repeated(H.frame(spark, [(1, None, "en", None)])).count() == 0


def test_efraimidis_spirakis_order(spark):
    """A document's chance to come first follows its weight."""
    from pyspark.sql import functions as F

    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 2 == 0, 3.0).otherwise(1.0).alias("w"))
    key, _ = mixing._keys(F.col("doc_id"), F.col("text"), F.col("w"), 1)
    first = rows.select("doc_id", key.alias("k")).groupBy(F.floor(F.col("doc_id") / 2)).agg(F.min_by("doc_id", "k").alias("d"))
    share = first.where("d % 2 = 0").count() / 10_000
    assert abs(share - 0.75) < 0.02


# ---- 8: Jaccard join


def brute_links(rows):
    sets = [H.shingle_set(t) for _, t, *_ in rows]
    return [[j for j, b in enumerate(sets) if i != j and a and b and 5 * len(a & b) >= 4 * len(a | b)] for i, a in enumerate(sets)]


def near_copies(rng, text, n, edits):
    out = []
    for _ in range(n):
        w = text.split(" ")
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = H.word(rng)
        out.append(" ".join(w))
    return out


def check_join(rows, got):
    links = brute_links(rows)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, js in enumerate(links):
        for j in js:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, *_) in enumerate(rows):
        least.setdefault(find(i), []).append(d)
    want = sorted((str(d), min((x for x in least[find(i)] if x is not None), default=None), len(links[i])) for i, (d, *_) in enumerate(rows) if d is not None)
    assert sorted((str(r.doc_id), r.class_id, r.n_links) for r in got if r.doc_id is not None) == want
    assert sorted(r.n_links for r in got if r.doc_id is None) == sorted(len(links[i]) for i, (d, *_) in enumerate(rows) if d is None)


def test_join_matches_brute_force(spark):
    rng = H.rng(12)
    passage = H.prose(rng, 60)
    rows = [H.prose(rng, rng.randint(1, 120)) for _ in range(120)] + [passage + " " + H.prose(rng, 40) for _ in range(30)]
    for n, edits in ((12, 3), (30, 6), (5, 1), (4, 0)):
        rows += near_copies(rng, H.prose(rng, 150), n, edits)
    rng.shuffle(rows)
    rows = [(i, t, "en", "a") for i, t in enumerate(rows)]
    check_join(rows, chosen_path.join(H.frame(spark, rows)).collect())


def test_join_splits_large_buckets(spark):
    """Tiny leaves and blocks send everything through the deeper levels and through block pairs."""
    rng = H.rng(13)
    texts = near_copies(rng, H.prose(rng, 150), 60, 8) + [H.prose(rng, 50) for _ in range(30)]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    check_join(rows, chosen_path.join(H.frame(spark, rows), leaf=5, block=8).collect())


def test_join_edges(spark):
    rows = H.awkward(H.rng(14)) + [(70, "same four words here", "en", "a"), (71, "Same four, words HERE!", "en", "a")]
    got = chosen_path.join(H.frame(spark, rows)).collect()
    check_join(rows, got)
    by = {r.doc_id: r for r in got}
    assert by[71].class_id == 70 and by[1].class_id == 1 and by[2].class_id == 2 and by[1].n_links == 0
    assert chosen_path.join(H.frame(spark, [])).count() == 0
    kept = chosen_path.distinct(H.frame(spark, rows))
    assert kept.columns == H.frame(spark, []).columns
    got = sorted(str(r.doc_id) for r in kept.collect())
    # the text of 6 also stands in a row without an id; three equal rows leave one; blanks stay
    assert got == sorted(str(i) for i in [1, 2, None, 3, 4, 5, 6, 7, 7, 8, 9, 10, -5, 70])


def test_runs_and_recall():
    assert 8 <= chosen_path.runs(0.9999) <= 16 and chosen_path.runs(0.9) < chosen_path.runs(0.99)


# ---- 9: quality


def test_quality_knn(spark):
    rng = H.rng(15)
    rows = [(i, H.prose(rng, rng.randint(20, 120)) if i % 3 else H.junk(rng, rng.randint(20, 120)), "en", "a") for i in range(400)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(400)] + [(None, 1, 0), (399, None, None), (0, 1, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    awkward = [(None if i is None else 5000 + i, t, g, s) for i, t, g, s in H.awkward(rng)]
    got = quality_knn.classify(H.frame(spark, rows + awkward), labels).collect()
    assert len(got) == len(rows) + len(awkward)
    held = [r for r in got if r.held_out and r.doc_id < 400]
    assert len(held) > 60 and np.mean([r.predicted == int(r.doc_id % 3 > 0) for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert quality_knn.classify(H.frame(spark, []), labels).count() == 0
    none = quality_knn.classify(H.frame(spark, rows[:5]), labels.limit(0)).collect()
    assert [r.score for r in none] == [0.5] * 5


def test_quality_vote_is_exact():
    rng = H.rng(16)
    texts = [H.prose(rng, 40) if i % 2 else H.junk(rng, 40) for i in range(60)]
    model = quality_knn.fit(texts, [i % 2 for i in range(60)])
    counts = quality_knn.term_counts([H.prose(rng, 30), "", H.junk(rng, 30)])
    for v, s in zip(model.latent(counts), model.score(counts)):
        near = sorted(((max(0.0, float(v @ u)), y) for u, y in zip(model.vectors, model.labels)), reverse=True)[: quality_knn.NEIGHBOURS]
        w = [a**quality_knn.SHARPNESS for a, _ in near]
        assert abs(s - (sum(a * y for a, (_, y) in zip(w, near)) + quality_knn.PRIOR_VOTES * model.rate) / (sum(w) + quality_knn.PRIOR_VOTES)) < 1e-4
    assert abs(model.score(quality_knn.term_counts([""]))[0] - model.rate) < 1e-6
