"""The pipeline's stages one by one, and the whole of it on the smallest tables."""

from collections import Counter

import helpers as H
import pytest

import corpus_pipeline as P
from myosig.llm import mixing, packing
from myosig.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """Each stage's input and output on the smallest tables."""
    out, docs = {}, spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in P.STAGES:
        done = P.written(stage(spark, docs, SF), name)
        out[name] = (docs, done)
        docs = done
    return out


def test_stages(kept):
    names = [n for n, _ in P.STAGES]
    assert names == ["language_id", "quality", "near_duplicates", "mix", "pack"]
    for name in names[:-1]:
        before, after = kept[name]
        assert after.columns == before.columns


def test_filters_keep_clean_documents(spark, kept):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = (set(r.doc_id for r in d.select("doc_id").collect()) for d in kept["quality"])
    good, bad = ({i for i in before if labels.get(i) == q} for q in (1, 0))
    assert len(good - after) <= 0.02 * len(good) and len(bad & after) <= 0.1 * len(bad)
    before, after = (d.count() for d in kept["language_id"])
    assert after >= 0.99 * before


def test_near_duplicates_by_brute_force(kept):
    before, after = (d.collect() for d in kept["near_duplicates"])
    sets = {r.doc_id: H.shingle_set(r.text) for r in before}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            if sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    assert sorted(r.doc_id for r in after) == sorted(i for i in ids if find(i) == i)


def test_mix_and_pack(kept):
    before, after = kept["mix"]
    times = {r.doc_id: r.times for r in mixing.mix(before).collect()}
    assert Counter(r.doc_id for r in after.collect()) == Counter({i: t for i, t in times.items() if t})
    packed = kept["pack"][1].collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r.doc_id for r in after.collect())
    fill = Counter()
    for r in packed:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= packing.SEQUENCE and len(fill) <= sum(fill.values()) / packing.SEQUENCE + 2


def test_stages_with_awkward_rows(spark):
    docs = H.frame(spark, H.awkward(H.rng(1)))
    for name, stage in P.STAGES:
        done = P.written(stage(spark, docs, SF), name)
        if name != "pack":
            assert done.columns == docs.columns
            assert P.written(stage(spark, docs.limit(0), SF), name).count() == 0


def test_run_and_queries(spark):
    assert P.run(spark, SF).count() > 0
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
