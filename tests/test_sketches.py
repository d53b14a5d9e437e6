"""Sketches per recording, merged, against exact ranks and counts."""

import os

import numpy as np
import pytest

from myosig.operators import sketches as sk
from myosig.streaming.feed import scratch_folder


@pytest.fixture(scope="module")
def samples(spark):
    rng = np.random.default_rng(3)
    # one recording holds most rows; one value is missing and one is no number
    rows = [("a" if i % 3 else f"r{i % 7}", [float(x) for x in rng.normal(size=3) * [1, 2, 50]], i % 900) for i in range(12_000)]
    rows[5][1][0], rows[6][1][1] = None, float("nan")
    return rows, spark.createDataFrame(rows, "rec string, x array<double>, subject int").repartition(6)


def test_quantiles_of_stored_recordings(spark, samples):
    rows, df = samples
    path = os.path.join(scratch_folder(spark, "test_sketch"), "s")
    new = sk.channel_sketches(df, "x", "rec")
    sk.add_recordings(new.where("recording <> 'a'"), path)
    stored = sk.add_recordings(new, path)
    assert sk.add_recordings(new, path).count() == stored.count() == new.count()  # nothing twice
    got = {r.ch: r for r in sk.bad_channels(stored, z=1.0).collect()}
    for ch in range(3):
        v = np.array([r[1][ch] for r in rows], float)
        v = v[~np.isnan(v)] ** 2
        assert got[ch].n == len(v)
        assert abs((v <= got[ch].median_sq).mean() - 0.5) <= 2 * sk.rank_error()
    assert [got[c].is_bad for c in range(3)] == [False, False, True]


def test_counts_of_merged_recordings(samples):
    _, df = samples
    row = sk.merged_cardinality(sk.distinct_sketches(df, ["subject", "rec"], "rec"), ["subject", "rec"]).first()
    assert abs(row.n_subject - 900) <= 4 * sk.count_error() * 900 and row.n_rec == 8


def test_empty_table(spark):
    df = spark.createDataFrame([], "rec string, x array<double>")
    assert sk.bad_channels(sk.channel_sketches(df, "x", "rec")).count() == 0
    assert sk.merged_cardinality(sk.distinct_sketches(df, ["rec"], "rec"), ["rec"]).first().n_rec == 0
