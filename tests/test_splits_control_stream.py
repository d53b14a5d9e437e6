"""Splits, control rules and stream/batch parity."""

import os

import numpy as np
from pyspark.sql import functions as F

from myosig.functions import features as ft
from myosig.operators import control as ctl
from myosig.operators import splits as sp
from myosig.operators.index import with_row_index
from myosig.operators.windows import sliding_windows
from myosig.streaming import feed as fd
from myosig.streaming.windows import run_to_table, stream_windows


def test_split_by_reps_disjoint_complete(spark):
    rows = [(a, r, i) for a, nrep in [("walk", 10), ("run", 1), ("sts", 4)] for r in range(nrep) for i in range(3)]
    df = spark.createDataFrame(rows, "activity string, reps int, i int")
    t = sp.rep_split_table(df, 0.8).toPandas()
    assert t.groupby(["activity", "reps"]).size().max() == 1  # no rep in both splits
    assert set(t[t.activity == "run"]["split"]) == {"test"}  # floor(0.8 * 1) = 0 -> all test
    assert (t[t.activity == "walk"]["split"] == "train").sum() == 8
    assert sp.split_by_reps(df).count() == df.count()


def test_stratified_and_balanced_counts(spark):
    rows = [(i, i % 3) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, label int")
    s = sp.split_stratified(df, "id", "label", test=0.2).toPandas()
    for lab, g in s.groupby("label"):
        assert (g.split == "test").sum() == int(np.ceil(0.2 * len(g)))
    b = sp.sample_balanced(df, "id", "label", total=10).toPandas()
    assert sorted(b.groupby("label").size().tolist()) == [3, 3, 4]
    assert sorted(b["pos"]) == list(range(10))


def test_torque_bounded_and_commands(spark):
    df = spark.createDataFrame([(float(p), "G_DK_X_Target") for p in range(-100, 101, 5)], "pred double, joint string")
    tq, _ = ctl.torque(F.col("pred"), F.lit(3.0), F.col("joint"))
    vals = [r[0] for r in df.select(tq).collect()]
    assert max(vals) <= 20.0 and min(vals) >= -20.0
    a, k = ctl.assist_command(F.lit(-20.0), F.lit(None).cast("double"))
    r = df.limit(1).select(a.alias("a"), k.alias("k")).first()
    assert r["a"].startswith("INCREASE") and r["k"].startswith("NEUTRAL")


def test_stream_equals_batch_with_duplicates(spark):
    rng = np.random.default_rng(7)
    rows = [(s, i, float(rng.normal()), float(i % 100)) for s in range(5) for i in range(60 + 7 * s)]
    dup = rows[10:30]  # duplicated samples must be ignored
    base = fd.scratch_folder(spark, "test_stream")
    feed = spark.createDataFrame(rows + dup, "subject long, seq long, x double, gait double")
    feed = feed.withColumn("activity", F.lit("walk")).withColumn("event_id", F.col("seq")).withColumn("first_seq", F.lit(0)).withColumn("arrived", F.current_timestamp())
    path = os.path.join(base, "feed")
    feed.withColumn("first_seq", F.col("first_seq").cast("long")).repartition(5, F.xxhash64("seq", "x")).write.parquet(path)
    sdf = fd.stream_samples(spark, path)
    out = run_to_table(spark, stream_windows(sdf, 8, 4, series="subject", x="x", truth="gait"), "w", base)
    got = spark.read.parquet(out).where("window_id >= 0").toPandas().sort_values(["series", "window_id"])
    b = spark.createDataFrame(rows, "subject long, seq long, x double, gait double")
    ix = with_row_index(b, ["seq"], series=["subject"], count_name="n_rows")
    exp = sliding_windows(ix, 8, 4, series=["subject"], aggs={"mav": ft.mav("x"), "mean_x": ft.mean("x")}).toPandas()
    exp = exp.sort_values(["subject", "window_id"])
    assert len(got) == len(exp)
    np.testing.assert_allclose(got["mav"].to_numpy(), exp["mav"].to_numpy(), rtol=1e-12)
    assert int(spark.read.parquet(out).agg(F.sum("n_dropped")).first()[0]) == len(dup)


def test_block_stream_equals_batch(spark):
    from myosig.streaming.windows import stream_block_windows

    rng = np.random.default_rng(8)
    rows = [(s, i, rng.normal(size=4).tolist(), float(i)) for s in range(3) for i in range(40 + 5 * s)]
    base = fd.scratch_folder(spark, "test_block_stream")
    path = os.path.join(base, "feed")
    df = spark.createDataFrame(rows + rows[3:9], "subject long, seq long, x array<double>, gait double")
    df.repartition(3, F.xxhash64("seq", "subject")).write.parquet(path)
    sdf = spark.readStream.schema("subject long, seq long, x array<double>, gait double").option("maxFilesPerTrigger", 1).parquet(path)
    out = run_to_table(spark, stream_block_windows(sdf, 8, 4, series="subject", truth="gait"), "w", base)
    got = spark.read.parquet(out).where("window_id >= 0").toPandas().sort_values(["series", "window_id"]).reset_index(drop=True)
    exp = []
    for s in range(3):
        xs = np.array([r[2] for r in rows if r[0] == s])
        for k, st in enumerate(range(0, len(xs) - 8 + 1, 4)):
            w = xs[st : st + 8]
            exp.append((s, k, np.abs(w).mean(), w.mean(axis=0)))
    assert len(got) == len(exp)
    for (s, k, mav, mch), row in zip(exp, got.itertuples()):
        assert (row.series, row.window_id) == (s, k)
        assert abs(row.mav - mav) < 1e-12
        np.testing.assert_allclose(np.asarray(row.mean_ch), mch, rtol=1e-12)


def _stream(spark, rows, name, files=4, **kw):
    base = fd.scratch_folder(spark, name)
    path = os.path.join(base, "feed")
    spark.createDataFrame(rows, "series long, seq long, x double, t double").repartition(files, F.xxhash64("seq", "series")).write.parquet(path)
    sdf = spark.readStream.schema("series long, seq long, x double, t double").option("maxFilesPerTrigger", 1).parquet(path)
    return spark.read.parquet(run_to_table(spark, stream_windows(sdf, 8, 4, **kw), "w", base)).toPandas()


def test_stream_starts_late(spark):
    """First sequence 100: with the declared origin every window comes; without, after the gap limit."""
    rows = [(1, 100 + i, float(i), 0.0) for i in range(100)]
    got = _stream(spark, rows, "late", origin=100)
    assert sorted(got.start_seq) == list(range(100, 193, 4))
    got = _stream(spark, rows, "late_unknown", files=1, gap_limit=20)
    assert sorted(got[got.window_id >= 0].start_seq) == list(range(100, 193, 4)) and got.n_missing.sum() == 100


def test_stream_goes_on_after_a_lost_sample(spark):
    rows = [(1, i, float(i), 0.0) for i in range(200) if i != 21] + [(2, i, float(i), 0.0) for i in range(40)]
    got = _stream(spark, rows, "lost", files=1, gap_limit=16)
    one = got[(got.series == 1) & (got.window_id >= 0)].sort_values("window_id")
    assert one.start_seq.tolist() == [0, 4, 8, 12, *range(22, 193, 4)]
    assert one.window_id.tolist() == list(range(len(one))) and got[got.series == 1].n_missing.sum() == 1
    assert len(got[(got.series == 2) & (got.window_id >= 0)]) == 9


def test_long_series_loses_no_sample(spark, monkeypatch):
    """One series far over the gap limit: the replayed feed gives up nothing and equals the batch windows."""
    from myosig import adapters

    n = 100_000
    x = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0
    sig = spark.range(n).select(
        F.col("id").alias("event_id"), F.timestamp_seconds("id").alias("ts"), F.lit(1).cast("long").alias("subject"), F.lit("walk").alias("activity"), F.lit(1).alias("reps"), F.lit(0.0).alias("gait"), x.alias("x")
    )
    monkeypatch.setattr(adapters, "signal", lambda spark, sf_dir: sig)
    base = fd.scratch_folder(spark, "test_long_series")
    sdf = fd.stream_samples(spark, fd.write_feed(spark, "", os.path.join(base, "feed")))
    all_rows = spark.read.parquet(run_to_table(spark, stream_windows(sdf, 8, 4, series="subject", x="x", truth="gait"), "w", base)).toPandas()
    got = all_rows[all_rows.window_id >= 0].sort_values("window_id")
    exp = sliding_windows(with_row_index(sig, adapters.SUBJECT_ORDER, series=["subject"], count_name="n_rows"), 8, 4, series=["subject"], aggs={"mav": ft.mav("x")}).toPandas().sort_values("window_id")
    print("windows", len(got), "of", len(exp), "missing", int(all_rows.n_missing.sum()), "dropped", int(all_rows.n_dropped.sum()))
    assert all_rows.n_missing.sum() == 0 and all_rows.n_dropped.sum() == 0
    assert got.window_id.tolist() == exp.window_id.tolist() and got.start_seq.tolist() == list(range(0, n - 7, 4))
    np.testing.assert_allclose(got["mav"].to_numpy(), exp["mav"].to_numpy(), rtol=1e-9)
