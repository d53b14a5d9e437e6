"""Guarantees at scale and on awkward rows: seeds, null series, exact values, one shuffle, bounded training."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from myosig import session
from myosig.functions import broadcast_if_small, frame_bytes
from myosig.models import fit, linear, mlp, trees
from myosig.operators import profile, sequence, splits
from myosig.operators.index import with_lags, with_row_index


def test_seeds_give_different_orders(spark):
    ids = spark.range(2000)
    orders = [tuple(r.id for r in splits.shuffle(ids, "id", s).collect()) for s in (0, 1, 4, 7, 42)]
    assert len(set(orders)) == 5
    assert all(sum(a == b for a, b in zip(orders[0], o)) < 50 for o in orders[1:])
    picks = [{r.id for r in splits.sample_n(ids, 100, "id", s).collect()} for s in (0, 1)]
    assert len(picks[0] & picks[1]) < 30
    kept = splits.sample_rows(ids, 0.2, "id", 3)
    assert 300 < kept.count() < 500 and sorted(kept.collect()) == sorted(splits.sample_rows(ids.repartition(5), 0.2, "id", 3).collect())


def test_hash_has_no_period(spark):
    ids = spark.range(0, 3_000_009, 1_000_003).unionByName(spark.range(1_000_000, 1_200_000))
    h = ids.select(splits.stable_hash("id").alias("h"))
    assert h.distinct().count() == ids.distinct().count()


def test_null_series_are_kept(spark):
    rows = [(None, 1), ("a", 1), (None, 2), ("a", 2)]
    got = with_row_index(spark.createDataFrame(rows, "label string, t int"), ["t"], series=["label"], count_name="n").collect()
    assert sorted((r.label or "", r.t, r.idx, r.n) for r in got) == [("", 1, 0, 2), ("", 2, 1, 2), ("a", 1, 0, 2), ("a", 2, 1, 2)]
    df = spark.createDataFrame(rows, "label string, t int")
    assert splits.split_by_class(df, "label", ["t"], 0.5).count() == 4
    q = profile.exact_quantile(df, ["label"], "t").collect()
    assert sorted((r.label or "", r.quantile) for r in q) == [("", 1.5), ("a", 1.5)]
    k = with_row_index(df, ["t"], series=["label"])
    assert sequence.kalman_smooth(k, "t", series=["label"]).count() == 4


def test_quantile_narrows_to_the_end(spark):
    rng = np.random.default_rng(0)
    v = np.concatenate([rng.lognormal(0, 6, 2001), [-1.5e308, 1.5e308]])
    df = spark.createDataFrame([(float(x),) for x in v], "v double").withColumn("g", F.lit(1))
    got = profile.exact_quantile(df, ["g"], "v", 0.5, buckets=512, max_final=100).first().quantile
    assert got == np.quantile(v, 0.5)


BIG = 9007199254740993


def test_lags_keep_types_and_nulls(spark):
    rng = np.random.default_rng(1)
    rows = [(s, t, None if rng.random() < 0.2 else float(rng.normal()), None if t % 7 == 0 else BIG + t) for s in ("a", None, "b") for t in range(40)]
    df = spark.createDataFrame(rows, "s string, t int, x double, big long")
    a = with_row_index(df, ["t"], series=["s"], lag_cols=["x"], lags=2, num_partitions=5)
    b = with_lags(with_row_index(df, ["t"], series=["s"]), ["x"], series=["s"], lags=2, block=8)
    key = lambda r: (r.s or "", r.t)
    cols = ["s", "t", "idx", "big", "x", "x_lag1", "x_lag2"]
    assert sorted(a.select(cols).collect(), key=key) == sorted(b.select(cols).collect(), key=key)
    assert {r.big for r in a.collect() if r.big is not None} == {BIG + t for t in range(40) if t % 7}


def test_scoring_keeps_other_columns(spark):
    nodes = trees.demo_forest(2)
    df = spark.createDataFrame([(BIG, 1.0, 2.0, 3.0, 4.0), (None, 1.0, 2.0, 3.0, 4.0)], "id long, a double, b double, c double, d double")
    assert {r.id for r in trees.score_forest(df, nodes, ["a", "b", "c", "d"], ["p", "q"]).collect()} == {BIG, None}


def test_row_index_moves_rows_once(spark):
    df = spark.range(5000).select((F.col("id") % 50).alias("s"), F.col("id").alias("t"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = with_row_index(df, ["t"], series=["s"], count_name="n")
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "strategy=broadcast" in plan
        physical = out._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" in physical and "SortMergeJoin" not in physical
        assert out.where("n != 100 or idx != floor(t / 50)").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_broadcast_goes_by_bytes(spark):
    df = spark.range(100).select("id", F.lit("x" * 1000).alias("s"))
    assert 100_000 < frame_bytes(df) < 130_000
    assert "broadcast" in broadcast_if_small(df)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in broadcast_if_small(df, limit=1000)._jdf.queryExecution().analyzed().toString()


def test_kalman_matches_sequential_with_nulls(spark):
    rng = np.random.default_rng(2)
    z = rng.normal(size=500).cumsum()
    miss = rng.random(500) < 0.1
    miss[:3] = True
    df = spark.createDataFrame([(i, None if m else float(v)) for i, (v, m) in enumerate(zip(z, miss))], "idx long, z double")
    got = [r.z_kalman for r in sequence.kalman_smooth(df, "z", block=128).orderBy("idx").collect()]
    gains, x, want = sequence.kalman_gains(600, 0.4), None, []
    for i, (v, m) in enumerate(zip(z, miss)):
        if not m:
            x = v if x is None else x + gains[i] * (v - x)
        want.append(x)
    assert all((a is None) == (b is None) and (a is None or abs(a - b) < 1e-9) for a, b in zip(got, want))


@pytest.mark.parametrize("d", [26, 96])
def test_ridge_and_lda_of_many_features(spark, d):
    rng = np.random.default_rng(d)
    x = rng.normal(size=(400, d))
    y = x @ rng.normal(size=d) + 0.1 * rng.normal(size=400)
    c = (x[:, 0] + 0.3 * rng.normal(size=400) > 0).astype(int)
    names = [f"f{i}" for i in range(d)]
    df = spark.createDataFrame([(*map(float, r), float(t), int(k)) for r, t, k in zip(x, y, c)], ", ".join(f"{n} double" for n in names) + ", y double, c int")
    m = linear.fit_ridge(df, names, ["y"], alpha=1.0)
    xc, yc = x - x.mean(0), y - y.mean()
    np.testing.assert_allclose(m.coef[0], np.linalg.solve(xc.T @ xc + np.eye(d), xc.T @ yc), rtol=1e-8)
    lda = linear.fit_lda(df, names, "c")
    z = x - np.stack([x[c == k].mean(0) for k in (0, 1)])[c]
    np.testing.assert_allclose(lda.covariance, z.T @ z / 400, rtol=1e-8, atol=1e-12)


def test_fits_learn_a_known_function(spark):
    rng = np.random.default_rng(3)
    x = rng.uniform(-1, 1, size=(600, 3))
    y = 3 * x[:, 0] + np.abs(x[:, 1])
    c = (x[:, 0] > 0).astype(float) + (x[:, 1] > 0.5)
    df = spark.createDataFrame([(*map(float, r), float(t), float(k), i % 3) for i, (r, t, k) in enumerate(zip(x, y, c))], "a double, b double, z double, y double, label double, fold int").repartition(3).cache()
    feats = ["a", "b", "z"]

    def r2(p):
        r = p.agg(F.avg((F.col("y") - F.col("p")) ** 2).alias("e"), F.var_pop("y").alias("v")).first()
        return 1 - r.e / r.v

    def acc(p):
        return p.where("label = prediction").count() / 600

    d = fit.assemble(df, feats)
    assert r2(fit.predict_models(fit.fit_forest_regressor(df, feats, ["y"]), df, feats).withColumn("p", F.col("y_pred"))) > 0.9
    assert r2(fit.fit_boosted_regressor(df, feats, "y", iters=20).setPredictionCol("p").transform(d)) > 0.95
    assert acc(fit.fit_forest_classifier(df, feats, "label", trees=10, depth=5).transform(d)) > 0.95
    assert acc(fit.fit_logistic(df, feats, "label", C=10.0).transform(d)) > 0.75
    svm, _ = fit.fit_kernel_svm(df, feats, "label", C=10.0, gamma=1.0, max_iter=20)
    k = df.withColumn("features", fit.random_fourier(feats, 64, 1.0, 0))
    assert acc(svm.transform(k)) > 0.85
    svr, _ = fit.fit_kernel_svr(df, feats, "y", C=10.0, gamma=1.0)
    assert r2(svr.setPredictionCol("p").transform(k)) > 0.9
    net = mlp.fit_mlp_regressor(df, feats, ["y"], epochs=150)
    out = linear.mlp_forward(F.array(*feats), net["layers"])[0]
    assert r2(df.withColumn("p", out)) > 0.9
    res, n = fit.pca_variance(df, feats, 0.99)
    assert n == 3 and res.count() == 600


def test_grid_search_ranks_and_refits(spark):
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rng = np.random.default_rng(4)
    x = rng.uniform(-1, 1, size=(300, 2))
    df = spark.createDataFrame([(*map(float, r), float(r[0] * r[1] > 0), i % 3) for i, r in enumerate(x)], "a double, b double, label double, fold int")
    d = fit.assemble(df, ["a", "b"])
    tree = DecisionTreeClassifier(featuresCol="features", labelCol="label", seed=1)
    families = {"tree": (tree, {tree.maxDepth: [1, 4]})}
    best, rows = fit.grid_search(d, families, MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy"), "fold")
    assert best["params"] == {"DecisionTreeClassifier.maxDepth": 4} and best["mean_train"] >= best["mean_test"] > 0.8
    assert sorted(r["rank"] for r in rows) == [1, 2]
    assert fit.refit_best(families, best, d).depth == 4


def test_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())
