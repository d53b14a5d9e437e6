"""Two-implementation checks: Kalman scan vs sequential, exact median vs numpy,
blocked kNN vs brute force, moving average vs pandas, model scorers vs each other."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from myosig.models import knn, linear, trees
from myosig.operators import profile as pf
from myosig.operators import sequence as sq
from myosig.operators.index import with_row_index


def _kalman_ref(z, q=0.4):
    r = np.var(z) * 0.5
    if r == 0:
        return z.copy()
    Q, x, P = r * q, z[0], r
    out = [x]
    for v in z[1:]:
        P = P + Q
        K = P / (P + r)
        x = x + K * (v - x)
        P = (1 - K) * P
        out.append(x)
    return np.array(out)


def test_kalman_blocks_match_sequential(spark):
    rng = np.random.default_rng(1)
    long = rng.normal(size=900).cumsum()
    rows = [(0, i, float(v)) for i, v in enumerate(long)] + [(1, i, float(v)) for i, v in enumerate(rng.normal(size=30))]
    rows += [(2, i, 5.0) for i in range(10)]  # constant series: returned unchanged
    df = spark.createDataFrame(rows, "s long, idx long, z double")
    out = sq.kalman_smooth(df, "z", series=["s"], block=128).toPandas().sort_values(["s", "idx"])
    for s, g in out.groupby("s"):
        ref = _kalman_ref(g["z"].to_numpy())
        np.testing.assert_allclose(g["z_kalman"].to_numpy(), ref, rtol=1e-9, atol=1e-9)


def test_moving_average_matches_pandas(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=300)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "idx long, x double")
    out = sq.moving_average(df, "x", 10).toPandas().sort_values("idx")
    exp = pd.Series(x).rolling(window=10, center=True, min_periods=1).mean().to_numpy()
    np.testing.assert_allclose(out["x_ma"].to_numpy(), exp, rtol=1e-12)


def test_fill_curve_interpolates_and_fills(spark):
    vals = [None, None, 2.0, None, 4.0, None, None]
    df = spark.createDataFrame([("j", i, v) for i, v in enumerate(vals)], "k string, pos int, v double")
    out = sq.fill_curve(df, ["k"], "pos", "v").toPandas().sort_values("pos")["v"].tolist()
    assert out == [2.0, 2.0, 2.0, 3.0, 4.0, 4.0, 4.0]


def test_exact_quantile_matches_numpy(spark):
    rng = np.random.default_rng(3)
    rows = [(g, float(v)) for g in range(3) for v in rng.exponential(size=5000 + g)]
    rows += [(9, 7.0)] * 1000 + [(9, 8.0)]  # heavy duplicates
    df = spark.createDataFrame(rows, "g int, v double")
    out = pf.exact_quantile(df, ["g"], "v", 0.5, buckets=16, max_final=50).toPandas().set_index("g")
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    for g, grp in pdf.groupby("g"):
        assert out.loc[g, "quantile"] == pytest.approx(grp["v"].median(), rel=1e-12)


def test_knn_blocks_match_brute_force(spark):
    rng = np.random.default_rng(4)
    tr = rng.normal(size=(300, 5))
    te = rng.normal(size=(70, 5))
    lab = rng.integers(0, 4, size=300)
    train = spark.createDataFrame([(i, tr[i].tolist(), int(lab[i])) for i in range(300)], "train_id long, vec array<double>, label int")
    test = spark.createDataFrame([(i, te[i].tolist()) for i in range(70)], "test_id long, vec array<double>")
    top = knn.knn_topk(test, train, 5, block_bytes=1024).toPandas()
    for t in range(70):
        d = ((tr - te[t]) ** 2).sum(axis=1)
        exp = np.lexsort((np.arange(300), d))[:5]
        got = top[top.test_id == t].sort_values("rank")["train_id"].tolist()
        assert got == exp.tolist()
    votes = knn.knn_vote(knn.knn_topk(test, train, 7), [3, 7]).count()
    assert votes == 140
    # the other way round the train side is the smaller one, in blocks of a few rows
    back = knn.knn_topk(
        train.withColumnRenamed("train_id", "test_id"), test.withColumnRenamed("test_id", "train_id").withColumn("label", F.lit(0)), 3, block_bytes=512
    ).toPandas()
    for t in range(0, 300, 17):
        d = ((te - tr[t]) ** 2).sum(axis=1)
        assert back[back.test_id == t].sort_values("rank")["train_id"].tolist() == np.lexsort((np.arange(70), d))[:3].tolist()


def test_knn_prunes_and_equals_brute_force_on_20000_vectors(spark, monkeypatch):
    """Clusters, ties on a grid, a third of all rows equal, a hot block in chunks, unusable vectors."""
    monkeypatch.setattr(knn, "CHUNK_ROWS", 300)
    rng = np.random.default_rng(8)
    centres = rng.normal(scale=40, size=(30, 6))
    tr = np.round(centres[rng.integers(0, 30, 20_000)] + rng.normal(size=(20_000, 6)), 1)
    tr[::3] = tr[0]
    te = np.concatenate([np.round(centres[rng.integers(0, 30, 600)] + rng.normal(size=(600, 6)), 1), tr[:400], np.full((1, 6), 1e4)])
    schema = "id long, vec array<double>, label int"
    train = spark.createDataFrame([(i, tr[i].tolist(), i % 3) for i in range(len(tr))] + [(90_000, None, 1), (90_001, [], 1), (90_002, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1)], schema)
    test = spark.createDataFrame([(i, te[i].tolist(), 0) for i in range(len(te))] + [(90_003, None, 1), (90_004, [float("nan")] * 6, 1)], schema)
    stats = {}
    top = knn.knn_topk(test.withColumnRenamed("id", "test_id"), train.withColumnRenamed("id", "train_id"), 7, block_bytes=64 << 10, stats=stats)
    got = {}
    for r in top.orderBy("test_id", "rank").collect():
        got.setdefault(r.test_id, []).append((r.train_id, r.dist2, r.label))
    assert set(got) == set(range(len(te)))
    for t in range(len(te)):
        d = ((tr - te[t]) ** 2).sum(axis=1)
        best = np.argsort(d, kind="stable")[:7]
        assert [g[0] for g in got[t]] == best.tolist() and [g[2] for g in got[t]] == (best % 3).tolist()
        np.testing.assert_allclose([g[1] for g in got[t]], d[best])
    assert stats["pairs"] == 20_000 * len(te) and stats["measured"] < 0.5 * stats["pairs"]
    none = spark.createDataFrame([], "train_id long, vec array<double>, label int")
    assert knn.knn_topk(test.withColumnRenamed("id", "test_id"), none, 3).count() == 0
    few = knn.knn_topk(test.withColumnRenamed("id", "test_id").limit(5), train.withColumnRenamed("id", "train_id").where("train_id < 2"), 3)
    assert few.count() == 10


def test_forest_scorers_agree(spark):
    rng = np.random.default_rng(5)
    x = rng.uniform([0, 0, 0, 0], [50, 100000, 0.1, 0.08], size=(500, 4))
    cols = ["a", "b", "c", "d"]
    df = spark.createDataFrame(pd.DataFrame(x, columns=cols))
    nodes = trees.demo_forest(2)
    e0, e1 = trees.forest_expr(nodes, cols, 2)
    s = trees.score_forest(df.withColumn("e0", e0).withColumn("e1", e1), nodes, cols, ["p0", "p1"]).toPandas()
    np.testing.assert_allclose(s["p0"], s["e0"])
    np.testing.assert_allclose(s["p1"], s["e1"])
    # the walk really branches: several distinct leaves are reached
    assert s["p0"].nunique() > 4


def test_ridge_matches_numpy(spark):
    rng = np.random.default_rng(6)
    X = rng.normal(size=(400, 3))
    y = X @ np.array([1.0, -2.0, 0.5]) + 3 + rng.normal(scale=0.1, size=400)
    df = spark.createDataFrame(pd.DataFrame(np.c_[X, y], columns=["a", "b", "c", "y"]))
    m = linear.fit_ridge(df, ["a", "b", "c"], ["y"], alpha=1.0)
    Xc, yc = X - X.mean(0), y - y.mean()
    coef = np.linalg.solve(Xc.T @ Xc + np.eye(3), Xc.T @ yc)
    np.testing.assert_allclose(m.coef[0], coef, rtol=1e-9)
    assert m.intercept[0] == pytest.approx(y.mean() - X.mean(0) @ coef)


def test_mlp_expression_matches_numpy(spark):
    layers = [([[0.5, -0.2], [0.3, 0.1], [-0.4, 0.6]], [0.1, -0.1, 0.0]), ([[1.0, -1.0, 0.5]], [0.2])]
    xs = [[1.0, 2.0], [-3.0, 0.5], [0.0, 0.0]]
    df = spark.createDataFrame([(x,) for x in xs], "x array<double>")
    got = [r[0][0] for r in df.select(linear.mlp_forward(F.col("x"), layers)).collect()]
    W1, b1 = np.array(layers[0][0]), np.array(layers[0][1])
    W2, b2 = np.array(layers[1][0]), np.array(layers[1][1])
    exp = [(np.maximum(W1 @ np.array(x) + b1, 0) @ W2.T + b2)[0] for x in xs]
    np.testing.assert_allclose(got, exp)
