"""Joint multi-output forest grown on Spark."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from myosig.models import multiforest, trees
from myosig.models.multiforest import fit_multi_forest


def test_single_tree_finds_steps(spark):
    rng = np.random.default_rng(0)
    n = 2000
    x0, x1 = rng.uniform(size=n), rng.uniform(size=n)
    y1 = np.where(x0 > 0.5, 10.0, 0.0)
    y2 = np.where(x1 > 0.3, 5.0, -5.0) + y1 / 10
    pdf = pd.DataFrame({"id": np.arange(n), "x0": x0, "x1": x1, "y1": y1, "y2": y2})
    df = spark.createDataFrame(pdf)
    nodes = fit_multi_forest(df, ["x0", "x1"], ["y1", "y2"], "id", trees=1, depth=2, min_leaf=5, bins=64, bootstrap=False)
    root = [nd for nd in nodes if nd.node == 0][0]
    assert root.feature == 0 and abs(root.threshold - 0.5) < 0.03
    s = trees.score_forest(df, nodes, ["x0", "x1"], ["p1", "p2"]).toPandas()
    assert np.mean(np.abs(s["p1"] - s["y1"])) < 0.5
    assert np.mean(np.abs(s["p2"] - s["y2"])) < 1.0
    e = df.select(*[c.alias(f"e{i}") for i, c in enumerate(trees.forest_expr(nodes, ["x0", "x1"], 2))]).toPandas()
    np.testing.assert_allclose(np.sort(e["e0"]), np.sort(s["p1"]))


def test_forest_is_deterministic_and_bounded(spark):
    rng = np.random.default_rng(1)
    n = 800
    X = rng.normal(size=(n, 3))
    pdf = pd.DataFrame({"id": np.arange(n), "a": X[:, 0], "b": X[:, 1], "c": X[:, 2], "y": X[:, 0] * 2 + X[:, 1], "z": X[:, 2] ** 2})
    df = spark.createDataFrame(pdf)
    a = fit_multi_forest(df, ["a", "b", "c"], ["y", "z"], "id", trees=3, depth=3, min_leaf=10)
    b = fit_multi_forest(df, ["a", "b", "c"], ["y", "z"], "id", trees=3, depth=3, min_leaf=10)
    assert a == b
    assert {nd.tree for nd in a} == {0, 1, 2}
    assert all(len(nd.value) == 2 for nd in a)
    s = trees.score_forest(df, a, ["a", "b", "c"], ["py", "pz"]).toPandas()
    r2 = 1 - np.sum((s.py - s.y) ** 2) / np.sum((s.y - s.y.mean()) ** 2)
    assert r2 > 0.7


def _plain(x, y, w, edges, depth, min_leaf):
    """The same trees by exhaustive search over the binned rows: {path: (feature, edge) or leaf means}."""
    out = {}

    def split(rows, path):
        best = (1e-12, None, None)
        yw, n = (w[rows, None] * y[rows]).sum(0), w[rows].sum()
        for f in range(x.shape[1]):
            for e in edges[f]:
                left = rows[x[rows, f] <= e]
                ln = w[left].sum()
                if min(ln, n - ln) < min_leaf:
                    continue
                ly = (w[left, None] * y[left]).sum(0)
                gain = (ly**2).sum() / ln + ((yw - ly) ** 2).sum() / (n - ln) - (yw**2).sum() / n
                if gain > best[0] * (1 + 1e-12):
                    best = (gain, f, e)
        if len(path) == depth or best[1] is None:
            out[path] = yw / n
            return
        out[path] = best[1:]
        go = x[rows, best[1]] <= best[2]
        split(rows[go], path + "L")
        split(rows[~go], path + "R")

    split(np.arange(len(x)), "")
    return out


def test_equals_exhaustive_search_in_small_passes(spark, monkeypatch):
    """Bootstrap weights, several blocks, tasks and passes a level: the trees of a plain search."""
    rng = np.random.default_rng(3)
    n, d = 1500, 4
    x = np.round(rng.normal(size=(n, d)), 2)
    y = np.stack([x[:, 0] * 2 + x[:, 1] ** 2, np.sign(x[:, 2]) * 3 + x[:, 0]], axis=1) + rng.normal(size=(n, 2)) * 0.1
    pdf = pd.DataFrame(np.hstack([x, y]), columns=["a", "b", "c", "d", "y", "z"]).assign(id=np.arange(n))
    df = spark.createDataFrame(pdf).repartition(6)
    df = df.unionByName(spark.createDataFrame([(None, 1.0, 1.0, 1.0, 1.0, 1.0, 7), (float("nan"), 1.0, 1.0, 1.0, 1.0, 1.0, 8)], df.schema))
    monkeypatch.setattr(multiforest, "HIST_BYTES", 3 * d * 16 * 3 * 8)  # three nodes a pass
    monkeypatch.setattr(multiforest, "REDUCE_BYTES", 4096)
    monkeypatch.setattr(multiforest, "PARTITION_BYTES", 8192)
    nodes = fit_multi_forest(df, ["a", "b", "c", "d"], ["y", "z"], "id", trees=3, depth=4, min_leaf=15, bins=16, seed=5)
    edges = [sorted(set(e)) for e in df.dropna().approxQuantile(["a", "b", "c", "d"], [(j + 1) / 16 for j in range(15)], 0.001)]
    h = np.array([r[0] for r in df.dropna().orderBy("id").select(F.xxhash64("id")).collect()])
    for k in range(3):
        w = multiforest._weights(h, k, 5)
        assert 0.9 < w.mean() < 1.1 and 0.85 < w.var() < 1.2
        want = _plain(x, y, w, edges, 4, 15)
        own, got = {nd.node: nd for nd in nodes if nd.tree == k}, {}

        def walk(nd, path):
            if nd.feature == trees.LEAF:
                got[path] = np.array(nd.value)
            else:
                got[path] = (nd.feature, nd.threshold)
                walk(own[nd.left], path + "L")
                walk(own[nd.right], path + "R")

        walk(own[0], "")
        assert got.keys() == want.keys()
        for path, v in want.items():
            np.testing.assert_allclose(got[path], v, rtol=1e-9, atol=1e-9)


def test_empty_and_constant_tables(spark):
    none = spark.createDataFrame([], "id long, a double, y double")
    assert [(nd.feature, nd.value) for nd in fit_multi_forest(none, ["a"], ["y"], "id", trees=2)] == [(trees.LEAF, (0.0,))] * 2
    flat = spark.createDataFrame([(i, 1.0, 2.0) for i in range(50)], "id long, a double, y double")
    nodes = fit_multi_forest(flat, ["a"], ["y"], "id", trees=2)
    assert [nd.feature for nd in nodes] == [trees.LEAF] * 2 and all(abs(nd.value[0] - 2.0) < 1e-12 for nd in nodes)


def test_forty_trees_of_depth_nine(spark):
    """The source's settings on 26 features: one pass a level and share of nodes, no copied rows."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(4000, 26))
    pdf = pd.DataFrame(x, columns=[f"f{i}" for i in range(26)]).assign(id=np.arange(4000), y=x[:, 0] + x[:, 1] * x[:, 2], z=x[:, 3])
    df = spark.createDataFrame(pdf).repartition(4)
    nodes = fit_multi_forest(df, [f"f{i}" for i in range(26)], ["y", "z"], "id", trees=40, depth=9)
    assert len({nd.tree for nd in nodes}) == 40
    s = trees.score_forest(df, nodes, [f"f{i}" for i in range(26)], ["py", "pz"]).toPandas()
    assert 1 - ((s.pz - s.z) ** 2).sum() / ((s.z - s.z.mean()) ** 2).sum() > 0.8
