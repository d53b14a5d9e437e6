"""Queries: closed-form fits, kNN, and scoring of tree / linear / MLP models."""

from __future__ import annotations

from pyspark.sql import functions as F

from myosig import adapters
from myosig.functions import features as ft
from myosig.models import knn, linear, trees
from myosig.operators import scaling as sc
from myosig.operators import splits as sp
from myosig.operators.index import with_row_index
from myosig.operators.windows import sliding_windows
from myosig.plans.q_sequence import control_tree
from myosig.plans.q_windows import GLOBAL_ORDER, SIG_SQL, indexed_signal
from myosig.plans.registry import query, r6, sql_index, sql_window_ids
from myosig.session import table

CH = adapters.REPS_CHANNELS


# --------------------------------------------------------------------- ML-11
@query(
    "ridge_one_feature",
    ["ML-11"],
    sql="""
WITH m AS (SELECT avg(l_quantity) AS mx, avg(l_extendedprice) AS my1, avg(l_tax) AS my2 FROM lineitem),
s AS (SELECT sum((l_quantity - mx) * (l_quantity - mx)) AS sxx, sum((l_quantity - mx) * (l_extendedprice - my1)) AS sxy1,
             sum((l_quantity - mx) * (l_tax - my2)) AS sxy2 FROM lineitem, m)
SELECT 'l_extendedprice' AS target, round(my1 - sxy1 / (sxx + 1.0) * mx, 6) AS intercept, round(sxy1 / (sxx + 1.0), 6) AS coef FROM s, m
UNION ALL
SELECT 'l_tax', round(my2 - sxy2 / (sxx + 1.0) * mx, 6), round(sxy2 / (sxx + 1.0), 6) FROM s, m
""",
)
def q_ridge(spark, sf_dir):
    li = adapters.reps(spark, sf_dir)
    model = linear.fit_ridge(li, ["l_quantity"], ["l_extendedprice", "l_tax"], alpha=1.0)
    f = model.to_frame(spark)
    return f.select("target", r6("intercept").alias("intercept"), r6(F.col("coef")[0]).alias("coef"))


@query(
    "ridge_predict",
    ["ML-11", "EVL-09"],
    sql="""
WITH m AS (SELECT avg(l_quantity) AS mx, avg(l_extendedprice) AS my FROM lineitem),
s AS (SELECT sum((l_quantity - mx) * (l_quantity - mx)) AS sxx, sum((l_quantity - mx) * (l_extendedprice - my)) AS sxy
      FROM lineitem, m),
p AS (SELECT l_returnflag || l_linestatus AS activity, l_extendedprice AS y,
             (my - sxy / (sxx + 10.0) * mx) + sxy / (sxx + 10.0) * l_quantity AS yhat FROM lineitem, s, m)
SELECT activity, round(avg(abs(y - yhat)), 6) AS mae, round(max(abs(y - yhat)), 6) AS max_err FROM p GROUP BY activity
""",
)
def q_ridge_predict(spark, sf_dir):
    li = adapters.reps(spark, sf_dir)
    model = linear.fit_ridge(li, ["l_quantity"], ["l_extendedprice"], alpha=10.0)
    p = model.predict(li)
    e = F.abs(F.col("l_extendedprice") - F.col("l_extendedprice_pred"))
    return p.groupBy("activity").agg(r6(F.avg(e)).alias("mae"), r6(F.max(e)).alias("max_err"))


# --------------------------------------------------------------------- ML-05
@query(
    "lda_one_feature",
    ["ML-05"],
    sql="""
WITH c AS (SELECT l_returnflag AS cls, count(*) AS n, avg(l_extendedprice) AS mu FROM lineitem GROUP BY 1),
t AS (SELECT sum(n) AS total FROM c),
v AS (SELECT sum((l.l_extendedprice - c.mu) * (l.l_extendedprice - c.mu)) / (SELECT total FROM t) AS var
      FROM lineitem l JOIN c ON l.l_returnflag = c.cls)
SELECT cls AS class, n, round(n / total, 6) AS prior, round(mu, 6) AS mean, round(mu / var, 6) AS coef,
       round(-0.5 * (mu / var) * mu + ln(n / total), 6) AS intercept
FROM c, t, v
""",
)
def q_lda(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_extendedprice", "l_returnflag")
    m = linear.fit_lda(li, ["l_extendedprice"], "l_returnflag")
    f = m.to_frame(spark)
    return f.select(
        "class", "n", r6("prior").alias("prior"), r6(F.col("mean")[0]).alias("mean"), r6(F.col("coef")[0]).alias("coef"),
        r6("intercept").alias("intercept"),
    )


# --------------------------------------------------------------------- JOI-05 / SRT-03 / ML-12
def _emb_split(spark, sf_dir):
    e = with_row_index(adapters.grid(spark, sf_dir), ["idx"], name="pos", count_name="n_rows")
    e = sp.split_sequential(e, 0.8, idx="pos")
    return e.select(F.col("idx").alias("vec_id"), F.col("emg_ta").alias("vec"), "label", "split")


_VOTES = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label, row_number() OVER (ORDER BY vec_id) - 1 AS pos,
                  count(*) OVER () AS n FROM embeddings),
tr AS (SELECT * FROM e WHERE pos < floor(n * 0.8)), te AS (SELECT * FROM e WHERE pos >= floor(n * 0.8)),
d AS (SELECT te.vec_id AS test_id, te.label AS truth, tr.vec_id AS train_id, tr.label, list_distance(te.v, tr.v) AS dist FROM te, tr),
r AS (SELECT *, row_number() OVER (PARTITION BY test_id ORDER BY dist, train_id) AS rk FROM d),
v AS (SELECT test_id, truth, kk.k, label, count(*) AS c FROM r JOIN (VALUES (3), (5), (7)) kk(k) ON r.rk <= kk.k GROUP BY ALL),
p AS (SELECT test_id, truth, k, label AS pred FROM (
  SELECT *, row_number() OVER (PARTITION BY test_id, k ORDER BY c DESC, label) AS q FROM v) WHERE q = 1)
"""


def _knn_votes(spark, sf_dir):
    e = _emb_split(spark, sf_dir)
    test = e.where(F.col("split") == sp.TEST).withColumnRenamed("vec_id", "test_id")
    train = e.where(F.col("split") == sp.TRAIN).withColumnRenamed("vec_id", "train_id")
    return test, knn.knn_vote(knn.knn_topk(test, train, 7, vec="vec", label="label"), [3, 5, 7])


@query("knn_vote", ["JOI-05", "SRT-03", "ML-12"], sql=_VOTES + "SELECT test_id, k, pred FROM p")
def q_knn(spark, sf_dir):
    _, v = _knn_votes(spark, sf_dir)
    return v.select("test_id", F.col("k").cast("int").alias("k"), "pred")


@query("knn_best_k", ["ML-12"], sql=_VOTES + "SELECT k, round(avg(CAST(pred = truth AS DOUBLE)), 6) AS accuracy FROM p GROUP BY k")
def q_knn_best(spark, sf_dir):
    test, v = _knn_votes(spark, sf_dir)
    scored = v.join(test.select("test_id", F.col("label").alias("truth")), "test_id")
    return knn.best_k(scored, "truth").select(F.col("k").cast("int").alias("k"), r6("accuracy").alias("accuracy"))


# --------------------------------------------------------------------- ML-19 / JOI-09
def tree_walk_sql(nodes, n_out: int, feature_sql: list[str], keys: list[str], table: str, pred: str = "pred") -> str:
    """Recursive-CTE oracle: walk each row down every tree, average the leaf vectors."""
    feat_case = "CASE n.feature " + " ".join(f"WHEN {i} THEN r.f{i}" for i in range(len(feature_sql))) + " END"
    outs = ", ".join(f"round(avg(n.v{o}), 6) AS {pred}_{o}" for o in range(n_out))
    vcols = ", ".join(f"v{o}" for o in range(n_out))
    return f"""
WITH RECURSIVE nodes(tree, node, feature, threshold, lft, rgt, {vcols}) AS (VALUES
{trees.nodes_values_sql(nodes, n_out)}),
rw AS (SELECT row_number() OVER () AS rid, {", ".join(keys)}, {", ".join(f"{e} AS f{i}" for i, e in enumerate(feature_sql))} FROM {table}),
walk(rid, tree, node) AS (
  SELECT rid, t.tree, 0 FROM rw, (SELECT DISTINCT tree FROM nodes) t
  UNION ALL
  SELECT w.rid, w.tree, CASE WHEN ({feat_case}) <= n.threshold THEN n.lft ELSE n.rgt END
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node JOIN rw r ON r.rid = w.rid
  WHERE n.feature <> -2)
SELECT {", ".join("r." + k for k in keys)}, {outs}
FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node AND n.feature = -2 JOIN rw r ON r.rid = w.rid
GROUP BY r.rid, {", ".join("r." + k for k in keys)}"""


@query(
    "score_forest",
    ["ML-19", "JOI-09"],
    sql=tree_walk_sql(trees.demo_forest(2), 2, CH, ["l_orderkey", "l_linenumber"], "lineitem"),
)
def q_score_forest(spark, sf_dir):
    li = adapters.reps(spark, sf_dir).select("l_orderkey", "l_linenumber", *CH)
    s = trees.score_forest(li, trees.demo_forest(2), CH, ["p0", "p1"])
    return s.select("l_orderkey", "l_linenumber", r6("p0").alias("pred_0"), r6("p1").alias("pred_1"))


@query(
    "score_tree_class",
    ["ML-20"],
    sql=tree_walk_sql(trees.demo_class_tree(), 1, CH, ["l_orderkey", "l_linenumber"], "lineitem", pred="cls").replace(
        "round(avg(n.v0), 6) AS cls_0", "CAST(max(n.v0) AS INT) AS pred_class"
    ),
)
def q_score_tree_class(spark, sf_dir):
    li = adapters.reps(spark, sf_dir).select("l_orderkey", "l_linenumber", *CH)
    return trees.score_tree_class(li, trees.demo_class_tree(), CH).select("l_orderkey", "l_linenumber", "pred_class")


@query(
    "parity_check",
    ["ML-24", "ML-19"],
    sql="SELECT l_returnflag || l_linestatus AS activity, count(*) AS n, count(*) AS n_pass FROM lineitem GROUP BY 1",
)
def q_parity(spark, sf_dir):
    li = adapters.reps(spark, sf_dir).select("activity", *CH)
    nodes = trees.demo_forest(2)
    e0, e1 = trees.forest_expr(nodes, CH, 2)
    s = trees.score_forest(li.withColumn("e0", e0).withColumn("e1", e1), nodes, CH, ["p0", "p1"])
    ok = trees.parity([F.col("p0"), F.col("p1")], [F.col("e0"), F.col("e1")], tol=1e-3)
    return s.groupBy("activity").agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).cast("bigint").alias("n_pass"))


# --------------------------------------------------------------------- ML-21 / ML-22 with ML-01
LIN_COEF = [[1.0, -1.0, 0.5, 0.0], [0.0, 1.0, -1.0, 0.5], [-1.0, 0.0, 0.5, 1.0]]
LIN_B = [0.1, 0.0, -0.1]
MLP = [
    ([[0.5, -0.2, 0.1, 0.3], [-0.4, 0.6, 0.2, -0.1], [0.3, 0.3, -0.5, 0.2]], [0.1, -0.1, 0.05]),
    ([[1.0, -0.5, 0.25], [-0.3, 0.8, 0.6]], [0.2, -0.2]),
]
SCALER_SQL = "p AS (SELECT " + ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(CH)) + " FROM lineitem)"
Z_SQL = ", ".join(f"({c} - m{i}) / CASE WHEN s{i} > 0 THEN s{i} ELSE 1 END AS z{i}" for i, c in enumerate(CH))


def _dot_sql(xs: list[str], w: list[float], b: float) -> str:
    acc = "0.0"
    for x, wv in zip(xs, w):
        acc = f"({acc} + {x} * {wv!r})"
    return f"({acc} + {b!r})"


def _scaled(spark, sf_dir):
    li = adapters.reps(spark, sf_dir)
    params = sc.fit_scaler(li, CH)
    mean = [params[c][0] for c in CH]
    scale = [params[c][1] for c in CH]
    return li.withColumn("z", linear.scale_array(F.array(*CH), mean, scale))


@query(
    "score_linear",
    ["ML-21", "ML-01", "SRT-05"],
    sql=f"""
WITH {SCALER_SQL}, z AS (SELECT l_orderkey, l_linenumber, {Z_SQL} FROM lineitem, p),
s AS (SELECT l_orderkey, l_linenumber, {", ".join(f"{_dot_sql(['z0', 'z1', 'z2', 'z3'], w, b)} AS s{k}" for k, (w, b) in enumerate(zip(LIN_COEF, LIN_B)))} FROM z)
SELECT l_orderkey, l_linenumber, CASE WHEN s0 >= s1 AND s0 >= s2 THEN 0 WHEN s1 >= s2 THEN 1 ELSE 2 END AS pred,
       round(greatest(s0, s1, s2), 6) AS score
FROM s
""",
)
def q_score_linear(spark, sf_dir):
    z = _scaled(spark, sf_dir).withColumn("scores", linear.linear_scores(F.col("z"), LIN_COEF, LIN_B))
    return z.select(
        "l_orderkey", "l_linenumber", sp.argmax_class("scores").alias("pred"), r6(F.array_max("scores")).alias("score")
    )


def _mlp_sql() -> str:
    (w1, b1), (w2, b2) = MLP
    hidden = [f"greatest({_dot_sql(['z0', 'z1', 'z2', 'z3'], w, b)}, 0.0) AS h{k}" for k, (w, b) in enumerate(zip(w1, b1))]
    outs = [f"round({_dot_sql(['h0', 'h1', 'h2'], w, b)}, 6) AS out_{k}" for k, (w, b) in enumerate(zip(w2, b2))]
    return f"""
WITH {SCALER_SQL}, z AS (SELECT l_orderkey, l_linenumber, {Z_SQL} FROM lineitem, p),
h AS (SELECT l_orderkey, l_linenumber, {", ".join(hidden)} FROM z)
SELECT l_orderkey, l_linenumber, {", ".join(outs)} FROM h"""


@query("score_mlp", ["ML-22", "ML-01"], sql=_mlp_sql())
def q_score_mlp(spark, sf_dir):
    z = _scaled(spark, sf_dir).withColumn("out", linear.mlp_forward(F.col("z"), MLP))
    return z.select("l_orderkey", "l_linenumber", r6(F.col("out")[0]).alias("out_0"), r6(F.col("out")[1]).alias("out_1"))


# --------------------------------------------------------------------- SRC-08
def _golden_sql() -> str:
    nodes = control_tree()
    p0 = trees.forest_sql(nodes, ["mav", "gait_mean"], 0)
    p1 = trees.forest_sql(nodes, ["mav", "gait_mean"], 1)
    return f"""
WITH {SIG_SQL},
ix AS (SELECT *, {sql_index(GLOBAL_ORDER)} AS idx, count(*) OVER () AS n_rows FROM sig),
m AS (SELECT *, unnest({sql_window_ids(8, 4)}) AS window_id FROM ix),
w AS (SELECT window_id, avg(abs(x)) AS mav, avg(gait) AS gait_mean, max_by(gait, idx) AS gait_last FROM m GROUP BY window_id
      HAVING min(activity) = max(activity) AND min(reps) = max(reps) ORDER BY window_id LIMIT 5)
SELECT window_id, [round(mav, 6), round(gait_mean, 6)] AS features, [round(gait_last, 6)] AS true_values,
       [round({p0}, 6), round({p1}, 6)] AS pred_values
FROM w"""


@query("golden_vectors", ["SRC-08", "ML-19"], sql=_golden_sql())
def q_golden(spark, sf_dir):
    ix = indexed_signal(spark, sf_dir)
    w = sliding_windows(
        ix, 8, 4, purity=["activity", "reps"],
        aggs={"mav": ft.mav("x"), "gait_mean": ft.mean("gait"), "gait_last": ft.last_value("gait")},
    )
    p0, p1 = trees.forest_expr(control_tree(), ["mav", "gait_mean"], 2)
    first = w.orderBy("window_id").limit(5)  # the feature: the first n windows
    return first.select(
        "window_id",
        F.array(r6("mav"), r6("gait_mean")).alias("features"),
        F.array(r6("gait_last")).alias("true_values"),
        F.array(r6(p0), r6(p1)).alias("pred_values"),
    )
