"""Queries: regression and classification evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from myosig import adapters
from myosig.operators import evaluation as ev
from myosig.plans.registry import query, r6
from myosig.session import table

PAIRS = {"price": ("y_price", "p_price"), "tax": ("y_tax", "p_tax")}

LONG_SQL = """lg AS (
  SELECT l_returnflag || l_linestatus AS activity, 'price' AS target, l_extendedprice AS y, l_quantity * 1500.0 AS p FROM lineitem
  UNION ALL
  SELECT l_returnflag || l_linestatus, 'tax', l_tax, l_discount * 0.8 FROM lineitem)"""

TARGET_STATS_SQL = """ts AS (SELECT {by} target, count(*) AS n, sum((y - p) * (y - p)) AS sse, sum(abs(y - p)) AS sae,
                  max(abs(y - p)) AS max_err, var_pop(y) * count(*) AS sst FROM lg GROUP BY {by} target),
tm AS (SELECT {by} target, n, CASE WHEN n <= 1 THEN NULL WHEN sst = 0 THEN CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END
                                  ELSE 1 - sse / sst END AS r2, sse / n AS mse, sae / n AS mae, max_err FROM ts)"""


def r4(c):
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double") * F.lit(1e4)) / F.lit(1e4)


def _long(spark, sf_dir):
    return ev.long_pairs(adapters.preds(spark, sf_dir), PAIRS, keep=["activity"])


@query(
    "regression_metrics",
    ["EVL-01"],
    sql=f"""
WITH {LONG_SQL}, {TARGET_STATS_SQL.format(by='')}
SELECT max(n) AS n, round(avg(r2), 6) AS r2, round(avg(mse), 6) AS mse, round(sqrt(avg(mse)), 6) AS rmse,
       round(avg(mae), 6) AS mae FROM tm
""",
)
def q_regression(spark, sf_dir):
    m = ev.regression_metrics(_long(spark, sf_dir))
    return m.select("n", *[r6(c).alias(c) for c in ["r2", "mse", "rmse", "mae"]])


@query(
    "metrics_rollup",
    ["AGG-26", "EVL-02"],
    sql=f"""
WITH {LONG_SQL}, {TARGET_STATS_SQL.format(by='activity,')},
all_ts AS (SELECT target, count(*) AS n, sum((y - p) * (y - p)) AS sse, sum(abs(y - p)) AS sae, var_pop(y) * count(*) AS sst
           FROM lg GROUP BY target),
all_tm AS (SELECT NULL::VARCHAR AS activity, target, n, CASE WHEN n <= 1 THEN NULL WHEN sst = 0 THEN CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END
                                  ELSE 1 - sse / sst END AS r2, sse / n AS mse, sae / n AS mae FROM all_ts),
u AS (SELECT activity, false AS is_total, target, n, r2, mse, mae FROM tm UNION ALL
      SELECT activity, true, target, n, r2, mse, mae FROM all_tm)
SELECT activity, is_total, max(n) AS n, round(avg(r2), 6) AS r2, round(avg(mse), 6) AS mse, round(sqrt(avg(mse)), 6) AS rmse,
       round(avg(mae), 6) AS mae FROM u GROUP BY activity, is_total
""",
)
def q_rollup(spark, sf_dir):
    m = ev.metrics_rollup(_long(spark, sf_dir), "activity")
    return m.select("activity", "is_total", "n", *[r6(c).alias(c) for c in ["r2", "mse", "rmse", "mae"]])


@query(
    "metrics_by_target",
    ["EVL-03"],
    sql=f"""
WITH {LONG_SQL}, {TARGET_STATS_SQL.format(by='activity,')}
SELECT activity, target, n, round(r2, 4) AS r2, round(sqrt(mse), 4) AS rmse FROM tm
""",
)
def q_by_target(spark, sf_dir):
    m = ev.metrics_by_target(_long(spark, sf_dir), ["activity"])
    return m.select("activity", "target", "n", r4("r2").alias("r2"), r4("rmse").alias("rmse"))


@query(
    "metrics_by_joint",
    ["EVL-04"],
    sql=f"""
WITH {LONG_SQL}, {TARGET_STATS_SQL.format(by='')}
SELECT target, n, round(r2, 6) AS r2, round(mse, 6) AS mse, round(sqrt(mse), 6) AS rmse, round(mae, 6) AS mae FROM tm
""",
)
def q_by_joint(spark, sf_dir):
    m = ev.metrics_by_target(_long(spark, sf_dir))
    return m.select("target", "n", *[r6(c).alias(c) for c in ["r2", "mse", "rmse", "mae"]])


@query(
    "joint_error",
    ["EVL-09"],
    sql=f"WITH {LONG_SQL}\nSELECT target, round(avg(abs(y - p)), 6) AS mae, round(max(abs(y - p)), 6) AS max_err FROM lg GROUP BY target",
)
def q_joint_error(spark, sf_dir):
    j = ev.joint_error(_long(spark, sf_dir))
    return j.select("target", r6("mae").alias("mae"), r6("max_err").alias("max_err"))


# --------------------------------------------------------------------- classification
CLS_SQL = """c AS (SELECT l_returnflag AS truth,
                  CASE WHEN l_tax = 0 THEN 'X' WHEN l_quantity > 25 THEN 'N' WHEN l_discount > 0.05 THEN 'A' ELSE 'R' END AS pred,
                  l_suppkey % 6 AS fold FROM lineitem)"""


def _cls(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    pred = (
        F.when(F.col("l_tax") == 0, "X").when(F.col("l_quantity") > 25, "N").when(F.col("l_discount") > 0.05, "A").otherwise("R")
    )
    return li.select(F.col("l_returnflag").alias("truth"), pred.alias("pred"), (F.col("l_suppkey") % 6).alias("fold"))


@query(
    "accuracy",
    ["EVL-05"],
    sql="SELECT count(*) AS n, round(avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM labels",
)
def q_accuracy(spark, sf_dir):
    a = ev.accuracy(table(spark, sf_dir, "labels"), "quality", "toxic")
    return a.select("n", r6("accuracy").alias("accuracy"))


@query(
    "confusion_matrix",
    ["EVL-07"],
    sql=f"""
WITH {CLS_SQL}, l AS (SELECT truth AS v FROM c UNION SELECT pred FROM c),
g AS (SELECT a.v AS truth, b.v AS pred FROM l a, l b),
k AS (SELECT truth, pred, count(*) AS n FROM c GROUP BY ALL)
SELECT g.truth, g.pred, coalesce(k.n, 0) AS n FROM g LEFT JOIN k USING (truth, pred)
""",
)
def q_confusion(spark, sf_dir):
    return ev.confusion_matrix(_cls(spark, sf_dir), "truth", "pred")


@query(
    "classification_report",
    ["EVL-06"],
    sql=f"""
WITH {CLS_SQL}, k AS (SELECT truth, pred, count(*) AS n FROM c GROUP BY ALL),
l AS (SELECT truth AS cls FROM k UNION SELECT pred FROM k),
per AS (SELECT l.cls,
               coalesce((SELECT sum(n) FROM k WHERE k.truth = l.cls), 0) AS support,
               coalesce((SELECT sum(n) FROM k WHERE k.pred = l.cls), 0) AS predicted,
               coalesce((SELECT sum(n) FROM k WHERE k.truth = l.cls AND k.pred = l.cls), 0) AS tp FROM l),
pr AS (SELECT cls, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, support, tp FROM per),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM pr)
SELECT cls, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
                 round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f
""",
)
def q_report(spark, sf_dir):
    r = ev.classification_report(_cls(spark, sf_dir), "truth", "pred")
    return r.select("cls", *[r6(c).alias(c) for c in ["precision", "recall", "f1"]], "support")


@query(
    "fold_report",
    ["EVL-08", "ML-15"],
    sql=f"""
WITH {CLS_SQL}, per AS (SELECT fold, count(*) AS n, avg(CASE WHEN truth = pred THEN 1.0 ELSE 0.0 END) AS accuracy FROM c GROUP BY fold)
SELECT fold, n, round(accuracy, 6) AS accuracy, false AS is_mean FROM per
UNION ALL SELECT NULL, CAST(sum(n) AS BIGINT), round(avg(accuracy), 6), true FROM per
""",
)
def q_fold_report(spark, sf_dir):
    r = ev.fold_report(_cls(spark, sf_dir), "fold", "truth", "pred")
    return r.select("fold", F.col("n").cast("bigint").alias("n"), r6("accuracy").alias("accuracy"), "is_mean")
