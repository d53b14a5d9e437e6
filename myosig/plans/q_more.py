"""Queries: cardinality, ordering helpers, exact-n sampling, round trips through storage,
activity-then-angle scoring, and the remaining model fits (rows-only)."""

from __future__ import annotations

import json
import os

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from myosig import adapters
from myosig.functions import features as ft
from myosig.models import fit, linear, stacked, trees
from myosig.operators import evaluation as ev
from myosig.operators import profile as pf
from myosig.operators import splits as sp
from myosig.operators.index import with_row_index
from myosig.operators.windows import sliding_windows
from myosig.plans.q_fit import WIN_FEATURES, window_features
from myosig.plans.q_models import _golden_sql, q_golden
from myosig.plans.q_windows import SIG_SQL
from myosig.plans.registry import query, r6, sql_index, sql_window_ids
from myosig.sources import io
from myosig.streaming.feed import scratch_folder

H = "md5(CAST({c} AS VARCHAR) || ':{seed}')"
CH = adapters.REPS_CHANNELS


@query(
    "cardinality",
    ["AGG-25"],
    sql="SELECT count(DISTINCT user_id) AS n_subject, count(DISTINCT event_type) AS n_activity FROM events",
)
def q_cardinality(spark, sf_dir):
    return pf.cardinality(adapters.signal(spark, sf_dir), ["subject", "activity"])


@query(
    "best_rep",
    ["SRT-04", "SRT-01"],
    sql="""
WITH c AS (SELECT l_returnflag || l_linestatus AS activity, l_linenumber AS reps, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT activity, arg_max(reps, n * 100 - reps) AS best_rep, max(n) AS n FROM c GROUP BY activity
""",
)
def q_best_rep(spark, sf_dir):
    r = adapters.reps(spark, sf_dir)
    c = r.groupBy("activity", "reps").agg(F.count(F.lit(1)).alias("n"))
    return c.groupBy("activity").agg(sp.best_of("reps", "n", "reps").alias("best_rep"), F.max("n").alias("n"))


@query(
    "sorted_distinct",
    ["SRT-01"],
    sql="SELECT DISTINCT l_returnflag || l_linestatus AS activity FROM lineitem",
)
def q_sorted_distinct(spark, sf_dir):
    return sp.sorted_distinct(adapters.reps(spark, sf_dir), "activity")


@query(
    "sample_n",
    ["SPL-08"],
    sql=f"SELECT o_orderkey FROM orders ORDER BY {H.format(c='o_orderkey', seed=5)}, o_orderkey LIMIT 100",
)
def q_sample_n(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    return sp.sample_n(o, 100, "o_orderkey", seed=5)


@query(
    "sample_rows",
    ["SPL-08"],
    sql=f"""
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE substr(md5(l_orderkey || '-' || l_linenumber || ':1'), 1, 8) < '{int(0.2 * 2**32):08x}'
""",
)
def q_sample_rows(spark, sf_dir):
    """Bernoulli sample: the sampling itself is the feature."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    return sp.sample_rows(li, 0.2, F.concat_ws("-", "l_orderkey", "l_linenumber"), seed=1)


@query(
    "take_windows",
    ["SPL-09", "SRT-07"],
    sql=f"""
WITH {SIG_SQL},
ix AS (SELECT *, {sql_index('activity, subject, ts, event_id')} AS idx, count(*) OVER () AS n_rows FROM sig),
m AS (SELECT *, unnest({sql_window_ids(8, 4)}) AS window_id FROM ix)
SELECT window_id, round(avg(x), 6) AS mean_x FROM m WHERE window_id < 50 GROUP BY window_id
""",
)
def q_take_windows(spark, sf_dir):
    ix = with_row_index(adapters.signal(spark, sf_dir), adapters.SIGNAL_ORDER, count_name="n_rows")
    w = sliding_windows(ix, 8, 4, aggs={"mean_x": ft.mean("x")})
    return sp.take_windows(w, 50).select("window_id", r6("mean_x").alias("mean_x"))


# --------------------------------------------------------------------- storage round trips
#: Folders of the feature store, whatever the number of subjects.
SUBJECT_FOLDERS = 64


@query(
    "feature_store_roundtrip",
    ["SRC-02", "SRC-03"],
    sql=f"""
WITH {SIG_SQL},
ix AS (SELECT *, {sql_index('ts, event_id', 'subject')} AS idx, count(*) OVER (PARTITION BY subject) AS n_rows FROM sig),
m AS (SELECT *, unnest({sql_window_ids(8, 4)}) AS window_id FROM ix)
SELECT subject, window_id, round(avg(abs(x)), 6) AS mav, round(avg(gait), 6) AS gait_target FROM m GROUP BY subject, window_id
""",
)
def q_feature_store(spark, sf_dir):
    ix = with_row_index(adapters.signal(spark, sf_dir), adapters.SUBJECT_ORDER, series=["subject"], count_name="n_rows")
    w = sliding_windows(ix, 8, 4, series=["subject"], aggs={"mav": ft.mav("x"), "gait_target": ft.target_mean("gait")})
    base = scratch_folder(spark, "feature_store")
    io.write_features(w, os.path.join(base, "features"), partition_by=["subject"], order=["window_id"], folders=SUBJECT_FOLDERS)
    io.write_schema_artifacts(os.path.join(base, "schema"), ["mav"], ["gait_target"], spark=spark)
    back = io.read_subjects(spark, os.path.join(base, "features"))
    return back.select(F.col("subject").cast("bigint").alias("subject"), "window_id", r6("mav").alias("mav"), r6("gait_target").alias("gait_target"))


@query("golden_roundtrip", ["SRC-08", "SRC-09"], sql=_golden_sql().replace("SELECT window_id, [", "SELECT ["))
def q_golden_roundtrip(spark, sf_dir):
    g = q_golden(spark, sf_dir).orderBy("window_id").drop("window_id")
    rows = [r.asDict() for r in g.collect()]  # at most 5 vectors: the artefact is a small JSON file
    path = os.path.join(scratch_folder(spark, "golden"), "vectors.json")
    io.write_text(spark, path, json.dumps(rows, indent=2))
    return io.read_golden(spark, path)


# --------------------------------------------------------------------- ML-25
@query(
    "activity_then_angle",
    ["ML-25", "ML-20", "ML-11"],
    sql=f"""
WITH cls AS (SELECT l_quantity, l_extendedprice,
                    CASE WHEN l_extendedprice <= 35000.0 THEN (CASE WHEN l_tax <= 0.03 THEN 0 ELSE 1 END)
                         ELSE (CASE WHEN l_quantity <= 30.5 THEN 2 ELSE 1 END) END AS act FROM lineitem),
m AS (SELECT act, avg(l_quantity) AS mx, avg(l_extendedprice) AS my FROM cls GROUP BY act),
s AS (SELECT c.act, m.mx, m.my, sum((c.l_quantity - m.mx) * (c.l_quantity - m.mx)) AS sxx,
             sum((c.l_quantity - m.mx) * (c.l_extendedprice - m.my)) AS sxy FROM cls c JOIN m USING (act) GROUP BY ALL),
md AS (SELECT act, sxy / (sxx + 1.0) AS coef, my - sxy / (sxx + 1.0) * mx AS intercept FROM s)
SELECT c.act, count(*) AS n, round(avg(md.intercept + md.coef * c.l_quantity), 6) AS mean_angle,
       round(avg(abs(c.l_extendedprice - (md.intercept + md.coef * c.l_quantity))), 6) AS mae
FROM cls c JOIN md USING (act) GROUP BY c.act
""",
)
def q_activity_then_angle(spark, sf_dir):
    li = adapters.reps(spark, sf_dir)
    act = trees.forest_expr(trees.demo_class_tree(), CH, 1)[0].cast("int")
    d = li.withColumn("act", act)
    models = linear.fit_ridge_by_group(d, "act", "l_quantity", "l_extendedprice", alpha=1.0)
    p = linear.activity_then_angle(li, act, models, "act", "l_quantity")
    return p.groupBy("act").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("angle")).alias("mean_angle"),
        r6(F.avg(F.abs(F.col("l_extendedprice") - F.col("angle")))).alias("mae"),
    )


# --------------------------------------------------------------------- remaining fits (rows-only)
def _cls_windows(spark, sf_dir):
    w = window_features(spark, sf_dir)
    mapping = sp.label_map(w, "activity")
    return sp.encode_labels(w, mapping, "activity", out="label").withColumn("label", F.col("label").cast("double"))


@query("pca_variance", ["ML-02"])
def q_pca(spark, sf_dir):
    w = window_features(spark, sf_dir)
    res, k = fit.pca_variance(w, WIN_FEATURES, 0.99)
    return res.select("window_id", F.lit(k).alias("n_components"), vector_to_array("pca")[0].alias("pc1"))


@query("forest_classifier", ["ML-04"])
def q_forest_classifier(spark, sf_dir):
    w = _cls_windows(spark, sf_dir)
    m = fit.fit_forest_classifier(w.where(F.col("split") == sp.TRAIN), WIN_FEATURES, "label")
    p = m.transform(fit.assemble(w, WIN_FEATURES))
    return p.select("window_id", "split", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"))


@query("logistic_fit", ["ML-06"])
def q_logistic(spark, sf_dir):
    w = _cls_windows(spark, sf_dir)
    m = fit.fit_logistic(w.where(F.col("split") == sp.TRAIN), WIN_FEATURES, "label", C=1.0)
    p = m.transform(fit.assemble(w, WIN_FEATURES))
    return p.select("window_id", "split", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"))


@query("boosted_models", ["ML-09", "ML-10"])
def q_boosted(spark, sf_dir):
    w = _cls_windows(spark, sf_dir)
    train = w.where(F.col("split") == sp.TRAIN)
    c, r = fit.fit_boosted_models(train, WIN_FEATURES, "label", "gait_target")
    p = r.setPredictionCol("gait_pred").transform(c.transform(fit.assemble(w, WIN_FEATURES)))
    return p.select("window_id", "split", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"), "gait_target", "gait_pred")


#: Passes over the windows that a machine may take.
KERNEL_PASSES = 60


@query("kernel_models", ["ML-07", "ML-08"])
def q_kernel(spark, sf_dir):
    """RBF machines on landmarks; the duality gaps and the kernel's residual come with the predictions."""
    w = _cls_windows(spark, sf_dir).checkpoint()
    train = w.where(F.col("split") == sp.TRAIN)
    svm = stacked.fit_machine(train, WIN_FEATURES, "label", "pairs", C=1.0, gamma="scale", landmarks=96, passes=KERNEL_PASSES)
    svr = stacked.fit_machine(train, WIN_FEATURES, "gait_target", "tube", C=10.0, gamma="scale", epsilon=0.1, landmarks=96, passes=KERNEL_PASSES)
    p = svr.predict(svm.predict(w, WIN_FEATURES), WIN_FEATURES, "gait_pred")
    return p.select(
        "window_id", "split", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"), "gait_target", "gait_pred",
        F.lit(svm.gap).alias("svm_gap"), F.lit(svr.gap).alias("svr_gap"), F.lit(max(svm.residual, svr.residual)).alias("residual"),
    )


_CVP = """
WITH r AS (SELECT l_quantity AS x, l_extendedprice AS y, l_suppkey % 6 AS subject FROM lineitem),
f AS (SELECT DISTINCT subject AS fold FROM r),
m AS (SELECT fold, avg(x) AS mx, avg(y) AS my FROM f JOIN r ON r.subject <> f.fold GROUP BY fold),
s AS (SELECT fold, mx, my, sum((x - mx) * (x - mx)) AS sxx, sum((x - mx) * (y - my)) AS sxy FROM m JOIN r ON r.subject <> m.fold GROUP BY ALL),
md AS (SELECT fold, sxy / (sxx + 1.0) AS w, my - sxy / (sxx + 1.0) * mx AS b FROM s),
p AS (SELECT r.subject, y, b + w * x AS p, avg(y) OVER (PARTITION BY r.subject) AS ym FROM r JOIN md ON md.fold = r.subject)
SELECT subject, count(*) AS n, round(1 - sum((y - p) * (y - p)) / sum((y - ym) * (y - ym)), 6) AS r2, round(avg(abs(y - p)), 6) AS mae
FROM p GROUP BY subject
"""


@query("cross_val_predict", ["ML-16", "ML-15"], sql=_CVP)
def q_cvp(spark, sf_dir):
    li = adapters.reps(spark, sf_dir)

    def fit_fn(d):
        return linear.fit_ridge(d, ["l_quantity"], ["l_extendedprice"], alpha=1.0)

    def pred_fn(m, d):
        return m.predict(d).select("subject", "l_extendedprice", "l_extendedprice_pred")

    oof = fit.cross_val_predict(li, "subject", fit_fn, pred_fn)
    long = ev.long_pairs(oof, {"price": ("l_extendedprice", "l_extendedprice_pred")}, keep=["subject"])
    return ev.metrics_by_target(long, ["subject"]).select("subject", "n", r6("r2").alias("r2"), r6("mae").alias("mae"))
