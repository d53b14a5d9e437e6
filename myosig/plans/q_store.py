"""Queries: artefacts written and read back, and operators that no other query calls."""

from __future__ import annotations

import os

from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import functions as F

from myosig import adapters
from myosig.channels import ChannelRegistry, select_sensors
from myosig.functions import features as ft
from myosig.functions import messages as msg
from myosig.models import fit, trees
from myosig.operators import cleaning as cl
from myosig.operators import evaluation as ev
from myosig.operators import splits as sp
from myosig.operators.index import with_row_index
from myosig.operators.windows import end_time, sliding_windows
from myosig.plans.q_eval import LONG_SQL, TARGET_STATS_SQL, _long
from myosig.plans.q_fit import WIN_FEATURES, window_features
from myosig.plans.q_models import CH, tree_walk_sql
from myosig.plans.q_sequence import _control_sql, q_control_replay
from myosig.plans.q_splits import H, REP_SPLIT_SQL, REPS_SQL
from myosig.plans.q_windows import GLOBAL_ORDER, SIG_SQL, indexed_signal
from myosig.plans.registry import query, r6, sql_index, sql_window_ids
from myosig.sources import io
from myosig.streaming.feed import scratch_folder


def _folder(spark, name, *parts):
    return os.path.join(scratch_folder(spark, name), *parts)


@query(
    "recording_roundtrip",
    ["SRC-01", "PRJ-17"],
    sql="SELECT CAST(label AS VARCHAR) AS activity, count(*) AS n, round(avg(CAST(embedding[1] AS DOUBLE)), 6) AS first_channel FROM embeddings GROUP BY label",
)
def q_recording(spark, sf_dir):
    g = adapters.grid(spark, sf_dir).select("idx", "activity", "emg_ta")
    rec = g.select(*[(F.col(f.name) if f.name in g.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in io.SAMPLE_SCHEMA.fields])
    path = _folder(spark, "recording", "s1.parquet")
    rec.write.parquet(path)
    back = io.read_recording(spark, path)
    return back.groupBy("activity").agg(F.count("idx").alias("n"), r6(F.avg(F.col("emg_ta")[0].cast("double"))).alias("first_channel"))


@query(
    "split_store",
    ["SRC-04", "SET-01"],
    sql=f"""
WITH {REPS_SQL}, {REP_SPLIT_SQL}
SELECT r.activity, rp.split, count(*) AS n, round(sum(r.l_quantity), 6) AS quantity FROM r JOIN rp USING (activity, reps) GROUP BY ALL
""",
)
def q_split_store(spark, sf_dir):
    path = _folder(spark, "split_store", "windows")
    io.write_split(sp.split_by_reps(adapters.reps(spark, sf_dir), 0.8), path)
    parts = [spark.read.parquet(path).where(F.col("split") == s) for s in (sp.TRAIN, sp.TEST)]
    return sp.union_splits(parts).groupBy("activity", "split").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("l_quantity")).alias("quantity"))


@query(
    "split_info_store",
    ["SRC-05"],
    sql=f"""
WITH {SIG_SQL}, g AS (SELECT subject, count(*) AS rows_total FROM sig GROUP BY subject),
c AS (SELECT subject, rows_total, CAST(floor(rows_total * 0.8) AS BIGINT) AS train_end FROM g)
SELECT subject, rows_total, train_end, CASE WHEN train_end >= 8 THEN CAST(floor((train_end - 8) / 4) + 1 AS BIGINT) ELSE 0 END AS train_rows,
       CASE WHEN rows_total - train_end - 4 >= 8 THEN CAST(floor((rows_total - train_end - 12) / 4) + 1 AS BIGINT) ELSE 0 END AS test_rows
FROM c
""",
)
def q_split_info_store(spark, sf_dir):
    ix = with_row_index(adapters.signal(spark, sf_dir), adapters.SUBJECT_ORDER, series=["subject"], count_name="n_rows")
    path = _folder(spark, "split_info", "info")
    io.write_split_info(sp.split_info(ix, 0.8, 4, 8, ["subject"], step=4), path)
    return spark.read.schema("subject long, rows_total long, train_end long, train_rows long, test_rows long").json(path)


@query(
    "metrics_store",
    ["SRC-07"],
    sql=f"""
WITH {LONG_SQL}, {TARGET_STATS_SQL.format(by='activity,')}
SELECT activity, target, n, round(r2, 4) AS r2 FROM tm
""",
)
def q_metrics_store(spark, sf_dir):
    m = ev.metrics_by_target(_long(spark, sf_dir), ["activity"])
    path = _folder(spark, "metrics", "doc")
    io.write_metrics(m, path)
    doc = spark.read.schema("metrics map<string, map<string, struct<r2: double, rmse: double, n: bigint>>>").json(path)
    by = doc.select(F.explode("metrics").alias("activity", "targets")).select("activity", F.explode("targets").alias("target", "v"))
    return by.select("activity", "target", "v.n", F.round("v.r2", 4).alias("r2"))


@query("model_store", ["SRC-10", "ML-19"], sql=tree_walk_sql(trees.demo_forest(2), 2, CH, ["l_orderkey", "l_linenumber"], "lineitem"))
def q_model_store(spark, sf_dir):
    path = _folder(spark, "model", "nodes")
    io.save_table_model(trees.nodes_frame(spark, trees.demo_forest(2)), path)
    nodes = trees.collect_nodes(io.load_table_model(spark, path))
    s = trees.score_forest(adapters.reps(spark, sf_dir).select("l_orderkey", "l_linenumber", *CH), nodes, CH, ["p0", "p1"])
    return s.select("l_orderkey", "l_linenumber", r6("p0").alias("pred_0"), r6("p1").alias("pred_1"))


@query(
    "forest_table_parity",
    ["ML-18", "ML-19", "ML-24", "SRC-10"],
    sql=f"""
WITH {SIG_SQL}, n AS (SELECT count(*) AS n FROM sig)
SELECT CASE WHEN n < 8 THEN 0 ELSE CAST(floor((n - 8) / 4) + 1 AS BIGINT) END AS n_windows, CAST(0 AS BIGINT) AS n_wrong FROM n
""",
)
def q_forest_table(spark, sf_dir):
    """A fitted forest is saved, loaded, turned into a node table and scored beside its own predictions."""
    w = window_features(spark, sf_dir)
    model = fit.fit_forest_regressor(w.where(F.col("split") == sp.TRAIN), WIN_FEATURES, ["gait_target"])["gait_target"]
    path = _folder(spark, "forest", "model")
    io.save_ml_model(model, path)
    loaded = RandomForestRegressionModel.load(path)
    nodes = trees.collect_nodes(trees.forest_to_table(spark, loaded))
    p = fit.predict_models({"gait_target": loaded}, w, WIN_FEATURES)
    s = trees.score_forest(p.select("gait_target_pred", *WIN_FEATURES), nodes, WIN_FEATURES, ["p0"])
    return s.agg(F.count(F.lit(1)).alias("n_windows"), F.count_if(F.abs(F.col("p0") - F.col("gait_target_pred")) > 1e-3).alias("n_wrong"))


@query("control_log_store", ["SRC-11", "CTL-04"], sql=_control_sql())
def q_control_log(spark, sf_dir):
    path = _folder(spark, "control", "log")
    log = q_control_replay(spark, sf_dir)
    io.write_control_log(log, path)
    return spark.read.schema(log.schema).option("header", True).csv(path)


@query(
    "one_repetition",
    ["PRJ-11"],
    sql="SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag || l_linestatus = 'NO' AND l_linenumber = 2",
)
def q_one_rep(spark, sf_dir):
    return cl.slice_rep(adapters.reps(spark, sf_dir), "NO", 2).select("l_orderkey", "l_linenumber")


@query(
    "sensor_arrays",
    ["PRJ-01", "PRJ-03"],
    sql="SELECT vec_id AS idx, 4 AS n, round(CAST(embedding[1] AS DOUBLE) + embedding[3], 6) AS ta, round(CAST(embedding[5] AS DOUBLE), 6) AS gm, round(CAST(embedding[7] AS DOUBLE), 6) AS imu FROM embeddings",
)
def q_sensor_arrays(spark, sf_dir):
    names = {"EMG_TA_1": 0, "EMG_TA_2": 2, "EMG_GM_1": 4, "shank-f": 6}
    wide = adapters.grid(spark, sf_dir).select("idx", *[F.col("emg_ta")[k].alias(n) for n, k in names.items()])
    reg = ChannelRegistry.from_columns(wide.columns, "endswith")
    a = select_sensors(reg.to_arrays(wide, ["idx"]))
    s = F.col("sensors")
    return a.select(
        "idx", F.size(s).alias("n"), r6(s[0].cast("double") + s[1].cast("double")).alias("ta"), r6(s[2].cast("double")).alias("gm"), r6(s[3].cast("double")).alias("imu")
    )


_MODES = """
WITH {sig}, ix AS (SELECT *, CASE WHEN event_id % 5 = 0 THEN NULL ELSE gait END AS g, {idx} AS idx, count(*) OVER () AS n_rows FROM sig),
m AS (SELECT *, unnest({win}) AS window_id FROM ix),
cg AS (SELECT window_id, g, count(*) AS c FROM m WHERE g IS NOT NULL GROUP BY ALL),
cr AS (SELECT window_id, reps, count(*) AS c FROM m GROUP BY ALL),
mg AS (SELECT window_id, arg_max(g, c * 1e6 - g) AS gait_mode FROM cg GROUP BY window_id),
mr AS (SELECT window_id, arg_max(reps, c * 1e9 - reps) AS reps_mode FROM cr GROUP BY window_id)
SELECT window_id, round(gait_mode, 6) AS gait_mode, CAST(reps_mode AS BIGINT) AS reps_mode FROM mr LEFT JOIN mg USING (window_id)
""".format(sig=SIG_SQL, idx=sql_index(GLOBAL_ORDER), win=sql_window_ids(8, 4))


@query("label_modes", ["AGG-14", "PRJ-22"], sql=_MODES + " WHERE gait_mode IS NOT NULL")
def q_label_modes(spark, sf_dir):
    s = adapters.signal(spark, sf_dir).withColumn("g", F.when(F.col("event_id") % 5 != 0, F.col("gait")))
    ix = with_row_index(s, adapters.SIGNAL_ORDER, count_name="n_rows")
    w = sliding_windows(ix, 8, 4, aggs={"gait_mode": ft.majority("g"), "reps_mode": ft.majority("reps")})
    return cl.skip_unlabelled(w, "gait_mode").select("window_id", r6("gait_mode").alias("gait_mode"), F.col("reps_mode").cast("bigint").alias("reps_mode"))


@query(
    "window_end_time",
    ["WIN-05"],
    sql=f"""
WITH {SIG_SQL}, ix AS (SELECT *, {sql_index(GLOBAL_ORDER)} AS idx, {sql_index(GLOBAL_ORDER, 'activity')} AS apos, count(*) OVER () AS n_rows FROM sig),
m AS (SELECT *, unnest({sql_window_ids(8, 4)}) AS window_id FROM ix),
w AS (SELECT window_id, max(idx) AS end_idx FROM m GROUP BY window_id HAVING count(DISTINCT activity) = 1)
SELECT window_id, round(apos / 100.0, 6) AS t FROM w JOIN ix ON ix.idx = w.end_idx
""",
)
def q_end_time(spark, sf_dir):
    ix = indexed_signal(spark, sf_dir)
    w = sliding_windows(ix, 8, 4, purity=["activity"], aggs={"end_idx": F.max("idx")})
    return end_time(w, ix, 100.0).select("window_id", r6("t").alias("t"))


@query(
    "first_seen_order",
    ["SRT-02"],
    sql=f"WITH {SIG_SQL}, ix AS (SELECT *, {sql_index('ts, event_id')} AS idx FROM sig) SELECT activity, min(idx) AS first_idx FROM ix GROUP BY activity",
)
def q_first_seen(spark, sf_dir):
    ix = with_row_index(adapters.signal(spark, sf_dir), adapters.SUBJECT_ORDER)
    return sp.first_seen_order(ix, "activity")


@query("shuffled", ["SRT-06"], sql=f"SELECT o_orderkey, row_number() OVER (ORDER BY {H.format(c='o_orderkey', seed=9)}, o_orderkey) - 1 AS pos FROM orders")
def q_shuffled(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    return with_row_index(sp.shuffle(o, "o_orderkey", 9), [sp.stable_hash("o_orderkey", 9), "o_orderkey"], name="pos")


@query(
    "format_prediction_scaled",
    ["SRC-16"],
    sql="""
WITH v AS (SELECT event_id, CAST(trunc(CAST(CAST(value AS FLOAT) * CAST(1000 AS FLOAT) AS FLOAT)) AS INT) AS s FROM events)
SELECT event_id, 'ankle' || CAST(s // 1000 AS VARCHAR) || '.' || lpad(CAST(s % 1000 AS VARCHAR), 3, '0') AS message FROM v
""",
)
def q_format_scaled(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select("event_id", msg.format_prediction_scaled("ankle", F.col("value")).alias("message"))


@query(
    "row_mean_windows",
    ["AGG-03"],
    sql="SELECT vec_id AS idx, round(list_avg(list_transform(embedding, lambda v: CAST(v AS DOUBLE))), 6) AS mean_all FROM embeddings",
)
def q_row_mean(spark, sf_dir):
    return adapters.grid(spark, sf_dir).select("idx", r6(ft.row_mean("emg_ta")).alias("mean_all"))
