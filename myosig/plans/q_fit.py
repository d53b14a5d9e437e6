"""Queries: model fitting (rows-only checks: no SQL equivalent) and packet decoding."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from myosig import adapters
from myosig.functions import features as ft
from myosig.functions import messages as msg
from myosig.models import fit, linear, mlp, search, trees
from myosig.operators import evaluation as ev
from myosig.operators import scaling as sc
from myosig.operators import splits as sp
from myosig.operators.index import with_row_index
from myosig.operators.windows import sliding_windows
from myosig.plans.q_windows import indexed_signal
from myosig.plans.registry import query, r6

WIN_FEATURES = ["mav", "std_x", "wl_x", "zc_x", "ssc_x", "rms_x"]


def window_features(spark, sf_dir):
    """Global 8/4 windows of the signed signal with six features, gait target and split."""
    ix = indexed_signal(spark, sf_dir, signed=True, lags=2)
    w = sliding_windows(
        ix, 8, 4,
        labels={"activity": ("activity", "last")},
        aggs={
            "mav": ft.mav("xs"), "std_x": ft.std_pop("xs"), "wl_x": ft.waveform_length("xs"),
            "zc_x": ft.zero_crossings("xs").cast("double"), "ssc_x": ft.slope_sign_changes("xs").cast("double"),
            "rms_x": ft.rms("xs"), "gait_target": ft.target_mean("gait"),
        },
    )
    w = with_row_index(w, ["window_id"], name="pos", count_name="n_rows")
    return sp.split_sequential(w, 0.8, idx="pos")


@query("forest_fit", ["ML-03", "EVL-03"])
def q_forest_fit(spark, sf_dir):
    w = window_features(spark, sf_dir).checkpoint()
    models = fit.fit_forest_regressor(w.where(F.col("split") == sp.TRAIN), WIN_FEATURES, ["gait_target"], trees=10, depth=5, min_leaf=10)
    pred = fit.predict_models(models, w.where(F.col("split") == sp.TEST), WIN_FEATURES)
    long = ev.long_pairs(pred, {"gait": ("gait_target", "gait_target_pred")}, keep=["activity"])
    m = ev.metrics_by_target(long, ["activity"])
    return m.select("activity", "target", "n", r6("r2").alias("r2"), r6("rmse").alias("rmse"))


@query("model_summary", ["ML-23"])
def q_model_summary(spark, sf_dir):
    w = window_features(spark, sf_dir)
    models = fit.fit_forest_regressor(w.where(F.col("split") == sp.TRAIN), WIN_FEATURES, ["gait_target"], trees=10, depth=5, min_leaf=10)
    nodes = trees.forest_to_table(spark, models["gait_target"])
    return trees.model_summary(nodes)


#: Window and step of the searched features.
SEARCH_WINDOW, SEARCH_STEP = 307, 153


def search_windows(spark, sf_dir):
    """Windows of every subject: two features a channel, standardised by subject, last activity."""
    ix = with_row_index(adapters.reps(spark, sf_dir), ["l_orderkey", "l_linenumber"], series=["subject"], count_name="n_rows")
    aggs = {f"{c}_{n}": f(c) for c in adapters.REPS_CHANNELS for n, f in (("mav", ft.mav), ("std", ft.std_pop))}
    w = sliding_windows(ix, SEARCH_WINDOW, SEARCH_STEP, series=["subject"], labels={"activity": ("activity", "last")}, aggs=aggs)
    z = sc.standardize_by_group(w, ["subject"], list(aggs), suffix="_z")
    z = sp.encode_labels(z, sp.label_map(z, "activity"), "activity", out="label")
    return z, [f"{a}_z" for a in aggs]


@query("grid_search", ["ML-14", "JOI-06", "ML-17"])
def q_grid_search(spark, sf_dir):
    """50 points of four families behind PCA, leave one subject out; the best one fitted on all windows."""
    z, features = search_windows(spark, sf_dir)
    z = z.select("subject", "window_id", "label", *features).checkpoint()
    found = search.Search(z, features, "label", "subject")
    rows = found.run()
    best = next(r for r in rows if r["rank"] == 1)
    pred = search.predict(z, features, found.refit(best))
    return pred.select(
        "subject", "window_id", F.col("label").cast("int").alias("label"), "prediction", F.lit(len(rows)).alias("n_points"),
        F.lit(best["family"]).alias("family"), F.lit(json.dumps(best["params"], sort_keys=True)).alias("params"),
        F.lit(best["mean_train"]).alias("mean_train"), F.lit(best["mean_test"]).alias("mean_test"),
    )


@query("mlp_fit", ["ML-13", "ML-22"])
def q_mlp_fit(spark, sf_dir):
    w = window_features(spark, sf_dir)
    params = sc.fit_scaler(w.where(F.col("split") == sp.TRAIN), WIN_FEATURES)
    z = sc.apply_scaler(w, params, suffix="_z").withColumn("is_val", F.col("split") == sp.TEST)
    feats = [f"{c}_z" for c in WIN_FEATURES]
    res = mlp.fit_mlp_regressor(z, feats, ["gait_target"], val_col="is_val")
    out = linear.mlp_forward(F.array(*[F.col(c) for c in feats]), res["layers"])[0]
    return z.select("window_id", "split", "gait_target", out.alias("gait_pred"), F.lit(res["history"][-1][0]).alias("epochs"))


@query(
    "decode_float_packets",
    ["SRC-14"],
    sql="SELECT vec_id, CAST(len(embedding) AS INT) AS n_values, true AS roundtrip_ok FROM embeddings",
)
def q_packets(spark, sf_dir):
    g = adapters.grid(spark, sf_dir).select(F.col("idx").alias("vec_id"), "emg_ta")
    enc = msg.encode_float_packets(g.withColumn("orig", F.col("emg_ta")), "emg_ta")
    dec = msg.decode_float_packets(enc, "payload", n=64, out="values")
    return dec.select("vec_id", F.size("values").alias("n_values"), (F.col("values") == F.col("orig")).alias("roundtrip_ok"))


@query("forest_fit_joint", ["ML-03", "ML-19", "EVL-03"])
def q_forest_fit_joint(spark, sf_dir):
    """Joint two-output forest (one structure for both targets), grown level-wise on Spark."""
    from myosig.models.multiforest import fit_multi_forest

    w = window_features(spark, sf_dir).checkpoint()
    feats = [f for f in WIN_FEATURES if f != "mav"]
    nodes = fit_multi_forest(w.where(F.col("split") == sp.TRAIN), feats, ["gait_target", "mav"], "window_id", trees=10, depth=5, min_leaf=10)
    test = w.where(F.col("split") == sp.TEST)
    pred = trees.score_forest(test.select("activity", "gait_target", "mav", *feats), nodes, feats, ["p_gait", "p_mav"])
    long = ev.long_pairs(pred, {"gait": ("gait_target", "p_gait"), "mav": ("mav", "p_mav")}, keep=["activity"])
    m = ev.metrics_by_target(long, ["activity"])
    return m.select("activity", "target", "n", r6("r2").alias("r2"), r6("rmse").alias("rmse"))
