"""Queries: global row index, sliding / tumbling windows, window labels and targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from myosig import adapters
from myosig.functions import features as ft
from myosig.operators.index import with_row_index
from myosig.operators.windows import sliding_windows, tumbling_windows
from myosig.plans.registry import query, r6, sql_index, sql_window_ids

SIG_SQL = """sig AS (
  SELECT event_id, ts, user_id AS subject, event_type AS activity, CAST(user_id AS INT) AS reps,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS gait, value AS x
  FROM events)"""

SIGV_SQL = """sig AS (
  SELECT event_id, ts, user_id AS subject,
         event_type || CASE WHEN event_id % 4 = 0 THEN '_' ELSE '' END AS activity,
         CAST(user_id AS INT) AS reps,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS gait, value AS x
  FROM events)"""

GLOBAL_ORDER = "activity, subject, ts, event_id"


def indexed_signal(spark, sf_dir, variants: bool = False, per_subject: bool = False, signed: bool = False, lags: int = 0):
    """The signal with its position; ``signed`` adds xs = x - 50, ``lags`` its lags (same pass)."""
    s = adapters.signal_variants(spark, sf_dir) if variants else adapters.signal(spark, sf_dir)
    if signed:
        s = s.withColumn("xs", F.col("x") - 50)
    lag_cols = ["xs"] if lags else []
    if per_subject:
        return with_row_index(s, adapters.SUBJECT_ORDER, series=["subject"], count_name="n_rows", lag_cols=lag_cols, lags=max(lags, 1))
    return with_row_index(s, adapters.SIGNAL_ORDER, count_name="n_rows", lag_cols=lag_cols, lags=max(lags, 1))


# --------------------------------------------------------------------- WIN-01
@query(
    "row_index",
    ["WIN-01"],
    sql=f"""
WITH {SIG_SQL}
SELECT event_id, {sql_index(GLOBAL_ORDER)} AS idx, count(*) OVER () AS n_rows FROM sig
""",
)
def q_row_index(spark, sf_dir):
    return indexed_signal(spark, sf_dir).select("event_id", "idx", "n_rows")


# --------------------------------------------------------------------- WIN-02 (flagship)
@query(
    "sliding_mav",
    ["WIN-02", "AGG-01", "AGG-03", "AGG-12", "AGG-17", "JOI-04"],
    sql=f"""
WITH {SIG_SQL},
ix AS (SELECT *, {sql_index(GLOBAL_ORDER)} AS idx, count(*) OVER () AS n_rows FROM sig),
m AS (SELECT *, unnest({sql_window_ids(8, 4)}) AS window_id FROM ix)
SELECT window_id, window_id * 4 AS start_idx, window_id * 4 + 7 AS end_idx,
       max_by(activity, idx) AS activity,
       round(avg(abs(x)), 6) AS mav, round(avg(x), 6) AS mean_x
FROM m GROUP BY window_id
HAVING min(activity) = max(activity) AND min(reps) = max(reps)
""",
)
def q_sliding_mav(spark, sf_dir):
    return sliding_mav(indexed_signal(spark, sf_dir))


def sliding_mav(ix):
    w = sliding_windows(
        ix,
        8,
        4,
        aggs={"mav": ft.mav("x"), "mean_x": ft.mean("x")},
        labels={"activity": ("activity", "last")},
        purity=["activity", "reps"],
    )
    return w.select("window_id", "start_idx", "end_idx", "activity", r6("mav").alias("mav"), r6("mean_x").alias("mean_x"))


# --------------------------------------------------------------------- all features
@query(
    "sliding_full_features",
    ["WIN-02", "WIN-06", "AGG-01", "AGG-03", "AGG-04", "AGG-05", "AGG-06", "AGG-07", "AGG-08", "AGG-09", "AGG-10", "AGG-11", "AGG-12", "AGG-16"],
    sql=f"""
WITH {SIG_SQL},
ix AS (SELECT *, x - 50 AS xs, {sql_index(GLOBAL_ORDER)} AS idx, count(*) OVER () AS n_rows FROM sig),
lg AS (SELECT *, lag(xs, 1) OVER (ORDER BY idx) AS xs_lag1, lag(xs, 2) OVER (ORDER BY idx) AS xs_lag2 FROM ix),
m AS (SELECT *, unnest({sql_window_ids(8, 4)}) AS window_id FROM lg),
r AS (SELECT *, idx - window_id * 4 AS rel FROM m)
SELECT window_id, window_id * 4 AS start_idx, window_id * 4 + 7 AS end_idx,
       max_by(activity, idx) AS activity,
       round(avg(abs(xs)), 6) AS mav, round(avg(xs), 6) AS mean_x, round(stddev_pop(xs), 6) AS std_x,
       round(sqrt(avg(xs * xs)), 6) AS rms_x, round(sum(xs * xs), 6) AS energy_x,
       round(coalesce(sum(CASE WHEN rel >= 1 THEN abs(xs - xs_lag1) END), 0), 6) AS wl_x,
       CAST(count(*) FILTER (WHERE rel >= 1 AND xs * xs_lag1 < 0) AS BIGINT) AS zc_x,
       CAST(count(*) FILTER (WHERE rel >= 2 AND (xs - xs_lag1) * (xs_lag1 - xs_lag2) < 0) AS BIGINT) AS ssc_x,
       round(stddev_pop(CASE WHEN rel >= 1 THEN xs - xs_lag1 END), 6) AS jerk_x,
       round(max(xs) - min(xs), 6) AS p2p_x,
       round(avg(gait), 6) AS gait_target
FROM r GROUP BY window_id
""",
)
def q_sliding_full(spark, sf_dir):
    ix = indexed_signal(spark, sf_dir, signed=True, lags=2)
    w = sliding_windows(
        ix,
        8,
        4,
        labels={"activity": ("activity", "last")},
        aggs={
            "mav": ft.mav("xs"),
            "mean_x": ft.mean("xs"),
            "std_x": ft.std_pop("xs"),
            "rms_x": ft.rms("xs"),
            "energy_x": ft.energy("xs"),
            "wl_x": ft.waveform_length("xs"),
            "zc_x": ft.zero_crossings("xs"),
            "ssc_x": ft.slope_sign_changes("xs"),
            "jerk_x": ft.jerk_std("xs"),
            "p2p_x": ft.peak_to_peak("xs"),
            "gait_target": ft.target_mean("gait"),
        },
    )
    dbl = ["mav", "mean_x", "std_x", "rms_x", "energy_x", "wl_x", "jerk_x", "p2p_x", "gait_target"]
    return w.select(
        "window_id", "start_idx", "end_idx", "activity", "zc_x", "ssc_x", *[r6(c).alias(c) for c in dbl]
    )


# --------------------------------------------------------------------- exclusive end + majority
@query(
    "sliding_exclusive_end",
    ["WIN-02", "AGG-13", "PRJ-22"],
    sql=f"""
WITH {SIGV_SQL},
ix AS (SELECT *, {sql_index(GLOBAL_ORDER)} AS idx, count(*) OVER () AS n_rows FROM sig),
m AS (SELECT *, unnest({sql_window_ids(7, 3, inclusive=False)}) AS window_id FROM ix),
c AS (SELECT window_id, activity, count(*) AS cnt FROM m WHERE activity IS NOT NULL GROUP BY window_id, activity),
top AS (SELECT window_id, activity AS label,
               row_number() OVER (PARTITION BY window_id ORDER BY cnt DESC, activity) AS rk FROM c),
f AS (SELECT window_id, round(avg(x), 6) AS mean_x, round(avg(abs(x)), 6) AS mav FROM m GROUP BY window_id)
SELECT f.window_id, top.label, f.mean_x, f.mav FROM f JOIN top ON f.window_id = top.window_id AND top.rk = 1
""",
)
def q_sliding_exclusive(spark, sf_dir):
    ix = indexed_signal(spark, sf_dir, variants=True)
    w = sliding_windows(
        ix,
        7,
        3,
        inclusive_end=False,
        aggs={"mean_x": ft.mean("x"), "mav": ft.mav("x")},
        labels={"label": ("activity", "majority")},
    )
    w = w.where(F.col("label").isNotNull())  # PRJ-22 skip unlabelled windows
    return w.select("window_id", "label", r6("mean_x").alias("mean_x"), r6("mav").alias("mav"))


# --------------------------------------------------------------------- 307/153, purity on activity
@query(
    "sliding_purity",
    ["WIN-02", "AGG-17", "AGG-15"],
    sql=f"""
WITH {SIG_SQL},
ix AS (SELECT *, {sql_index(GLOBAL_ORDER)} AS idx, count(*) OVER () AS n_rows FROM sig),
m AS (SELECT *, unnest({sql_window_ids(307, 153)}) AS window_id FROM ix)
SELECT window_id, max_by(activity, idx) AS activity, round(avg(abs(x)), 6) AS mav,
       round(avg(x), 6) AS mean_x, round(max_by(gait, idx), 6) AS gait_target
FROM m GROUP BY window_id HAVING min(activity) = max(activity)
""",
)
def q_sliding_purity(spark, sf_dir):
    ix = indexed_signal(spark, sf_dir)
    w = sliding_windows(
        ix,
        307,
        153,
        purity=["activity"],
        labels={"activity": ("activity", "last")},
        aggs={
            "mav": ft.mav("x"),
            "mean_x": ft.mean("x"),
            "gait_target": ft.last_value("gait"),
        },
    )
    return w.select("window_id", "activity", *[r6(c).alias(c) for c in ["mav", "mean_x", "gait_target"]])


# --------------------------------------------------------------------- WIN-03
@query(
    "tumbling_chunks",
    ["WIN-03", "AGG-01", "AGG-03", "SRT-07"],
    sql=f"""
WITH {SIG_SQL},
ix AS (SELECT *, {sql_index(GLOBAL_ORDER)} AS idx FROM sig)
SELECT CAST(floor(idx / 64) AS BIGINT) AS chunk, round(avg(abs(x)), 6) AS mav, round(avg(x), 6) AS mean_x,
       round(max_by(gait, idx), 6) AS gait_last
FROM ix GROUP BY 1 HAVING count(*) = 64
""",
)
def q_tumbling(spark, sf_dir):
    ix = with_row_index(adapters.signal(spark, sf_dir), adapters.SIGNAL_ORDER)
    t = tumbling_windows(
        ix, 64, aggs={"mav": ft.mav("x"), "mean_x": ft.mean("x"), "gait_last": ft.last_value("gait")}
    )
    return t.select("chunk", *[r6(c).alias(c) for c in ["mav", "mean_x", "gait_last"]])


# --------------------------------------------------------------------- per-subject windows
SUBJ_IX_SQL = "ix AS (SELECT *, " + sql_index("ts, event_id", "subject") + " AS idx, count(*) OVER (PARTITION BY subject) AS n_rows FROM sig)"


@query(
    "label_majority",
    ["WIN-02", "AGG-13", "AGG-14"],
    sql=f"""
WITH {SIGV_SQL}, {SUBJ_IX_SQL},
m AS (SELECT *, unnest({sql_window_ids(8, 4)}) AS window_id FROM ix),
c AS (SELECT subject, window_id, activity, count(*) AS cnt FROM m GROUP BY ALL),
top AS (SELECT subject, window_id, activity AS label,
               row_number() OVER (PARTITION BY subject, window_id ORDER BY cnt DESC, activity) AS rk FROM c)
SELECT subject, window_id, label FROM top WHERE rk = 1
""",
)
def q_label_majority(spark, sf_dir):
    ix = indexed_signal(spark, sf_dir, variants=True, per_subject=True)
    w = sliding_windows(ix, 8, 4, series=["subject"], labels={"label": ("activity", "majority")})
    return w.select("subject", "window_id", "label")


@query(
    "label_last",
    ["WIN-02", "AGG-12", "AGG-15"],
    sql=f"""
WITH {SIG_SQL}, {SUBJ_IX_SQL},
m AS (SELECT *, unnest({sql_window_ids(7, 3)}) AS window_id FROM ix)
SELECT subject, window_id, max_by(activity, idx) AS activity, round(max_by(gait, idx), 6) AS gait_target
FROM m GROUP BY subject, window_id
""",
)
def q_label_last(spark, sf_dir):
    ix = indexed_signal(spark, sf_dir, per_subject=True)
    w = sliding_windows(
        ix, 7, 3, series=["subject"], aggs={"gait_target": ft.last_value("gait")}, labels={"activity": ("activity", "last")}
    )
    return w.select("subject", "window_id", "activity", r6("gait_target").alias("gait_target"))


@query(
    "target_mean",
    ["WIN-02", "AGG-16"],
    sql=f"""
WITH {SIG_SQL}, {SUBJ_IX_SQL},
m AS (SELECT *, unnest({sql_window_ids(8, 4, inclusive=False)}) AS window_id FROM ix)
SELECT subject, window_id, round(avg(gait), 6) AS gait_mean, round(avg(x), 6) AS x_mean
FROM m GROUP BY subject, window_id
""",
)
def q_target_mean(spark, sf_dir):
    ix = indexed_signal(spark, sf_dir, per_subject=True)
    w = sliding_windows(
        ix, 8, 4, series=["subject"], inclusive_end=False, aggs={"gait_mean": ft.target_mean("gait"), "x_mean": ft.mean("x")}
    )
    return w.select("subject", "window_id", r6("gait_mean").alias("gait_mean"), r6("x_mean").alias("x_mean"))


# --------------------------------------------------------------------- per-channel features of an electrode grid
@query(
    "sliding_channel_features",
    ["WIN-02", "AGG-02", "AGG-03", "AGG-05", "AGG-06"],
    sql=f"""
WITH g AS (SELECT vec_id, embedding, {sql_index('vec_id')} AS idx, count(*) OVER () AS n_rows FROM embeddings),
l AS (SELECT idx, n_rows, CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS ch, CAST(unnest(embedding) AS DOUBLE) AS v FROM g),
m AS (SELECT *, unnest({sql_window_ids(8, 4)}) AS window_id FROM l),
pc AS (SELECT window_id, ch, avg(abs(v)) AS mav, sqrt(avg(v * v)) AS rms, avg(v) AS mean_v, sum(v * v) AS energy
       FROM m GROUP BY window_id, ch)
SELECT window_id, round(avg(mav), 6) AS mav_avg, round(avg(rms), 6) AS rms_avg, round(avg(mean_v), 6) AS mean_avg,
       round(avg(energy), 6) AS energy_avg, round(max(mav), 6) AS mav_max
FROM pc GROUP BY window_id
""",
)
def q_sliding_channels(spark, sf_dir):
    from myosig.operators.profile import channel_long

    g = with_row_index(adapters.grid(spark, sf_dir), ["idx"], name="pos", count_name="n_rows")
    long = channel_long(g, "emg_ta", keys=["pos", "n_rows"]).withColumn("v", F.col("v").cast("double"))
    per_ch = sliding_windows(
        long, 8, 4, series=["ch"], idx="pos",
        aggs={"mav": ft.mav("v"), "rms": ft.rms("v"), "mean_v": ft.mean("v"), "energy": ft.energy("v")},
    )
    w = per_ch.groupBy("window_id").agg(
        F.avg("mav").alias("mav_avg"), F.avg("rms").alias("rms_avg"), F.avg("mean_v").alias("mean_avg"),
        F.avg("energy").alias("energy_avg"), F.max("mav").alias("mav_max"),
    )
    return w.select("window_id", *[r6(c).alias(c) for c in ["mav_avg", "rms_avg", "mean_avg", "energy_avg", "mav_max"]])


# --------------------------------------------------------------------- pane form (large step)
@query(
    "sliding_panes",
    ["WIN-02", "WIN-06", "AGG-01", "AGG-03", "AGG-04", "AGG-05", "AGG-06", "AGG-07", "AGG-08", "AGG-09", "AGG-11", "AGG-12", "AGG-17"],
    sql=f"""
WITH {SIG_SQL},
ix AS (SELECT *, x - 50 AS xs, {sql_index(GLOBAL_ORDER)} AS idx, count(*) OVER () AS n_rows FROM sig),
lg AS (SELECT *, lag(xs, 1) OVER (ORDER BY idx) AS xs_lag1, lag(xs, 2) OVER (ORDER BY idx) AS xs_lag2 FROM ix),
m AS (SELECT *, unnest({sql_window_ids(307, 153)}) AS window_id FROM lg),
r AS (SELECT *, idx - window_id * 153 AS rel FROM m)
SELECT window_id, max_by(activity, idx) AS last_activity, count(*) AS n,
       round(avg(abs(xs)), 6) AS mav, round(avg(xs), 6) AS mean_x, round(stddev_pop(xs), 6) AS std_x,
       round(sqrt(avg(xs * xs)), 6) AS rms_x, round(sum(xs * xs), 6) AS energy_x,
       round(coalesce(sum(CASE WHEN rel >= 1 THEN abs(xs - xs_lag1) END), 0), 6) AS wl_x,
       CAST(count(*) FILTER (WHERE rel >= 1 AND xs * xs_lag1 < 0) AS BIGINT) AS zc_x,
       CAST(count(*) FILTER (WHERE rel >= 2 AND (xs - xs_lag1) * (xs_lag1 - xs_lag2) < 0) AS BIGINT) AS ssc_x,
       round(max(xs) - min(xs), 6) AS p2p_x
FROM r GROUP BY window_id HAVING min(activity) = max(activity)
""",
)
def q_sliding_panes(spark, sf_dir):
    from myosig.operators.panes import sliding_window_stats

    ix = indexed_signal(spark, sf_dir, signed=True, lags=2)
    w = sliding_window_stats(ix, 307, 153, "xs", purity=["activity"], last_label="activity", lag1="xs_lag1", lag2="xs_lag2")
    ren = {"mean": "mean_x", "std": "std_x", "rms": "rms_x", "energy": "energy_x", "wl": "wl_x", "p2p": "p2p_x"}
    return w.select(
        "window_id", "last_activity", "n", "zc", "ssc", "mav", *[F.col(k).alias(v) for k, v in ren.items()]
    ).select(
        "window_id", "last_activity", "n", F.col("zc").alias("zc_x"), F.col("ssc").alias("ssc_x"),
        *[r6(c).alias(c) for c in ["mav", "mean_x", "std_x", "rms_x", "energy_x", "wl_x", "p2p_x"]],
    )
