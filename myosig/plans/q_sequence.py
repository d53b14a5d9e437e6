"""Queries: sequence post-processing, reference curves, control decisions and device messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from myosig import adapters
from myosig.functions import features as ft
from myosig.functions import messages as msg
from myosig.models import trees
from myosig.operators import control as ctl
from myosig.operators import sequence as sq
from myosig.operators.index import with_row_index
from myosig.operators import evaluation as ev
from myosig.operators.windows import align_truth, prediction_time, sliding_windows
from myosig.plans.q_windows import GLOBAL_ORDER, SIG_SQL, indexed_signal
from myosig.plans.registry import query, r6, sql_index, sql_window_ids

SUBJ_IX = "ix AS (SELECT *, " + sql_index("ts, event_id", "subject") + " AS idx FROM sig)"


def subject_series(spark, sf_dir):
    return with_row_index(adapters.signal(spark, sf_dir), adapters.SUBJECT_ORDER, series=["subject"])


# --------------------------------------------------------------------- WIN-07
@query(
    "moving_average",
    ["WIN-07"],
    sql=f"""
WITH {SIG_SQL}
SELECT subject, event_id,
       round(avg(x) OVER (PARTITION BY subject ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING), 6) AS x_ma
FROM sig
""",
)
def q_moving_average(spark, sf_dir):
    s = sq.moving_average(subject_series(spark, sf_dir), "x", 10, series=["subject"], out="x_ma")
    return s.select("subject", "event_id", r6("x_ma").alias("x_ma"))


# --------------------------------------------------------------------- WIN-09
KALMAN_SQL = f"""
WITH RECURSIVE {SIG_SQL}, {SUBJ_IX},
iv AS (SELECT subject, event_id, idx, x, var_pop(x) OVER (PARTITION BY subject) AS v FROM ix),
k(subject, idx, event_id, z, xs, p) AS (
  SELECT subject, idx, event_id, x, x, CAST(1.0 AS DOUBLE) FROM iv WHERE idx = 0
  UNION ALL
  SELECT i.subject, i.idx, i.event_id, i.x,
         CASE WHEN i.v > 0 THEN k.xs + ((k.p + 0.4) / (k.p + 0.4 + 1.0)) * (i.x - k.xs) ELSE i.x END,
         (k.p + 0.4) / (k.p + 0.4 + 1.0)
  FROM k JOIN iv i ON i.subject = k.subject AND i.idx = k.idx + 1)"""


@query(
    "kalman_smooth",
    ["WIN-09"],
    sql=KALMAN_SQL + "\nSELECT subject, event_id, round(xs, 6) AS x_kalman FROM k",
)
def q_kalman(spark, sf_dir):
    s = sq.kalman_smooth(subject_series(spark, sf_dir), "x", series=["subject"], q_ratio=0.4, out="x_kalman")
    return s.select("subject", "event_id", r6("x_kalman").alias("x_kalman"))


# --------------------------------------------------------------------- WIN-10
@query(
    "jitter",
    ["WIN-10", "WIN-06"],
    sql=f"""
WITH {SIG_SQL}
SELECT subject, round(stddev_pop(d), 6) AS jitter FROM (
  SELECT subject, x - lag(x) OVER (PARTITION BY subject ORDER BY ts, event_id) AS d FROM sig)
GROUP BY subject
""",
)
def q_jitter(spark, sf_dir):
    j = sq.jitter(subject_series(spark, sf_dir), "x", series=["subject"])
    return j.select("subject", r6("jitter").alias("jitter"))


# --------------------------------------------------------------------- EVL-10
@query(
    "compare_smoothers",
    ["EVL-10", "WIN-09", "WIN-10", "EVL-04"],
    sql=KALMAN_SQL
    + """,
kk AS (SELECT k.subject, k.idx, k.z AS raw, k.xs AS kal, iv.x / 3.0 AS truth FROM k JOIN iv USING (subject, idx)),
d AS (SELECT *, raw - lag(raw) OVER w AS d_raw, kal - lag(kal) OVER w AS d_kal FROM kk WINDOW w AS (PARTITION BY subject ORDER BY idx)),
g AS (SELECT subject, 1 - avg((truth - raw) * (truth - raw)) / var_pop(truth) AS r2_raw,
             1 - avg((truth - kal) * (truth - kal)) / var_pop(truth) AS r2_kalman, avg(abs(raw - truth)) AS mae_raw, avg(abs(kal - truth)) AS mae_kalman,
             stddev_pop(d_raw) AS jitter_raw, stddev_pop(d_kal) AS jitter_kalman FROM d GROUP BY subject)
SELECT subject, round(r2_raw, 6) AS r2_raw, round(r2_kalman, 6) AS r2_kalman, round(mae_raw, 6) AS mae_raw, round(mae_kalman, 6) AS mae_kalman, round(jitter_raw, 6) AS jitter_raw,
       round(jitter_kalman, 6) AS jitter_kalman, round((jitter_raw - jitter_kalman) / jitter_raw * 100, 6) AS reduction_pct
FROM g
""",
)
def q_compare_smoothers(spark, sf_dir):
    s = sq.kalman_smooth(subject_series(spark, sf_dir), "x", series=["subject"], out="kal")
    s = s.withColumn("truth", F.col("x") / 3.0)
    g = ev.compare_smoothers(s, "truth", "x", "kal", series=["subject"])
    return g.select("subject", *[r6(c).alias(c) for c in ["r2_raw", "r2_kalman", "mae_raw", "mae_kalman", "jitter_raw", "jitter_kalman", "reduction_pct"]])


# --------------------------------------------------------------------- WIN-11
@query(
    "running_rmse",
    ["WIN-11"],
    sql=f"""
WITH {SIG_SQL}, {SUBJ_IX}
SELECT subject, idx + 1 AS cycle, round(rmse, 6) AS rmse FROM (
  SELECT subject, idx, sqrt(sum((x - gait) * (x - gait)) OVER (PARTITION BY subject ORDER BY idx
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / (idx + 1)) AS rmse FROM ix)
WHERE (idx + 1) % 20 = 0
""",
)
def q_running_rmse(spark, sf_dir):
    s = subject_series(spark, sf_dir).withColumn("err", F.col("x") - F.col("gait"))
    r = sq.running_rmse(s, "err", series=["subject"], every=20)
    return r.select("subject", "cycle", r6("rmse").alias("rmse"))


# --------------------------------------------------------------------- WIN-12
@query(
    "last_n",
    ["WIN-12", "STR-06"],
    sql=f"""
WITH {SIG_SQL}
SELECT subject, event_id FROM (
  SELECT subject, event_id, row_number() OVER (PARTITION BY subject ORDER BY ts DESC, event_id DESC) AS rn FROM sig)
WHERE rn <= 25
""",
)
def q_last_n(spark, sf_dir):
    s = adapters.signal(spark, sf_dir)
    return sq.last_n(s, 25, ["ts", "event_id"], series=["subject"]).select("subject", "event_id")


# --------------------------------------------------------------------- WIN-04
@query(
    "elapsed_time",
    ["WIN-04"],
    sql=f"""
WITH {SIG_SQL}
SELECT event_id, activity, round({sql_index('subject, ts, event_id', 'activity')} / 2048.0, 6) AS t FROM sig
""",
)
def q_elapsed(spark, sf_dir):
    s = sq.elapsed_time(adapters.signal(spark, sf_dir), hz=2048.0, order=["subject", "ts", "event_id"])
    return s.select("event_id", "activity", r6("t").alias("t"))


# --------------------------------------------------------------------- JOI-03 / WIN-05
@query(
    "align_truth",
    ["JOI-03", "WIN-05"],
    sql=f"""
WITH {SIG_SQL},
ix AS (SELECT *, {sql_index(GLOBAL_ORDER)} AS idx, count(*) OVER () AS n_rows FROM sig),
m AS (SELECT *, unnest({sql_window_ids(8, 4)}) AS window_id FROM ix),
w AS (SELECT window_id, window_id * 4 + 7 AS end_idx, round(avg(abs(x)), 6) AS mav FROM m GROUP BY window_id
      HAVING min(activity) = max(activity) AND min(reps) = max(reps))
SELECT w.window_id, w.mav, ix.event_id AS end_event_id, round(ix.gait, 6) AS gait_truth,
       round(w.window_id * 4 / 2048.0, 6) AS t_step
FROM w JOIN ix ON ix.idx = w.end_idx
""",
)
def q_align(spark, sf_dir):
    ix = indexed_signal(spark, sf_dir)
    w = sliding_windows(ix, 8, 4, aggs={"mav": ft.mav("x")}, purity=["activity", "reps"])
    samples = ix.select("idx", F.col("event_id").alias("end_event_id"), F.col("gait").alias("gait_truth"))
    j = align_truth(w, samples, ["end_event_id", "gait_truth"])
    return j.select(
        "window_id", r6("mav").alias("mav"), "end_event_id", r6("gait_truth").alias("gait_truth"),
        r6(prediction_time(F.col("window_id"), 4, 2048.0)).alias("t_step"),
    )


# --------------------------------------------------------------------- AGG-22 / WIN-08
JOINTS = ["G_DA_X_Target", "G_DK_X_Target", "G_NDA_Y_Target"]  # the last one is absent: zero curve


def angle_signal(spark, sf_dir):
    """Signal with two joint-angle columns (and no third: exercises the missing-joint rule)."""
    s = adapters.signal(spark, sf_dir)
    return s.withColumn("G_DA_X", F.col("x") / 10.0 - 5.0).withColumn("G_DK_X", (F.col("event_id") % 13 - 6).cast("double"))


def curve_sql(bin_expr: str = "gait") -> str:
    """DuckDB CTEs ``curve(joint, gait_bin, ref_angle)`` built independently of the Spark code."""
    return f"""
cb AS (SELECT least(100, greatest(0, CAST(round_even({bin_expr}, 0) AS INT))) AS gait_bin,
              x / 10.0 - 5.0 AS a1, CAST(event_id % 13 - 6 AS DOUBLE) AS a2
       FROM sig WHERE NOT ends_with(activity, '_')),
cl AS (SELECT 'G_DA_X_Target' AS joint, gait_bin, a1 AS angle FROM cb UNION ALL
       SELECT 'G_DK_X_Target', gait_bin, a2 FROM cb),
cm AS (SELECT joint, gait_bin, avg(angle) AS m FROM cl GROUP BY joint, gait_bin),
cg AS (SELECT j.joint, CAST(b.range AS INT) AS gait_bin FROM (VALUES ('G_DA_X_Target'), ('G_DK_X_Target'), ('G_NDA_Y_Target')) j(joint),
       range(101) b),
cj AS (SELECT cg.joint, cg.gait_bin, cm.m FROM cg LEFT JOIN cm ON cg.joint = cm.joint AND cg.gait_bin = cm.gait_bin),
cf AS (SELECT *, last_value(CASE WHEN m IS NOT NULL THEN gait_bin END IGNORE NULLS) OVER wp AS pp,
              last_value(m IGNORE NULLS) OVER wp AS pv,
              first_value(CASE WHEN m IS NOT NULL THEN gait_bin END IGNORE NULLS) OVER wn AS np,
              first_value(m IGNORE NULLS) OVER wn AS nv
       FROM cj WINDOW wp AS (PARTITION BY joint ORDER BY gait_bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                      wn AS (PARTITION BY joint ORDER BY gait_bin ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
curve AS (SELECT joint, gait_bin,
                 CASE WHEN joint = 'G_NDA_Y_Target' THEN 0.0 WHEN pp = gait_bin THEN pv WHEN pp IS NULL THEN nv
                      WHEN np IS NULL THEN pv ELSE pv + (nv - pv) * (gait_bin - pp) / (np - pp) END AS ref_angle
          FROM cf)"""


@query(
    "reference_trajectory",
    ["AGG-22", "WIN-08", "PRJ-07"],
    sql=f"WITH {SIG_SQL}, {curve_sql()}\nSELECT joint, gait_bin, round(ref_angle, 6) AS ref_angle FROM curve",
)
def q_reference(spark, sf_dir):
    import warnings

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        c = ctl.reference_trajectory(angle_signal(spark, sf_dir), JOINTS)
    return c.select("joint", "gait_bin", r6("ref_angle").alias("ref_angle"))


@query(
    "fill_curve",
    ["WIN-08"],
    sql=f"""
WITH {SIG_SQL},
b AS (SELECT 'a' AS curve, least(100, greatest(0, CAST(round_even(gait * 1.3 - 20, 0) AS INT))) AS pos, x FROM sig UNION ALL
      SELECT 'b', least(100, greatest(0, CAST(round_even(gait + 15, 0) AS INT))), x FROM sig),
m AS (SELECT curve, pos, avg(x) AS v FROM b GROUP BY curve, pos),
g AS (SELECT c.curve, CAST(r.range AS INT) AS pos FROM (VALUES ('a'), ('b')) c(curve), range(101) r),
j AS (SELECT g.curve, g.pos, m.v FROM g LEFT JOIN m ON g.curve = m.curve AND g.pos = m.pos),
f AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) OVER wp AS pp,
             last_value(v IGNORE NULLS) OVER wp AS pv,
             first_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) OVER wn AS np,
             first_value(v IGNORE NULLS) OVER wn AS nv
      FROM j WINDOW wp AS (PARTITION BY curve ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                    wn AS (PARTITION BY curve ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT curve, pos, round(CASE WHEN pp = pos THEN pv WHEN pp IS NULL THEN nv WHEN np IS NULL THEN pv
                              ELSE pv + (nv - pv) * (pos - pp) / (np - pp) END, 6) AS v
FROM f
""",
)
def q_fill_curve(spark, sf_dir):
    s = adapters.signal(spark, sf_dir)
    pts = s.select(
        F.explode(
            F.array(
                F.struct(F.lit("a").alias("curve"), ctl.gait_bin(F.col("gait") * 1.3 - 20).alias("pos"), F.col("x")),
                F.struct(F.lit("b").alias("curve"), ctl.gait_bin(F.col("gait") + 15).alias("pos"), F.col("x")),
            )
        ).alias("p")
    ).select("p.*")
    means = pts.groupBy("curve", "pos").agg(F.avg("x").alias("v"))
    grid = spark.range(101).select(F.col("id").cast("int").alias("pos"), F.explode(F.array(F.lit("a"), F.lit("b"))).alias("curve"))
    c = sq.fill_curve(grid.join(means, ["curve", "pos"], "left"), ["curve"], "pos", "v")
    return c.select("curve", "pos", r6("v").alias("v"))


# --------------------------------------------------------------------- CTL-01 / JOI-02
@query(
    "torque",
    ["CTL-01", "JOI-02", "CTL-02"],
    sql=f"""
WITH {SIG_SQL}, {curve_sql()},
p AS (SELECT event_id, 'G_DA_X_Target' AS joint, x / 10.0 - 5.0 AS pred,
             least(100, greatest(0, CAST(round_even(gait, 0) AS INT))) AS gait_bin FROM sig)
SELECT p.event_id, p.joint, round(coalesce(c.ref_angle, 0.0) - p.pred, 6) AS error,
       round(greatest(-20.0, least(20.0, 0.5 * (coalesce(c.ref_angle, 0.0) - p.pred))), 6) AS torque,
       round(greatest(-20.0, least(20.0, 0.5 * (p.pred - 0.0))), 6) AS torque_neutral
FROM p LEFT JOIN curve c ON c.joint = p.joint AND c.gait_bin = p.gait_bin
""",
)
def q_torque(spark, sf_dir):
    import warnings

    sig = angle_signal(spark, sf_dir)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        curve = ctl.reference_trajectory(sig, JOINTS)
    p = sig.select(
        "event_id", F.lit("G_DA_X_Target").alias("joint"), F.col("G_DA_X").alias("pred"), ctl.gait_bin(F.col("gait")).alias("gait_bin")
    )
    p = ctl.lookup_reference(p, curve)
    tq, err = ctl.torque(F.col("pred"), F.col("ref_angle"), F.col("joint"))
    neutral = ctl.torque_neutral(F.col("pred"), F.col("joint"))
    return p.select("event_id", "joint", r6(err).alias("error"), r6(tq).alias("torque"), r6(neutral).alias("torque_neutral"))


# --------------------------------------------------------------------- CTL-03
@query(
    "assist_command",
    ["CTL-03"],
    sql="""
SELECT event_id,
       CASE WHEN ankle < -15.0 THEN 'INCREASE support (dorsiflexion)' WHEN ankle > -5.0 THEN 'REDUCE support (plantarflexion)'
            ELSE 'MAINTAIN (normal range)' END AS ankle_cmd,
       CASE WHEN coalesce(knee, 0.0) < -10.0 THEN 'FLEXION assist ON' WHEN coalesce(knee, 0.0) > 5.0 THEN 'EXTENSION assist ON'
            ELSE 'NEUTRAL — no assist' END AS knee_cmd
FROM (SELECT event_id, value / 10.0 - 30.0 AS ankle,
             CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) / 5.0 - 12.0 END AS knee
      FROM events)
""",
)
def q_assist(spark, sf_dir):
    s = adapters.signal(spark, sf_dir)
    knee = F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("gait") / 5.0 - 12.0)
    a, k = ctl.assist_command(F.col("x") / 10.0 - 30.0, knee)
    return s.select("event_id", a.alias("ankle_cmd"), k.alias("knee_cmd"))


# --------------------------------------------------------------------- CTL-04
CONTROL_OUT = ["G_DA_X_Target", "G_DK_X_Target"]


def control_tree() -> list[trees.Node]:
    """A 7-node two-output regression tree over chunk features (mav, gait mean)."""
    return [
        trees.split(0, 0, 0, 50.0, 1, 2, 2),
        trees.split(0, 1, 1, 50.0, 3, 4, 2),
        trees.split(0, 2, 1, 40.0, 5, 6, 2),
        trees.leaf(0, 3, [-20.0, 10.0]),
        trees.leaf(0, 4, [-10.0, 30.0]),
        trees.leaf(0, 5, [-8.0, 5.0]),
        trees.leaf(0, 6, [-25.0, -15.0]),
    ]


def _control_sql() -> str:
    nodes = control_tree()
    p0 = trees.forest_sql(nodes, ["mav", "gait_mean"], 0)
    p1 = trees.forest_sql(nodes, ["mav", "gait_mean"], 1)
    return f"""
WITH {SIG_SQL}, {curve_sql()},
ix AS (SELECT *, {sql_index(GLOBAL_ORDER)} AS idx FROM sig),
ch AS (SELECT CAST(floor(idx / 64) AS BIGINT) AS chunk, avg(abs(x)) AS mav, avg(gait) AS gait_mean,
              max_by(gait, idx) AS gait_pct FROM ix GROUP BY 1 HAVING count(*) = 64),
sc AS (SELECT chunk, gait_pct, {p0} AS p0, {p1} AS p1 FROM ch),
lg AS (SELECT chunk, gait_pct, 'G_DA_X_Target' AS joint, p0 AS pred FROM sc UNION ALL
       SELECT chunk, gait_pct, 'G_DK_X_Target', p1 FROM sc),
lb AS (SELECT *, least(100, greatest(0, CAST(round_even(gait_pct, 0) AS INT))) AS gait_bin FROM lg)
SELECT lb.chunk, lb.joint, round(lb.gait_pct, 6) AS gait_pct, round(lb.pred, 6) AS pred,
       round(coalesce(c.ref_angle, 0.0), 6) AS ref,
       round(coalesce(c.ref_angle, 0.0) - lb.pred, 6) AS error,
       round(greatest(-20.0, least(20.0, CASE lb.joint WHEN 'G_DA_X_Target' THEN 0.5 ELSE 0.8 END
                                          * (coalesce(c.ref_angle, 0.0) - lb.pred))), 6) AS torque
FROM lb LEFT JOIN curve c ON c.joint = lb.joint AND c.gait_bin = lb.gait_bin
"""


@query("control_replay", ["CTL-04", "WIN-03", "ML-19", "JOI-02", "CTL-01"], sql=_control_sql())
def q_control_replay(spark, sf_dir):
    import warnings

    sig = angle_signal(spark, sf_dir)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        curve = ctl.reference_trajectory(sig, JOINTS)
    ix = with_row_index(sig, adapters.SIGNAL_ORDER)
    log = ctl.control_replay(
        ix, curve, 64, {"mav": ft.mav("x"), "gait_mean": ft.mean("gait")},
        lambda c: trees.forest_expr(control_tree(), ["mav", "gait_mean"], 2), CONTROL_OUT,
    )
    return log.select("chunk", "joint", *[r6(c).alias(c) for c in ["gait_pct", "pred", "ref", "error", "torque"]])


# --------------------------------------------------------------------- AGG-23 / EVL-11
@query(
    "latency_summary",
    ["AGG-23"],
    sql="""
WITH lg AS (SELECT value * 10.0 AS feat_us, (event_id % 97) * 3.0 + 100.0 AS infer_us,
                   value * 10.0 + (event_id % 97) * 3.0 + 100.0 AS total_us FROM events),
l AS (SELECT 'feat_us' AS stage, feat_us AS us FROM lg UNION ALL SELECT 'infer_us', infer_us FROM lg
      UNION ALL SELECT 'total_us', total_us FROM lg)
SELECT stage, round(avg(us), 6) AS avg_us, round(min(us), 6) AS min_us, round(max(us), 6) AS max_us, count(us) AS n,
       round(avg(us) / 150000.0 * 100.0, 6) AS budget_pct
FROM l GROUP BY stage
""",
)
def q_latency(spark, sf_dir):
    lg = msg.latency_log(spark, sf_dir)
    s = ctl.latency_summary(lg, ["feat_us", "infer_us", "total_us"])
    return s.select("stage", *[r6(c).alias(c) for c in ["avg_us", "min_us", "max_us"]], "n", r6("budget_pct").alias("budget_pct"))


@query(
    "inference_benchmark",
    ["EVL-11"],
    sql="""
SELECT CAST(count(*) FILTER (WHERE quality = toxic) AS BIGINT) AS n_correct, count(*) AS n_total,
       round(avg(CAST((doc_id % 97) * 10.0 + 500.0 AS DOUBLE)), 6) AS mean_us, round(sum(CAST((doc_id % 97) * 10.0 + 500.0 AS DOUBLE)), 6) AS total_us
FROM labels
""",
)
def q_inference_benchmark(spark, sf_dir):
    return msg.inference_benchmark(spark, sf_dir)


# --------------------------------------------------------------------- SRC-15 / SRC-16
@query(
    "parse_prediction_log",
    ["SRC-15", "STR-07"],
    sql=f"""
WITH raw AS (SELECT event_id AS line_no, {msg.MESSAGE_SQL} AS line FROM events),
p AS (SELECT line_no, regexp_extract(line, '^(READY_FOR_CHUNK|PREDICTION)', 1) AS kind,
             TRY_CAST(regexp_extract(line, '^PREDICTION:([^,]*),', 1) AS DOUBLE) AS angle,
             TRY_CAST(regexp_extract(line, 'LATENCY_US:(.*)$', 1) AS DOUBLE) AS latency_us,
             TRY_CAST(regexp_extract(line, '^READY_FOR_CHUNK:(.*)$', 1) AS INT) AS samples_needed FROM raw)
SELECT line_no, kind, round(angle, 6) AS angle, round(latency_us / 1000.0, 6) AS latency_ms, samples_needed FROM p
WHERE (kind = 'PREDICTION' AND angle IS NOT NULL AND latency_us IS NOT NULL)
   OR (kind = 'READY_FOR_CHUNK' AND samples_needed IS NOT NULL)
""",
)
def q_parse_log(spark, sf_dir):
    p = msg.parse_prediction_log(msg.message_log(spark, sf_dir))
    return p.select("line_no", "kind", r6("angle").alias("angle"), r6("latency_ms").alias("latency_ms"), "samples_needed")


@query(
    "format_prediction",
    ["SRC-16"],
    sql="""
WITH v AS (SELECT event_id, CAST(value - 50.0 AS FLOAT) AS a FROM events),
w AS (SELECT event_id, a, abs(a) AS pa, CAST(trunc(abs(a)) AS INT) AS whole FROM v)
SELECT event_id, 'G_DA_X:' || CASE WHEN a < 0 THEN '-' ELSE '' END || CAST(whole AS VARCHAR) || '.'
       || lpad(CAST(CAST(trunc((pa - CAST(whole AS FLOAT)) * CAST(1000.0 AS FLOAT)) AS INT) AS VARCHAR), 3, '0') AS text
FROM w
""",
)
def q_format(spark, sf_dir):
    s = adapters.signal(spark, sf_dir)
    return s.select("event_id", msg.format_prediction("G_DA_X:", F.col("x") - 50.0).alias("text"))
