"""Queries: reading, projection, cleaning rules and channel profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from myosig import adapters
from myosig.channels import resolve_channels
from myosig.functions.features import row_abs_mean
from myosig.operators import cleaning as cl
from myosig.operators import profile as pf
from myosig.operators.index import with_row_index
from myosig.operators.sequence import elapsed_time
from myosig.plans.q_windows import GLOBAL_ORDER, SIG_SQL, SIGV_SQL
from myosig.plans.registry import query, r6, sql_index
from myosig.session import table
from myosig.sources.io import head_samples


@query(
    "read_filter_activity",
    ["SRC-01", "PRJ-07", "PRJ-10"],
    sql=f"""
WITH {SIGV_SQL}
SELECT event_id, subject, activity, round(x, 6) AS x FROM sig
WHERE NOT ends_with(activity, '_') AND activity IN ('click', 'purchase', 'view')
""",
)
def q_read_filter(spark, sf_dir):
    s = adapters.signal_variants(spark, sf_dir)
    s = cl.keep_activities(cl.drop_variants(s, how="endswith"), ["click", "purchase", "view"])
    return s.select("event_id", "subject", "activity", r6("x").alias("x"))


@query(
    "drop_variants_contains",
    ["PRJ-08", "AGG-19"],
    sql=f"""
WITH {SIGV_SQL}
SELECT activity, count(*) AS n FROM sig WHERE NOT contains(activity, '_') GROUP BY activity
""",
)
def q_drop_contains(spark, sf_dir):
    s = cl.drop_variants(adapters.signal_variants(spark, sf_dir), how="contains")
    return pf.value_counts(s, "activity")


@query(
    "merge_variants",
    ["PRJ-09", "AGG-19"],
    sql=f"""
WITH {SIGV_SQL}
SELECT regexp_replace(activity, '_+$', '') AS activity, count(*) AS n FROM sig GROUP BY 1
""",
)
def q_merge_variants(spark, sf_dir):
    return pf.value_counts(cl.merge_variants(adapters.signal_variants(spark, sf_dir)), "activity")


@query(
    "value_counts",
    ["AGG-19"],
    sql=f"""
WITH {SIGV_SQL}
SELECT activity, count(*) AS n FROM sig GROUP BY activity
""",
)
def q_value_counts(spark, sf_dir):
    return pf.value_counts(adapters.signal_variants(spark, sf_dir), "activity")


@query(
    "phase_encode",
    ["PRJ-13", "PRJ-14"],
    sql=f"""
WITH {SIG_SQL}
SELECT event_id, round(cos(gait / 100 * 2 * pi()), 6) AS phase_x, round(sin(gait / 100 * 2 * pi()), 6) AS phase_y FROM sig
""",
)
def q_phase(spark, sf_dir):
    s = adapters.signal(spark, sf_dir)
    g = cl.gait_column(s, ("Gait", "Gait_Pct"))
    s = cl.phase_encode(s, g)
    return s.select("event_id", r6("phase_x").alias("phase_x"), r6("phase_y").alias("phase_y"))


# NaN / inf / NULL injected by a fixed rule on the event id (edge fixture on the whole table).
_DIRTY = """CASE WHEN event_id % 17 = 0 THEN 'NaN'::DOUBLE WHEN event_id % 23 = 0 THEN 'inf'::DOUBLE
              WHEN event_id % 29 = 0 THEN '-inf'::DOUBLE ELSE value END"""


def _dirty(spark, sf_dir):
    s = adapters.signal(spark, sf_dir)
    eid = F.col("event_id")
    x = (
        F.when(eid % 17 == 0, F.lit(float("nan")))
        .when(eid % 23 == 0, F.lit(float("inf")))
        .when(eid % 29 == 0, F.lit(float("-inf")))
        .otherwise(F.col("x"))
    )
    gait = F.when(eid % 13 == 0, F.lit(None).cast("double")).otherwise(F.col("gait"))
    return s.select("event_id", x.alias("x"), gait.alias("gait"))


@query(
    "clean_signal",
    ["PRJ-04", "PRJ-12", "PRJ-21"],
    sql=f"""
SELECT event_id,
       CAST(CASE WHEN isnan(x) THEN 0 WHEN x = 'inf'::DOUBLE THEN 3.4028234663852886e38
                 WHEN x = '-inf'::DOUBLE THEN -3.4028234663852886e38 ELSE x END AS FLOAT) AS x,
       CAST(gait AS FLOAT) AS gait
FROM (SELECT event_id, {_DIRTY} AS x,
             CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS gait
      FROM events)
WHERE gait IS NOT NULL
""",
)
def q_clean(spark, sf_dir):
    d = cl.drop_missing_target(_dirty(spark, sf_dir), ["gait"])
    d = cl.downcast_float(d)
    return cl.sanitize(d, ["x"])


@query(
    "label_text",
    ["PRJ-18"],
    sql="""
SELECT DISTINCT event_type AS activity, upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) AS label,
       replace(event_type || '_Target', '_Target', '') AS short_name
FROM events
""",
)
def q_label_text(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(F.col("event_type").alias("activity")).distinct()
    return ev.select(
        "activity",
        cl.label_text("activity").alias("label"),
        cl.short_joint(F.concat("activity", F.lit("_Target"))).alias("short_name"),
    )


@query(
    "seek_activity",
    ["PRJ-19"],
    sql=f"""
WITH {SIG_SQL}, ix AS (SELECT *, {sql_index(GLOBAL_ORDER)} AS idx FROM sig)
SELECT event_id, idx FROM ix
WHERE idx >= coalesce((SELECT min(idx) FROM ix WHERE lower(activity) = 'purchase'), 0)
""",
)
def q_seek(spark, sf_dir):
    ix = with_row_index(adapters.signal(spark, sf_dir), adapters.SIGNAL_ORDER)
    return cl.seek_activity(ix, "Purchase").select("event_id", "idx")


@query(
    "cap_duration",
    ["PRJ-20", "WIN-04", "SRT-02"],
    sql=f"""
WITH {SIG_SQL}, ix AS (SELECT *, {sql_index(GLOBAL_ORDER)} AS idx,
                              {sql_index('subject, ts, event_id', 'activity')} / 100.0 AS t FROM sig),
firsts AS (SELECT activity FROM ix GROUP BY activity ORDER BY min(idx) LIMIT 2)
SELECT activity, count(*) AS n, round(max(t), 6) AS t_max FROM ix
WHERE NOT (activity IN (SELECT activity FROM firsts) AND t > 5.0)
GROUP BY activity
""",
)
def q_cap(spark, sf_dir):
    ix = with_row_index(adapters.signal(spark, sf_dir), adapters.SIGNAL_ORDER)
    ix = elapsed_time(ix, hz=100.0, activity="activity", order=["subject", "ts", "event_id"])
    out = cl.cap_duration(ix, "t", n_act=2, seconds=5.0)
    return out.groupBy("activity").agg(F.count(F.lit(1)).alias("n"), r6(F.max("t")).alias("t_max"))


@query(
    "pool_channels",
    ["PRJ-15", "PRJ-03"],
    sql="""
SELECT vec_id AS idx,
       round(list_avg(list_transform(embedding[1:16], lambda v: CAST(v AS DOUBLE))), 6) AS p0,
       round(list_avg(list_transform(embedding[17:32], lambda v: CAST(v AS DOUBLE))), 6) AS p1,
       round(list_avg(list_transform(embedding[33:48], lambda v: CAST(v AS DOUBLE))), 6) AS p2,
       round(list_avg(list_transform(embedding[49:64], lambda v: CAST(v AS DOUBLE))), 6) AS p3
FROM embeddings
""",
)
def q_pool(spark, sf_dir):
    g = cl.pool_channels(adapters.grid(spark, sf_dir), "emg_ta", group=16, out="pooled")
    return g.select("idx", *[r6(F.col("pooled")[k]).alias(f"p{k}") for k in range(4)])


@query(
    "validate_channels",
    ["PRJ-02"],
    sql="""
SELECT count(*) AS n_rows, CAST(count(*) FILTER (WHERE coalesce(len(embedding), -1) <> 64) AS BIGINT) AS bad_emg_ta
FROM embeddings
""",
)
def q_validate(spark, sf_dir):
    return cl.validate_channels(adapters.grid(spark, sf_dir), {"emg_ta": 64}, mode="report")


@query(
    "select_sensors",
    ["PRJ-01", "PRJ-03", "AGG-01"],
    sql="""
SELECT l_returnflag || l_linestatus AS activity, count(*) AS n,
       round(avg((abs(l_quantity) + abs(l_extendedprice) + abs(l_discount) + abs(l_tax)) / 4), 6) AS mav
FROM lineitem GROUP BY 1
""",
)
def q_select_sensors(spark, sf_dir):
    r = adapters.reps(spark, sf_dir)
    chans = resolve_channels(r.columns, "exact_list", adapters.REPS_CHANNELS)
    s = r.select("activity", F.array(*chans).alias("sensors"))
    return s.groupBy("activity").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg(row_abs_mean("sensors"))).alias("mav")
    )


@query(
    "coerce_numeric",
    ["PRJ-05"],
    sql="""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, event_type FROM events
""",
)
def q_coerce(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"), "event_type"
    )
    return cl.coerce_numeric(ev)


@query(
    "profile_types",
    ["PRJ-06"],
    sql="SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_columns, CAST(3 AS BIGINT) AS n_numeric, CAST(3 AS BIGINT) AS n_categorical FROM events",
)
def q_profile(spark, sf_dir):
    return cl.profile_types(table(spark, sf_dir, "events"))


@query(
    "head_samples",
    ["SRC-17"],
    sql=f"""
WITH {SIG_SQL}, ix AS (SELECT *, {sql_index(GLOBAL_ORDER)} AS idx FROM sig)
SELECT event_id, idx, round(x, 6) AS x FROM ix WHERE idx < 350
""",
)
def q_head(spark, sf_dir):
    ix = with_row_index(adapters.signal(spark, sf_dir), adapters.SIGNAL_ORDER)
    return head_samples(ix, 350).select("event_id", "idx", r6("x").alias("x"))


@query(
    "activity_activation",
    ["AGG-20"],
    sql="""
SELECT activity, ch, round(avg(v), 6) AS mean_v FROM (
  SELECT CAST(label AS VARCHAR) AS activity, CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS ch,
         CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
GROUP BY activity, ch
""",
)
def q_activation(spark, sf_dir):
    a = pf.activity_activation(adapters.grid(spark, sf_dir), "emg_ta")
    return a.select("activity", "ch", r6("mean_v").alias("mean_v"))


@query(
    "bad_channels",
    ["AGG-21"],
    sql="""
WITH long AS (SELECT CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS ch,
                     CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
med AS (SELECT ch, quantile_cont(v * v, 0.5) AS median_sq FROM long GROUP BY ch),
z AS (SELECT ch, median_sq, (median_sq - avg(median_sq) OVER ()) / (stddev_samp(median_sq) OVER () + 1e-6) AS z FROM med)
SELECT ch, round(median_sq, 6) AS median_sq, round(z, 6) AS z, abs(z) > 3 AS is_bad FROM z
""",
)
def q_bad_channels(spark, sf_dir):
    b = pf.bad_channels(adapters.grid(spark, sf_dir), "emg_ta")
    return b.select("ch", r6("median_sq").alias("median_sq"), r6("z").alias("z"), "is_bad")
