"""Queries: splits, sampling, label maps, folds and scalers."""

from __future__ import annotations

from pyspark.sql import functions as F

from myosig import adapters
from myosig.operators import scaling as sc
from myosig.operators import splits as sp
from myosig.operators.index import with_row_index
from myosig.operators.windows import sliding_windows
from myosig.plans.q_windows import GLOBAL_ORDER, SIG_SQL, SIGV_SQL, indexed_signal
from myosig.plans.registry import query, r6, sql_index, sql_window_ids

REPS_SQL = """r AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
                  l_returnflag || l_linestatus AS activity, l_linenumber AS reps, l_suppkey % 6 AS subject FROM lineitem)"""
REP_SPLIT_SQL = """rp AS (SELECT activity, reps,
                   CASE WHEN (row_number() OVER (PARTITION BY activity ORDER BY reps) - 1)
                             < floor(count(*) OVER (PARTITION BY activity) * 0.8) THEN 'train' ELSE 'test' END AS split
            FROM (SELECT DISTINCT activity, reps FROM r))"""
H = "md5(CAST({c} AS VARCHAR) || ':{seed}')"


@query(
    "split_by_reps",
    ["SPL-01"],
    sql=f"""
WITH {REPS_SQL}, {REP_SPLIT_SQL}
SELECT r.activity, r.reps, rp.split, count(*) AS n_rows FROM r JOIN rp USING (activity, reps) GROUP BY ALL
""",
)
def q_split_by_reps(spark, sf_dir):
    d = sp.split_by_reps(adapters.reps(spark, sf_dir), 0.8, "sorted")
    return d.groupBy("activity", "reps", "split").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "split_first_seen",
    ["SPL-02"],
    sql=f"""
WITH {SIG_SQL}, ix AS (SELECT *, {sql_index(GLOBAL_ORDER)} AS idx FROM sig),
p AS (SELECT activity, reps, min(idx) AS f FROM ix GROUP BY activity, reps)
SELECT activity, reps, CASE WHEN (row_number() OVER (PARTITION BY activity ORDER BY f, reps) - 1)
                             < floor(count(*) OVER (PARTITION BY activity) * 0.8) THEN 'train' ELSE 'test' END AS split
FROM p
""",
)
def q_split_first_seen(spark, sf_dir):
    ix = with_row_index(adapters.signal(spark, sf_dir), adapters.SIGNAL_ORDER)
    return sp.rep_split_table(ix, 0.8, "first_seen")


@query(
    "split_time_gap",
    ["SPL-03", "SRC-05"],
    sql=f"""
WITH {SIG_SQL}, g AS (SELECT subject, count(*) AS rows_total FROM sig GROUP BY subject),
c AS (SELECT subject, rows_total, CAST(floor(rows_total * 0.8) AS BIGINT) AS train_end FROM g)
SELECT subject, rows_total, CAST(0.8 AS DOUBLE) AS train_ratio, CAST(4 AS BIGINT) AS gap_samples, train_end, train_end + 4 AS test_start,
       CASE WHEN train_end >= 8 THEN CAST(floor((train_end - 8) / 4) + 1 AS BIGINT) ELSE 0 END AS train_rows,
       CASE WHEN rows_total - train_end - 4 >= 8 THEN CAST(floor((rows_total - train_end - 12) / 4) + 1 AS BIGINT) ELSE 0 END AS test_rows,
       rows_total >= 24 AND train_end >= 8 AND rows_total - (train_end + 4) >= 8 AS valid
FROM c
""",
)
def q_split_time(spark, sf_dir):
    ix = with_row_index(adapters.signal(spark, sf_dir), adapters.SUBJECT_ORDER, series=["subject"], count_name="n_rows")
    return sp.split_info(ix, 0.8, 4, 8, ["subject"], step=4)


@query(
    "split_time_rows",
    ["SPL-03"],
    sql=f"""
WITH {SIG_SQL}, ix AS (SELECT *, {sql_index('ts, event_id', 'subject')} AS idx, count(*) OVER (PARTITION BY subject) AS n FROM sig)
SELECT subject, split, count(*) AS n_rows FROM (
  SELECT subject, CASE WHEN NOT (n >= 24 AND floor(n * 0.8) >= 8 AND n - (floor(n * 0.8) + 4) >= 8) THEN NULL
                       WHEN idx < floor(n * 0.8) THEN 'train' WHEN idx >= floor(n * 0.8) + 4 THEN 'test' ELSE 'gap' END AS split
  FROM ix) GROUP BY ALL
""",
)
def q_split_time_rows(spark, sf_dir):
    ix = with_row_index(adapters.signal(spark, sf_dir), adapters.SUBJECT_ORDER, series=["subject"], count_name="n_rows")
    d = sp.split_by_time(ix, 0.8, gap=4, window=8, series=["subject"])
    return d.groupBy("subject", "split").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "split_by_class",
    ["SPL-04", "WIN-02", "AGG-13"],
    sql=f"""
WITH {SIGV_SQL},
ix AS (SELECT *, {sql_index(GLOBAL_ORDER)} AS idx, count(*) OVER () AS n_rows FROM sig),
m AS (SELECT *, unnest({sql_window_ids(7, 3, inclusive=False)}) AS window_id FROM ix),
c AS (SELECT window_id, activity, count(*) AS cnt FROM m GROUP BY window_id, activity),
w AS (SELECT window_id, activity AS label FROM (
        SELECT *, row_number() OVER (PARTITION BY window_id ORDER BY cnt DESC, activity) AS rk FROM c) WHERE rk = 1)
SELECT window_id, label, CASE WHEN (row_number() OVER (PARTITION BY label ORDER BY window_id) - 1)
                                   < floor(count(*) OVER (PARTITION BY label) * 0.8) THEN 'train' ELSE 'test' END AS split
FROM w
""",
)
def q_split_by_class(spark, sf_dir):
    ix = indexed_signal(spark, sf_dir, variants=True)
    w = sliding_windows(ix, 7, 3, inclusive_end=False, labels={"label": ("activity", "majority")})
    return sp.split_by_class(w.select("window_id", "label"), "label", ["window_id"], 0.8)


@query(
    "split_sequential",
    ["SPL-05"],
    sql="""
SELECT vec_id, CASE WHEN (row_number() OVER (ORDER BY vec_id) - 1) < floor(count(*) OVER () * 0.8) THEN 'train' ELSE 'test' END AS split
FROM embeddings
""",
)
def q_split_sequential(spark, sf_dir):
    e = with_row_index(adapters.grid(spark, sf_dir), ["idx"], name="pos", count_name="n_rows")
    return sp.split_sequential(e, 0.8, idx="pos").select(F.col("idx").alias("vec_id"), "split")


@query(
    "split_stratified",
    ["SPL-06"],
    sql=f"""
SELECT vec_id, label, CASE WHEN (row_number() OVER (PARTITION BY label ORDER BY {H.format(c='vec_id', seed=7)}, vec_id) - 1)
                                 < ceil(count(*) OVER (PARTITION BY label) * 0.2) THEN 'test' ELSE 'train' END AS split
FROM embeddings
""",
)
def q_split_stratified(spark, sf_dir):
    e = adapters.grid(spark, sf_dir).select(F.col("idx").alias("vec_id"), "label")
    return sp.split_stratified(e, "vec_id", "label", test=0.2, seed=7)


@query(
    "balanced_sample",
    ["SPL-07"],
    sql=f"""
WITH e AS (SELECT vec_id, label FROM embeddings),
cls AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS cr, count(*) OVER () AS k FROM (SELECT DISTINCT label FROM e)),
q AS (SELECT label, 100 // k + CASE WHEN cr < 100 % k THEN 1 ELSE 0 END AS quota FROM cls),
rk AS (SELECT e.vec_id, e.label, row_number() OVER (PARTITION BY e.label ORDER BY {H.format(c='e.vec_id', seed=3)}, e.vec_id) - 1 AS r
       FROM e),
pick AS (SELECT rk.vec_id, rk.label FROM rk JOIN q USING (label) WHERE rk.r < q.quota)
SELECT vec_id, label, row_number() OVER (ORDER BY {H.format(c='vec_id', seed=4)}, vec_id) - 1 AS pos FROM pick
""",
)
def q_balanced(spark, sf_dir):
    e = adapters.grid(spark, sf_dir).select(F.col("idx").alias("vec_id"), "label")
    return sp.sample_balanced(e, "vec_id", "label", total=100, seed=3).select("vec_id", "label", "pos")


@query(
    "split_distribution",
    ["AGG-18"],
    sql=f"""
WITH {REPS_SQL}, {REP_SPLIT_SQL}
SELECT activity, count(DISTINCT reps) FILTER (WHERE split = 'train') AS train_reps,
       count(DISTINCT reps) FILTER (WHERE split = 'test') AS test_reps
FROM r JOIN rp USING (activity, reps) GROUP BY activity
""",
)
def q_split_distribution(spark, sf_dir):
    d = sp.split_by_reps(adapters.reps(spark, sf_dir), 0.8)
    return sp.split_distribution(d)


@query(
    "semi_reps",
    ["JOI-01"],
    sql=f"""
WITH {REPS_SQL}, {REP_SPLIT_SQL}
SELECT activity, count(*) AS n_rows FROM r WHERE (activity, reps) IN (SELECT activity, reps FROM rp WHERE split = 'train')
GROUP BY activity
""",
)
def q_semi_reps(spark, sf_dir):
    r = adapters.reps(spark, sf_dir)
    train = sp.rep_split_table(r, 0.8).where(F.col("split") == sp.TRAIN)
    return sp.semi_reps(r, train).groupBy("activity").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "class_guard",
    ["AGG-24"],
    sql="""
WITH c AS (SELECT CAST(floor(value / 10) AS BIGINT) AS cls FROM events)
SELECT cls, count(*) AS n FROM c GROUP BY cls HAVING count(*) >= 2
""",
)
def q_class_guard(spark, sf_dir):
    s = adapters.signal(spark, sf_dir).select(F.floor(F.col("x") / 10).cast("bigint").alias("cls"))
    g = sp.class_guard(s, "cls", 2)
    return g.groupBy("cls").agg(F.count(F.lit(1)).alias("n"))


@query(
    "logo_folds",
    ["JOI-06"],
    sql=f"""
WITH {REPS_SQL}, g AS (SELECT subject, count(*) AS n_test FROM r GROUP BY subject)
SELECT CAST(row_number() OVER (ORDER BY subject) - 1 AS INT) AS fold, subject, n_test,
       CAST(sum(n_test) OVER () - n_test AS BIGINT) AS n_train FROM g
""",
)
def q_logo(spark, sf_dir):
    return sp.leave_one_group_out(adapters.reps(spark, sf_dir), "subject").withColumn("n_train", F.col("n_train").cast("bigint"))


@query(
    "encode_labels",
    ["JOI-07", "PRJ-09"],
    sql=f"""
WITH {SIGV_SQL},
m AS (SELECT activity, CAST(row_number() OVER (ORDER BY activity) - 1 AS INT) AS id
      FROM (SELECT DISTINCT activity FROM sig WHERE NOT ends_with(activity, '_')))
SELECT s.activity, coalesce(m.id, 0) AS label_id, count(*) AS n FROM sig s LEFT JOIN m USING (activity) GROUP BY ALL
""",
)
def q_encode(spark, sf_dir):
    s = adapters.signal_variants(spark, sf_dir)
    mapping = sp.label_map(s.where(~F.col("activity").endswith("_")), "activity")
    e = sp.encode_labels(s, mapping, "activity", default=0)
    return e.groupBy("activity", "label_id").agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------- scalers
CH = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "standardize_global",
    ["ML-01"],
    sql=f"""
WITH {REPS_SQL}, {REP_SPLIT_SQL},
j AS (SELECT r.*, rp.split FROM r JOIN rp USING (activity, reps)),
p AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in CH)} FROM j WHERE split = 'train')
SELECT l_orderkey, l_linenumber, split,
       {", ".join(f"round(({c} - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1 END, 6) AS z_{c}" for c in CH)}
FROM j, p
""",
)
def q_standardize_global(spark, sf_dir):
    d = sp.split_by_reps(adapters.reps(spark, sf_dir), 0.8)
    params = sc.fit_scaler(d.where(F.col("split") == sp.TRAIN), CH)
    z = sc.apply_scaler(d, params, suffix="_z")
    return z.select("l_orderkey", "l_linenumber", "split", *[r6(f"{c}_z").alias(f"z_{c}") for c in CH])


@query(
    "standardize_by_group",
    ["WIN-13", "JOI-08"],
    sql=f"""
WITH {REPS_SQL},
p AS (SELECT subject, {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in CH)} FROM r GROUP BY subject)
SELECT l_orderkey, l_linenumber, r.subject,
       {", ".join(f"round(({c} - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1 END, 6) AS z_{c}" for c in CH)}
FROM r JOIN p USING (subject)
""",
)
def q_standardize_group(spark, sf_dir):
    z = sc.standardize_by_group(adapters.reps(spark, sf_dir), ["subject"], CH, suffix="_z")
    return z.select("l_orderkey", "l_linenumber", "subject", *[r6(f"{c}_z").alias(f"z_{c}") for c in CH])


@query(
    "center_by_group",
    ["WIN-14"],
    sql=f"""
WITH {REPS_SQL}
SELECT l_orderkey, l_linenumber, subject, round(l_extendedprice - avg(l_extendedprice) OVER (PARTITION BY subject), 6) AS c_price
FROM r
""",
)
def q_center(spark, sf_dir):
    c = sc.center_by_group(adapters.reps(spark, sf_dir), ["subject"], ["l_extendedprice"], suffix="_c")
    return c.select("l_orderkey", "l_linenumber", "subject", r6("l_extendedprice_c").alias("c_price"))
