"""Query: live windows on a replayed sample stream (checked against the batch definition)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from myosig.models import trees
from myosig.plans.q_sequence import control_tree
from myosig.plans.q_windows import SIG_SQL
from myosig.plans.registry import query, r6, sql_index, sql_window_ids
from myosig.streaming import feed as fd
from myosig.streaming.live import read_live_view, update_live_view
from myosig.streaming.windows import complete_windows, run_to_table, stream_windows


def _stream_sql() -> str:
    nodes = control_tree()
    p0 = trees.forest_sql(nodes, ["mav", "mean_x"], 0)
    return f"""
WITH {SIG_SQL},
ix AS (SELECT *, {sql_index('ts, event_id', 'subject')} AS idx, count(*) OVER (PARTITION BY subject) AS n_rows FROM sig),
m AS (SELECT *, unnest({sql_window_ids(8, 4)}) AS window_id FROM ix),
w AS (SELECT subject AS series, window_id, avg(abs(x)) AS mav, avg(x) AS mean_x, max_by(gait, idx) AS truth_last
      FROM m GROUP BY subject, window_id)
SELECT series, window_id, window_id * 4 AS start_seq, window_id * 4 + 7 AS end_seq, round(mav, 6) AS mav,
       round(mean_x, 6) AS mean_x, round(truth_last, 6) AS truth_last, round({p0}, 6) AS pred
FROM w"""


@query("stream_windows", ["STR-01", "STR-02", "STR-03", "STR-04", "STR-05", "SRC-12", "SRC-13"], sql=_stream_sql())
def q_stream_windows(spark, sf_dir):
    base = fd.scratch_folder(spark, "stream_windows")
    path = fd.write_feed(spark, sf_dir, os.path.join(base, "feed"))
    sdf = fd.stream_samples(spark, path)
    w = stream_windows(sdf, 8, 4, series="subject", seq="seq", x="x", truth="gait")
    (p0,) = trees.forest_expr(control_tree(), ["mav", "mean_x"], 1)[:1]
    scored = w.withColumn("pred", p0)  # STR-04: stateless scoring of each emitted window
    t = complete_windows(spark, run_to_table(spark, scored, "windows", base))
    return t.select(
        "series", "window_id", "start_seq", "end_seq", r6("mav").alias("mav"), r6("mean_x").alias("mean_x"),
        r6("truth_last").alias("truth_last"), r6("pred").alias("pred"),
    )


_START = f"""
WITH {SIG_SQL},
n AS (SELECT *, {sql_index('ts, event_id', 'subject')} AS seq FROM sig),
o AS (SELECT *, coalesce(min(seq) FILTER (WHERE lower(activity) = 'purchase') OVER (PARTITION BY subject), 0) AS first_seq FROM n),
ix AS (SELECT *, seq - first_seq AS idx, count(*) OVER (PARTITION BY subject) AS n_rows FROM o WHERE seq >= first_seq),
m AS (SELECT *, unnest({sql_window_ids(8, 4)}) AS window_id FROM ix)
SELECT subject AS series, window_id, min(seq) AS start_seq, max(seq) AS end_seq, round(avg(x), 6) AS mean_x, round(sqrt(avg(x * x)), 6) AS rms
FROM m GROUP BY subject, window_id
"""


@query("stream_from_activity", ["SRC-12", "STR-01", "STR-03"], sql=_START)
def q_stream_from_activity(spark, sf_dir):
    """Every subject's stream starts at its first 'purchase' sample, wherever that is."""
    base = fd.scratch_folder(spark, "from_activity")
    sdf = fd.stream_samples(spark, fd.write_feed(spark, sf_dir, os.path.join(base, "feed"), start_activity="Purchase"))
    w = stream_windows(sdf, 8, 4, series="subject", truth="gait", origin="first_seq")
    t = complete_windows(spark, run_to_table(spark, w, "windows", base))
    return t.select("series", "window_id", "start_seq", "end_seq", r6("mean_x").alias("mean_x"), r6("rms").alias("rms"))


_LIVE = f"""
WITH {SIG_SQL},
ix AS (SELECT *, {sql_index('ts, event_id', 'subject')} AS idx, count(*) OVER (PARTITION BY subject) AS n_rows FROM sig),
m AS (SELECT *, unnest({sql_window_ids(8, 4)}) AS window_id FROM ix),
w AS (SELECT subject AS series, window_id, round(avg(abs(x)), 6) AS mav, round(max_by(gait, idx), 6) AS truth_last FROM m GROUP BY subject, window_id)
SELECT series, window_id, mav, truth_last, true AS latency_ok FROM w
QUALIFY row_number() OVER (PARTITION BY series ORDER BY window_id DESC) <= 150
"""


@query("stream_live_view", ["STR-06", "STR-07", "WIN-12", "SRC-13"], sql=_LIVE)
def q_stream_live_view(spark, sf_dir):
    """The last 150 windows per series; the latency since arrival is a processing time, so it is only checked to be sane."""
    from myosig.streaming.windows import add_latency, live_view

    base = fd.scratch_folder(spark, "live_view")
    sdf = fd.stream_samples(spark, fd.write_feed(spark, sf_dir, os.path.join(base, "feed")))
    w = stream_windows(sdf, 8, 4, series="subject", seq="seq", x="x", truth="gait", arrived="arrived")
    path = run_to_table(spark, add_latency(w), "windows", base)
    complete_windows(spark, path)
    out = live_view(spark, path, n=150)
    ok = (F.col("latency_ms") >= 0) & (F.col("latency_ms") < 24 * 3600 * 1000)
    return out.select("series", "window_id", r6("mav").alias("mav"), r6("truth_last").alias("truth_last"), ok.alias("latency_ok"))


@query("stream_live_state", ["STR-06", "STR-01", "SRC-13"], sql=_LIVE.replace(", true AS latency_ok", ""))
def q_stream_live_state(spark, sf_dir):
    """The last 150 windows per series from the state of a second stream, which reads the first one's sink."""
    base = fd.scratch_folder(spark, "live_state")
    sdf = fd.stream_samples(spark, fd.write_feed(spark, sf_dir, os.path.join(base, "feed")))
    path = run_to_table(spark, stream_windows(sdf, 8, 4, series="subject", seq="seq", x="x", truth="gait"), "windows", base)
    complete_windows(spark, path)
    view = read_live_view(spark, update_live_view(spark, path, "view", base, n=150))
    return view.select("series", "window_id", r6("mav").alias("mav"), r6("truth_last").alias("truth_last"))


@query(
    "stream_grid_windows",
    ["STR-01", "STR-02", "STR-03", "STR-05", "AGG-01", "AGG-03", "SRC-12"],
    sql=f"""
WITH g AS (SELECT label AS series, vec_id, embedding, {sql_index('vec_id', 'label')} AS idx,
                  count(*) OVER (PARTITION BY label) AS n_rows FROM embeddings),
m AS (SELECT *, unnest({sql_window_ids(8, 4)}) AS window_id FROM g),
l AS (SELECT series, window_id, idx, vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS ch,
             CAST(unnest(embedding) AS DOUBLE) AS v FROM m)
SELECT CAST(series AS BIGINT) AS series, window_id, round(avg(abs(v)), 6) AS mav,
       round(avg(v) FILTER (WHERE ch = 0), 6) AS mean_c0, round(avg(v) FILTER (WHERE ch = 63), 6) AS mean_c63,
       round(CAST(max(vec_id) AS DOUBLE), 6) AS truth_last
FROM l GROUP BY series, window_id
""",
)
def q_stream_grid(spark, sf_dir):
    from myosig.streaming.windows import stream_block_windows

    base = fd.scratch_folder(spark, "stream_grid")
    path = fd.write_grid_feed(spark, sf_dir, os.path.join(base, "feed"))
    sdf = spark.readStream.schema(fd.GRID_FEED_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    w = stream_block_windows(sdf, 8, 4, series="series", seq="seq", x="x", truth="t")
    t = complete_windows(spark, run_to_table(spark, w, "windows", base))
    return t.select(
        "series", "window_id", r6("mav").alias("mav"), r6(F.col("mean_ch")[0]).alias("mean_c0"),
        r6(F.col("mean_ch")[63]).alias("mean_c63"), r6("truth_last").alias("truth_last"),
    )
