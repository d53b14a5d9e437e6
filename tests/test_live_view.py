"""The view kept in state equals ranking the sink, also after a restart."""

import os

from myosig.streaming.feed import scratch_folder
from myosig.streaming.live import read_live_view, update_live_view
from myosig.streaming.windows import live_view


def _rows(df):
    return sorted((r.series, r.window_id, r.mav, r.truth_last) for r in df.select("series", "window_id", "mav", "truth_last").collect())


def test_view_follows_the_sink(spark):
    base = scratch_folder(spark, "test_live")
    sink, ddl = os.path.join(base, "sink"), "series long, window_id long, mav double, truth_last double"
    first = [(s, w, w + s / 8, None if w % 5 == 0 else float(w)) for s in range(3) for w in range(4 + 9 * s)]
    spark.createDataFrame([*first, first[0], (1, -1, None, None)], ddl).repartition(3).write.parquet(sink)
    view = update_live_view(spark, sink, "view", base, n=10)
    assert _rows(read_live_view(spark, view).fillna(-1)) == _rows(live_view(spark, sink, 10).dropDuplicates(["series", "window_id"]).fillna(-1))
    # later: one series grows by more than the view, one by little, one is new, one is untouched
    later = [(0, w, 2.0 * w, 0.0) for w in range(4, 40)] + [(1, 13, 1.0, 1.0), (7, 0, 1.0, None)]
    spark.createDataFrame(later, ddl).repartition(2).write.mode("append").parquet(sink)
    assert update_live_view(spark, sink, "view", base, n=10) == view
    got = _rows(read_live_view(spark, view).fillna(-1))
    assert got == _rows(live_view(spark, sink, 10).dropDuplicates(["series", "window_id"]).fillna(-1))
    assert [r[1] for r in got if r[0] == 0] == list(range(30, 40))


def test_view_is_kept_by_an_aggregate_of_slots(spark):
    """No call per series: the state is that of a streaming aggregate, a key per slot, and windows come in any order."""
    base, n, ids = scratch_folder(spark, "test_live_slots"), 5, 23
    sink = os.path.join(base, "sink")
    rows = spark.range(400 * ids).selectExpr("id % 400 AS series", "id DIV 400 AS window_id", "CAST(id AS DOUBLE) AS mav", "CAST(nullif(id % 3, 0) AS DOUBLE) AS truth_last")
    rows.union(rows.where("window_id > 15")).orderBy("mav", ascending=False).write.parquet(sink)
    view = update_live_view(spark, sink, "view", base, n=n)
    got = sorted((r.series, r.window_id, r.mav, r.truth_last) for r in read_live_view(spark, view).collect())
    assert got == sorted((i % 400, i // 400, float(i), float(i % 3) or None) for i in range(400 * ids) if i // 400 >= ids - n)
    assert {r.operatorName for r in spark.read.format("state-metadata").load(view).collect()} == {"stateStoreSave"}
