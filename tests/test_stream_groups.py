"""Live windows of many series share calls and state; each series still gets exactly its own windows."""

import os

import numpy as np
import pandas as pd

from myosig.streaming import windows as sw
from myosig.streaming.feed import scratch_folder

COLUMNS = ["series", "known", "seq", "x", "t", "origin", "arrived"]


class Held:
    exists, get = False, None

    def update(self, value):
        self.exists, self.get = True, value


def one_series(batches, size, step, limit):
    """The rule for one series, row by row: (windows, dropped, missing) of every batch."""
    nxt, nwin, buf, pend, out = None, 0, [], {}, []
    for rows in batches:
        wins, dropped, missing = [], 0, 0
        for seq, x, origin in rows:
            nxt = origin if nxt is None else nxt
            if seq < nxt or seq in pend:
                dropped += 1
            else:
                pend[seq] = x
        while True:
            while nxt in pend:
                buf.append((nxt, pend.pop(nxt)))
                nxt += 1
            while len(buf) >= size:
                w = np.array([v for _, v in buf[:size]])
                wins.append((nwin, buf[0][0], buf[size - 1][0], round(np.abs(w).mean(), 9)))
                nwin, buf = nwin + 1, buf[step:]
            if len(pend) <= limit:
                break
            missing, nxt, buf = missing + min(pend) - nxt, min(pend), []
        out.append((wins, dropped, missing))
    return out


def test_a_group_of_series_follows_the_rule_of_each():
    rng, size, step, limit = np.random.default_rng(3), 8, 3, 5
    fn, state = sw._window_step(size, step, limit), Held()
    feeds = {}
    for s in [None, -4, 0, 2, 3, 9]:
        seq = np.arange(5, 5 + int(rng.integers(20, 90)))
        seq = seq[rng.random(len(seq)) > (0.08 if s in (2, 9) else 0)]
        seq = np.concatenate([seq, rng.choice(seq, 6)])
        seq = seq[np.argsort(seq + rng.integers(0, 4, len(seq)), kind="stable")]
        feeds[s] = [(int(q), float(rng.normal()), 5) for q in seq]
    late = feeds[9]
    cut = {s: [f[i::4] if s == 3 else f[i * len(f) // 4 : (i + 1) * len(f) // 4] for i in range(4)] for s, f in feeds.items()}
    cut[9] = [[], late[: len(late) // 2], [], late[len(late) // 2 :]]  # seen late, and not in every batch
    want = {s: one_series([b for b in f if b], size, step, limit) for s, f in cut.items()}
    turn = dict.fromkeys(feeds, 0)
    for b in range(4):
        rows = [(0 if s is None else s, s is not None, q, [x], q / 2, o, 1.0) for s, f in cut.items() for q, x, o in f[b]]
        frame = pd.DataFrame(rows, columns=COLUMNS)
        got = pd.concat(list(fn((0,), iter([frame.iloc[: len(frame) // 2], frame.iloc[len(frame) // 2 :]]), state)))
        for s, f in cut.items():
            mine = got[got["series"].isna()] if s is None else got[got["series"] == s]
            if not f[b]:
                assert mine.empty
                continue
            wins, dropped, missing = want[s][turn[s]]
            turn[s] += 1
            real = mine[mine["window_id"] >= 0]
            assert [(r.window_id, r.start_seq, r.end_seq, round(r.mav, 9)) for r in real.itertuples()] == wins
            assert (real["truth_last"] == real["end_seq"] / 2).all()
            assert (mine["n_dropped"].sum(), mine["n_missing"].sum()) == (dropped, missing)
    assert any(m for w in want.values() for _, _, m in w) and any(d for w in want.values() for _, d, _ in w)


def test_state_and_calls_do_not_follow_the_number_of_series(spark):
    """Short series over several batches: one value of state per group, not per series."""
    base, n, rows = scratch_folder(spark, "test_groups"), 3 * sw.GROUPS, 12
    feed = spark.range(n * rows).selectExpr(f"CAST(id % {n} AS BIGINT) AS s", f"CAST(id DIV {n} AS BIGINT) AS seq", "CAST(id AS DOUBLE) AS x", "CAST(1 AS DOUBLE) AS t")
    feed = feed.selectExpr("nullif(s, 7) AS s", "seq", "x", "t")  # a series without a name is one too
    feed.repartition(2).write.parquet(os.path.join(base, "feed"))
    sdf = spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(base, "feed"))
    path = sw.run_to_table(spark, sw.stream_windows(sdf, 8, 4, series="s"), "w", base)
    got = {(r.series, r.window_id): r.mean_x for r in sw.complete_windows(spark, path).collect()}
    assert got == {(None if s == 7 else s, w): s + n * (4 * w + 3.5) for s in range(n) for w in range(2)}
    assert spark.read.format("statestore").load(os.path.join(base, "w", "checkpoint")).count() <= sw.GROUPS


def test_samples_as_numbers_give_the_windows_of_arrays_of_one():
    """Numbers and arrays of one number: the same windows, losses and state."""
    rng, held = np.random.default_rng(4), (Held(), Held())
    fns = sw._window_step(4, 2, 6), sw._window_step(4, 2, 6, True)
    for b in range(4):
        seq = rng.permutation(np.concatenate([np.arange(b * 9, b * 9 + 14)] * 5))  # some come again
        s = rng.choice([-3, 0, 0, 5, 8], len(seq))
        known = rng.random(len(seq)) > 0.2
        x = np.where(rng.random(len(seq)) > 0.1, rng.normal(size=len(seq)), np.nan)
        frame = pd.DataFrame({"series": np.where(known, s, 0), "known": known, "seq": seq, "x": x, "t": seq / 2, "origin": b * 9, "arrived": 1.0})
        arrays = frame.assign(x=[[v] for v in x])
        want = [p.assign(mean_x=[m if m is None else m[0] for m in p["mean_ch"]]) for p in fns[0]((0,), iter([arrays]), held[0])]
        got = list(fns[1]((0,), iter([frame]), held[1]))
        assert len(got) == len(want) and sum(map(len, got))
        for g, w in zip(got, want):
            assert list(g.columns) == [c.replace("mean_ch", "mean_x") for c in sw._OUT]
            pd.testing.assert_frame_equal(g, w[list(g.columns)], check_dtype=False)
    assert held[0].get == held[1].get


def test_batches_and_state_stores_do_not_follow_the_feed(spark, monkeypatch):
    """Many files are read in few micro-batches, and state stores follow the cores, not the shuffle partitions."""
    from myosig import adapters
    from myosig.streaming import feed as fd

    n, each = 60, 40
    sig = spark.range(n * each).selectExpr(
        "id AS event_id", "timestamp_seconds(id) AS ts", f"CAST(id % {n} AS BIGINT) AS subject", "'walk' AS activity", "1 AS reps", "CAST(0 AS DOUBLE) AS gait", "CAST(id AS DOUBLE) AS x"
    )
    monkeypatch.setattr(adapters, "signal", lambda spark, sf_dir: sig)
    monkeypatch.setattr(fd, "FILE_ROWS", 40)
    base = fd.scratch_folder(spark, "test_batches")
    parts, before = 4 * spark.sparkContext.defaultParallelism + 7, spark.conf.get("spark.sql.shuffle.partitions")
    path = fd.write_feed(spark, "", os.path.join(base, "feed"))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        out = sw.run_to_table(spark, sw.stream_windows(fd.stream_samples(spark, path), 8, 4, series="subject", truth="gait"), "w", base)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    got = {(r.series, r.window_id): r.mean_x for r in sw.complete_windows(spark, out).collect()}
    assert got == {(s, w): s + n * (4 * w + 3.5) for s in range(n) for w in range(each // 4 - 1)}
    ckpt = os.path.join(base, "w", "checkpoint")
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    batches = [f for f in os.listdir(os.path.join(ckpt, "commits")) if f.isdigit()]
    assert len(files) > 50 and fd.MIN_FILES <= len(batches) <= -(-len(files) // min(fd.BATCH_FILES, len(files) // fd.MIN_FILES))
    assert spark.read.format("state-metadata").load(ckpt).first()["numPartitions"] < parts
