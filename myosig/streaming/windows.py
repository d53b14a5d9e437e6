"""STR-01..07: row-count sliding windows on a live sample stream.

Samples arrive with a per-series sequence number, because Spark gives no order across
files or partitions.  Each series (device/subject) keeps in Spark's state store:

* ``next_seq`` -- the next sample number it expects, first its *origin*: a declared number
  or a column of the feed.  Rows before it are duplicates and dropped (and counted);
* ``pending`` -- rows after a gap, waiting for it to be filled.  At most ``gap_limit`` rows
  wait: beyond, the missing samples are given up (and counted), the incomplete window is
  dropped and a new run starts at the first row that waits, so a series that lost a sample
  or started late goes on, and state stays bounded;
* the carry-over buffer -- the last ``size - step`` samples of the previous window
  (STR-02), so the next window can be completed;
* ``next_win`` -- the id of the next window to emit.

A window is emitted only when all ``size`` samples are present (STR-03: an incomplete tail
is never emitted).  Windows start every ``step`` samples of a run and are never dropped
for crossing a label boundary, so a stream without gaps equals batch
:func:`myosig.operators.windows.sliding_windows` with ``purity=None`` over the same
per-series positions.

Series are dealt by hash into ``GROUPS`` groups: short series get about one row a batch, and a call
per series and batch took most of the time.  The group function is a numpy helper over the new rows
of all series of a group, and their state is one value; the shuffle by group, the state store and
fault tolerance are Spark's.
"""

from __future__ import annotations

import os
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from myosig.session import ensure_checkpoint_dir

# State lives in RocksDB (off-heap, spills to local disk, checkpointed incrementally).
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Rows that may wait for a missing sample of their series.  It must be over the disorder of the
#: source (rows of a series that may overtake one of its samples), or samples still to come are given up.
GAP_LIMIT = 4096

OUT_SCHEMA = (
    "series long, window_id long, start_seq long, end_seq long, mav double, rms double, mean_ch array<double>, "
    "truth_last double, arrived_last double, n_dropped long, n_missing long"
)
_OUT = [c.split()[0] for c in OUT_SCHEMA.split(", ")]
#: The same for one channel, whose samples come and go as numbers: arrays would be handled row by row.
ONE_SCHEMA = OUT_SCHEMA.replace("mean_ch array<double>", "mean_x double")
#: Per number of channels the arrays of all series of a group: next_seq, next_win, buffered and pending rows.
STATE_SCHEMA = "arrays binary"
#: Series are dealt by hash into so many groups, fixed for the life of a checkpoint: a call of the
#: group function costs milliseconds, so its number must not follow the number of series.
GROUPS = 512
#: State stores per core at most.
TASKS_PER_CORE = 4
_ROWS = ("own", "seq", "x", "t", "a")


def _taken(rows: dict, which: np.ndarray) -> dict:
    return {c: v[which] for c, v in rows.items()}


def _joined(parts: list[dict]) -> dict:
    return {c: np.concatenate([p[c] for p in parts]) for c in _ROWS}


def _places(own: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows sorted by series: the first row and the number of rows of every series, every row's place in its own."""
    count = np.bincount(own, minlength=n)
    first = np.cumsum(count) - count
    return first, count, np.arange(len(own)) - first[own]


def _advance(size: int, step: int, state: dict) -> dict:
    """Move the rows that follow on from the buffers out of ``pend``, and cut the windows that are complete."""
    n, pend = len(state["nxt"]), state["pend"]
    _, count, place = _places(pend["own"], n)
    run = count.copy()
    np.minimum.at(run, pend["own"], np.where(pend["seq"] == state["nxt"][pend["own"]] + place, run[pend["own"]], place))
    follows = place < run[pend["own"]]
    buf = _joined([state["buf"], _taken(pend, follows)])
    buf = _taken(buf, np.argsort(buf["own"], kind="stable"))  # a series' buffered rows come before its new ones
    state["pend"], state["nxt"] = _taken(pend, ~follows), state["nxt"] + run
    first, count, place = _places(buf["own"], n)
    windows = np.where(count < size, 0, (count - size) // step + 1)
    own = np.repeat(np.arange(n), windows)
    nth = np.arange(len(own)) - (np.cumsum(windows) - windows)[own]
    start = first[own] + nth * step
    last = start + size - 1
    w = buf["x"][start[:, None] + np.arange(size)[None, :]]  # windows, samples, channels
    out = {
        "own": own, "window_id": state["win"][own] + nth, "start_seq": buf["seq"][start], "end_seq": buf["seq"][last],
        "mav": np.abs(w).mean(axis=(1, 2)), "rms": np.sqrt((w * w).mean(axis=(1, 2))), "mean_ch": w.mean(axis=1),
        "truth_last": buf["t"][last], "arrived_last": buf["a"][last],
    }
    state["buf"], state["win"] = _taken(buf, place >= (windows * step)[buf["own"]]), state["win"] + windows
    return out


def _new_rows(frame: pd.DataFrame, x: np.ndarray) -> dict:
    f = {c: frame[c].to_numpy() for c in ("known", "series", "seq", "origin")}
    return {"known": f["known"].astype(bool), "series": f["series"].astype("int64"), "seq": f["seq"].astype("int64"), "origin": f["origin"], "x": x, "t": frame["t"].to_numpy(dtype="float64"), "a": frame["arrived"].to_numpy(dtype="float64")}


def _empty(ch: int) -> dict:
    none, whole = np.empty(0), np.empty(0, np.int64)
    rows = {"own": whole, "seq": whole, "x": np.empty((0, ch)), "t": none, "a": none}
    return {"known": np.empty(0, bool), "series": whole, "nxt": whole, "win": whole, "buf": rows, "pend": rows}


def _with_series(state: dict, new: dict) -> np.ndarray:
    """Add the series seen first, by (known, series) and from their first row's origin; the place of every new row's series."""
    n = len(state["nxt"])
    known, series = (np.concatenate([state[c], new[c]]) for c in ("known", "series"))
    order = np.lexsort((series, known))  # stable: a series' place is that of its first row
    known, series = known[order], series[order]
    starts = np.concatenate([[True], (known[1:] != known[:-1]) | (series[1:] != series[:-1])])
    first, place = order[starts], np.empty(len(order), np.int64)
    place[order] = np.cumsum(starts) - 1
    held, seen = place[:n], first[first >= n] - n
    if pd.isna(new["origin"][seen]).any():
        raise ValueError("a series declares no origin")
    fresh = np.flatnonzero(first >= n)

    def spread(old, values):
        out = np.empty(len(first), old.dtype)
        out[held], out[fresh] = old, values
        return out

    state["known"], state["series"] = known[starts], series[starts]
    state["nxt"], state["win"] = spread(state["nxt"], new["origin"][seen].astype(np.int64)), spread(state["win"], 0)
    for side in ("buf", "pend"):  # the order of the series held does not change
        state[side] = {**state[side], "own": held[state[side]["own"]]}
    return place[n:]


def _window_step(size: int, step: int, gap_limit: int, one: bool = False):
    """The group function; ``one``: samples are numbers (``ONE_SCHEMA``), not arrays."""
    names_out = [c.replace("mean_ch", "mean_x") for c in _OUT] if one else _OUT
    if not 0 < step <= size:
        raise ValueError("need 0 < step <= size")

    def of_channels(state: dict, new: dict):
        """The windows (and losses) of the new rows of a group, for series with the same number of channels."""
        own = _with_series(state, new)
        n, held = len(state["nxt"]), len(state["pend"]["own"])
        pend = _joined([state["pend"], {"own": own, **{c: new[c] for c in _ROWS[1:]}}])
        order = np.lexsort((pend["seq"], pend["own"]))  # stable: of repeated samples the first one stays
        pend = _taken(pend, order)
        again = np.zeros(len(order), bool)
        again[1:] = (pend["own"][1:] == pend["own"][:-1]) & (pend["seq"][1:] == pend["seq"][:-1])
        keep = ~again & (pend["seq"] >= state["nxt"][pend["own"]])
        dropped, missing = np.bincount(pend["own"][~keep], minlength=n), np.zeros(n, np.int64)
        state["pend"] = _taken(pend, keep)
        outs = [_advance(size, step, state)]
        while (over := np.bincount(state["pend"]["own"], minlength=n) > gap_limit).any():
            # series that wait for too long: on from the first row that waits, the others aside
            mine = {side: over[state[side]["own"]] for side in ("buf", "pend")}
            aside = {side: _taken(state[side], ~mine[side]) for side in mine}
            state["pend"] = _taken(state["pend"], mine["pend"])
            first = _places(state["pend"]["own"], n)[0][over]
            start = state["pend"]["seq"][first]
            missing[over] += start - state["nxt"][over]
            state["nxt"][over] = start
            state["buf"] = _taken(state["buf"], np.zeros(len(state["buf"]["own"]), bool))
            outs.append(_advance(size, step, state))
            for side, rest in aside.items():
                rows = _joined([rest, state[side]])
                state[side] = _taken(rows, np.argsort(rows["own"], kind="stable"))
        out = {c: np.concatenate([o[c] for o in outs]) for c in outs[0]}
        lost = (dropped > 0) | (missing > 0)
        own, count = out["own"], len(out["own"])
        ends = np.full(n, -1)
        ends[own] = np.arange(count)  # a series' last window of this call
        counts = {"n_dropped": np.zeros(count, np.int64), "n_missing": np.zeros(count, np.int64)}
        told = np.flatnonzero(lost & (ends >= 0))
        counts["n_dropped"][ends[told]], counts["n_missing"][ends[told]] = dropped[told], missing[told]
        names = pd.Series(state["series"]).where(pd.Series(state["known"]), None).astype("Int64")
        frame = {**out, **counts, **({"mean_x": out["mean_ch"][:, 0]} if one else {"mean_ch": list(out["mean_ch"])})}
        yield pd.DataFrame({"series": names.take(own).array, **{c: frame[c] for c in names_out[1:]}})
        silent = np.flatnonzero(lost & (ends < 0))
        if len(silent):
            rows = [(names[i], -1, -1, -1, None, None, None, None, None, dropped[i], missing[i]) for i in silent.tolist()]
            yield pd.DataFrame(rows, columns=names_out).astype({"series": "Int64"})

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState):
        states = pickle.loads(state.get[0]) if state.exists else {}
        frames = [p for p in pdfs if len(p)]
        frame = pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0]
        if one:
            yield from of_channels(states.setdefault(1, _empty(1)), _new_rows(frame, frame["x"].to_numpy(dtype="float64")[:, None]))
            state.update((pickle.dumps(states, protocol=5),))
            return
        xs = [np.asarray(v, dtype="float64") for v in frame["x"]]
        widths = np.array([len(v) for v in xs])
        for ch in np.unique(widths).tolist():
            rows = np.flatnonzero(widths == ch)
            mine = frame if len(rows) == len(frame) else frame.iloc[rows]
            own = states.setdefault(ch, _empty(ch))
            yield from of_channels(own, _new_rows(mine, np.concatenate([xs[i] for i in rows.tolist()]).reshape(-1, ch)))
        if len(states) > 1:
            every = np.concatenate([np.rec.fromarrays([s["known"], s["series"]]) for s in states.values()])
            if len(np.unique(every)) < len(every):
                raise ValueError("a series has samples of different numbers of channels")
        state.update((pickle.dumps(states, protocol=5),))

    return fn


def _stream(
    sdf: DataFrame, size: int, step: int, series: str, seq: str, x: str, truth: str, one: bool,
    origin: int | str = 0, arrived: str | None = None, gap_limit: int = GAP_LIMIT,
) -> DataFrame:
    s = sdf.select(
        F.coalesce(F.col(series).cast("long"), F.lit(0)).alias("series"), F.col(series).isNotNull().alias("known"), F.col(seq).cast("long").alias("seq"), F.col(x).cast("double" if one else "array<double>").alias("x"), F.col(truth).cast("double").alias("t"),
        (F.col(origin) if isinstance(origin, str) else F.lit(origin)).cast("long").alias("origin"),
        (F.unix_micros(F.col(arrived).cast("timestamp")) / 1e6 if arrived else F.lit(None)).cast("double").alias("arrived"),
    )
    return s.withColumn("_group", F.pmod(F.xxhash64("series", "known"), F.lit(GROUPS))).groupBy("_group").applyInPandasWithState(
        _window_step(size, step, gap_limit, one), ONE_SCHEMA if one else OUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout
    )


def stream_block_windows(sdf: DataFrame, size: int, step: int, series: str = "series", seq: str = "seq", x: str = "x", truth: str = "t", **kw) -> DataFrame:
    """STR-01/02/03/05 for multi-channel samples (``x`` is an array per sample, e.g. an electrode grid):
    per window MAV and RMS over all samples and channels, the mean of every channel, the truth
    and arrival time (epoch seconds, of the column ``arrived``) at its last sample.

    ``origin`` (default 0): a series' first sequence number, or the column that declares it.
    ``gap_limit``: rows that may wait for a missing sample of their series.
    Rows with ``window_id = -1`` only report dropped duplicates or samples given up.
    """
    return _stream(sdf, size, step, series, seq, x, truth, False, **kw)


def stream_windows(sdf: DataFrame, size: int, step: int, series: str = "series", seq: str = "seq", x: str = "x", truth: str = "t", **kw) -> DataFrame:
    """The same for one channel (``x`` a number): ``mean_x`` instead of ``mean_ch``."""
    return _stream(sdf, size, step, series, seq, x, truth, True, **kw)


def add_latency(df: DataFrame) -> DataFrame:
    """STR-07: emission time of each window, and milliseconds since its last sample arrived."""
    out = df.withColumn("emitted_at", F.current_timestamp())
    return out.withColumn("latency_ms", F.unix_micros("emitted_at") / 1000.0 - F.col("arrived_last") * 1000.0)


def state_partitions(spark: SparkSession) -> int:
    """Stateful shuffles are not coalesced by AQE and their partition count is fixed for the
    life of the checkpoint: the session's shuffle partitions, which the user sizes to the data,
    but at most ``TASKS_PER_CORE`` a core: every one commits a state store in every micro-batch."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)


def run_to_table(
    spark: SparkSession, sdf: DataFrame, name: str, base: str | None = None, trigger_once: bool = True, partitions: int | None = None
) -> str:
    """SRC-13: run a streaming frame to a Parquet table in the shared checkpoint folder
    (append sink, exactly-once through the query checkpoint); returns the table path.

    ``partitions`` (default :func:`state_partitions`) is the state-store partition
    count recorded in the checkpoint when the query first starts."""
    root = base or os.path.join(ensure_checkpoint_dir(spark).replace("file:", ""), "streams")
    path = os.path.join(root, name, "data")
    ckpt = os.path.join(root, name, "checkpoint")
    w = sdf.writeStream.format("parquet").option("path", path).option("checkpointLocation", ckpt).outputMode("append")
    # Both settings are recorded in the checkpoint when the query first starts.
    settings = {
        "spark.sql.shuffle.partitions": str(partitions or state_partitions(spark)),
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        q = w.trigger(availableNow=True).start() if trigger_once else w.start()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    q.awaitTermination()
    return path


def complete_windows(spark: SparkSession, path: str) -> DataFrame:
    """The windows of the sink table; fails if the stream gave up any sample."""
    t = spark.read.parquet(path)
    n = t.agg(F.sum("n_missing")).first()[0]
    if n:
        raise RuntimeError(f"the stream gave up {n} samples: its gap limit is under the disorder of its source")
    return t.where(F.col("window_id") >= 0)


def live_view(spark: SparkSession, path: str, n: int = 150) -> DataFrame:
    """STR-06: the most recent ``n`` windows per series from the sink table."""
    from myosig.operators.sequence import last_n

    t = spark.read.parquet(path).where(F.col("window_id") >= 0)
    return last_n(t, n, ["window_id"], series=["series"])
