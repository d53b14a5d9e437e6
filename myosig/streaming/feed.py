"""SRC-12: a replayable sample feed for Structured Streaming, derived from a table.

A batch job numbers each series' samples (distributed row index) and writes
them as several Parquet files under the shared checkpoint folder; ``readStream``
with ``maxFilesPerTrigger`` then replays them as micro-batches that arrive out of
order within and across files, as a device link would, but with bounded disorder:
a row comes at most ``DISORDER`` samples of its series late, so a reader that lets
more rows than that wait gives up no sample that is still to come.  The stream reads
files by modification time, so the files get ascending times after they are written.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from myosig import adapters
from myosig.functions import broadcast_if_small
from myosig.operators.index import with_row_index
from myosig.session import ensure_checkpoint_dir
from myosig.streaming.windows import GAP_LIMIT

FEED_SCHEMA = "subject bigint, seq bigint, x double, gait double, activity string, event_id bigint, first_seq bigint, arrived timestamp"
#: Rows per feed file; at least ``MIN_FILES`` files.
FILE_ROWS = 200_000
MIN_FILES = 4
#: A micro-batch reads so many files by default, or fewer, for at least ``MIN_FILES`` batches.  Every batch rewrites the
#: rows that wait, so with short batches the work grew with the square of the feed.
BATCH_FILES = 20
#: A row comes after at most so many later samples of its series.
DISORDER = GAP_LIMIT // 2


def scratch_folder(spark: SparkSession, name: str) -> str:
    root = ensure_checkpoint_dir(spark).replace("file:", "")
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def _files(df: DataFrame) -> int:
    return max(MIN_FILES, -(-df.count() // FILE_ROWS))


def _store(spark: SparkSession, path: str) -> tuple:
    """The file system of ``path``, and a function that lists its part files in the order of their partitions."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def parts() -> list:
        found = [f for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")]
        return sorted(found, key=lambda f: int(f.getPath().getName().split("-")[1]))

    return fs, parts


def _in_turn(spark: SparkSession, path: str) -> None:
    """Ascending modification times for the part files, in the order of their partitions."""
    fs, parts = _store(spark, path)
    files = parts()
    last = max((f.getModificationTime() for f in files), default=0) // 1000 * 1000
    for i, f in enumerate(files):
        fs.setTimes(f.getPath(), last - 1000 * (len(files) - 1 - i), -1)
    times = [f.getModificationTime() for f in parts()]
    if any(a >= b for a, b in zip(times, times[1:])):
        raise RuntimeError(f"the store of {path} keeps no modification times: the feed's files would be read in any order")


def _write(spark: SparkSession, feed: DataFrame, path: str, series: str, files: int) -> str:
    """Write by sequence number plus a hashed delay under ``DISORDER``; every file is a range of that."""
    h = F.xxhash64(series, "seq")
    place = F.col("seq") + F.pmod(h, F.lit(DISORDER))
    feed.repartitionByRange(files, place, h).write.mode("overwrite").parquet(path)
    _in_turn(spark, path)
    return path


def write_feed(spark: SparkSession, sf_dir: str, path: str, start_activity: str | None = None) -> str:
    """Per-subject numbered samples, written as Parquet files with bounded disorder.

    ``start_activity`` starts every subject at its own first sample of that activity
    (a subject without it starts at its first sample); numbers stay those of the recording, and
    ``first_seq`` declares where a subject starts.
    """
    s = adapters.signal(spark, sf_dir)
    ix = with_row_index(s, adapters.SUBJECT_ORDER, series=["subject"], name="seq")
    own = F.lower(F.col("activity")) == start_activity.lower() if start_activity else F.lit(False)
    starts = ix.groupBy(F.col("subject").alias("_s")).agg(F.coalesce(F.min(F.when(own, F.col("seq"))), F.min("seq")).alias("first_seq"))
    ix = ix.join(broadcast_if_small(starts), F.col("subject").eqNullSafe(F.col("_s"))).where("seq >= first_seq")
    feed = ix.select("subject", "seq", "x", "gait", "activity", "event_id", "first_seq", F.current_timestamp().alias("arrived"))
    return _write(spark, feed, path, "subject", _files(s))


def stream_samples(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """SRC-12: the feed as a stream (fixed schema); ``max_files`` per micro-batch, by default up to ``BATCH_FILES``."""
    if max_files is None:
        max_files = max(1, min(BATCH_FILES, len(_store(spark, path)[1]()) // MIN_FILES))
    return spark.readStream.schema(FEED_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(path)


def write_grid_feed(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Electrode-grid samples (64 channels) numbered per class, written out of order."""
    g = adapters.grid(spark, sf_dir)
    ix = with_row_index(g, ["idx"], series=["label"], name="seq")
    feed = ix.select(F.col("label").cast("bigint").alias("series"), "seq", F.col("emg_ta").alias("x"), F.col("idx").cast("double").alias("t"))
    return _write(spark, feed, path, "series", _files(g))


GRID_FEED_SCHEMA = "series bigint, seq bigint, x array<float>, t double"
