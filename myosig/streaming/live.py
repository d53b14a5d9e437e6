"""STR-06: the view of every series' latest windows, kept in Spark's state store.

A second streaming query reads the windows that the first one appended and keeps, per series,
the ``n`` latest in ``n`` slots: a window's slot is its id modulo ``n``, so a new window
replaces the one that leaves the view.  A slot is a key of a streaming aggregate, the largest
of its windows: a batch reads and writes only the slots of its windows, in the JVM (a call
per series and a question to the store per window took most of the time), and the whole
sink table is never ranked again.  The view is read from the checkpoint through Spark's state
data source, at most ``n`` rows per series.

Window ids of a series run without holes, as :mod:`myosig.streaming.windows` numbers them.
Files may be read in any order and windows may repeat: a slot keeps its largest id.  Rows that only
report losses (``window_id`` below 0) and rows without a series are no windows.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from myosig.session import ensure_checkpoint_dir
from myosig.streaming.windows import ROCKSDB_PROVIDER, state_partitions


def update_live_view(
    spark: SparkSession, windows_path: str, name: str, base: str | None = None, columns: Sequence[str] = ("mav", "truth_last"), n: int = 150,
    trigger_once: bool = True,
) -> str:
    """Bring the view up to the windows in the sink table at ``windows_path``; returns the view's checkpoint.

    Called again, it goes on where the checkpoint ends.  ``columns`` are numbers or strings.
    """
    root = base or os.path.join(ensure_checkpoint_dir(spark).replace("file:", ""), "streams")
    view = os.path.join(root, name, "checkpoint")
    names = ["window_id", *columns]
    schema = spark.read.parquet(windows_path).schema
    new = spark.readStream.schema(schema).parquet(windows_path).where("window_id >= 0 AND series IS NOT NULL").select(F.col("series").cast("long").alias("series"), *names)
    settings = {"spark.sql.shuffle.partitions": str(state_partitions(spark)), "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        kept = new.groupBy("series", F.pmod("window_id", F.lit(n)).alias("slot")).agg(F.max(F.struct(*names)).alias("latest"))
        w = kept.writeStream.format("noop").option("checkpointLocation", view).outputMode("update")
        q = w.trigger(availableNow=True).start() if trigger_once else w.start()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    q.awaitTermination()
    return view


def read_live_view(spark: SparkSession, view: str) -> DataFrame:
    """(series, window_id, columns): the view as of the last finished batch."""
    state = spark.read.format("statestore").load(view)
    return state.select(F.col("key.series").alias("series"), "value.max.*")
