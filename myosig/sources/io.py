"""SRC-01..11: reading recordings and writing feature tables, splits, metrics and logs.

Everything is Parquet / JSON / CSV through Spark's own readers and writers, so
reads get partition pruning and predicate pushdown and writes are distributed
(no file passes through the driver).  Small artefacts (schema names, label
maps, model tables) are written as single small JSON files.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_SCHEMA = T.StructType(
    [
        T.StructField("subject", T.StringType()),
        T.StructField("idx", T.LongType()),
        T.StructField("ts", T.DoubleType()),
        T.StructField("activity", T.StringType()),
        T.StructField("reps", T.IntegerType()),
        T.StructField("gait", T.DoubleType()),
        T.StructField("emg_ta", T.ArrayType(T.FloatType())),
        T.StructField("emg_gm", T.ArrayType(T.FloatType())),
        T.StructField("imu", T.ArrayType(T.FloatType())),
        T.StructField("gonio", T.ArrayType(T.FloatType())),
    ]
)

GOLDEN_SCHEMA = T.StructType(
    [
        T.StructField("features", T.ArrayType(T.DoubleType())),
        T.StructField("true_values", T.ArrayType(T.DoubleType())),
        T.StructField("pred_values", T.ArrayType(T.DoubleType())),
    ]
)


#: Folder of a row, and the number of folders, in a dataset whose partition values are hashed into folders.
FOLDER, FOLDERS = "subject_folder", "subject_folders"


def _folder(*parts: Column) -> Column:
    *values, n = parts
    return F.pmod(F.xxhash64(*values), n).cast("int")


def read_recording(spark: SparkSession, path: str, schema: T.StructType | None = SAMPLE_SCHEMA) -> DataFrame:
    """SRC-01: one recording (Parquet) with a declared schema (no inference)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_subjects(spark: SparkSession, root: str, subjects: Sequence[str] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """SRC-02: a dataset partitioned by subject, one folder each (``subject=...``) or hashed into a number of
    folders (:func:`write_features`); a subject list prunes folders at planning time in both."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.option("basePath", root).parquet(root)
    hashed = {FOLDER, FOLDERS} <= set(df.columns)
    if subjects is not None:
        df = df.where(F.col("subject").isin(list(subjects)))
        if hashed:
            kind = df.schema["subject"].dataType
            df = df.where(F.col(FOLDER).isin([_folder(F.lit(s).cast(kind), F.col(FOLDERS)) for s in subjects]))
    return df.drop(FOLDER, FOLDERS) if hashed else df


def write_features(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("subject",),
    csv_path: str | None = None,
    order: Sequence[str] = (),
    max_records_per_file: int = 5_000_000,
    folders: int | None = None,
) -> None:
    """SRC-03: the feature database as partitioned Parquet (and CSV with a header if asked).

    Rows are range-partitioned on (partition columns, order) before writing: each
    subject lands in one or a few tasks (few files per directory) while a subject
    holding a large share of the rows is still split over many tasks.

    ``folders``: the partition values are hashed into so many folders, in which their rows lie in
    order, and stay columns of the files.  A folder a value costs the driver a file to commit, list
    and open per value, so its time follows the number of values; this one does not.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = list(partition_by)
    if folders is not None:
        df_out = df.withColumn(FOLDERS, F.lit(folders)).withColumn(FOLDER, _folder(*map(F.col, keys), F.col(FOLDERS)))
        sort = [FOLDER, *keys, *order]
        ranged = df_out.repartitionByRange(n, *sort).sortWithinPartitions(FOLDERS, *sort)
        keys = [FOLDERS, FOLDER]
    else:
        ranged = df.repartitionByRange(n, *keys, *order)
    ranged.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).partitionBy(*keys).parquet(path)
    if csv_path:
        df.write.mode("overwrite").option("header", True).csv(csv_path)


def write_split(df: DataFrame, path: str, split: str = "split") -> None:
    """SRC-04: train and test in one table, partitioned by ``split``."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def write_split_info(info: DataFrame, path: str) -> None:
    """SRC-05: per-series row counts and cut positions as JSON lines."""
    info.coalesce(1).write.mode("overwrite").json(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small text file through the Hadoop FileSystem of ``path`` (HDFS, object
    stores, local), so artefacts land in the shared folder; errors are the caller's."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_schema_artifacts(
    path: str, feature_names: Sequence[str], target_names: Sequence[str], label_map: dict | None = None, spark: SparkSession | None = None
) -> None:
    """SRC-06: feature/target names and label map (driver-side metadata, a few KB)."""
    files = {"feature_names.json": list(feature_names), "target_names.json": list(target_names)}
    if label_map is not None:
        files["label_map.json"] = label_map
    for name, obj in files.items():
        target = os.path.join(path, name)
        if spark is not None:
            write_text(spark, target, json.dumps(obj))
        else:
            os.makedirs(path, exist_ok=True)
            with open(target, "w") as f:
                json.dump(obj, f)


def metrics_document(metrics: DataFrame, by: str = "activity", target: str = "target", values: Sequence[str] = ("r2", "rmse", "n")) -> DataFrame:
    """SRC-07: nested metrics {activity: {target: {r2, rmse, n}}} built with map aggregates."""
    inner = metrics.groupBy(by).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(target), F.struct(*[F.col(v) for v in values])))).alias("targets")
    )
    return inner.agg(F.map_from_entries(F.collect_list(F.struct(F.col(by), F.col("targets")))).alias("metrics"))


def write_metrics(metrics: DataFrame, path: str, **kw) -> None:
    """SRC-07: write the nested metrics document as one JSON object (bounded: activities x targets)."""
    metrics_document(metrics, **kw).coalesce(1).write.mode("overwrite").json(path)


def read_golden(spark: SparkSession, path: str) -> DataFrame:
    """SRC-09: golden vectors from a multi-line JSON array of {features, true_values, pred_values}."""
    return spark.read.schema(GOLDEN_SCHEMA).option("multiLine", True).json(path)


def save_table_model(df: DataFrame, path: str) -> None:
    """SRC-10: a model kept as a table (forest nodes, linear classes, MLP layers)."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def load_table_model(spark: SparkSession, path: str) -> DataFrame:
    """SRC-10."""
    return spark.read.parquet(path)


def save_ml_model(model, path: str) -> None:
    """SRC-10: a fitted pyspark.ml model through its MLWriter."""
    model.write().overwrite().save(path)


def write_control_log(log: DataFrame, path: str) -> None:
    """SRC-11: the control log (one row per chunk and joint) as CSV with a header."""
    log.write.mode("overwrite").option("header", True).csv(path)


def head_samples(df: DataFrame, n: int = 350, idx: str = "idx") -> DataFrame:
    """SRC-17: the first ``n`` samples by position (a predicate on the index, no sort or collect)."""
    return df.where(F.col(idx) < n)
