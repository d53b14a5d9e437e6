"""The feature store with more subjects than folders."""

import os

from pyspark.sql import functions as F

from myosig.plans import q_more
from myosig.sources import io


def test_subjects_share_folders(spark, tmp_path):
    names = [f"{i:03d}" for i in range(200)] + ["", "7", None]
    df = spark.createDataFrame([(s, k, k * 0.5) for s in names for k in range(3)], "subject string, window_id long, v double")
    path = str(tmp_path / "store")
    io.write_features(df, path, order=["window_id"], folders=8)
    assert len(os.listdir(f"{path}/subject_folders=8")) <= 8
    back = io.read_subjects(spark, path)
    assert sorted(map(str, back.select(*df.columns).collect())) == sorted(map(str, df.collect())) and sorted(back.columns) == sorted(df.columns)
    some = io.read_subjects(spark, path, ["007", "7", "nobody"])
    assert sorted(r.subject for r in some.collect()) == ["007"] * 3 + ["7"] * 3
    # files of other folders are not read
    near = {r[0] for r in some.select(F.input_file_name()).collect()}
    scan = some._jdf.queryExecution().executedPlan().toString()
    assert len(near) <= 2 and "subject_folder" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_numbers_find_their_folder(spark, tmp_path):
    df = spark.range(100).select(F.col("id").alias("subject"), F.lit(0).alias("window_id"))
    io.write_features(df, str(tmp_path / "n"), folders=16)
    assert sorted(r.subject for r in io.read_subjects(spark, str(tmp_path / "n"), ["3", "42", "99"]).collect()) == [3, 42, 99]
    io.write_features(df.where("subject < 3"), str(tmp_path / "each"))
    assert {r.subject for r in io.read_subjects(spark, str(tmp_path / "each"), ["1"]).collect()} == {1}


def test_store_of_many_subjects_has_few_folders(spark, tmp_path, monkeypatch):
    events = spark.range(1500).select(
        F.col("id").alias("event_id"), F.timestamp_seconds("id").alias("ts"), (F.col("id") % 150).alias("user_id"),
        F.lit("a").alias("event_type"), (F.col("id") % 7).cast("double").alias("value"), F.lit('{"k": 1}').alias("props"),
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(q_more, "scratch_folder", lambda spark, name: str(tmp_path / name))
    rows = q_more.q_feature_store(spark, str(tmp_path)).collect()
    assert len(rows) == 150 and len({r.subject for r in rows}) == 150
    folders = [d for d, _, files in os.walk(tmp_path / "feature_store" / "features") if any(f.endswith(".parquet") for f in files)]
    assert len(folders) <= q_more.SUBJECT_FOLDERS < 150
