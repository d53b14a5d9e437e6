"""Cleaning rules, schema helpers, sources/sinks and metric edge cases."""

import json
import math
import os

import pytest
from pyspark.sql import functions as F

from myosig.channels import ChannelRegistry, resolve_channels
from myosig.functions import messages as msg
from myosig.operators import cleaning as cl
from myosig.operators import evaluation as ev
from myosig.operators.index import with_row_index
from myosig.sources import io
from myosig.streaming.feed import scratch_folder


def test_variant_rules(spark):
    df = spark.createDataFrame([("walk",), ("walk_",), ("sts__",), ("run_x",)], "activity string")
    assert sorted(r[0] for r in cl.drop_variants(df, how="endswith").collect()) == ["run_x", "walk"]
    assert [r[0] for r in cl.drop_variants(df, how="contains").collect()] == ["walk"]
    assert sorted(r[0] for r in cl.merge_variants(df).collect()) == ["run_x", "sts", "walk", "walk"]


def test_sanitize_and_missing(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (float("inf"), None), (-float("inf"), 2.0), (3.0, float("nan"))], "x double, g double")
    s = cl.sanitize(cl.downcast_float(df), ["x"]).collect()
    assert [r.x for r in s][:3] == [0.0, pytest.approx(cl.FLOAT32_MAX, rel=1e-6), pytest.approx(-cl.FLOAT32_MAX, rel=1e-6)]
    assert cl.drop_missing_target(df, ["g"]).count() == 2


def test_coerce_profile_validate(spark):
    df = spark.createDataFrame([("1", "a"), ("2.5", "b"), (None, "c")], "k string, t string")
    c = cl.coerce_numeric(df)
    assert dict(c.dtypes) == {"k": "double", "t": "string"}
    assert cl.profile_types(c).first().asDict() == {"n_rows": 3, "n_columns": 2, "n_numeric": 1, "n_categorical": 1}
    arr = spark.createDataFrame([([1.0] * 64,), ([1.0] * 63,)], "emg_ta array<float>")
    with pytest.raises(ValueError):
        cl.validate_channels(arr, {"emg_ta": 64}, mode="raise")
    assert cl.validate_channels(arr, {"emg_ta": 64}, mode="report").first()["bad_emg_ta"] == 1


def test_seek_and_cap(spark):
    df = spark.createDataFrame([(i, a, i / 10.0) for i, a in enumerate(["b"] * 3 + ["A"] * 80 + ["c"] * 5)], "idx long, activity string, t double")
    assert cl.seek_activity(df, "a").agg(F.min("idx")).first()[0] == 3
    assert cl.seek_activity(df, "zzz").count() == df.count()  # no match -> from row 0
    capped = cl.cap_duration(df, "t", n_act=2, seconds=5.0)
    assert capped.where("activity = 'A'").agg(F.max("t")).first()[0] <= 5.0
    assert capped.where("activity = 'c'").count() == 5


def test_label_text_and_channels(spark):
    df = spark.createDataFrame([("sts",), ("WALK",)], "a string")
    assert sorted(r[0] for r in df.select(cl.label_text("a")).collect()) == ["Sts", "Walk"]
    cols = ["EMG_TA_CH_0", "EMG_TA_CH_1", "EMG_GM_CH_0", "aX-f", "gZ-h", "G_DA_X", "Activity"]
    reg = ChannelRegistry.from_columns(cols)
    assert reg.groups == {"emg_ta": ["EMG_TA_CH_0", "EMG_TA_CH_1"], "emg_gm": ["EMG_GM_CH_0"], "imu": ["aX-f", "gZ-h"], "gonio": ["G_DA_X"]}
    assert resolve_channels(cols, "dash", []) == ["aX-f", "gZ-h"]
    with pytest.raises(ValueError):
        resolve_channels(cols, "exact_list", ["nope"])


def test_split_columns_and_same_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, "walk", 3.0)], "f1 double, f2 double, Activity string, G_DA_X_Target double")
    feats, tg, md = cl.split_columns(df, ["Activity"])
    assert feats == ["f1", "f2"] and tg == ["G_DA_X_Target"] and md == ["Activity"]
    cl.assert_same_columns(df, df)
    with pytest.raises(ValueError):
        cl.assert_same_columns(df, df.drop("f2"))


def test_format_and_parse_messages(spark):
    df = spark.createDataFrame([(-1.2345,), (12.0009,), (-0.5,)], "v double")
    out = [r[0] for r in df.select(msg.format_prediction("A:", F.col("v"))).collect()]
    assert out == ["A:-1.234", "A:12.000", "A:-0.500"]
    lines = spark.createDataFrame([("PREDICTION:-5.123,LATENCY_US:1450",), ("READY_FOR_CHUNK:307",), ("PREDICTION:x,LATENCY_US:1",), ("junk",)], "line string")
    p = msg.parse_prediction_log(lines).orderBy("kind").collect()
    assert len(p) == 2 and p[0]["angle"] == -5.123 and p[0]["latency_ms"] == 1.45 and p[1]["samples_needed"] == 307


def test_golden_roundtrip_and_metrics_document(spark):
    base = scratch_folder(spark, "test_io")
    os.makedirs(base, exist_ok=True)
    path = os.path.join(base, "g.json")
    with open(path, "w") as f:
        json.dump([{"features": [1.0, 2.0], "true_values": [3.0], "pred_values": [2.5]}] * 2, f, indent=2)
    g = io.read_golden(spark, path).collect()
    assert len(g) == 2 and g[0]["features"] == [1.0, 2.0]
    m = spark.createDataFrame([("walk", "knee", 0.9, 1.5, 10), ("run", "knee", 0.8, 2.0, 5)], "activity string, target string, r2 double, rmse double, n bigint")
    doc = io.metrics_document(m).first()["metrics"]
    assert doc["walk"]["knee"]["r2"] == 0.9


def test_r2_edge_cases(spark):
    rows = [("a", "t", 1.0, 1.0), ("b", "t", 2.0, 2.0), ("b", "t", 2.0, 3.0), ("c", "t", 1.0, 2.0), ("c", "t", 3.0, 2.0)]
    long = spark.createDataFrame(rows, "activity string, target string, y double, p double")
    m = {r.activity: r for r in ev.metrics_by_target(long, ["activity"]).collect()}
    assert m["a"].r2 is None  # n <= 1
    assert m["b"].r2 == 0.0  # constant truth, imperfect
    assert m["c"].r2 == pytest.approx(0.0)
    assert math.isclose(m["c"].rmse, 1.0)
