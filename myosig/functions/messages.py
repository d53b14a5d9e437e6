"""SRC-14..16, STR-07, EVL-11: device messages, packets and latency logs as columns.

The text protocol: ``READY_FOR_CHUNK:<n>`` requests and
``PREDICTION:<deg>,LATENCY_US:<us>`` replies.  Parsing is ``regexp_extract`` +
``try_cast`` (garbled lines become NULL and are dropped); formatting truncates
toward zero in float32 like the firmware.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from myosig.session import table

# Fixed protocol prefixes.
READY = "READY_FOR_CHUNK"
PREDICTION = "PREDICTION"
LATENCY = "LATENCY_US"

# Message log derived from the events table (test adapter): signups are chunk
# requests, errors are garbled replies, everything else a prediction.
MESSAGE_SQL = """CASE event_type
  WHEN 'signup' THEN 'READY_FOR_CHUNK:' || CAST(153 + (event_id % 2) * 154 AS VARCHAR)
  WHEN 'error' THEN 'PREDICTION:#garbled,LATENCY_US:x'
  ELSE 'PREDICTION:' || (CASE WHEN CAST(round(value * 100) AS BIGINT) - 5000 < 0 THEN '-' ELSE '' END)
       || CAST(abs(CAST(round(value * 100) AS BIGINT) - 5000) // 100 AS VARCHAR) || '.'
       || lpad(CAST(abs(CAST(round(value * 100) AS BIGINT) - 5000) % 100 AS VARCHAR), 2, '0')
       || ',LATENCY_US:' || CAST(1000 + event_id % 900 AS VARCHAR) END"""


def message_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    am = F.round(F.col("value") * 100).cast("bigint") - 5000
    angle = F.concat(
        F.when(am < 0, F.lit("-")).otherwise(F.lit("")),
        F.floor(F.abs(am) / 100).cast("bigint").cast("string"),
        F.lit("."),
        F.lpad((F.abs(am) % 100).cast("string"), 2, "0"),
    )
    line = (
        F.when(F.col("event_type") == "signup", F.concat(F.lit(f"{READY}:"), (153 + (F.col("event_id") % 2) * 154).cast("string")))
        .when(F.col("event_type") == "error", F.lit(f"{PREDICTION}:#garbled,{LATENCY}:x"))
        .otherwise(
            F.concat(F.lit(f"{PREDICTION}:"), angle, F.lit(f",{LATENCY}:"), (1000 + F.col("event_id") % 900).cast("string"))
        )
    )
    return ev.select(F.col("event_id").alias("line_no"), line.alias("line"))


def parse_prediction_log(df: DataFrame, line: str = "line") -> DataFrame:
    """SRC-15: (kind, angle, latency_ms, samples_needed); garbled lines dropped. STR-07: µs -> ms."""
    c = F.col(line)
    kind = F.regexp_extract(c, f"^({READY}|{PREDICTION})", 1)
    angle = F.regexp_extract(c, f"^{PREDICTION}:([^,]*),", 1).try_cast("double")
    lat = F.regexp_extract(c, f"{LATENCY}:(.*)$", 1).try_cast("double")
    need = F.regexp_extract(c, f"^{READY}:(.*)$", 1).try_cast("int")
    out = df.select(
        "*", kind.alias("kind"), angle.alias("angle"), (lat / 1000.0).alias("latency_ms"), need.alias("samples_needed")
    )
    ok = ((F.col("kind") == PREDICTION) & F.col("angle").isNotNull() & F.col("latency_ms").isNotNull()) | (
        (F.col("kind") == READY) & F.col("samples_needed").isNotNull()
    )
    return out.where(ok)


def format_prediction(name: str, value: Column) -> Column:
    """SRC-16: ``name-?w.ddd`` with the fraction truncated toward zero in float32."""
    a = value.cast("float")
    pa = F.abs(a)
    whole = pa.cast("int")
    frac = ((pa - whole.cast("float")) * F.lit(1000.0).cast("float")).cast("int")
    return F.concat(F.lit(name), F.when(a < 0, F.lit("-")).otherwise(F.lit("")), whole.cast("string"), F.lit("."), F.lpad(frac.cast("string"), 3, "0"))


def format_prediction_scaled(name: str, value: Column) -> Column:
    """SRC-16 variant: s = int(v*1000); w = s/1000, f = |s%1000| (sign lost for -1 < v < 0)."""
    s = (value.cast("float") * F.lit(1000.0).cast("float")).cast("int")
    w = (s / 1000).cast("int")
    f = F.abs(s % 1000)
    return F.concat(F.lit(name), w.cast("string"), F.lit("."), F.lpad(f.cast("string"), 3, "0"))


# ---------------------------------------------------------------- SRC-14 packets
def encode_float_packets(df: DataFrame, arr: str, out: str = "payload") -> DataFrame:
    """ARRAY<FLOAT> -> little-endian float32 bytes (the wire format), per Arrow batch."""
    schema = T.StructType([*[f for f in df.schema.fields if f.name != arr], T.StructField(out, T.BinaryType())])
    keep = [f.name for f in df.schema.fields if f.name != arr]

    def run(batches):
        for pdf in batches:
            pay = [np.asarray(v, dtype="<f4").tobytes() if v is not None else None for v in pdf[arr]]
            res = pdf[keep].copy()
            res[out] = pay
            yield res

    return df.mapInPandas(run, schema)


def decode_float_packets(df: DataFrame, payload: str = "payload", n: int | None = None, out: str = "values") -> DataFrame:
    """SRC-14: little-endian float32 payloads -> ARRAY<FLOAT>; a wrong length gives NULL."""
    schema = T.StructType([*[f for f in df.schema.fields if f.name != payload], T.StructField(out, T.ArrayType(T.FloatType()))])
    keep = [f.name for f in df.schema.fields if f.name != payload]

    def run(batches):
        for pdf in batches:
            vals = []
            for b in pdf[payload]:
                if b is None or len(b) % 4 or (n is not None and len(b) != 4 * n):
                    vals.append(None)
                else:
                    vals.append(np.frombuffer(b, dtype="<f4").astype("float32"))
            res = pdf[keep].copy()
            res[out] = pd.Series(vals, dtype=object)
            yield res

    return df.mapInPandas(run, schema)


# ---------------------------------------------------------------- latency logs (test adapters)
def latency_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    feat = F.col("value") * 10.0
    infer = (F.col("event_id") % 97) * 3.0 + 100.0
    return ev.select(feat.alias("feat_us"), infer.alias("infer_us"), (feat + infer).alias("total_us"))


def inference_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EVL-11: correct count, total and mean/total time over a labelled latency log."""
    lb = table(spark, sf_dir, "labels")
    us = (F.col("doc_id") % 97) * 10.0 + 500.0
    return lb.agg(
        F.count_if(F.col("quality") == F.col("toxic")).cast("bigint").alias("n_correct"),
        F.count(F.lit(1)).alias("n_total"),
        F.round(F.avg(us), 6).alias("mean_us"),
        F.round(F.sum(us), 6).alias("total_us"),
    )
