"""myosig.functions: column expressions and small shared helpers."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only when its checked size is at most this.
MAX_BROADCAST_BYTES = 64 << 20


def _column_bytes(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(field.dataType, T.ArrayType):
        return F.coalesce(F.size(c), F.lit(0)) * 8 + 24
    if isinstance(field.dataType, (T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 32
    return F.lit(8)


def frame_bytes(df: DataFrame) -> int:
    """Size of the rows, summed over the table (one aggregate, one number)."""
    width = reduce(lambda a, b: a + b, map(_column_bytes, df.schema.fields), F.lit(16))
    return int(df.agg(F.sum(width.cast("bigint"))).first()[0] or 0)


def broadcast_if_small(df: DataFrame, limit: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only after checking its size in bytes; otherwise leave the join
    strategy to Spark (a shuffle join, whose skewed partitions AQE splits)."""
    return F.broadcast(df) if frame_bytes(df) <= limit else df
