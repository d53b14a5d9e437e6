"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from myosig.session import ensure_checkpoint_dir

#: Code points that one numpy pass handles at a time; bounds a worker's memory.
SEGMENT_CHARS = 2_000_000


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back.

    Cuts the lineage: what follows never recomputes ``df``, also when executors
    are lost, and reads only the columns it needs.
    """
    path = shared_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id's text modulo 4; null for a null id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % F.lit(4)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True where the remainder is 2; a null id has no remainder and is not held out."""
    return F.coalesce(remainder(doc_id) == 2, F.lit(False))


def teachable(doc_id: str | Column = "doc_id") -> Column:
    """Rows a model may learn from: a known id whose remainder is not 2."""
    return F.coalesce(remainder(doc_id) != 2, F.lit(False))


def segments(texts: Iterable[str], overlap: int, limit: int = SEGMENT_CHARS) -> Iterator[tuple[list[int], list[str]]]:
    """Deal texts into runs of at most ``limit`` code points.

    Yields (row numbers, pieces).  A longer text is cut into pieces that share
    ``overlap`` code points, so that every n-gram of ``overlap + 1`` code points
    lies in exactly one piece; its row number then comes several times.
    """
    rows: list[int] = []
    parts: list[str] = []
    held = 0
    for i, text in enumerate(texts):
        for start in range(0, max(1, len(text) - overlap), limit):
            piece = text[start : start + limit + overlap]
            if rows and held + len(piece) > limit:
                yield rows, parts
                rows, parts, held = [], [], 0
            rows.append(i)
            parts.append(piece)
            held += len(piece)
    if rows:
        yield rows, parts


def release() -> None:
    """Hand memory that was freed back to the system: Arrow's pool and the C library keep it for later otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The pass ``run`` over a task's batches, releasing memory after every batch and at its end.

    Spark keeps Python workers alive between stages; without this a worker stays at the
    largest size that any pass before needed.
    """

    def passed(batches: Iterator) -> Iterator:
        def fed() -> Iterator:
            for b in batches:
                yield b
                del b
                release()

        try:
            yield from run(fed())
        finally:
            release()

    return passed


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
