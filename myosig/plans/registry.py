"""Query registry: every query keeps its Spark plan and its independent SQL oracle together."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    operators: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(name: str, operators: tuple[str, ...] | list[str] = (), sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql.strip() if sql else None, tuple(operators))
        return fn

    return deco


def r6(c: Column | str) -> Column:
    """Doubles are compared at 6 decimals on both sides.

    Scale, round half away from zero, unscale -- the same floating-point steps
    as the SQL side's ``round(x, 6)``, so a value whose scaled form is just
    below .5 rounds the same way on both engines.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double") * F.lit(1e6)) / F.lit(1e6)


def sql_index(order: str, partition: str | None = None) -> str:
    part = f"PARTITION BY {partition} " if partition else ""
    return f"(row_number() OVER ({part}ORDER BY {order}) - 1)"


def sql_window_ids(size: int, step: int, inclusive: bool = True, idx: str = "idx", n: str = "n_rows") -> str:
    """DuckDB expression: list of window ids containing ``idx`` (empty if none)."""
    tail = f"{n} - {size}" if inclusive else f"{n} - {size} - 1"
    first = f"greatest(0, CAST(ceil(({idx} - {size} + 1) / {step}) AS BIGINT))"
    last = f"least(CAST(floor({idx} / {step}) AS BIGINT), CAST(floor(({tail}) / {step}) AS BIGINT))"
    return f"generate_series({first}, {last})"
