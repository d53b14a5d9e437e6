"""PRJ-01..03: channel registry -- sensor groups resolved by name once, on the driver.

Only column *names* are looked at here (schema work); the result is used as an
``array(*cols)`` projection that runs distributed.  Wide recordings are carried
as one array per sensor group so a plan never has 150+ scalar columns (which
would exceed ``spark.sql.codegen.maxFields`` and lose whole-stage codegen).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Channel names of the recordings (sensor layout).
IMU_AXES = ["aX", "aY", "az", "gX", "gY", "gZ"]
IMU_SITES = ["f", "c", "q", "h"]
IMU_NAMES = [f"{axis}-{site}" for site in IMU_SITES for axis in IMU_AXES]
GONIO_NAMES = ["G_DA_X", "G_DA_Y", "G_DK_X", "G_DK_Y", "G_NDA_X", "G_NDA_Y"]
EMG_TA_PREFIX = "EMG_TA"
EMG_GM_PREFIX = "EMG_GM"
GONIO_PREFIX = "G_"
IMU_SUFFIXES = ["-f", "-c", "-q", "-h"]
GROUP_ORDER = ["emg_ta", "emg_gm", "imu"]


def resolve_channels(columns: Sequence[str], rule: str, tokens: Sequence[str]) -> list[str]:
    """PRJ-01: pick channel columns by a name rule, keeping the schema order.

    rules: ``contains`` (any token is a substring), ``endswith`` (any token is a
    suffix), ``startswith``, ``dash`` (the name contains '-'), ``exact_list``
    (the tokens themselves, in token order, all required).
    """
    if rule == "contains":
        return [c for c in columns if any(t in c for t in tokens)]
    if rule == "endswith":
        return [c for c in columns if any(c.endswith(t) for t in tokens)]
    if rule == "startswith":
        return [c for c in columns if any(c.startswith(t) for t in tokens)]
    if rule == "dash":
        return [c for c in columns if "-" in c]
    if rule == "exact_list":
        missing = [t for t in tokens if t not in columns]
        if missing:
            raise ValueError(f"missing channels {missing}")
        return list(tokens)
    raise ValueError(f"unknown rule {rule!r}")


@dataclass
class ChannelRegistry:
    groups: dict[str, list[str]] = field(default_factory=dict)

    @classmethod
    def from_columns(cls, columns: Sequence[str], imu_rule: str = "contains") -> ChannelRegistry:
        return cls(
            {
                "emg_ta": resolve_channels(columns, "contains", [EMG_TA_PREFIX]),
                "emg_gm": resolve_channels(columns, "contains", [EMG_GM_PREFIX]),
                "imu": resolve_channels(columns, imu_rule, IMU_SUFFIXES),
                "gonio": resolve_channels(columns, "startswith", [GONIO_PREFIX]),
            }
        )

    def to_arrays(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Wide columns -> one ``ARRAY<FLOAT>`` per non-empty group."""
        arrays = [
            F.array(*[F.col(f"`{c}`").cast("float") for c in cols]).alias(g) for g, cols in self.groups.items() if cols
        ]
        return df.select(*keep, *arrays)


def select_sensors(df: DataFrame, groups: Sequence[str] = GROUP_ORDER, out: str = "sensors") -> DataFrame:
    """PRJ-03: TA ++ GM ++ IMU in the canonical order, as one array."""
    present = [g for g in groups if g in df.columns]
    return df.withColumn(out, F.concat(*[F.col(g) for g in present]))
