"""Point-in-time serving reads over the point table.

``asof`` is always explicit (never ``current_timestamp()``), so a query is
reproducible and cacheable.  The look-back window is ``[asof - lookback,
asof)``.  When the table is partitioned by a day column, the same bound is
applied to it so Spark prunes partitions before reading a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layercake.functions.events import MEASUREMENT

# Look-backs of the three endpoints.
DEVICES_LOOKBACK = "1 hour"
DEVICE_LOOKBACK = "10 minutes"
TEMPERATURE_LOOKBACK = "5 minutes"

SERIES = ["measurement", "device_id", "device_type", "location_id", "field"]


def _bounds(asof: str, lookback: str) -> tuple[Column, Column]:
    end = F.lit(asof).cast("timestamp_ntz")
    return end - F.expr(f"INTERVAL {lookback}"), end


def in_window(points: DataFrame, asof: str, lookback: str, time_col: str = "time",
              day_col: str | None = None) -> DataFrame:
    start, end = _bounds(asof, lookback)
    out = points
    if day_col and day_col in points.columns:
        out = out.filter(
            (F.col(day_col) >= F.date_format(start, "yyyy-MM-dd"))
            & (F.col(day_col) <= F.date_format(end, "yyyy-MM-dd"))
        )
    return out.filter((F.col(time_col) >= start) & (F.col(time_col) < end))


def devices_seen(points: DataFrame, asof: str, lookback: str = DEVICES_LOOKBACK, **kw) -> DataFrame:
    """Distinct devices with any point in the look-back window."""
    return in_window(points, asof, lookback, **kw).select("device_id").distinct()


def latest_per_series(points: DataFrame, asof: str, lookback: str = DEVICE_LOOKBACK,
                      device_id: str | None = None, **kw) -> DataFrame:
    """Last point of every series (measurement, tags, field) in the window.

    ``max(struct(time, value...))`` is an ordinary aggregate: partial
    aggregation map-side keeps one candidate per series per task, so a
    chatty series never piles up in one task.  ``device_id=None`` serves
    every device in one pass.
    """
    pts = in_window(points, asof, lookback, **kw)
    if device_id is not None:
        pts = pts.filter(F.col("device_id") == F.lit(device_id))
    best = F.max(F.struct("time", "value_num", "value_str")).alias("last")
    return pts.groupBy(*SERIES).agg(best).select(*SERIES, "last.time", "last.value_num", "last.value_str")


def field_points(points: DataFrame, asof: str, lookback: str = TEMPERATURE_LOOKBACK,
                 field: str = "temperature", measurement: str = MEASUREMENT, **kw) -> DataFrame:
    """``(time, value, device)`` of one field of one measurement in the window."""
    pts = in_window(points, asof, lookback, **kw)
    return pts.filter((F.col("measurement") == measurement) & (F.col("field") == field)).select(
        "time", F.col("value_num").alias("value"), F.col("device_id").alias("device")
    )
