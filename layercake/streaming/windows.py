"""Event-time tumbling windows over a stream, with a watermark.

``timestamp_ntz`` columns cannot carry a watermark, so event time is cast to
``timestamp`` (session zone UTC) for the aggregation and back on output.
In append mode a window is emitted once the watermark passes its end, so
results are final and state for closed windows is dropped.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tumbling(
    df: DataFrame,
    time_col: str,
    keys: Mapping[str, Column | str],
    aggs: Mapping[str, Column],
    size: str = "1 hour",
    delay: str = "0 seconds",
) -> DataFrame:
    """``groupBy(window(time, size), keys).agg(aggs)`` with a watermark.

    Returns ``keys..., window_start, window_end, aggs...`` (times as
    ``timestamp_ntz``).  Works the same on batch frames (no watermark
    effect), which is how the stream is checked.
    """
    t = "_lc_event_time"
    timed = df.withColumn(t, F.col(time_col).cast("timestamp"))
    if df.isStreaming:
        timed = timed.withWatermark(t, delay)
    key_cols = [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in keys.items()]
    grouped = timed.groupBy(F.window(t, size).alias("_lc_w"), *key_cols)
    out = grouped.agg(*[c.alias(n) for n, c in aggs.items()])
    return out.select(
        *keys.keys(),
        F.col("_lc_w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("_lc_w.end").cast("timestamp_ntz").alias("window_end"),
        *aggs.keys(),
    )
