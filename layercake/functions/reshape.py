"""Reshaping: nested flatten, UNIX-time detection, NaN->NULL, unpivot, date grids.

Everything is a projection planned from ``df.schema`` (no UDF, no per-row
Python); the only data-dependent step, UNIX-time detection, is one
aggregate pass returning one boolean per candidate column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StructType,
)


def _flat_fields(schema: StructType, prefix: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    out: list[tuple[str, ...]] = []
    for f in schema.fields:
        path = prefix + (f.name,)
        if isinstance(f.dataType, StructType):
            out.extend(_flat_fields(f.dataType, path))  # empty struct -> nothing
        else:
            out.append(path)
    return out


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Recursively flatten struct columns into ``parent<sep>child`` columns.

    Arrays are left untouched (kept as one value); an empty struct yields
    no column.  Pure projection: Catalyst prunes nested fields at the scan.
    """
    cols = []
    for path in _flat_fields(df.schema):
        ref = F.col(".".join(f"`{p}`" for p in path))
        cols.append(ref.alias(sep.join(path)))
    return df.select(*cols)


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn NaN into NULL in float/double columns (all of them by default)."""
    floats = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (DoubleType, FloatType)) and (columns is None or f.name in columns)
    ]
    return df.withColumns(
        {c: F.when(F.isnan(c), F.lit(None).cast(df.schema[c].dataType)).otherwise(F.col(c)) for c in floats}
    )


_SECONDS_MIN = 1_000_000_000  # ten digits
_MILLIS_MIN = 1_000_000_000_000  # thirteen digits


def unix_time_columns(df: DataFrame, candidates: Sequence[str] | None = None) -> list[str]:
    """Numeric columns whose every non-null value has >= 10 integer digits.

    One aggregate pass for all candidates (``bool_and`` per column, computed
    map-side), returning one boolean per column to the driver.  Only
    numeric columns qualify (digits in a text column are not a time); an
    all-null column is not converted.
    """
    numeric = (IntegerType, LongType, DoubleType, FloatType)
    names = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, numeric) and (candidates is None or f.name in candidates)
    ]
    if not names:
        return []
    aggs = []
    for n in names:
        v = F.col(n).try_cast("double")
        aggs.append(
            (F.bool_and(F.coalesce(F.abs(v) >= _SECONDS_MIN, F.lit(False)) | F.col(n).isNull())
             & (F.count(v) > 0)).alias(n)
        )
    row = df.agg(*aggs).first()
    return [n for n in names if row[n]]


def to_timestamp_auto(col: str | Column) -> Column:
    """Epoch seconds -> timestamp; 13+ digit values are taken as milliseconds."""
    v = F.col(col) if isinstance(col, str) else col
    num = v.try_cast("double")
    ts = F.when(F.abs(num) >= _MILLIS_MIN, F.timestamp_millis(v.try_cast("long"))).otherwise(
        F.timestamp_seconds(num)
    )
    return ts.cast("timestamp_ntz")


def convert_unix_times(df: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """Convert the UNIX-time columns (see :func:`unix_time_columns`) among the named candidates.

    Candidates are named per dataset: a large amount looks like a time, so
    no column is converted unasked.
    """
    cols = unix_time_columns(df, list(candidates))
    return df.withColumns({c: to_timestamp_auto(c) for c in cols}) if cols else df


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str] | None = None,
            name_col: str = "metric", value_col: str = "value") -> DataFrame:
    """Wide -> long (one row per id and value column); NULL values dropped."""
    values = list(values) if values is not None else [c for c in df.columns if c not in ids]
    return df.unpivot(list(ids), values, name_col, value_col).filter(F.col(value_col).isNotNull())


def date_labels(df: DataFrame, fmt: str = "%Y-%m-%d") -> DataFrame:
    """Rename columns whose names are timestamps (``2024-01-01 00:00:00``,
    ``2024-01-01T00:00:00``) to date text; other names are kept.  Metadata only."""
    from datetime import datetime

    def relabel(name: str) -> str:
        try:
            return datetime.fromisoformat(name).strftime(fmt)
        except ValueError:
            return name

    mapping = {c: relabel(c) for c in df.columns if relabel(c) != c}
    return df.withColumnsRenamed(mapping) if mapping else df


def wide_by(df: DataFrame, ids: Sequence[str], label: Column, agg: Column, labels: Sequence) -> DataFrame:
    """One column per label value, aggregated with ``agg``.

    The label values are an explicit list (a report's dates), so Spark plans
    one grouped aggregation and never runs a distinct pass to find them.
    """
    return df.withColumn("_lc_label", label).groupBy(*ids).pivot("_lc_label", list(labels)).agg(agg)


def expand_dates(start: str | Column, end: str | Column, step: str = "1 day") -> Column:
    """Array of dates from ``start`` to ``end`` inclusive (for ``explode``)."""
    s = F.to_date(F.lit(start) if isinstance(start, str) else start)
    e = F.to_date(F.lit(end) if isinstance(end, str) else end)
    return F.sequence(s, e, F.expr(f"INTERVAL {step}"))
