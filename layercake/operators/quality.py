"""Schema inference and data-quality checks.

Checks that need data (nulls, bounds, duplicates, row counts) are fused so
one scan answers all of them: a single ``agg`` with one conditional count
per column and one violation flag per bound.  Results are small frames
(one row per column or per group), never pandas objects on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# Validation messages and verdicts, as the checks report them.
MSG_MISSING_COLUMN = "Missing column"
MSG_WRONG_TYPE = "Expected {expected}, got {actual}"
MSG_COLUMN_NOT_FOUND = "Column not found"
MSG_BELOW_MIN = "Values below min {bound}"
MSG_ABOVE_MAX = "Values above max {bound}"
MSG_JOIN = "; "
VERDICT_VALID = "VALID"
VERDICT_INVALID = "INVALID"

# ------------------------------------------------------------------- SQ1
# The four logical types and the fallback.
LOGICAL_INTEGER = "INTEGER"
LOGICAL_FLOAT = "FLOAT"
LOGICAL_TIMESTAMP = "TIMESTAMP"
LOGICAL_STRING = "STRING"


def logical_type(dt: DataType) -> str:
    """INTEGER / FLOAT / TIMESTAMP, everything else (bool included) STRING."""
    if isinstance(dt, (ByteType, ShortType, IntegerType, LongType)):
        return LOGICAL_INTEGER
    if isinstance(dt, (FloatType, DoubleType, DecimalType)):
        return LOGICAL_FLOAT
    if isinstance(dt, (TimestampType, TimestampNTZType, DateType)):
        return LOGICAL_TIMESTAMP
    return LOGICAL_STRING


def infer_schema(df: DataFrame) -> dict[str, str]:
    """``{column: logical type}`` from the frame's schema (no scan)."""
    return {f.name: logical_type(f.dataType) for f in df.schema.fields}


def profile(df: DataFrame) -> DataFrame:
    """Per column: logical type and non-null count, in one aggregate pass."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    types = infer_schema(df)
    stack = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.lit(types[c]).alias("logical_type"),
                    F.col(f"`{c}`").alias("non_null"),
                )
                for c in df.columns
            ]
        )
    )
    return counts.select(stack.alias("p")).select("p.*")


# ------------------------------------------------------------------- DQ1
# Pandas dtype names accepted in expected schemas -> Spark types.
PANDAS_DTYPES = {
    "int64": "bigint",
    "int32": "int",
    "int16": "smallint",
    "int8": "tinyint",
    "float64": "double",
    "float32": "float",
    "object": "string",
    "string": "string",
    "bool": "boolean",
    "datetime64[ns]": "timestamp_ntz",
    "datetime64[us]": "timestamp_ntz",
}


def normalise_type(name: str) -> str:
    return PANDAS_DTYPES.get(name, name)


def schema_errors(df: DataFrame, expected: Mapping[str, str]) -> dict[str, str]:
    """Expected name -> type check; extra columns are allowed.

    Types are Spark simple strings (``bigint``, ``double``...) or pandas dtype
    names, translated.  Metadata only: no job runs.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    errors: dict[str, str] = {}
    for col, want in expected.items():
        if col not in actual:
            errors[col] = MSG_MISSING_COLUMN
        elif actual[col] != normalise_type(want):
            errors[col] = MSG_WRONG_TYPE.format(expected=want, actual=actual[col])
    return errors



def schema_conformance(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Per expected column: declared-type verdict plus values that would not
    survive a cast to the expected type (one aggregate pass).

    Columns: ``column_name, expected, actual, error`` (NULL when the declared
    type matches) and ``bad_values`` (non-NULL values whose ``try_cast`` to
    the expected type is NULL; 0 for a missing column, which has no values).
    """
    errs = schema_errors(df, expected)
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    present = [c for c in expected if c in actual]
    counts = df.agg(
        *[
            F.count_if(F.col(f"`{c}`").isNotNull()
                       & F.col(f"`{c}`").try_cast(normalise_type(expected[c])).isNull()).alias(c)
            for c in present
        ],
        F.count(F.lit(1)).alias("__rows"),
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(expected[c]).alias("expected"),
            F.lit(actual.get(c)).cast("string").alias("actual"),
            F.lit(errs.get(c)).cast("string").alias("error"),
            (F.col(f"`{c}`") if c in actual else F.lit(0)).cast("bigint").alias("bad_values"),
        )
        for c in expected
    ]
    return counts.select(F.inline(F.array(*rows)))


# ------------------------------------------------------------- DQ3 / DQ4
def _is_missing(df: DataFrame, c: str) -> Column:
    col = F.col(f"`{c}`")
    if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
        return col.isNull() | F.isnan(col)  # pandas counts NaN as null
    return col.isNull()


def _fmt(v: float | int) -> str:
    return str(v)


def check_stats(
    df: DataFrame,
    required: Sequence[str] | None = None,
    bounds: Mapping[str, tuple[float | None, float | None]] | None = None,
) -> DataFrame:
    """One-row frame with every null count and bound flag, in one scan.

    Columns: ``null__<c>`` (count of NULL or NaN) for each required column
    (all columns by default) and ``below__<c>`` / ``above__<c>`` booleans for
    each bound.  NaN never violates a bound (Spark orders NaN above every
    number; pandas comparisons with NaN are false).  NULLs never violate.
    """
    required = list(df.columns if required is None else required)
    bounds = dict(bounds or {})
    aggs = [F.count_if(_is_missing(df, c)).alias(f"null__{c}") for c in required if c in df.columns]
    for c, (lo, hi) in bounds.items():
        if c not in df.columns:
            continue
        col = F.col(f"`{c}`")
        ok = col.isNotNull()
        if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
            ok = ok & ~F.isnan(col)
        if lo is not None:
            aggs.append(F.coalesce(F.bool_or(ok & (col < F.lit(lo))), F.lit(False)).alias(f"below__{c}"))
        if hi is not None:
            aggs.append(F.coalesce(F.bool_or(ok & (col > F.lit(hi))), F.lit(False)).alias(f"above__{c}"))
    aggs.append(F.count(F.lit(1)).alias("row_count"))
    return df.agg(*aggs)


def null_errors_frame(stats: DataFrame, required: Sequence[str]) -> DataFrame:
    """Tall ``(column_name, null_count)`` for required columns with nulls."""
    cols = [c for c in required if f"null__{c}" in stats.columns]
    if not cols:
        return stats.sparkSession.createDataFrame([], "column_name string, null_count bigint")
    stack = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`null__{c}`").alias("null_count")) for c in cols])
    )
    return stats.select(stack.alias("n")).select("n.*").filter("null_count > 0")


def _bound_messages(
    columns: Sequence[str], bounds: Mapping[str, tuple[float | None, float | None]]
) -> dict[str, Column]:
    """Message of each bounded column over :func:`check_stats` ('' where all is well)."""
    out = {}
    for c, (lo, hi) in bounds.items():
        if c not in columns:
            out[c] = F.lit(MSG_COLUMN_NOT_FOUND)
            continue
        parts = []
        if lo is not None:
            parts.append(F.when(F.col(f"`below__{c}`"), F.lit(MSG_BELOW_MIN.format(bound=_fmt(lo)))))
        if hi is not None:
            parts.append(F.when(F.col(f"`above__{c}`"), F.lit(MSG_ABOVE_MAX.format(bound=_fmt(hi)))))
        out[c] = F.concat_ws(MSG_JOIN, *parts) if parts else F.lit("")
    return out


def bound_errors_frame(
    stats: DataFrame, columns: Sequence[str], bounds: Mapping[str, tuple[float | None, float | None]]
) -> DataFrame:
    """Tall ``(column_name, error)``: missing columns and violated bounds."""
    rows = [
        F.struct(F.lit(c).alias("column_name"), text.alias("error")) for c, text in _bound_messages(columns, bounds).items()
    ]
    if not rows:
        return stats.sparkSession.createDataFrame([], "column_name string, error string")
    return stats.select(F.explode(F.array(*rows)).alias("e")).select("e.*").filter("error <> ''")


def validate_all(
    df: DataFrame,
    expected_schema: Mapping[str, str],
    required: Sequence[str] | None = None,
    bounds: Mapping[str, tuple[float | None, float | None]] | None = None,
) -> DataFrame:
    """Schema, null and bound checks in one row; one scan of the data.

    Columns: ``schema_valid, nulls_valid, min_max_valid, overall_valid,
    schema_errors, null_errors, min_max_errors`` (error counts) and
    ``errors``, a JSON object of every message by check and column:
    ``{"schema": {column: message}, "nulls": {column: null count},
    "min_max": {column: message}}`` (columns without an error are left out,
    in the order of the arguments).
    """
    required = list(df.columns if required is None else required)
    bounds = dict(bounds or {})
    s_err = schema_errors(df, expected_schema)
    stats = check_stats(df, required, bounds)
    nulls = [F.when(F.col(f"`null__{c}`") > 0, F.lit(c)) for c in required if c in df.columns]
    null_list = F.filter(F.array(*nulls), lambda x: x.isNotNull()) if nulls else F.array().cast("array<string>")
    bound_texts = _bound_messages(df.columns, bounds)
    n_bound = reduce(lambda a, b: a + b, [(t != "").cast("int") for t in bound_texts.values()], F.lit(0))

    def messages(entries: Mapping[str, Column]) -> Column:
        """A struct whose empty fields are NULL, which to_json leaves out."""
        return F.struct(*[t.alias(c) for c, t in entries.items()]) if entries else F.create_map().cast("map<string,string>")

    errors = F.to_json(
        F.struct(
            messages({c: F.lit(t) for c, t in s_err.items()}).alias("schema"),
            messages({c: F.nullif(F.col(f"`null__{c}`"), F.lit(0)) for c in required if c in df.columns}).alias("nulls"),
            messages({c: F.nullif(t, F.lit("")) for c, t in bound_texts.items()}).alias("min_max"),
        )
    )
    out = stats.select(
        F.lit(len(s_err) == 0).alias("schema_valid"),
        (F.size(null_list) == 0).alias("nulls_valid"),
        (n_bound == 0).alias("min_max_valid"),
        F.lit(len(s_err)).cast("bigint").alias("schema_errors"),
        F.size(null_list).cast("bigint").alias("null_errors"),
        n_bound.cast("bigint").alias("min_max_errors"),
        errors.alias("errors"),
    )
    return out.withColumn(
        "overall_valid", F.col("schema_valid") & F.col("nulls_valid") & F.col("min_max_valid")
    )


# ------------------------------------------------------------------- DQ6
def verdict(df: DataFrame, bad: Column | str, out_col: str = "validation_status") -> DataFrame:
    """``'VALID'`` when no row matches ``bad``, else ``'INVALID'`` (one row)."""
    cond = F.expr(bad) if isinstance(bad, str) else bad
    return df.agg(
        F.when(F.count_if(cond) == 0, F.lit(VERDICT_VALID)).otherwise(F.lit(VERDICT_INVALID)).alias(out_col)
    )


# ------------------------------------------------------------- DQ2 / A7
HEALTH_SCHEMA = StructType(
    [
        StructField("metric", StringType()),
        StructField("column_name", StringType()),
        StructField("value", LongType()),
    ]
)


def health(df: DataFrame, group_cols: Sequence[str | Column], data_cols: Sequence[str] | None = None) -> DataFrame:
    """Tall health stats per group: ``row_count``, ``duplicate_rows``, ``null_count`` per column.

    ``group_cols`` are expressions over ``df`` (e.g. ``to_date(ts)``), named
    by their alias.  One scan, one shuffle: rows are first counted per
    distinct full row (partial aggregation map-side; the full-row hash
    spreads a hot group over many tasks), and every statistic follows from
    those copies -- rows = sum(copies), duplicates = sum(copies - 1),
    nulls of c = sum(copies where c is NULL/NaN).  Empty groups produce no
    rows.
    """
    data_cols = list(data_cols or df.columns)
    gcols = [F.col(g) if isinstance(g, str) else g for g in group_cols]
    keyed = df.select(*gcols, *[F.col(f"`{c}`") for c in data_cols])
    gnames = keyed.columns[: len(gcols)]
    copies = keyed.groupBy(*gnames, *[F.col(f"`{c}`") for c in data_cols]).agg(
        F.count(F.lit(1)).alias("__copies")
    )
    n = F.col("__copies")
    per_group = copies.groupBy(*gnames).agg(
        F.sum(n).alias("__rows"),
        F.sum(n - 1).alias("__dups"),
        *[F.sum(F.when(_is_missing(keyed, c), n).otherwise(F.lit(0))).alias(f"__null_{c}") for c in data_cols],
    )
    def metric(name: str, column: str | None, value: str) -> Column:
        return F.struct(F.lit(name).alias("metric"), F.lit(column).cast("string").alias("column_name"),
                        F.col(f"`{value}`").cast("bigint").alias("value"))

    metrics = [
        metric("row_count", None, "__rows"),
        metric("duplicate_rows", None, "__dups"),
        *[metric("null_count", c, f"__null_{c}") for c in data_cols],
    ]
    return per_group.select(*gnames, F.inline(F.array(*metrics)))


def merge_health(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Additive merge of partial health frames (row and null counts add up;
    duplicates add per batch, as the accumulating report does)."""
    merged = reduce(lambda a, b: a.unionByName(b), frames)
    return merged.groupBy(*keys, "metric", "column_name").agg(F.sum("value").cast("bigint").alias("value"))
