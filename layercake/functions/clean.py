"""Silver cleaning: distinct rows, null imputation, casts, category labels.

All column expressions are built-in functions, so the whole chain stays in
one whole-stage-codegen span after the distinct's shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, StringType


def dedup(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Full-row DISTINCT (NULLs compare equal), or distinct on ``subset``.

    Partial aggregation runs map-side, so only distinct rows per task are
    shuffled; hot duplicate rows collapse before the exchange.
    """
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def impute(df: DataFrame, rules: Mapping[str, object] | None = None, text_null_for_strings: bool = False) -> DataFrame:
    """``COALESCE(col, default)`` per listed column, default cast to the column type.

    Unlisted columns are left alone.  ``text_null_for_strings`` reproduces
    the SQL-builder habit of filling unlisted *string* columns with the text
    ``'NULL'``; numeric columns never get it (that raises in any engine).
    """
    rules = dict(rules or {})
    exprs: dict[str, Column] = {}
    for f in df.schema.fields:
        if f.name in rules:
            exprs[f.name] = F.coalesce(F.col(f.name), F.lit(rules[f.name]).cast(f.dataType))
        elif text_null_for_strings and isinstance(f.dataType, StringType):
            exprs[f.name] = F.coalesce(F.col(f.name), F.lit("NULL"))
    return df.withColumns(exprs) if exprs else df


def cast_columns(
    df: DataFrame,
    casts: Mapping[str, str] | None = None,
    round_half_even: bool = True,
    strict: bool = True,
    reject_col: str | None = None,
) -> DataFrame:
    """``CAST(col AS type)`` per listed column.

    Spark truncates double -> integral and decimal -> integral casts; SQL
    engines round instead (doubles half-to-even, decimals half away from
    zero).  ``round_half_even`` applies ``bround`` to doubles and ``round``
    (HALF_UP) to decimals first so both agree.  ``strict=False`` uses ``try_cast`` and, with
    ``reject_col``, flags rows where a non-null value failed to cast.
    """
    casts = dict(casts or {})
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs: dict[str, Column] = {}
    failed: list[Column] = []
    integral = {"tinyint", "smallint", "int", "integer", "bigint", "long", "short", "byte"}
    for name, target in casts.items():
        src = F.col(name)
        if round_half_even and target.lower() in integral:
            if isinstance(types.get(name), (DoubleType, FloatType)):
                src = F.bround(src, 0)
            elif isinstance(types.get(name), DecimalType):
                src = F.round(src, 0)
        if strict:
            exprs[name] = src.cast(target)
        else:
            exprs[name] = src.try_cast(target)
            failed.append(F.col(name).isNotNull() & src.try_cast(target).isNull())
    out = df.withColumns(exprs) if exprs else df
    if reject_col and failed:
        any_failed = failed[0]
        for c in failed[1:]:
            any_failed = any_failed | c
        out = df.withColumn(reject_col, any_failed).withColumns(exprs)
    return out


def silver_clean(
    df: DataFrame,
    dedup_rows: bool = True,
    null_rules: Mapping[str, object] | None = None,
    cast_types: Mapping[str, str] | None = None,
    check_nonempty: bool = False,
) -> DataFrame:
    """Fixed order: distinct -> impute -> cast (as the SQL builder does).

    Duplicates that only appear after imputation survive, by that order.
    ``check_nonempty`` runs a one-row probe (``limit(1)``) and raises on an
    empty result, instead of materialising the frame.
    """
    out = dedup(df) if dedup_rows else df
    out = impute(out, null_rules)
    out = cast_columns(out, cast_types)
    if check_nonempty and out.isEmpty():
        raise ValueError("silver transformation produced an empty result")
    return out


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """``na.fill`` restricted to columns present in ``df``."""
    present = {k: v for k, v in defaults.items() if k in df.columns}
    return df.na.fill(present) if present else df


def map_categories(df: DataFrame, column: str, mapping: Mapping[str, str], out_col: str | None = None) -> DataFrame:
    """Code -> label lookup via a literal map; unmatched codes are kept.

    The mapping is a literal in the plan (no join, no broadcast) since it
    is configuration, not data.
    """
    if not mapping:
        return df
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    target = out_col or column
    return df.withColumn(target, F.coalesce(F.try_element_at(lookup, F.col(column)), F.col(column)))
