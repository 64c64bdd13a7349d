"""Gold layer: business-rule facts, grouped metrics, referential integrity.

All three are declarative so Catalyst pushes the rule predicate into the
Parquet scan, aggregates map-side before the shuffle, and chooses the join
strategy from measured sizes (AQE) rather than from a hint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def business_rules(spark: SparkSession, source: DataFrame, rules_sql: str = "") -> DataFrame:
    """``SELECT * FROM source <rules_sql>`` as a lazy DataFrame.

    ``rules_sql`` is a free-form tail (``WHERE ...``, ``QUALIFY ...``),
    bound through Spark's DataFrame parameter so no temp view leaks into
    the session catalog.
    """
    return spark.sql("SELECT * FROM {src} " + (rules_sql or ""), src=source)


def compute_metrics(
    source: DataFrame,
    group_by: Sequence[str] | None = None,
    metrics: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Grouped (or, with no columns, global) aggregation.

    ``metrics`` are SQL expression strings or Columns.  ``SELECT *`` with a
    GROUP BY is a binder error in SQL, so it is rejected up front; without
    groups and without metrics the source passes through unchanged.
    """
    group_by = list(group_by or [])
    if not metrics:
        if group_by:
            raise ValueError("compute_metrics: grouping needs explicit metrics, not '*'")
        return source.select("*")
    exprs = [F.expr(m) if isinstance(m, str) else m for m in metrics]
    if group_by:
        # Metrics may repeat the group columns (as in SQL); drop those.
        names = set(group_by)
        exprs = [e for e, m in zip(exprs, metrics) if not (isinstance(m, str) and m.strip() in names)]
        return source.groupBy(*group_by).agg(*exprs)
    return source.agg(*exprs)


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows whose key has no match in the dimension.

    Same answer as ``LEFT JOIN ... WHERE d.key IS NULL``: a NULL fact key
    never matches, so it is an orphan; duplicate dimension keys do not
    multiply anything because an anti join emits each fact row at most once.
    NULL keys take a branch of their own, without a join, and the dimension's
    keys join as they are: nothing stands between exchange and sort, so AQE
    splits a hot fact key, and broadcasts only a key set it has measured.
    """
    keys = dim.select(F.col(dim_key).alias("__dim_key")).where(F.col("__dim_key").isNotNull())
    keyed = fact.where(F.col(fact_key).isNotNull())
    known = keyed.join(keys, F.col(fact_key) == F.col("__dim_key"), "left_anti")
    return known.union(fact.where(F.col(fact_key).isNull()))


def referential_integrity(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str
) -> DataFrame:
    """One row: ``invalid_references`` = number of orphan fact rows."""
    return orphans(fact, dim, fact_key, dim_key).agg(
        F.count(F.lit(1)).alias("invalid_references")
    )
