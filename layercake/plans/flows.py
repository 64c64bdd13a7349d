"""Layer flows: bronze landing, silver indicators, gold metrics, source gates.

Each flow chains the operators as lazy DataFrames and writes each output
once; checks that share an input with a sink read the written data back
instead of recomputing the source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake.functions import reshape
from layercake.operators import gold, incremental, quality, windows
from layercake.sinks import tables
from layercake.sources import files


def source_gate(source: DataFrame, universe: DataFrame, symbol_col: str, source_symbol: Column) -> DataFrame:
    """One status row: the canary symbol (smallest of the universe), its row
    count in the source, and ``CONTINUE`` / ``STOP``.

    The canary is an uncorrelated scalar subquery, evaluated once and used
    as a filter, so only the canary's rows are counted; nothing is collected
    and no join is planned.  An empty universe or canary gives ``STOP``.
    """
    spark = source.sparkSession
    canary = "(SELECT MIN(" + symbol_col + ") FROM {uni})"
    counted = spark.sql(
        "SELECT " + canary + " AS canary_symbol, COUNT(*) AS canary_rows FROM {src} "
        "WHERE _lc_sym = " + canary,
        src=source.select(source_symbol.alias("_lc_sym")),
        uni=universe,
    )
    return counted.withColumn(
        "status", F.when(F.col("canary_rows") > 0, F.lit("CONTINUE")).otherwise(F.lit("STOP"))
    )


def bronze(raw: DataFrame, out_root: str, group_cols: Sequence[Column], layout_cols: Sequence[str],
           unix_candidates: Sequence[str] = (), sep: str = "_") -> DataFrame:
    """Normalise landed raw records, profile them, write the bronze layout.

    flatten -> UNIX-time detection -> NaN->NULL; the normalised rows are
    written partitioned by ``layout_cols`` (which ``group_cols`` must name),
    schema snapshots and health stats are appended next to them, and the
    health frame is returned read back from storage.
    """
    flat = reshape.nan_to_null(reshape.convert_unix_times(reshape.flatten(raw, sep), unix_candidates))
    keyed = flat.select(*group_cols, *flat.columns)
    data_cols = flat.columns
    data_path, meta_path, health_path = f"{out_root}/data", f"{out_root}/_meta", f"{out_root}/health"
    # Every output is partitioned like the data and written with dynamic
    # partition overwrite, so re-landing a day replaces that day's rows,
    # snapshots and health stats instead of duplicating them.
    # Snapshots and health cover this run's groups only: earlier days keep the
    # schema and the counts they were landed with, and are not read.
    landed = tables.land_layout(keyed, data_path, list(layout_cols))
    tables.write_layout(tables.schema_snapshots(landed, list(layout_cols)), meta_path, list(layout_cols))
    health = quality.health(landed, list(layout_cols), data_cols)
    tables.write_layout(health, health_path, list(layout_cols))
    # Read back with the written schema: partition discovery would otherwise
    # turn a yyyy-MM-dd text key into a DATE.
    return keyed.sparkSession.read.schema(health.schema).parquet(health_path)


def silver(spark: SparkSession, new_json: str, store_base: str, json_schema: str,
           keys: Sequence[str], date_col: str, close_col: str, tie_break: Sequence[str],
           digits: int | None = 6) -> tuple[DataFrame, DataFrame, incremental.Run]:
    """New raw JSON into a day-partitioned store of indicators; returns
    (indicators read back, verdict row of the days computed in this run, the run).

    Raw rows meet raw rows, and indicators are computed again only where the
    new rows reach (see :mod:`layercake.operators.incremental`), so a rerun
    never mixes raw and derived columns and changes nothing.  A row with
    known keys, tie-break and date replaces the stored one: corrections
    count.  Raw rows and indicators become current together.
    """
    new = files.read_json(spark, new_json, "auto", schema=json_schema)
    store = incremental.Store(spark, store_base, keys, date_col, close_col, tie_break, digits)
    run = store.update(new)
    result = store.indicators()
    if result is None:  # nothing yet
        empty = new.limit(0).select(*keys, *tie_break, F.col(date_col).alias("Date"), F.col(close_col).alias("Close"))
        result = windows.indicators(empty, keys=keys, tie_break=tie_break, digits=digits)
    parts = tables.current_parts(spark, store_base).get(incremental.INDICATORS, {})
    written = [parts[d] for d in run.computed]
    checked = spark.read.schema(result.schema).parquet(*written) if written else result.limit(0)
    return result, quality.verdict(checked, F.col("Close").isNull()), run


def gold_flow(spark: SparkSession, silver_df: DataFrame, dim: DataFrame, rules_sql: str,
              group_by: Sequence[str], metrics: Sequence[str], fact_key: str, dim_key: str,
              csv_path: str) -> DataFrame:
    """Rules -> metrics -> integrity -> CSV export; returns the exported
    metrics with the orphan count of the fact as a column."""
    fact = gold.business_rules(spark, silver_df, rules_sql)
    metrics_df = gold.compute_metrics(fact, group_by, metrics)
    tables.export_csv(metrics_df, csv_path)
    exported = spark.read.option("header", True).schema(metrics_df.schema).csv(csv_path)
    integrity = gold.referential_integrity(fact, dim, fact_key, dim_key)
    return spark.sql(
        "SELECT m.*, (SELECT invalid_references FROM {ri}) AS invalid_references FROM {m} m",
        m=exported,
        ri=integrity,
    )
