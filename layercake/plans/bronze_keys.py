"""Bronze query keys: sources, sinks written and read back, layouts, backfill.

Every sink key writes a frame derived from the supplied tables to a fresh
folder under the session's shared checkpoint folder and reads it back, so
the comparison covers the round trip.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from layercake.functions import reshape
from layercake.plans.quality_keys import EVENT_COLS
from layercake.plans.registry import register
from layercake.session import configure, scratch_path, table
from layercake.sinks import tables
from layercake.sources import files

EVENTS_DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
EVENTS_SQL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"

# The four landed datasets of a symbol.
DATASETS = ("price", "recommendations", "news", "financials")
# Stand-in: which event type lands which dataset (errors land nothing).
LANDED_BY = {"purchase": "price", "click": "recommendations", "view": "news", "signup": "financials"}
BACKFILL_START, BACKFILL_END = "2024-01-01", "2024-01-30"


@register("scan_json", EVENTS_SQL, group="bronze")
def q_scan_json(spark, sf_dir):
    """Events landed as JSON Lines, read back with format auto-detection."""
    configure(spark)
    path = scratch_path(spark, "events_json")
    tables.write_json(table(spark, sf_dir, "events"), path)
    return files.read_json(spark, path, "auto", schema=EVENTS_DDL)


@register(
    "scan_parquet",
    "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase' AND value > 50",
    group="bronze",
)
def q_scan_parquet(spark, sf_dir):
    configure(spark)
    return files.read_parquet(
        spark, os.path.join(sf_dir, "events.parquet"), ["event_id", "user_id", "value"],
        "event_type = 'purchase' AND value > 50",
    )


@register("scan_csv_column", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS Symbol FROM events", group="bronze")
def q_scan_csv_column(spark, sf_dir):
    """Symbol universe: a headed CSV written from the data, one column read back."""
    configure(spark)
    path = scratch_path(spark, "universe_csv")
    table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("Symbol")).write.option(
        "header", True
    ).csv(path)
    return files.csv_column(spark, path, "Symbol")


@register(
    "flatten_json",
    """SELECT event_id AS event_id, user_id AS event_user_id, event_type AS event_user_kind,
              CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k, value AS value,
              1 AS n_tags
       FROM events""",
    group="bronze",
)
def q_flatten_json(spark, sf_dir):
    """Nested JSON objects (schema inferred) flattened to ``parent_child`` columns."""
    configure(spark)
    path = scratch_path(spark, "nested_json")
    ev = table(spark, sf_dir, "events")
    nested = ev.select(
        F.to_json(
            F.struct(
                F.struct(
                    F.col("event_id").alias("id"),
                    F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("kind")).alias("user"),
                ).alias("event"),
                F.col("value"),
                F.from_json("props", "k bigint").alias("props"),
                F.array("event_type").alias("tags"),
            )
        ).alias("value")
    )
    nested.write.text(path)
    flat = files.read_flat_json(spark, path, "auto", sep="_")
    return flat.select(
        "event_id", "event_user_id", "event_user_kind", "props_k", "value",
        F.size("tags").alias("n_tags"),
    )


def _landed(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumns(
        {"dt": F.date_format("ts", "yyyy-MM-dd"), "dataset": F.col("event_type")}
    )


@register(
    "bronze_layout",
    "SELECT strftime(ts, '%Y-%m-%d') AS dt, event_type AS dataset, event_id, user_id, value FROM events",
    group="bronze",
)
def q_bronze_layout(spark, sf_dir):
    """Events written partitioned by day and dataset, read back with pruning-ready columns."""
    configure(spark)
    path = scratch_path(spark, "bronze")
    tables.write_layout(_landed(spark, sf_dir), path, ["dt", "dataset"])
    schema = EVENTS_DDL + ", dt string, dataset string"
    return spark.read.schema(schema).parquet(path).select("dt", "dataset", "event_id", "user_id", "value")


def _events_ddl_string() -> str:
    return ("struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,"
            "value:double,props:string,dt:string,dataset:string>")


@register(
    "schema_history",
    f"""SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS dt, event_type AS dataset,
           '{_events_ddl_string()}' AS schema_ddl FROM events""",
    group="bronze",
)
def q_schema_history(spark, sf_dir):
    """Schema snapshot per landed (day, dataset), appended to a history table."""
    configure(spark)
    path = scratch_path(spark, "schema_history")
    snaps = tables.schema_snapshots(_landed(spark, sf_dir), ["dt", "dataset"])
    snaps.write.mode("append").parquet(path)
    return spark.read.parquet(path)


@register("parquet_snapshot", EVENTS_SQL, group="bronze")
def q_parquet_snapshot(spark, sf_dir):
    """Silver snapshot rewritten from itself plus new rows, then swapped in."""
    configure(spark)
    base = scratch_path(spark, "silver_snapshot")
    ev = table(spark, sf_dir, "events")
    tables.write_snapshot(ev.filter("value <= 100"), base)
    current = tables.read_snapshot(spark, base)
    tables.write_snapshot(current.unionByName(ev.filter("(value <= 100) IS NOT TRUE")), base)
    return tables.read_snapshot(spark, base)


@register("append_table", EVENTS_SQL, group="bronze")
def q_append_table(spark, sf_dir):
    """Create-if-missing then append, into an external table in shared storage."""
    configure(spark)
    path = scratch_path(spark, "append_table")
    name = "lc_append_" + path.rsplit("-", 1)[-1]
    ev = table(spark, sf_dir, "events")
    tables.save_or_append(ev.filter("value <= 50"), name, path)
    tables.save_or_append(ev.filter("(value <= 50) IS NOT TRUE"), name, path)
    return spark.read.parquet(path).select(*EVENT_COLS)


@register(
    "union_incremental",
    """SELECT event_id, ts, user_id, event_type, value,
              CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN NULL ELSE props END AS props
       FROM events""",
    group="bronze",
)
def q_union_incremental(spark, sf_dir):
    """New JSON (no ``props``) unioned by name with the existing Parquet."""
    configure(spark)
    ev = table(spark, sf_dir, "events")
    old_path, new_path = scratch_path(spark, "silver_old"), scratch_path(spark, "bronze_new")
    ev.filter("ts < TIMESTAMP '2024-01-16'").write.parquet(old_path)
    tables.write_json(ev.filter("(ts < TIMESTAMP '2024-01-16') IS NOT TRUE").drop("props"), new_path)
    old = files.read_parquet(spark, old_path)
    new = files.read_json(
        spark, new_path, "auto",
        schema="event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    )
    return old.unionByName(new, allowMissingColumns=True).select(*EVENT_COLS)


def _report(spark, report: dict):
    """A schema report as rows (one per column)."""
    rows = [(report["type"], c, t, report["rows_sampled"]) for c, t in report["columns"].items()]
    return spark.createDataFrame(rows, "format string, column_name string, type string, rows_sampled bigint")


def _report_sql(fmt: str, types: dict[str, str], rows: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{fmt}' AS format, '{c}' AS column_name, '{t}' AS type, CAST({rows} AS BIGINT) AS rows_sampled FROM events"
        for c, t in types.items()
    )


@register(
    "csv_schema_report",
    _report_sql(
        "csv", {"event_id": "int", "ts": "timestamp", "event_type": "string", "value": "double"}, "LEAST(COUNT(*), 10)"
    ),
    group="bronze",
)
def q_csv_schema_report(spark, sf_dir):
    """Types of a landed CSV from its header and first ten rows (the sample is the feature)."""
    configure(spark)
    path = scratch_path(spark, "csv_report")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    events.write.option("header", True).csv(path)
    return _report(spark, files.csv_schema_sample(spark, path))


@register(
    "json_schema_report",
    _report_sql(
        "json", {"event_id": "bigint", "ts": "string", "event_type": "string", "value": "double"}, "COUNT(*)"
    ),
    group="bronze",
)
def q_json_schema_report(spark, sf_dir):
    """Types and row count of landed JSON lines."""
    configure(spark)
    path = scratch_path(spark, "json_report")
    table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value").write.json(path)
    return _report(spark, files.json_schema_profile(spark, path))


@register(
    "object_manifest",
    """SELECT lang, CAST(SUM(strlen(coalesce(text, '')) + 1) AS BIGINT) AS total_bytes
       FROM documents GROUP BY lang""",
    group="bronze",
)
def q_object_manifest(spark, sf_dir):
    """Documents landed as text files per language, scanned as objects and stored."""
    configure(spark)
    src, dst = scratch_path(spark, "media"), scratch_path(spark, "objects")
    docs = table(spark, sf_dir, "documents").select("lang", F.coalesce("text", F.lit("")).alias("text"))
    docs.write.partitionBy("lang").text(src)
    stored = tables.store_objects(files.read_objects(spark, src, "*.txt"), dst, root=src)
    return stored.groupBy("lang").agg(F.sum("length").cast("bigint").alias("total_bytes"))


def _grid_sql() -> str:
    ds = ", ".join(f"'{d}'" for d in DATASETS)
    landed = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LANDED_BY.items())
    return f"""WITH s AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS symbol FROM events),
      d AS (SELECT strftime(CAST(x AS DATE), '%Y-%m-%d') AS run_date
            FROM range(DATE '{BACKFILL_START}', DATE '{BACKFILL_END}' + INTERVAL 1 DAY, INTERVAL 1 DAY) t(x)),
      k AS (SELECT unnest([{ds}]) AS dataset),
      landed AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS run_date, CAST(user_id AS VARCHAR) AS symbol,
                        CASE event_type {landed} END AS dataset FROM events)
    SELECT d.run_date, s.symbol, k.dataset FROM s, d, k
    WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.run_date = d.run_date
                      AND l.symbol = s.symbol AND l.dataset = k.dataset)"""


def backfill_missing(symbols, landed, start: str, end: str, datasets=DATASETS):
    """(run_date, symbol, dataset) work items not yet landed.

    The grid is generated per symbol row (``explode`` of the day sequence and
    of the dataset list), not by a join, then anti-joined with what landed.
    """
    grid = (
        symbols.select("symbol", F.explode(reshape.expand_dates(start, end)).alias("day"))
        .select(F.date_format("day", "yyyy-MM-dd").alias("run_date"), "symbol")
        .select("run_date", "symbol", F.explode(F.array(*[F.lit(d) for d in datasets])).alias("dataset"))
    )
    return grid.join(landed, ["run_date", "symbol", "dataset"], "left_anti")


@register("backfill_grid", _grid_sql(), group="bronze")
def q_backfill_grid(spark, sf_dir):
    configure(spark)
    ev = table(spark, sf_dir, "events")
    symbols = ev.select(F.col("user_id").cast("string").alias("symbol")).distinct()
    lookup = F.create_map(*[F.lit(x) for kv in LANDED_BY.items() for x in kv])
    landed = ev.select(
        F.date_format("ts", "yyyy-MM-dd").alias("run_date"),
        F.col("user_id").cast("string").alias("symbol"),
        F.try_element_at(lookup, F.col("event_type")).alias("dataset"),
    ).filter(F.col("dataset").isNotNull()).distinct()
    return backfill_missing(symbols, landed, BACKFILL_START, BACKFILL_END)
