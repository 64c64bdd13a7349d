"""End-to-end layer flows and the vector mart as query keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from layercake.operators import incremental, vectors
from layercake.plans import flows
from layercake.plans.bronze_keys import EVENTS_DDL
from layercake.plans.event_keys import hourly_averages, sensor_rows, sensor_text
from layercake.plans.gold_keys import PRICE_THRESHOLD, RULES_SQL
from layercake.plans.registry import register
from layercake.plans.silver_keys import _indicator_sql
from layercake.session import configure, scratch_path, table
from layercake.sinks import tables
from layercake.sources import files


@register(
    "source_gate",
    """SELECT CAST(MIN(user_id) AS VARCHAR) AS canary_symbol,
              (SELECT COUNT(*) FROM events WHERE CAST(user_id AS VARCHAR) =
                  (SELECT CAST(MIN(user_id) AS VARCHAR) FROM events)) AS canary_rows,
              CASE WHEN (SELECT COUNT(*) FROM events WHERE CAST(user_id AS VARCHAR) =
                  (SELECT CAST(MIN(user_id) AS VARCHAR) FROM events)) > 0
                   THEN 'CONTINUE' ELSE 'STOP' END AS status
       FROM events""",
    group="flow",
)
def q_source_gate(spark, sf_dir):
    """Universe from a landed CSV; its first symbol is the canary for the run."""
    configure(spark)
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "gate_universe")
    events.select(F.col("user_id").cast("string").alias("Symbol")).distinct().write.option(
        "header", True
    ).csv(path)
    universe = files.csv_column(spark, path, "Symbol")
    return flows.source_gate(events, universe.selectExpr("CAST(Symbol AS BIGINT) AS s"), "s",
                             F.col("user_id")).select(
        F.col("canary_symbol").cast("string").alias("canary_symbol"), "canary_rows", "status"
    )


_BRONZE_COLS = ["event_id", "event_user", "kind", "time", "value", "props_k"]


def _bronze_health_sql() -> str:
    cols = _BRONZE_COLS
    base = """SELECT strftime(ts, '%Y-%m-%d') AS dt, event_type AS kind_p,
                     event_id, user_id AS event_user, event_type AS kind,
                     date_trunc('second', ts) AS time, value,
                     CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k FROM events"""
    parts = ["SELECT dt, kind_p, 'row_count' AS metric, CAST(NULL AS VARCHAR) AS column_name, "
             "COUNT(*) AS value FROM e GROUP BY dt, kind_p"]
    for c in cols:
        cond = f"{c} IS NULL" + (f" OR isnan({c})" if c == "value" else "")
        parts.append(f"SELECT dt, kind_p, 'null_count', '{c}', COUNT(*) FILTER (WHERE {cond}) "
                     "FROM e GROUP BY dt, kind_p")
    parts.append(
        "SELECT dt, kind_p, 'duplicate_rows', CAST(NULL AS VARCHAR), CAST(SUM(c - 1) AS BIGINT) FROM "
        f"(SELECT dt, kind_p, {', '.join(cols)}, COUNT(*) AS c FROM e GROUP BY ALL) GROUP BY dt, kind_p"
    )
    return (f"WITH e AS ({base}) SELECT dt, kind_p AS dataset, metric, column_name, "
            f"CAST(value AS BIGINT) AS value FROM ({' UNION ALL '.join(parts)})")


@register("flow_bronze", _bronze_health_sql(), group="flow")
def q_flow_bronze(spark, sf_dir):
    """Raw nested JSON with epoch times -> flatten, time detection, NaN->NULL ->
    day/dataset layout, schema history, health stats (returned)."""
    configure(spark)
    ev = table(spark, sf_dir, "events")
    raw_path, root = scratch_path(spark, "raw_landing"), scratch_path(spark, "bronze_flow")
    raw = ev.select(
        F.to_json(
            F.struct(
                F.struct(F.col("event_id").alias("id"), F.col("user_id").alias("user")).alias("event"),
                F.col("event_type").alias("kind"),
                F.unix_seconds(F.col("ts").cast("timestamp")).alias("time"),
                F.col("value"),
                F.from_json("props", "k bigint").alias("props"),
            )
        ).alias("value")
    )
    raw.write.text(raw_path)
    landed = files.read_json(spark, raw_path, "auto")
    health = flows.bronze(
        landed, root,
        group_cols=[F.date_format("time", "yyyy-MM-dd").alias("dt"),
                    F.col("kind").alias("dataset")],
        layout_cols=["dt", "dataset"], unix_candidates=["time"],
    )
    return health.select("dt", "dataset", "metric", "column_name", F.col("value").cast("bigint"))


def _landed_store(spark, ev):
    """The silver store of the events after two landings; every run must be valid."""
    base = scratch_path(spark, "silver_flow")
    early = F.coalesce(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"), F.lit(False))
    wrong = F.col("event_id") % 500 == 3
    landings = [
        ev.where(early).withColumn("value", F.when(wrong, F.col("value") + 1000).otherwise(F.col("value"))),
        ev.where(~early | wrong),
    ]
    for landing in landings:
        new_path = scratch_path(spark, "silver_new_json")
        tables.write_json(landing, new_path)
        _, verdict, _ = flows.silver(
            spark, new_path, base, EVENTS_DDL, keys=["event_type"], date_col="ts", close_col="value", tie_break=["event_id"],
        )
        if verdict.first()["validation_status"] != "VALID":
            raise ValueError("silver validation failed: NULL Close")
    return incremental.Store(spark, base, ["event_type"], "ts", "value", ["event_id"])


@register(
    "silver_order",
    """SELECT event_type, event_id, ts AS Date, value AS Close,
              ROW_NUMBER() OVER (ORDER BY ts, event_id, event_type) - 1 AS position FROM events""",
    group="flow",
)
def q_silver_order(spark, sf_dir):
    """Where the rows of the silver files stand: the files' manifest and their rows' places are in date order."""
    configure(spark)
    placed = _landed_store(spark, table(spark, sf_dir, "events")).positions()
    return placed.select("event_type", "event_id", "Date", "Close", "position")


@register("flow_silver", _indicator_sql("PARTITION BY event_type"), group="flow")
def q_flow_silver(spark, sf_dir):
    """Two landings: the first days, some prices wrong; then the rest, with the corrections."""
    configure(spark)
    ev = table(spark, sf_dir, "events")
    return _landed_store(spark, ev).indicators()


@register(
    "flow_gold",
    f"""SELECT event_type AS name, COUNT(*) AS total_orders, ROUND(SUM(value), 6) AS total_sales,
           (SELECT COUNT(*) FROM events f LEFT JOIN customer d ON f.user_id = d.c_custkey
            WHERE d.c_custkey IS NULL AND f.value > {PRICE_THRESHOLD}) AS invalid_references
        FROM events WHERE value > {PRICE_THRESHOLD} GROUP BY event_type""",
    group="flow",
)
def q_flow_gold(spark, sf_dir):
    """Fact rule -> metrics -> integrity against customers -> CSV export."""
    configure(spark)
    metrics = ["event_type AS name", "COUNT(*) AS total_orders", "ROUND(SUM(value), 6) AS total_sales"]
    out = flows.gold_flow(
        spark, table(spark, sf_dir, "events"), table(spark, sf_dir, "customer"), RULES_SQL,
        ["event_type"], metrics, "user_id", "c_custkey", scratch_path(spark, "gold_csv"),
    )
    return out.drop("event_type") if "event_type" in out.columns else out


@register(
    "embed_rows",
    """SELECT user_id AS id, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS timestamp,
              1536 AS dim, CAST(4.0 AS FLOAT) AS n_tokens
       FROM events WHERE ts IS NOT NULL GROUP BY user_id, date_trunc('hour', ts)""",
    group="vectors",
)
def q_embed_rows(spark, sf_dir):
    """Device-hour averages -> text -> hashed embedding -> vector rows, stored twice over and read back once."""
    configure(spark)
    rows = sensor_rows(table(spark, sf_dir, "events"))
    text = hourly_averages(rows, "id").withColumn("text", sensor_text())
    vec = vectors.vector_rows(vectors.embed(text, sparse=True), "id", "embedding", "window_start")
    path = scratch_path(spark, "sensor_embeddings")
    vectors.upsert_vectors(vec.where("id % 2 = 0"), path)
    vectors.upsert_vectors(vec, path)
    stored = vectors.read_vectors(spark, path)
    return stored.select(
        "id", "timestamp", F.size("embedding").alias("dim"),
        F.aggregate("embedding", F.lit(0.0).cast("float"), lambda a, x: a + x).alias("n_tokens"),
    )
