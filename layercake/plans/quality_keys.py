"""Schema and data-quality query keys.

Stand-ins: the checked frame is ``events`` (bounds on ``value``); nulls come
from ``documents`` left-joined to ``labels``; health groups are
``(day of ts, event_type)``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from layercake.operators import quality
from layercake.plans.registry import register
from layercake.session import configure, table

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
DOC_LABEL_COLS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]

# Parameters of the checks (ours; the reference's example uses age 18..60).
VALUE_BOUNDS = {"value": (0, 100), "user_id": (1, None), "missing_col": (0, 1)}
EXPECTED_SCHEMA = {
    "event_id": "int64",
    "ts": "datetime64[ns]",
    "value": "float64",
    "event_type": "object",
    "user_id": "int32",
    "device": "object",
}
REQUIRED = ["event_id", "value", "user_id"]
ALL_BOUNDS = {"value": (0, 100), "missing_col": (0, 1)}


def docs_with_labels(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left").select(*DOC_LABEL_COLS)


DOCS_WITH_LABELS_SQL = """SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


@register(
    "infer_schema",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS logical_type, COUNT({c}) AS non_null FROM events"
        for c, t in [
            ("event_id", "INTEGER"),
            ("ts", "TIMESTAMP"),
            ("user_id", "INTEGER"),
            ("event_type", "STRING"),
            ("value", "FLOAT"),
            ("props", "STRING"),
        ]
    ),
    group="quality",
)
def q_infer_schema(spark, sf_dir):
    configure(spark)
    return quality.profile(table(spark, sf_dir, "events"))


@register(
    "null_counts",
    f"""WITH j AS ({DOCS_WITH_LABELS_SQL})
    SELECT * FROM (
      {" UNION ALL ".join(f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count FROM j" for c in DOC_LABEL_COLS)}
    ) WHERE null_count > 0""",
    group="quality",
)
def q_null_counts(spark, sf_dir):
    configure(spark)
    df = docs_with_labels(spark, sf_dir)
    stats = quality.check_stats(df, DOC_LABEL_COLS)
    return quality.null_errors_frame(stats, DOC_LABEL_COLS)


@register(
    "min_max_check",
    """SELECT column_name, error FROM (
      SELECT 'value' AS column_name, concat_ws('; ',
          CASE WHEN bool_or(value < 0) THEN 'Values below min 0' END,
          CASE WHEN bool_or(value > 100) THEN 'Values above max 100' END) AS error FROM events
      UNION ALL
      SELECT 'user_id', concat_ws('; ',
          CASE WHEN bool_or(user_id < 1) THEN 'Values below min 1' END) FROM events
      UNION ALL
      SELECT 'missing_col', 'Column not found'
    ) WHERE error <> ''""",
    group="quality",
)
def q_min_max_check(spark, sf_dir):
    configure(spark)
    df = table(spark, sf_dir, "events")
    stats = quality.check_stats(df, [], VALUE_BOUNDS)
    return quality.bound_errors_frame(stats, df.columns, VALUE_BOUNDS)


@register(
    "validate_all",
    """WITH s AS (
         SELECT COUNT(*) FILTER (WHERE event_id IS NULL) AS n1,
                COUNT(*) FILTER (WHERE value IS NULL OR isnan(value)) AS n2,
                COUNT(*) FILTER (WHERE user_id IS NULL) AS n3,
                coalesce(bool_or(value < 0 AND NOT isnan(value)), false) AS low,
                coalesce(bool_or(value > 100 AND NOT isnan(value)), false) AS high
         FROM events),
       t AS (
         SELECT *, CAST(n1 > 0 AS INT) + CAST(n2 > 0 AS INT) + CAST(n3 > 0 AS INT) AS nulls,
                CAST(low OR high AS INT) + 1 AS bad,
                concat_ws(',', CASE WHEN n1 > 0 THEN '"event_id":' || n1 END,
                          CASE WHEN n2 > 0 THEN '"value":' || n2 END,
                          CASE WHEN n3 > 0 THEN '"user_id":' || n3 END) AS null_text,
                concat_ws('; ', CASE WHEN low THEN 'Values below min 0' END,
                          CASE WHEN high THEN 'Values above max 100' END) AS bound_text
         FROM s)
       SELECT false AS schema_valid, nulls = 0 AS nulls_valid, bad = 0 AS min_max_valid,
              CAST(2 AS BIGINT) AS schema_errors, CAST(nulls AS BIGINT) AS null_errors,
              CAST(bad AS BIGINT) AS min_max_errors, false AS overall_valid,
              '{"schema":{"user_id":"Expected int32, got bigint","device":"Missing column"},"nulls":{'
              || null_text || '},"min_max":{'
              || concat_ws(',', CASE WHEN bound_text <> '' THEN '"value":"' || bound_text || '"' END,
                           '"missing_col":"Column not found"') || '}}' AS errors
       FROM t""",
    group="quality",
)
def q_validate_all(spark, sf_dir):
    configure(spark)
    return quality.validate_all(table(spark, sf_dir, "events"), EXPECTED_SCHEMA, REQUIRED, ALL_BOUNDS)


@register(
    "silver_validate",
    """SELECT CASE WHEN COUNT(*) = 0 THEN 'VALID' ELSE 'INVALID' END AS validation_status
       FROM events WHERE value IS NULL""",
    group="quality",
)
def q_silver_validate(spark, sf_dir):
    configure(spark)
    return quality.verdict(table(spark, sf_dir, "events"), F.col("value").isNull())


def _health_sql(extra_group: str = "", batch_key: str | None = None) -> str:
    cols = EVENT_COLS
    base = "SELECT strftime(ts, '%Y-%m-%d') AS run_date, event_type AS symbol, *"
    if batch_key:
        base += f", {batch_key} AS batch"
    g = "run_date, symbol" + (", batch" if batch_key else "")
    parts = [f"SELECT {g}, 'row_count' AS metric, CAST(NULL AS VARCHAR) AS column_name, COUNT(*) AS value FROM e GROUP BY {g}"]
    for c in cols:
        cond = f"{c} IS NULL" + (f" OR isnan({c})" if c == "value" else "")
        parts.append(
            f"SELECT {g}, 'null_count', '{c}', COUNT(*) FILTER (WHERE {cond}) FROM e GROUP BY {g}"
        )
    parts.append(
        f"SELECT {g}, 'duplicate_rows', CAST(NULL AS VARCHAR), CAST(SUM(c - 1) AS BIGINT) FROM "
        f"(SELECT {g}, {', '.join(cols)}, COUNT(*) AS c FROM e GROUP BY ALL) GROUP BY {g}"
    )
    body = " UNION ALL ".join(parts)
    if batch_key:
        return (
            f"WITH e AS ({base} FROM events), t AS ({body}) "
            "SELECT run_date, symbol, 'events' AS dataset, metric, column_name, "
            "CAST(SUM(value) AS BIGINT) AS value FROM t GROUP BY run_date, symbol, metric, column_name"
        )
    return (
        f"WITH e AS ({base} FROM events), t AS ({body}) "
        "SELECT run_date, symbol, 'events' AS dataset, metric, column_name, CAST(value AS BIGINT) AS value FROM t"
    )


def health_frame(df):
    return quality.health(
        df, [F.date_format("ts", "yyyy-MM-dd").alias("run_date"), F.col("event_type").alias("symbol")], EVENT_COLS
    ).select("run_date", "symbol", F.lit("events").alias("dataset"), "metric", "column_name", "value")


@register("health_report", _health_sql(), group="quality")
def q_health_report(spark, sf_dir):
    configure(spark)
    return health_frame(table(spark, sf_dir, "events"))


@register("health_merge", _health_sql(batch_key="hour(ts) < 12"), group="quality")
def q_health_merge(spark, sf_dir):
    """Two landing batches (morning / afternoon) profiled apart, then merged."""
    configure(spark)
    events = table(spark, sf_dir, "events")
    morning = health_frame(events.filter(F.hour("ts") < 12))
    afternoon = health_frame(events.filter(F.coalesce(F.hour("ts") >= 12, F.lit(True))))
    return quality.merge_health(
        [morning, afternoon], ["run_date", "symbol", "dataset"]
    ).select("run_date", "symbol", "dataset", "metric", "column_name", "value")


SCHEMA_EXPECTED = {"event_id": "int64", "user_id": "int32", "props": "float64", "device": "object"}


@register(
    "schema_check",
    """SELECT 'event_id' AS column_name, 'int64' AS expected, 'bigint' AS actual,
              CAST(NULL AS VARCHAR) AS error,
              COUNT(*) FILTER (WHERE event_id IS NOT NULL AND TRY_CAST(event_id AS BIGINT) IS NULL) AS bad_values
       FROM events
       UNION ALL
       SELECT 'user_id', 'int32', 'bigint', 'Expected int32, got bigint',
              COUNT(*) FILTER (WHERE user_id IS NOT NULL AND TRY_CAST(user_id AS INTEGER) IS NULL) FROM events
       UNION ALL
       SELECT 'props', 'float64', 'string', 'Expected float64, got string',
              COUNT(*) FILTER (WHERE props IS NOT NULL AND TRY_CAST(props AS DOUBLE) IS NULL) FROM events
       UNION ALL
       SELECT 'device', 'object', NULL, 'Missing column', 0""",
    group="quality",
)
def q_schema_check(spark, sf_dir):
    """Expected schema (pandas dtype names) vs the table, with non-castable value counts."""
    configure(spark)
    return quality.schema_conformance(table(spark, sf_dir, "events"), SCHEMA_EXPECTED)
