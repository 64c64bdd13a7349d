"""Gold-layer query keys: business-rule fact, metrics, integrity, exports.

Stand-ins: the fact is ``events`` (price = value, name = event_type); the
integrity pair is ``documents.doc_id`` against ``labels.doc_id``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from layercake.operators import gold
from layercake.plans.registry import register
from layercake.session import configure, scratch_path, table
from layercake.sinks import tables

# Fixed values of the reference's gold walk-through.
PRICE_THRESHOLD = 100
RULES_SQL = f"WHERE value > {PRICE_THRESHOLD}"


def gold_fact_frame(spark: SparkSession, sf_dir: str):
    return gold.business_rules(spark, table(spark, sf_dir, "events"), RULES_SQL)


def gold_metrics_frame(spark: SparkSession, sf_dir: str):
    return gold.compute_metrics(
        gold_fact_frame(spark, sf_dir),
        group_by=["event_type"],
        metrics=[
            "event_type",
            "COUNT(*) AS total_orders",
            "ROUND(SUM(value), 6) AS total_sales",
        ],
    ).withColumnRenamed("event_type", "name")


@register(
    "gold_fact",
    f"SELECT * FROM events WHERE value > {PRICE_THRESHOLD}",
    group="gold",
)
def q_gold_fact(spark, sf_dir):
    configure(spark)
    return gold_fact_frame(spark, sf_dir)


@register(
    "gold_metrics",
    f"""SELECT event_type AS name, COUNT(*) AS total_orders,
           ROUND(SUM(value), 6) AS total_sales
        FROM events WHERE value > {PRICE_THRESHOLD} GROUP BY event_type""",
    group="gold",
)
def q_gold_metrics(spark, sf_dir):
    configure(spark)
    return gold_metrics_frame(spark, sf_dir)


@register(
    "gold_metrics_global",
    f"""SELECT COUNT(*) AS total_orders, ROUND(SUM(value), 6) AS total_sales,
           ROUND(AVG(value), 6) AS avg_sale, MAX(value) AS max_sale
        FROM events WHERE value > {PRICE_THRESHOLD}""",
    group="gold",
)
def q_gold_metrics_global(spark, sf_dir):
    configure(spark)
    return gold.compute_metrics(
        gold_fact_frame(spark, sf_dir),
        metrics=[
            "COUNT(*) AS total_orders",
            "ROUND(SUM(value), 6) AS total_sales",
            "ROUND(AVG(value), 6) AS avg_sale",
            "MAX(value) AS max_sale",
        ],
    )


@register(
    "referential_integrity",
    """SELECT COUNT(*) AS invalid_references
       FROM documents f LEFT JOIN labels d ON f.doc_id = d.doc_id
       WHERE d.doc_id IS NULL""",
    group="gold",
)
def q_referential_integrity(spark, sf_dir):
    configure(spark)
    return gold.referential_integrity(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id", "doc_id"
    )


@register(
    "orphan_rows",
    """SELECT f.doc_id, f.lang, f.source, f.n_chars
       FROM documents f LEFT JOIN labels d ON f.doc_id = d.doc_id
       WHERE d.doc_id IS NULL""",
    group="gold",
)
def q_orphan_rows(spark, sf_dir):
    configure(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return gold.orphans(docs, table(spark, sf_dir, "labels"), "doc_id", "doc_id")


@register(
    "sql_step",
    """SELECT event_type, COUNT(*) AS n, ROUND(AVG(value), 6) AS avg_value,
              MIN(ts) AS first_ts, MAX(ts) AS last_ts
       FROM events GROUP BY event_type""",
    group="gold",
)
def q_sql_step(spark, sf_dir):
    """An arbitrary SQL string over frames, returned lazily (no collect)."""
    configure(spark)
    return spark.sql(
        """SELECT event_type, COUNT(*) AS n, ROUND(AVG(value), 6) AS avg_value,
                  MIN(ts) AS first_ts, MAX(ts) AS last_ts
           FROM {events} GROUP BY event_type""",
        events=table(spark, sf_dir, "events"),
    )


@register(
    "csv_roundtrip",
    f"""SELECT event_type AS name, COUNT(*) AS total_orders,
           ROUND(SUM(value), 6) AS total_sales
        FROM events WHERE value > {PRICE_THRESHOLD} GROUP BY event_type""",
    group="gold",
)
def q_csv_roundtrip(spark, sf_dir):
    """Gold metrics exported as CSV (header, comma) and read back typed."""
    configure(spark)
    path = scratch_path(spark, "gold_metrics_csv")
    tables.export_csv(gold_metrics_frame(spark, sf_dir), path)
    return tables.read_csv(spark, path, "name string, total_orders bigint, total_sales double")
