"""Silver query keys: cleaning chain, imputation, casts, indicators.

Stand-ins: price bars are ``events`` (``Date = ts``, ``Close = value``) with
one series per ``event_type``; the global variant is one series over the
whole table.  ``event_id`` breaks ties in every ROWS frame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from layercake.functions.numeric import round_half_up
from layercake.functions import clean, reshape
from layercake.operators import windows
from layercake.plans.quality_keys import DOCS_WITH_LABELS_SQL, docs_with_labels
from layercake.plans.registry import register
from layercake.session import configure, table

# The silver job's fill defaults and category labels, applied
# to our stand-in columns.
NULL_FILL = {"quality": -1, "toxic": 0, "lang": "UNKNOWN"}
CATEGORY_MAP = {"click": "Type1", "view": "Type2", "purchase": "Type3"}


def bars(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_type", "event_id", F.col("ts").alias("Date"), F.col("value").alias("Close")
    )


def _indicator_sql(partition: str) -> str:
    def w(n: int) -> str:
        return f"({partition} ORDER BY ts, event_id ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"

    # Rounded at nine decimals first: many averages of prices are exact ties
    # at the sixth, which the last bit of a sum must not decide.
    def ma(n: int) -> str:
        return f"ROUND(ROUND(AVG(value) OVER {w(n)}, 9), 6)"

    return f"""SELECT event_type, event_id, Date, Close,
        MA20, MA50, MA200, MA20 AS BB_Mid, ROUND(ROUND(BB_Std, 9), 6) AS BB_Std,
        ROUND(ROUND(mean + 2 * BB_Std, 9), 6) AS BB_Upper, ROUND(ROUND(mean - 2 * BB_Std, 9), 6) AS BB_Lower
      FROM (SELECT event_type, event_id, ts AS Date, value AS Close,
              {ma(20)} AS MA20, {ma(50)} AS MA50, {ma(200)} AS MA200,
              AVG(value) OVER {w(20)} AS mean, STDDEV_SAMP(value) OVER {w(20)} AS BB_Std
            FROM events)"""


@register("silver_indicators", _indicator_sql("PARTITION BY event_type"), group="silver")
def q_silver_indicators(spark, sf_dir):
    configure(spark)
    return windows.indicators(
        bars(spark, sf_dir), keys=["event_type"], tie_break=["event_id"], digits=6
    )


@register("silver_indicators_global", _indicator_sql(""), group="silver")
def q_silver_indicators_global(spark, sf_dir):
    configure(spark)
    return windows.indicators(bars(spark, sf_dir), tie_break=["event_id"], digits=6)


@register(
    "silver_clean",
    f"""WITH j AS (SELECT DISTINCT * FROM ({DOCS_WITH_LABELS_SQL}))
    SELECT doc_id, COALESCE(lang, 'UNKNOWN') AS lang, source,
           CAST(n_chars AS INTEGER) AS n_chars, COALESCE(quality, -1) AS quality,
           CAST(COALESCE(toxic, 0) AS BOOLEAN) AS toxic
    FROM j""",
    group="silver",
)
def q_silver_clean(spark, sf_dir):
    configure(spark)
    return clean.silver_clean(
        docs_with_labels(spark, sf_dir),
        dedup_rows=True,
        null_rules=NULL_FILL,
        cast_types={"n_chars": "int", "toxic": "boolean"},
    )


@register("dedup_rows", "SELECT DISTINCT lang, source, text FROM documents", group="silver")
def q_dedup_rows(spark, sf_dir):
    configure(spark)
    return clean.dedup(table(spark, sf_dir, "documents").select("lang", "source", "text"))


@register(
    "impute_nulls",
    f"""SELECT doc_id, COALESCE(quality, -1) AS quality, COALESCE(toxic, 0) AS toxic
        FROM ({DOCS_WITH_LABELS_SQL})""",
    group="silver",
)
def q_impute_nulls(spark, sf_dir):
    configure(spark)
    df = docs_with_labels(spark, sf_dir).select("doc_id", "quality", "toxic")
    return clean.impute(df, NULL_FILL)


@register(
    "cast_columns",
    """SELECT CAST(event_id AS DOUBLE) AS event_id, CAST(value AS INTEGER) AS value,
              CAST(user_id AS VARCHAR) AS user_id FROM events""",
    group="silver",
)
def q_cast_columns(spark, sf_dir):
    configure(spark)
    df = table(spark, sf_dir, "events").select("event_id", "value", "user_id")
    return clean.cast_columns(df, {"value": "int", "user_id": "string", "event_id": "double"})


@register(
    "map_categories",
    """SELECT event_id, event_type,
              COALESCE(CASE event_type WHEN 'click' THEN 'Type1' WHEN 'view' THEN 'Type2'
                                       WHEN 'purchase' THEN 'Type3' END,
                       COALESCE(event_type, 'UNKNOWN')) AS category
       FROM events""",
    group="silver",
)
def q_map_categories(spark, sf_dir):
    configure(spark)
    df = table(spark, sf_dir, "events").select("event_id", "event_type")
    df = df.withColumn("category", F.col("event_type"))
    df = clean.fill_defaults(df, {"category": "UNKNOWN"})
    return clean.map_categories(df, "category", CATEGORY_MAP)


@register(
    "nan_to_null",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value
       FROM events""",
    group="silver",
)
def q_nan_to_null(spark, sf_dir):
    """Error readings arrive as NaN (as a pandas source would hand them over)."""
    configure(spark)
    df = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
    )
    return reshape.nan_to_null(df)


@register(
    "unix_time_detect",
    """SELECT event_id, user_id, date_trunc('second', ts) AS ts_s,
              date_trunc('millisecond', ts) AS ts_ms FROM events""",
    group="silver",
)
def q_unix_time_detect(spark, sf_dir):
    """Epoch columns (seconds and milliseconds) are found and converted; ids are not."""
    configure(spark)
    ts = F.col("ts").cast("timestamp")
    df = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.unix_seconds(ts).alias("ts_s"), F.unix_millis(ts).alias("ts_ms")
    )
    return reshape.convert_unix_times(df, ["user_id", "ts_s", "ts_ms"])


@register(
    "unpivot_metrics",
    """WITH w AS (SELECT event_type, CAST(COUNT(*) AS DOUBLE) AS n, ROUND(SUM(value), 6) AS total,
                        ROUND(AVG(value), 6) AS mean, MAX(value) AS peak
                 FROM events GROUP BY event_type)
       SELECT event_type, 'n' AS metric, n AS value FROM w
       UNION ALL SELECT event_type, 'total', total FROM w
       UNION ALL SELECT event_type, 'mean', mean FROM w
       UNION ALL SELECT event_type, 'peak', peak FROM w""",
    group="silver",
)
def q_unpivot_metrics(spark, sf_dir):
    configure(spark)
    wide = table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        round_half_up(F.sum("value"), 6).alias("total"),
        round_half_up(F.avg("value"), 6).alias("mean"),
        F.max("value").alias("peak"),
    )
    return reshape.unpivot(wide, ["event_type"], ["n", "total", "mean", "peak"])


@register(
    "wide_report",
    """SELECT event_type, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day,
              ROUND(SUM(value), 6) AS total
       FROM events WHERE ts IS NOT NULL
       GROUP BY event_type, date_trunc('day', ts)""",
    group="silver",
)
def q_wide_report(spark, sf_dir):
    """Daily totals as wide reports (one column per day, labelled by timestamp),
    relabelled to dates and turned back into records.

    The days are those that the data spans, a report for every year of them.
    """
    configure(spark)
    from datetime import datetime, timedelta

    events = table(spark, sf_dir, "events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    if first is None:
        first = last = datetime(1970, 1, 1)

    def report(year: int):
        start = max(datetime(year, 1, 1), datetime(first.year, first.month, first.day))
        end = min(datetime(year, 12, 31), last)
        days = [start + timedelta(days=i) for i in range((end - start).days + 1)]
        part = events.filter((F.col("ts") >= F.lit(start)) & (F.col("ts") < F.lit(days[-1] + timedelta(days=1))))
        wide = reshape.wide_by(
            part, ["event_type"], F.date_trunc("day", "ts").cast("string"), F.sum("value"),
            [d.strftime("%Y-%m-%d %H:%M:%S") for d in days],
        )
        return reshape.unpivot(
            reshape.date_labels(wide), ["event_type"], [d.strftime("%Y-%m-%d") for d in days], "day", "total"
        )

    years = [report(y) for y in range(first.year, last.year + 1)]
    long = reduce(lambda a, b: a.unionByName(b), years)
    return long.withColumn("total", round_half_up("total", 6))
