"""Event, point and serving query keys.

Stand-in events are built from ``events`` rows by
:func:`layercake.functions.events.sensor_messages`; serving reads the
point table derived from them at a fixed ``asof``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from layercake.functions import events as ev
from layercake.functions.numeric import exact_avg, fixed_text
from layercake.operators import serving
from layercake.plans.registry import register
from layercake.session import configure, table

ASOF = "2024-01-31 00:00:00"
# Wider than the endpoints' own look-backs (1 h / 10 min / 5 min): the
# supplied data holds few events in the last hour.
DEVICES_LOOKBACK = "1 day"
DEVICE_LOOKBACK = "1 day"
TEMPERATURE_LOOKBACK = "6 hours"

POINTS_SQL = """WITH e AS (
    SELECT CAST(user_id AS VARCHAR) AS device_id, event_type AS device_type,
           'loc_' || event_type AS location_id, ts AS time, value,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
    FROM events),
  p AS (
    SELECT device_id, device_type, location_id, time, 'temperature' AS field,
           value AS value_num, CAST(NULL AS VARCHAR) AS value_str FROM e WHERE value IS NOT NULL
    UNION ALL SELECT device_id, device_type, location_id, time, 'humidity',
           CAST(k AS DOUBLE), NULL FROM e WHERE k IS NOT NULL
    UNION ALL SELECT device_id, device_type, location_id, time, 'motion',
           CASE WHEN value > 100 THEN 1.0 ELSE 0.0 END, NULL FROM e WHERE value IS NOT NULL
    UNION ALL SELECT device_id, device_type, location_id, time, 'status', NULL,
           CASE WHEN value > 100 THEN 'ALERT' ELSE 'OK' END FROM e),
  pts AS (SELECT 'iot_measurements' AS measurement, * FROM p)"""


def points(spark, sf_dir):
    """The point table as the stream writes it, derived by projection.

    Same rows as ``event_points(sensor_messages(events))`` without the JSON
    round trip, so a time predicate on ``time`` reaches the Parquet scan of
    ``ts`` (row groups outside the look-back are skipped).
    """
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint").cast("double")
    v = F.col("value")
    null_s, null_d = F.lit(None).cast("string"), F.lit(None).cast("double")

    def field(name, num, text, keep):
        return F.struct(F.lit(name).alias("field"), num.cast("double").alias("value_num"),
                        text.cast("string").alias("value_str"), keep.alias("keep"))

    fields = F.array(
        field("temperature", v, null_s, v.isNotNull()),
        field("humidity", k, null_s, k.isNotNull()),
        field("motion", F.when(v > 100, 1.0).otherwise(0.0), null_s, v.isNotNull()),
        field("status", null_d, F.when(v > 100, F.lit("ALERT")).otherwise(F.lit("OK")), F.lit(True)),
    )
    return (
        e.select(
            F.lit(ev.MEASUREMENT).alias("measurement"),
            F.col("user_id").cast("string").alias("device_id"),
            F.col("event_type").alias("device_type"),
            F.concat(F.lit("loc_"), F.col("event_type")).alias("location_id"),
            F.col("ts").alias("time"),
            F.inline(fields),
        )
        .filter("keep")
        .select("measurement", "device_id", "device_type", "location_id", "field",
                "value_num", "value_str", "time")
    )


def _window_sql(lookback_sql: str) -> str:
    return (f"time >= TIMESTAMP '{ASOF}' - INTERVAL {lookback_sql} "
            f"AND time < TIMESTAMP '{ASOF}'")


@register(
    "parse_events",
    """SELECT CAST(user_id AS VARCHAR) AS device_id, event_type AS device_type,
              'loc_' || event_type AS location_id, ts AS event_time, value AS temperature,
              CAST(json_extract_string(props, '$.k') AS DOUBLE) AS humidity,
              CASE WHEN value > 100 THEN 'ALERT' ELSE 'OK' END AS status
       FROM events""",
    group="stream",
)
def q_parse_events(spark, sf_dir):
    configure(spark)
    parsed = ev.parse_events(ev.sensor_messages(table(spark, sf_dir, "events")))
    return parsed.select("device_id", "device_type", "location_id", "event_time",
                         "temperature", "humidity", "status")


@register(
    "event_to_points",
    POINTS_SQL + " SELECT * FROM pts",
    group="stream",
)
def q_event_to_points(spark, sf_dir):
    configure(spark)
    return ev.event_points(ev.sensor_messages(table(spark, sf_dir, "events")))


@register(
    "serve_devices",
    POINTS_SQL + " SELECT DISTINCT device_id FROM pts WHERE " + _window_sql("'1 day'"),
    group="serving",
)
def q_serve_devices(spark, sf_dir):
    configure(spark)
    return serving.devices_seen(points(spark, sf_dir), ASOF, DEVICES_LOOKBACK)


@register(
    "serve_device_last",
    POINTS_SQL
    + f""" SELECT measurement, device_id, device_type, location_id, field, time, value_num, value_str
      FROM (SELECT *, row_number() OVER (
               PARTITION BY measurement, device_id, device_type, location_id, field
               ORDER BY time DESC, value_num DESC NULLS LAST, value_str DESC NULLS LAST) AS rn
            FROM pts WHERE {_window_sql("'1 day'")}) WHERE rn = 1""",
    group="serving",
)
def q_serve_device_last(spark, sf_dir):
    configure(spark)
    return serving.latest_per_series(points(spark, sf_dir), ASOF, DEVICE_LOOKBACK)


@register(
    "serve_one_device",
    POINTS_SQL
    + f""", seen AS (SELECT * FROM pts WHERE {_window_sql("'1 day'")})
      SELECT measurement, device_id, device_type, location_id, field, time, value_num, value_str
      FROM (SELECT *, row_number() OVER (
               PARTITION BY measurement, device_id, device_type, location_id, field
               ORDER BY time DESC, value_num DESC NULLS LAST, value_str DESC NULLS LAST) AS rn
            FROM seen WHERE device_id = (SELECT MIN(device_id) FROM seen)) WHERE rn = 1""",
    group="serving",
)
def q_serve_one_device(spark, sf_dir):
    """Latest values of ONE device: the first by name that was seen in the window."""
    configure(spark)
    pts = points(spark, sf_dir)
    device = serving.devices_seen(pts, ASOF, DEVICE_LOOKBACK).agg(F.min("device_id")).first()[0]
    return serving.latest_per_series(pts, ASOF, DEVICE_LOOKBACK, device_id=device or "")


@register(
    "serve_temperature",
    POINTS_SQL
    + f""" SELECT time, value_num AS value, device_id AS device FROM pts
      WHERE measurement = 'iot_measurements' AND field = 'temperature' AND {_window_sql("'6 hours'")}""",
    group="serving",
)
def q_serve_temperature(spark, sf_dir):
    configure(spark)
    return serving.field_points(points(spark, sf_dir), ASOF, TEMPERATURE_LOOKBACK)


# ----------------------------------------------------------- window text
def sensor_rows(events):
    """Stand-in silver sensor rows derived from ``events``; humidity is absent."""
    return events.select(
        F.col("user_id").alias("id"),
        F.col("event_type").alias("kind"),
        F.col("ts").alias("timestamp"),
        F.lit(230.0).alias("voltage"),
        (F.col("value") * 0.5).alias("current"),
        (F.col("value") * 2).alias("power"),
        F.col("value").alias("temperature"),
    )


def hourly_averages(rows, key: str = "kind"):
    """Tumbling one-hour averages per ``key`` as ``id``, exact to 6 decimals."""
    w = F.window(F.col("timestamp").cast("timestamp"), "1 hour")
    return (
        rows.groupBy(w.alias("w"), F.col(key).alias("id"))
        .agg(exact_avg("temperature").alias("avg_temp"), exact_avg("power").alias("avg_power"))
        .select(
            "id",
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end"),
            "avg_temp",
            "avg_power",
        )
    )


def _exact_avg_sql(col: str) -> str:
    """Micro-units of avg(col) rounded HALF_UP (non-negative values of up to 9 decimals)."""
    return (f"((SUM(CAST(ROUND({col} * 1000000000) AS HUGEINT)) * 2 + COUNT({col}) * 1000)"
            f" // (COUNT({col}) * 2000))")


HOURLY_SQL = f"""WITH h AS (
    SELECT event_type AS id, date_trunc('hour', ts) AS window_start,
           date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
           {_exact_avg_sql("value")} AS t_micro, {_exact_avg_sql("value * 2")} AS p_micro
    FROM events WHERE ts IS NOT NULL GROUP BY event_type, date_trunc('hour', ts))"""


def sensor_text():
    """The text of one row of averages.  Fixed values: the template's words."""
    return F.concat(
        F.lit("Sensor "), F.col("id").cast("string"), F.lit(": avg_temp="), fixed_text("avg_temp"),
        F.lit(", avg_power="), fixed_text("avg_power"),
    )


def _micro_text(c: str) -> str:
    return f"printf('%d.%06d', {c} // 1000000, {c} % 1000000)"


@register(
    "row_to_text",
    HOURLY_SQL
    + f""" SELECT id, window_start, window_end,
         'Sensor ' || id || ': avg_temp=' || {_micro_text("t_micro")}
           || ', avg_power=' || {_micro_text("p_micro")} AS text
    FROM h""",
    group="vectors",
)
def q_row_to_text(spark, sf_dir):
    configure(spark)
    avgs = hourly_averages(sensor_rows(table(spark, sf_dir, "events")))
    return ev.row_text(avgs, [sensor_text()]).select("id", "window_start", "window_end", "text")
