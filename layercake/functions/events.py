"""Sensor events: JSON messages, parsing, and the long time-series point model.

A point is ``(measurement, device_id, device_type, location_id, field,
value_num, value_str, time)``: one row per field of an event, tags as
columns, numbers and strings in separate typed columns.  Schemaless
messages go through VARIANT (``parse_json`` + ``variant_explode``), so a
new sensor field needs no schema change and no Python per row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

# Fixed values of the stream writer: measurement name and the keys that are
# identity/time rather than fields.
MEASUREMENT = "iot_measurements"
RESERVED_KEYS = ("device_id", "device_type", "location_id", "timestamp")
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

EVENT_SCHEMA = StructType(
    [
        StructField("device_id", StringType()),
        StructField("device_type", StringType()),
        StructField("location_id", StringType()),
        StructField("timestamp", StringType()),
        StructField("temperature", DoubleType()),
        StructField("humidity", DoubleType()),
        StructField("status", StringType()),
    ]
)


def sensor_messages(events: DataFrame) -> DataFrame:
    """Stand-in producer: one JSON message per ``events`` row.

    ``device_id = user_id``, ``device_type = event_type``, temperature is
    ``value``, humidity the ``k`` of ``props``; a boolean, a status string,
    a list and a nested object exercise every branch of the point mapping.
    """
    msg = F.struct(
        F.col("user_id").cast("string").alias("device_id"),
        F.col("event_type").alias("device_type"),
        F.concat(F.lit("loc_"), F.col("event_type")).alias("location_id"),
        F.date_format("ts", ISO_FORMAT).alias("timestamp"),
        F.col("value").alias("temperature"),
        F.get_json_object("props", "$.k").cast("bigint").alias("humidity"),
        (F.col("value") > 100).alias("motion"),
        F.when(F.col("value") > 100, F.lit("ALERT")).otherwise(F.lit("OK")).alias("status"),
        F.array(F.col("event_id")).alias("tags"),
        F.struct(F.col("event_id").alias("seq")).alias("meta"),
    )
    return events.select("event_id", "ts", F.to_json(msg).alias("value"))


def parse_events(df: DataFrame, col: str = "value", schema: StructType = EVENT_SCHEMA,
                 corrupt_col: str | None = None) -> DataFrame:
    """Typed parse of JSON messages (PERMISSIVE) plus ISO-8601 event time.

    With ``corrupt_col``, unparseable messages are kept with the raw text in
    that column instead of being dropped silently.
    """
    opts = {"mode": "PERMISSIVE"}
    if corrupt_col:
        schema = StructType(schema.fields + [StructField(corrupt_col, StringType())])
        opts["columnNameOfCorruptRecord"] = corrupt_col
    parsed = df.select(F.from_json(F.col(col), schema, opts).alias("e")).select("e.*")
    return parsed.withColumn("event_time", F.try_to_timestamp(F.col("timestamp")).cast("timestamp_ntz"))


_NUMERIC = r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*|BOOLEAN)$"


def event_points(df: DataFrame, col: str = "value", measurement: str = MEASUREMENT,
                 reserved: Sequence[str] = RESERVED_KEYS) -> DataFrame:
    """Explode each JSON event into points (one row per field).

    Numbers and booleans become ``value_num`` (booleans as 1.0/0.0), strings
    ``value_str``; nulls, lists and objects are dropped; reserved keys are
    tags or time, never fields.  ``location_id`` is a tag when present.
    """
    spark = df.sparkSession
    v = df.select(F.parse_json(F.col(col)).alias("v"))
    exploded = spark.sql(
        """SELECT variant_get(v, '$.device_id', 'string') AS device_id,
                  variant_get(v, '$.device_type', 'string') AS device_type,
                  variant_get(v, '$.location_id', 'string') AS location_id,
                  CAST(try_to_timestamp(variant_get(v, '$.timestamp', 'string')) AS TIMESTAMP_NTZ) AS time,
                  e.key AS field, e.value AS fv, schema_of_variant(e.value) AS ftype
           FROM {v}, LATERAL variant_explode(v) AS e""",
        v=v,
    )
    typed = exploded.filter(~F.col("field").isin(*reserved))
    is_num = F.col("ftype").rlike(_NUMERIC)
    is_str = F.col("ftype") == F.lit("STRING")
    return typed.filter(is_num | is_str).select(
        F.lit(measurement).alias("measurement"),
        "device_id",
        "device_type",
        "location_id",
        "field",
        F.when(is_num, F.try_variant_get("fv", "$", "double")).alias("value_num"),
        F.when(is_str, F.try_variant_get("fv", "$", "string")).alias("value_str"),
        "time",
    )


# The silver sensor fields written as points, default 0.0.
SENSOR_FIELDS = ("voltage", "current", "power", "temperature", "humidity")
SENSOR_MEASUREMENT = "sensor_data"


def sensor_points(df: DataFrame, id_col: str = "id", time_col: str = "timestamp",
                  fields: Sequence[str] = SENSOR_FIELDS, default: float = 0.0,
                  measurement: str = SENSOR_MEASUREMENT) -> DataFrame:
    """Fixed-field rows -> points; a missing or NULL field is written as ``default``.

    Time is kept at second precision, as the sensor store writes it.
    """
    present = set(df.columns)
    vals = {
        f: (F.coalesce(F.col(f).cast("double"), F.lit(default)) if f in present else F.lit(default))
        for f in fields
    }
    stack = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), v.alias("value")) for f, v in vals.items()]))
    return df.select(
        F.lit(measurement).alias("measurement"),
        F.col(id_col).cast("string").alias("device_id"),
        F.date_trunc("second", F.col(time_col).cast("timestamp")).cast("timestamp_ntz").alias("time"),
        stack.alias("p"),
    ).select("measurement", "device_id", "time", "p.field", "p.value")


def row_text(df: DataFrame, template: Sequence[str | Column], out: str = "text") -> DataFrame:
    """Text assembled from literal parts and columns (NULL if any part is NULL)."""
    parts = [F.lit(p) if isinstance(p, str) else p for p in template]
    return df.withColumn(out, F.concat(*parts))


def fixed(col: str | Column, digits: int = 4) -> Column:
    """Fixed-point text of a number (``%.<digits>f``), stable across engines."""
    c = F.col(col) if isinstance(col, str) else col
    return F.format_string(f"%.{digits}f", c)
