"""Streaming query keys.

Each key lands data derived from the supplied tables as files in arrival
waves (time ordered, several files per wave), runs the stream with an
``availableNow`` trigger, micro-batches bounded in bytes and a checkpoint in
shared storage, writes each micro-batch idempotently, and reads the
result back.  The oracle is the batch answer.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import functions as F

from layercake.functions.numeric import round_half_up
from layercake.functions import events as ev
from layercake.operators import ml
from layercake.operators.sequences import round_ema
from layercake.plans.event_keys import POINTS_SQL, sensor_rows
from layercake.plans.registry import register
from layercake.plans.sequence_keys import (
    EMA_SQL,
    GAP_FEATURES_SQL,
    PREDICT_SQL,
    TEMP_FEATURES_SQL,
    _score_sql,
    gappy_readings,
    readings,
    saved_model,
    temp_features_frame,
)
from layercake.session import configure, scratch_path, table
from layercake.sources import files
from layercake.streaming import blocks, cdc, io, stateful
from layercake.streaming.windows import tumbling

# Arrival waves: at least WAVES, of equal row counts and at most WAVE_ROWS while MOST_WAVES last;
# a wave's files grow in number with its rows.
WAVES, WAVE_ROWS, MOST_WAVES = 4, 1 << 20, 64
FILES, FILE_ROWS = 4, 1 << 17
#: Bytes that a micro-batch takes at most; less where the input is small, so that state is carried between several.
BYTES_PER_TRIGGER = 64 << 20


def _seconds(ts: str):
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def _waves(df, ts: str = "ts") -> tuple[list[int], int]:
    """(first second of each wave but the first, rows): quantiles, so a far-off time leaves the waves even."""
    rows = df.count()
    n = min(max(WAVES, -(-rows // WAVE_ROWS)), MOST_WAVES)
    bounds = df.agg(F.percentile_approx(_seconds(ts), [i / n for i in range(1, n)], 10_000).alias("b")).first()["b"]
    return list(bounds or []), rows


def _wave(bounds: list[int], ts: str = "ts"):
    """A row's wave; rows without a time land first."""
    passed = [F.coalesce(_seconds(ts) > b, F.lit(False)).cast("int") for b in bounds]
    return reduce(add, passed, F.lit(0)).cast("int")


def _land(df, name: str, key: str | None = None, fmt: str = "parquet", ts: str = "ts",
          ordered: bool = True):
    """Land stream input; ``ordered`` lands time-ordered waves (needed by
    stateful and watermarked streams), otherwise one write suffices."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    columns = ["value"] if fmt == "text" else df.columns
    if not ordered:
        # Several files, like the partitions of a topic, so micro-batches
        # are processed by as many tasks as the cluster has cores.
        df.select(*columns).repartition(spark.sparkContext.defaultParallelism).write.format(fmt).save(path)
        return path
    bounds, rows = _waves(df, ts)
    n = len(bounds) + 1
    wave_files = max(FILES, -(-rows // (n * FILE_ROWS)))
    io.land_in_order(df, path, _wave(bounds, ts), n, key, fmt, columns, files=wave_files, stage=scratch_path(spark, f"{name}_stage"))
    return path


def _stream(spark, path: str, schema, fmt: str = "parquet"):
    """The landed files as a stream, admitted by bytes."""
    total = files.object_manifest(spark, path).agg(F.sum("length")).first()[0] or 0
    return io.file_source(spark, path, fmt, schema, max_bytes_per_trigger=max(1, min(BYTES_PER_TRIGGER, total // WAVES)))


def _run(stream, name: str, spark):
    """Run to completion; state partitions = the cluster's default parallelism."""
    out, ck = scratch_path(spark, f"{name}_out"), scratch_path(spark, f"{name}_ckpt")
    io.run_available(stream, io.parquet_batch_writer(out), ck,
                     state_partitions=spark.sparkContext.defaultParallelism)
    return io.read_batches(spark, out)


@register(
    "stream_scan",
    "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    group="stream",
)
def q_stream_scan(spark, sf_dir):
    """Streaming Parquet directory (explicit schema), event time cast and cast back."""
    configure(spark)
    events = table(spark, sf_dir, "events")
    path = _land(events, "events_stream", ordered=False)
    stream = _stream(spark, path, events.schema)
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp")).withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")
    )
    return _run(stream, "events_stream", spark).select(*events.columns)


TOPICS = [f"topic_{i}" for i in range(5)]


@register(
    "stream_topics",
    "SELECT 'topic_' || (event_id % 5) AS topic, event_id, user_id, value FROM events",
    group="stream",
)
def q_stream_topics(spark, sf_dir):
    """Five topics read as one stream of messages that know their topic."""
    configure(spark)
    path = scratch_path(spark, "topics")
    topic = F.concat(F.lit("topic_"), (F.col("event_id") % len(TOPICS)).cast("string"))
    table(spark, sf_dir, "events").select(
        topic.alias("topic"), F.to_json(F.struct("event_id", "user_id", "value")).alias("value")
    ).write.partitionBy("topic").text(path)
    for name in TOPICS:  # a topic without messages still exists
        spark.createDataFrame([], "value string").write.mode("append").text(f"{path}/topic={name}")
    stream = io.topic_files(spark, {t: f"{path}/topic={t}" for t in TOPICS}, max_bytes_per_trigger=BYTES_PER_TRIGGER)
    message = F.from_json("value", "event_id bigint, user_id bigint, value double")
    return _run(stream.select("topic", message.alias("m")).select("topic", "m.*"), "topics_stream", spark)


@register("stream_points", POINTS_SQL + " SELECT * FROM pts", group="stream")
def q_stream_points(spark, sf_dir):
    """JSON messages (a topic stand-in) -> points -> idempotent batch writes."""
    configure(spark)
    msgs = ev.sensor_messages(table(spark, sf_dir, "events"))
    path = _land(msgs, "sensor_topic", fmt="text", ordered=False)
    stream = _stream(spark, path, None, "text")
    return _run(ev.event_points(stream), "sensor_points_stream", spark)


_SENSOR_POINTS_SQL = " UNION ALL ".join(
    f"""SELECT 'sensor_data' AS measurement, CAST(user_id AS VARCHAR) AS device_id,
               date_trunc('second', ts) AS time, '{f}' AS field, {expr} AS value FROM events"""
    for f, expr in [
        ("voltage", "230.0"),
        ("current", "value * 0.5"),
        ("power", "value * 2"),
        ("temperature", "value"),
        ("humidity", "0.0"),
    ]
)


@register("sensor_points", _SENSOR_POINTS_SQL, group="stream")
def q_sensor_points(spark, sf_dir):
    """Silver sensor rows streamed from Parquet; five fields, missing ones 0.0."""
    configure(spark)
    rows = sensor_rows(table(spark, sf_dir, "events"))
    path = _land(rows, "silver_sensor", ts="timestamp", ordered=False)
    stream = _stream(spark, path, rows.schema)
    return _run(ev.sensor_points(stream), "sensor_rows_stream", spark)


def _landed_readings(spark, sf_dir, name: str):
    df = readings(spark, sf_dir)
    path = _land(df, name, key="device_id")
    return _stream(spark, path, df.schema)


@register("stream_ema_anomaly", EMA_SQL, group="stream")
def q_stream_ema_anomaly(spark, sf_dir):
    """Keyed EMA state per device across micro-batches."""
    configure(spark)
    stream = _landed_readings(spark, sf_dir, "readings_ema").drop("humidity")
    out = stateful.stream_ema_anomalies(
        stream, "device_id", ["ts", "event_id"], "temperature",
        ["device_id", "event_id", "ts", "temperature"],
    )
    res = _run(out, "ema_stream", spark)
    return res.withColumn("ema", round_ema("ema", 6))


@register("stream_ema_blocks", EMA_SQL, group="stream")
def q_stream_ema_blocks(spark, sf_dir):
    """The same records with the averages in a committed table: a hot device's rows of a micro-batch meet many tasks."""
    configure(spark)
    stream = _landed_readings(spark, sf_dir, "readings_blocks").drop("humidity")
    out, state = scratch_path(spark, "ema_blocks_out"), scratch_path(spark, "ema_blocks_state")
    sink = blocks.ema_batches(
        state, out, "device_id", ["ts", "event_id"], "temperature", ["device_id", "event_id", "ts", "temperature"], buckets=8
    )
    io.run_available(stream, sink, scratch_path(spark, "ema_blocks_ckpt"))
    return io.read_batches(spark, out).withColumn("ema", round_ema("ema", 6))


@register("stream_sequence_score", _score_sql(), group="stream")
def q_stream_sequence_score(spark, sf_dir):
    """Last-20-readings state per device; warm-up, prediction and alert records."""
    configure(spark)
    stream = _landed_readings(spark, sf_dir, "readings_seq").drop("humidity")
    out = stateful.stream_score_sequences(
        stream, "device_id", ["ts", "event_id"], "temperature", ["device_id", "event_id", "ts"]
    )
    res = _run(out, "sequence_stream", spark)
    return res.withColumn("prediction", round_half_up("prediction", 6)).select(
        "device_id", "event_id", "ts", "window_len", "prediction", "observed", "kind"
    )


def _stream_features(spark, sf_dir, name: str):
    feats = stateful.stream_lag_features(
        _landed_readings(spark, sf_dir, name), "device_id", ["ts", "event_id"], "temperature",
        ["device_id", "event_id", "temperature", "humidity"],
    )
    return ml.assemble(feats, ["temp_lag_1", "temp_roll_mean_5", "humidity"])


@register("stream_temp_features", TEMP_FEATURES_SQL, group="stream")
def q_stream_temp_features(spark, sf_dir):
    """Lag and rolling mean from per-device state, assembled into vectors on the stream."""
    configure(spark)
    assembled = _stream_features(spark, sf_dir, "readings_feat")
    res = _run(assembled.drop("features"), "features_stream", spark)
    return res.select(
        "device_id", "event_id", "temperature", "temp_lag_1",
        round_half_up("temp_roll_mean_5", 6).alias("temp_roll_mean_5"), "humidity",
    )


@register("stream_predict", PREDICT_SQL, group="stream")
def q_stream_predict(spark, sf_dir):
    """A model saved by a batch job, loaded and applied to the features on the stream."""
    configure(spark)
    model = ml.load_linear(saved_model(spark, temp_features_frame(spark, sf_dir)))
    scored = ml.predict(model, _stream_features(spark, sf_dir, "readings_predict"))
    res = _run(scored.select("device_id", "event_id", "temperature", "prediction"), "predict_stream", spark)
    return res.withColumn("prediction", round_half_up("prediction", 4))


def _mark_end(rows, path: str, ts: str, beyond: int, marker: dict) -> int:
    """How late rows of a wave can be, in seconds; lands a last row far enough after all to let them go."""
    first, last = rows.agg(F.min(_seconds(ts)), F.max(_seconds(ts))).first()
    first, last = first or 0, last or 0
    edges = [first, *_waves(rows, ts)[0], last]
    late = max(b - a for a, b in zip(edges, edges[1:])) + 1
    marker = marker | {ts: F.timestamp_seconds(F.lit(last + late + beyond)).cast("timestamp_ntz")}
    rows.sparkSession.range(1).select(
        *[marker.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
    ).write.mode("append").parquet(path)
    return late


@register("stream_gaps", GAP_FEATURES_SQL, group="stream")
def q_stream_gaps(spark, sf_dir):
    """Features over readings with NULL, NaN and spikes, a fifth of them landing three hours late: the
    event-time buffer puts them back in order.  A last marker row releases all others and stays."""
    configure(spark)
    held = 3 * 3600
    df = gappy_readings(spark, sf_dir)
    came = F.when(F.col("event_id") % 5 == 0, F.col("ts") + F.expr(f"INTERVAL {held} SECONDS")).otherwise(F.col("ts"))
    path = _land(df.withColumn("came", came), "readings_gaps", ts="came")
    late = _mark_end(df.withColumn("came", came), path, "came", 0, {})
    spark.range(1).select(
        *[(F.expr("TIMESTAMP_NTZ '2200-01-01'") if c == "ts" else F.lit(None)).cast(t).alias(c) for c, t in [*df.dtypes, ("came", "timestamp_ntz")]]
    ).write.mode("append").parquet(path)
    stream = _stream(spark, path, df.withColumn("came", came).schema).drop("came").where("ts IS NOT NULL")
    feats = stateful.stream_lag_features(
        stream, "device_id", ["ts", "event_id"], "temperature", ["device_id", "event_id", "temperature", "humidity"],
        delay=f"{late + held} seconds",
    )
    res = _run(feats, "gaps_stream", spark)
    return res.select(
        "device_id", "event_id", "temperature", "temp_lag_1", round_half_up("temp_roll_mean_5", 6).alias("temp_roll_mean_5"), "humidity",
    )


@register(
    "tumbling_sensor_avg",
    """SELECT event_type AS id, date_trunc('hour', ts) AS window_start,
              date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
              CAST(COUNT(*) AS BIGINT) AS n,
              ROUND(AVG(value), 6) AS avg_temp, ROUND(AVG(value * 2), 6) AS avg_power
       FROM events WHERE ts IS NOT NULL GROUP BY event_type, date_trunc('hour', ts)""",
    group="stream",
)
def q_tumbling_sensor_avg(spark, sf_dir):
    """Hourly averages per kind with a watermark; a last marker row closes every window.

    Rows are at most one wave late, which is the watermark's delay; the
    marker lies beyond that after the last row, and its own window stays open.
    """
    configure(spark)
    rows = sensor_rows(table(spark, sf_dir, "events"))
    path = _land(rows, "sensor_windows", ts="timestamp")
    late = _mark_end(rows, path, "timestamp", 2 * 3600, {"kind": F.lit("end of input")})
    stream = _stream(spark, path, rows.schema)
    windows = tumbling(
        stream, "timestamp", {"id": "kind"},
        {"n": F.count(F.lit(1)), "avg_temp": F.avg("temperature"), "avg_power": F.avg("power")},
        size="1 hour", delay=f"{late} seconds",
    )
    res = _run(windows, "windows_stream", spark)
    return res.withColumns({"avg_temp": round_half_up("avg_temp", 6), "avg_power": round_half_up("avg_power", 6)})


_CDC_KIND = "CASE WHEN o_orderkey % 5 = 0 THEN 'delete' WHEN o_orderkey % 5 = 1 THEN 'update' ELSE 'insert' END"


@register(
    "cdc_explode",
    f"""WITH k AS (SELECT *, {_CDC_KIND} AS kind FROM orders)
       SELECT kind, o_orderkey, CASE WHEN kind <> 'delete' THEN o_custkey ELSE -1 END AS o_custkey,
              CASE WHEN kind <> 'delete' THEN o_orderstatus END AS o_orderstatus,
              CASE WHEN kind <> 'delete' THEN o_totalprice END AS o_totalprice,
              CASE WHEN kind <> 'delete' THEN o_orderdate END AS o_orderdate,
              CAST(NULL AS VARCHAR) AS rejected
       FROM k
       UNION ALL
       SELECT NULL, -1, -1, NULL, NULL, NULL, '{{"changes": [broken ' || o_orderkey
       FROM orders WHERE o_orderkey % 64 = 7""",
    group="stream",
)
def q_cdc_explode(spark, sf_dir):
    """Orders packed into change messages (both key spellings; inserts, updates and
    deletes), streamed and exploded; torn messages among them come out as rejects.
    A key that a row does not carry is shown as -1."""
    configure(spark)
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        F.floor(F.col("o_orderkey") / 16).alias("grp"),
    )
    msgs = cdc.pack_changes(orders, "orders", "grp", F.expr(_CDC_KIND), "o_orderkey").select("value")
    torn = orders.where("o_orderkey % 64 = 7").select(
        F.concat(F.lit('{"changes": [broken '), F.col("o_orderkey").cast("string")).alias("value")
    )
    path = scratch_path(spark, "cdc_topic")
    msgs.unionByName(torn).write.text(path)
    stream = _stream(spark, path, None, "text")
    typed = cdc.typed_columns(
        cdc.explode_changes(stream),
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz",
        keep=("kind", "rejected"),
    )
    out = _run(typed, "cdc_stream", spark)
    return out.withColumns({c: F.coalesce(c, F.lit(-1)) for c in ("o_orderkey", "o_custkey")})
