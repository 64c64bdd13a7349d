"""What a stream's step costs must follow the rows, not the devices times the micro-batches."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from layercake.operators import ml, sequences, windows
from layercake.streaming import io, stateful

ORDER = ["ts", "event_id"]
DEVICES, WAVES = 700, 3


def _readings(spark):
    """Seven readings of every device, some of them NULL; ids that a double cannot hold; a device without a name."""
    x = F.col("id")
    device = x % (DEVICES + 1)
    return spark.range(7 * (DEVICES + 1)).select(
        F.when(device < DEVICES, device + 2**53 + 1).alias("device_id"), (x + 2**53 + 1).alias("event_id"),
        F.expr("timestamp_ntz '2024-03-01' + make_dt_interval(0, 0, 0, CAST(id DIV 3 AS INT))").alias("ts"),
        F.when(x % 11 != 3, F.round(F.sin(x.cast("double")) * 20, 3)).alias("temperature"),
        F.when(x % 5 > 0, (x % 90).cast("int")).alias("level"),
    )


def _streamed(spark, tmp_dir, df, make):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    for wave in range(WAVES):
        df.where(F.floor((F.col("event_id") - 2**53 - 1) * WAVES / (7 * (DEVICES + 1))) == wave).coalesce(1).write.mode("append").parquet(src)
    df.limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema]).withColumn(
        "ts", F.expr("timestamp_ntz '2025-01-01'")).coalesce(1).write.mode("append").parquet(src)
    stream = make(io.file_source(spark, src, "parquet", df.schema, max_files_per_trigger=1))
    query = io.run_available(stream, io.parquet_batch_writer(out), out + "_ck", state_partitions=4)
    groups = max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"])
    return io.read_batches(spark, out).where("event_id IS NOT NULL"), groups


def _same(got, want, columns):
    text = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    got, want = (sorted([text(r[c]) for c in columns] for r in x.collect()) for x in (got, want))
    assert got == want and len(got) >= 7 * (DEVICES + 1)


def test_late_rows_wait_by_buckets_of_devices(spark, tmp_dir):
    df, kept = _readings(spark), ["device_id", "event_id", "temperature", "level"]
    got, groups = _streamed(spark, tmp_dir, df, lambda s: stateful.stream_lag_features(
        s, "device_id", ORDER, "temperature", kept, delay="10 seconds"))
    assert got.schema["level"].dataType == df.schema["level"].dataType
    _same(got, sequences.lag_features(df, ["device_id"], ORDER, "temperature"), [*kept, "temp_lag_1", "temp_roll_mean_5"])
    assert groups <= stateful.BUCKETS + 1 < DEVICES


@pytest.mark.parametrize("key", ["device_id", "name", "weight"])
def test_recurrences_of_many_devices_go_on_in_one_call(spark, tmp_dir, key):
    """Keys of every kind: integers, texts, doubles."""
    df = _readings(spark).withColumns({"name": F.concat(F.lit("d"), F.col("device_id").cast("string")), "weight": (F.col("device_id") % 4096) / 8})
    kept = [key, "event_id", "temperature"]
    got, groups = _streamed(spark, tmp_dir, df, lambda s: stateful.stream_ema_anomalies(s, key, ORDER, "temperature", kept))
    batch = sequences.ema_anomalies(df, [key], ORDER, "temperature")
    rows = {r["event_id"]: r["ema"] for r in got.collect()}
    want = {r["event_id"]: r["ema"] for r in batch.collect()}
    assert rows.keys() == want.keys() and max(abs(rows[k] - want[k]) for k in want) < 1e-9
    assert groups <= stateful.BUCKETS + 1 < DEVICES


def test_a_fit_computes_its_rows_once(spark):
    """Spark ML asks for a fit's rows several times; what they come from (a window over all readings) must not run each time."""
    made = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            made.add(len(frame))
            yield frame

    x = F.col("id").cast("double")
    df = spark.range(400).select((x % 7).alias("a"), F.when(x % 10 > 0, x % 11).alias("b"), (2 * (x % 7) - 3 * (x % 11) + 5).alias("y"))
    rows = df.mapInPandas(counted, df.schema).repartition(3, "a")
    model = ml.fit_linear(ml.assemble(rows, ["a", "b"]), "y")
    assert made.value == 400
    assert [round(v, 9) for v in [*model.coefficients, model.intercept]] == [2, -3, 5]


def test_margins_in_earlier_keys_need_no_count(spark, monkeypatch):
    """With short series a range's margin lies in an earlier key: no pass over all rows judges it, and frames are whole."""
    for name, value in (("SMALL_RANGE", 64), ("SAMPLES_PER_RANGE", 8), ("LEAST_SAMPLES", 8)):
        monkeypatch.setattr(windows, name, value)
    searched = []
    monkeypatch.setattr(windows, "_upto", lambda *a, f=windows._upto: searched.append(len(a[1])) or f(*a))
    x, counted, frame = F.col("id"), [], type(spark.range(0))
    monkeypatch.setattr(frame, "groupBy", lambda self, *a, f=frame.groupBy: counted.extend(a) or f(self, *a))

    def lagged(rows_per_key, **how):
        df = spark.range(4000).select(F.floor(x / rows_per_key).alias("k"), x.alias("t"), (x % 13).cast("double").alias("v"))
        return sorted(tuple(r) for r in windows.rolling(df, ["k"], ["t"], 4, lambda w: {"s": F.sum("v").over(w.rowsBetween(-4, 0))}, **how).collect())

    got = lagged(2, ranges=4)
    assert searched and not counted
    assert got == lagged(2, method="partition")
    got = lagged(2000, ranges=4)
    assert counted and got == lagged(2000, method="partition")
