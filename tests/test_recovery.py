"""What must not be lost: snapshots, earlier days, NULL keys, object keys, stream batches."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from layercake.functions import reshape
from layercake.operators import gold
from layercake.plans import flows, stream_keys
from layercake.sinks import tables
from layercake.sources import files
from layercake.streaming import io, stateful


def test_snapshot_without_commit_is_an_error_not_an_empty_table(spark, tmp_dir):
    base = os.path.join(tmp_dir, "snap")
    assert tables.read_snapshot(spark, base) is None
    spark.range(10).write.parquet(f"{base}/v=lost")
    with pytest.raises(RuntimeError, match="no commit"):
        tables.read_snapshot(spark, base)


def test_crash_between_versions_leaves_the_former_one(spark, tmp_dir):
    base = os.path.join(tmp_dir, "snap")
    tables.write_snapshot(spark.range(10), base)
    spark.range(3).write.parquet(f"{base}/v=uncommitted")
    assert tables.read_snapshot(spark, base).count() == 10
    tables.write_snapshot(spark.range(12), base)
    assert tables.read_snapshot(spark, base).count() == 12


def test_silver_rerun_adds_no_row_twice(spark, tmp_dir):
    base, new = os.path.join(tmp_dir, "silver"), os.path.join(tmp_dir, "new")
    rows = spark.range(6).select(
        F.col("id"), F.lit("s").alias("sym"), F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(CAST(id AS INT))").alias("d"), F.col("id").cast("double").alias("p")
    )
    tables.write_json(rows, new)
    schema = "id bigint, sym string, d timestamp_ntz, p double"
    for _ in range(2):
        out, _, _ = flows.silver(spark, new, base, schema, ["sym"], "d", "p", ["id"])
        assert out.count() == 6


def test_second_day_leaves_the_first_days_schema_and_health(spark, tmp_dir):
    def land(day, **columns):
        raw = spark.range(2).select("id", *[F.lit(v).alias(c) for c, v in columns.items()])
        health = flows.bronze(raw, tmp_dir, [F.lit(day).alias("dt"), F.lit("x").alias("dataset")], ["dt", "dataset"])
        return {tuple(map(str, r)) for r in health.where(F.col("dt") == day).collect()}

    first = land("2024-01-01", revenue=5_000_000_000)
    kept = spark.read.schema("schema_ddl string, dt string, dataset string").parquet(f"{tmp_dir}/_meta").collect()
    land("2024-01-02", revenue=5_000_000_000, b=1)
    after = spark.read.schema("schema_ddl string, dt string, dataset string").parquet(f"{tmp_dir}/_meta").where("dt = '2024-01-01'").collect()
    assert [r["schema_ddl"] for r in after] == [r["schema_ddl"] for r in kept] and "revenue:bigint" in kept[0]["schema_ddl"]
    assert first


def test_amounts_stay_numbers_unless_named(spark):
    df = spark.createDataFrame([(5_000_000_000, 1_704_067_200)], "revenue bigint, at bigint")
    out = reshape.convert_unix_times(df, ["at"])
    assert dict(out.dtypes) == {"revenue": "bigint", "at": "timestamp_ntz"}


def test_orphans_with_null_and_repeated_keys(spark):
    fact = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    dim = spark.createDataFrame([(1,), (1,), (None,)], "d int")
    got = sorted((r["k"] is None, r["k"] or 0) for r in gold.orphans(fact, dim, "k", "d").collect())
    assert got == [(False, 2), (True, 0), (True, 0)]
    assert gold.referential_integrity(fact, dim, "k", "d").first()[0] == 3


def test_objects_of_different_folders_keep_different_keys(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    for folder in ("k=a", "k=b"):
        os.makedirs(os.path.join(src, folder))
        with open(os.path.join(src, folder, "part.bin"), "wb") as f:
            f.write(b"x")
    stored = tables.store_objects(files.read_objects(spark, src), os.path.join(tmp_dir, "dst"), root=src)
    assert sorted(r["key"] for r in stored.collect()) == ["k=a/part.bin", "k=b/part.bin"]


@pytest.mark.parametrize("per_trigger", [1, 4, 16])
def test_stream_over_three_months_equals_one_pass(spark, tmp_dir, per_trigger):
    rows = spark.range(240).select(
        F.concat(F.lit("d"), (F.col("id") % 3).cast("string")).alias("device_id"),
        F.col("id").alias("event_id"),
        F.expr("timestamp_ntz '2024-01-20' + make_dt_interval(0, CAST(id * 9 AS INT))").alias("ts"),
        (F.col("id") % 17 + F.when(F.col("id") == 100, 900).otherwise(0)).cast("double").alias("temperature"),
    )
    path = stream_keys._land(rows, "three_months", key="device_id")
    stream = io.file_source(spark, path, "parquet", rows.schema, per_trigger)
    out = os.path.join(tmp_dir, "out")
    feats = stateful.stream_ema_anomalies(stream, "device_id", ["ts", "event_id"], "temperature", ["device_id", "event_id", "ts", "temperature"])
    io.run_available(feats, io.parquet_batch_writer(out), os.path.join(tmp_dir, "ck"), state_partitions=4)
    want = {}
    for r in rows.orderBy("event_id").collect():
        last = want.get(r["device_id"], [])
        last.append(0.9 * (last[-1] if last else 0.0) + 0.1 * r["temperature"])
        want[r["device_id"]] = last
    got = io.read_batches(spark, out).orderBy("event_id").collect()
    assert len(got) == 240
    for device, emas in want.items():
        assert [r["ema"] for r in got if r["device_id"] == device] == pytest.approx(emas)
    if per_trigger == 1:  # few keys leave some files of a wave out
        assert len([d for d in os.listdir(out) if d.startswith("batch=")]) >= stream_keys.WAVES


def test_waves_stay_even_with_a_far_off_time(spark, tmp_dir):
    """Waves are quantiles of the rows, files and micro-batches go by size."""
    rows = spark.range(4000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") == 7, F.expr("timestamp_ntz '1970-01-01'")).when(F.col("id") != 8, F.expr("timestamp_ntz '2024-01-20' + make_dt_interval(0, 0, CAST(id AS INT))")).alias("ts"),
    )
    bounds, n = stream_keys._waves(rows)
    sizes = [r["count"] for r in rows.groupBy(stream_keys._wave(bounds).alias("w")).count().collect()]
    assert n == 4000 and len(sizes) == stream_keys.WAVES and max(sizes) < 1.1 * min(sizes)
    path = stream_keys._land(rows, "even")
    stream = stream_keys._stream(spark, path, rows.schema)
    out = os.path.join(tmp_dir, "out")
    io.run_available(stream, io.parquet_batch_writer(out), os.path.join(tmp_dir, "ck"))
    got = io.read_batches(spark, out)
    assert got.count() == 4000 and len([d for d in os.listdir(out) if d.startswith("batch=")]) >= stream_keys.WAVES - 1
    assert stream_keys._waves(rows.limit(0))[1] == 0


def test_a_restarted_stream_admitted_by_bytes_reads_each_file_once(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, p) for p in ("src", "out", "ck"))
    for day in range(2):
        spark.range(day * 1000, day * 1000 + 1000).repartition(5).write.mode("append").parquet(src)
        stream = io.file_source(spark, src, "parquet", "id long", max_bytes_per_trigger=1)
        io.run_available(stream, io.parquet_batch_writer(out), ck)
        assert io.read_batches(spark, out).distinct().count() == io.read_batches(spark, out).count() == (day + 1) * 1000
    assert len([d for d in os.listdir(out) if d.startswith("batch=")]) == 10


def test_a_hot_device_of_a_micro_batch_is_split(spark, tmp_dir, monkeypatch):
    """Half of each batch is one device; averages equal the loop, over batches, replays and a lost commit."""
    from layercake.streaming import blocks

    df = spark.range(6000).select(
        F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 101 == 1, F.lit(None)).otherwise(F.concat(F.lit("d"), (F.col("id") % 30).cast("string"))).alias("device_id"),
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 59 != 3, (F.col("id") % 23).cast("double") + F.when(F.col("id") == 1500, 1e6).otherwise(0.0)).alias("temperature"),
    )
    out, state = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "state")
    sink = blocks.ema_batches(state, out, "device_id", ["event_id"], "temperature", ["device_id", "event_id"], buckets=4, block_rows=200, ranges=4)
    batches = [df.where(f"event_id >= {2000 * i} AND event_id < {2000 * (i + 1)}") for i in range(3)]
    sink(batches[0], 0)

    def lost(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(blocks.tables, "commit_parts", lost)
        with pytest.raises(RuntimeError, match="lost"):
            sink(batches[1], 1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a small batch would meet one task after all
    try:
        for i, batch in ((1, batches[1]), (1, batches[1]), (2, df.limit(0)), (3, batches[2])):
            sink(batch, i)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want, average = {}, {}
    for r in df.where("temperature IS NOT NULL").orderBy("event_id").collect():
        average[r["device_id"]] = 0.9 * average.get(r["device_id"], 0.0) + 0.1 * r["temperature"]
        want[r["event_id"]] = average[r["device_id"]]
    stored = io.read_batches(spark, out)
    assert {r["event_id"]: r["ema"] for r in stored.collect()} == pytest.approx(want) and stored.count() == len(want)
    tasks = spark.read.parquet(f"{out}/batch=3").where("device_id = 'hot'").select(F.input_file_name()).distinct().count()
    assert tasks > 1
