"""Empty inputs: every operator returns an empty (or verdict) frame, never fails."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from layercake.functions import clean
from layercake.operators import gold, quality, sequences, windows
from layercake.plans import flows


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], "device_id bigint, event_id bigint, ts timestamp_ntz, temperature double")


def test_windows_on_empty(spark, empty):
    bars = empty.select("device_id", "event_id", F.col("ts").alias("Date"), F.col("temperature").alias("Close"))
    assert windows.indicators(bars, keys=["device_id"], tie_break=["event_id"]).count() == 0
    assert sequences.ema(empty, ["device_id"], ["ts", "event_id"], "temperature").count() == 0
    assert sequences.score_sequences(empty, ["device_id"], ["ts", "event_id"], "temperature").count() == 0


def test_checks_on_empty(spark, empty):
    assert quality.health(empty, ["device_id"]).count() == 0  # empty groups produce no rows
    row = quality.validate_all(empty, {"temperature": "float64"}, ["temperature"], {"temperature": (0, 1)}).first()
    assert row["overall_valid"] is True
    assert quality.verdict(empty, "temperature IS NULL").first()[0] == "VALID"
    assert gold.referential_integrity(empty, empty, "device_id", "device_id").first()[0] == 0


def test_silver_clean_rejects_empty(spark, empty):
    with pytest.raises(ValueError):
        clean.silver_clean(empty, check_nonempty=True)


def test_gate_stops_on_empty_universe(spark, empty):
    uni = spark.createDataFrame([], "s bigint")
    row = flows.source_gate(empty, uni, "s", F.col("device_id")).first()
    assert row["status"] == "STOP" and row["canary_rows"] == 0
