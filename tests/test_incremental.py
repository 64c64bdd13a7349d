"""Incremental indicators equal those of the whole history, and cost the days that a run changes."""

from __future__ import annotations

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from layercake.operators import incremental, windows
from layercake.plans import flows
from layercake.sinks import tables

SCHEMA = "sym string, id long, d timestamp_ntz, p double, note string"
START = datetime(2024, 1, 1)


def _store(spark, base, keys=("sym",)):
    return incremental.Store(spark, base, list(keys), "d", "p", ["id"])


def _want(spark, rows, keys=("sym",)):
    df = spark.createDataFrame(rows, SCHEMA).select(*keys, "id", F.col("d").alias("Date"), F.col("p").alias("Close"))
    return windows.indicators(df, keys=list(keys), tie_break=["id"], digits=6, method="partition")


def _rows(df):
    columns = ["sym", "id", "Date", "Close", "MA20", "MA50", "MA200", "BB_Std", "BB_Upper", "BB_Lower"]
    return sorted(map(repr, df.select(*[c for c in columns if c in df.columns]).collect()))


def _day(n, per_day, sym, rng):
    return [(sym, n * 1000 + i, START + timedelta(days=n, minutes=i), round(rng.uniform(1, 100), 2), "x") for i in range(per_day)]


@pytest.mark.parametrize("keys", [("sym",), ()])
def test_any_order_of_landings_equals_the_whole(spark, tmp_dir, keys):
    """Appends, late rows, corrections near and far, series that pause, rows without a date, repeats in a batch."""
    rng = random.Random(4)
    store, current = _store(spark, os.path.join(tmp_dir, "s"), keys), {}

    def land(rows):
        run = store.update(spark.createDataFrame(rows, SCHEMA))
        for r in sorted(rows, key=lambda r: (r[3] is not None, r[3] or 0.0)):
            current[r[0] if keys else None, r[1], r[2]] = r
        assert _rows(store.indicators()) == _rows(_want(spark, list(current.values()), keys))
        assert store.raw().count() == len(current)
        return run

    ids = iter(range(10**6, 2 * 10**6))
    land([r for n in range(6) for r in _day(n, 60, "a", rng)] + [("b", next(ids), START, 5.0, None)])
    land(_day(6, 60, "a", rng) + [("c", next(ids), None, 7.0, "no date")])  # a new day
    land(_day(6, 60, "a", rng)[30:] + [("b", next(ids), START + timedelta(days=6), 6.5, None)])  # the last day again
    if not keys:
        return
    far = next(r for r in current.values() if r[0] == "a" and r[2] and r[2].day == 2)
    land([(*far[:3], 55.55, "corrected")])  # only days 2 to 5 are reached
    land([("a", next(ids), START + timedelta(days=3, hours=5), 1.25, "late"), ("d", next(ids), START - timedelta(days=40), 3.0, "earlier than all")])
    twice = ("a", next(ids), START + timedelta(days=9))
    land([(*twice, 2.0, "x"), (*twice, 3.0, "y"), ("c", next(ids), None, None, "no price")])


def test_a_days_run_reads_that_day_and_the_tails(spark, tmp_dir):
    rng = random.Random(5)
    base = os.path.join(tmp_dir, "s")
    store = _store(spark, base)
    store.update(spark.createDataFrame([r for n in range(9) for s in "ab" for r in _day(n, 80, s, rng)], SCHEMA))
    run = store.update(spark.createDataFrame(_day(9, 80, "a", rng) + _day(9, 80, "b", rng), SCHEMA))
    assert run.changed == run.computed == ["2024-01-10"]
    read = {path.split(base)[1].split("/")[1:][0] + "/" + path.split(incremental.DAY + "=")[1].split("/")[0] for path in run.files if incremental.DAY + "=" in path}
    assert read == {"tails/2024-01-09", "raw/2024-01-10"}
    correction = store.update(store.raw().where("sym = 'a' AND d = TIMESTAMP_NTZ '2024-01-03'").select("sym", "id", "d", (F.col("p") + 2).alias("p"), "note"))
    assert correction.changed == ["2024-01-03"]
    assert correction.computed == ["2024-01-03", "2024-01-04", "2024-01-05", "2024-01-06"]  # 80 rows a day, 199 on
    days = {path.split(incremental.DAY + "=")[1].split("/")[0] for path in correction.files if incremental.DAY + "=" in path}
    assert days == {"2024-01-01", "2024-01-02", *correction.computed}


def test_rerun_and_unchanged_rows_commit_nothing(spark, tmp_dir):
    base = os.path.join(tmp_dir, "s")
    store, rows = _store(spark, base), spark.createDataFrame(_day(0, 30, "a", random.Random(6)), SCHEMA)
    assert store.update(rows).changed and not store.update(rows).changed and not store.update(rows.limit(0)).changed
    assert spark.read.parquet(f"{base}/parts").agg(F.max("number")).first()[0] == 1


def test_a_run_that_fails_before_its_commit_leaves_the_former_state(spark, tmp_dir, monkeypatch):
    base, rng = os.path.join(tmp_dir, "s"), random.Random(7)
    store = _store(spark, base)
    first = _day(0, 30, "a", rng)
    store.update(spark.createDataFrame(first, SCHEMA))

    def lost(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "commit_parts", lost)
        with pytest.raises(RuntimeError, match="lost"):
            store.update(spark.createDataFrame(_day(1, 30, "a", rng), SCHEMA))
    assert _rows(store.indicators()) == _rows(_want(spark, first)) and store.raw().count() == 30


def test_flow_shows_a_corrected_price_and_new_columns(spark, tmp_dir):
    def land(name, rows, schema):
        path = os.path.join(tmp_dir, name)
        tables.write_json(spark.createDataFrame(rows, schema), path)
        return flows.silver(spark, path, os.path.join(tmp_dir, "s"), schema, ["sym"], "d", "p", ["id"])

    short = "sym string, id long, d timestamp_ntz, p double"
    land("one", [("a", 1, START, 10.0), ("a", 2, START, 20.0)], short)
    result, verdict, run = land("two", [("a", 1, START, 12.0, "fixed")], SCHEMA)
    assert [r["MA20"] for r in result.orderBy("id").collect()] == [12.0, 16.0]
    assert verdict.first()["validation_status"] == "VALID" and run.changed == ["2024-01-01"]
    raw = _store(spark, os.path.join(tmp_dir, "s")).raw().orderBy("id").collect()
    assert [r["note"] for r in raw] == ["fixed", None]


def test_nothing_landed(spark, tmp_dir):
    path = os.path.join(tmp_dir, "none")
    tables.write_json(spark.createDataFrame([], SCHEMA), path)
    result, _, run = flows.silver(spark, path, os.path.join(tmp_dir, "s"), SCHEMA, ["sym"], "d", "p", ["id"])
    assert result.count() == 0 and run.changed == [] and "MA200" in result.columns
