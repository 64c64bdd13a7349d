"""Block/halo windows must equal the plain partitioned window exactly."""

from __future__ import annotations

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from layercake.operators import sequences, windows
from tests.conftest import SF_CHECK, SF_SMALL


def _events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


def _plain_indicators(df, keys):
    w = Window.partitionBy(*keys).orderBy("ts", "event_id") if keys else Window.orderBy("ts", "event_id")
    return df.select(
        "event_id",
        F.avg("value").over(w.rowsBetween(-19, 0)).alias("MA20"),
        F.avg("value").over(w.rowsBetween(-199, 0)).alias("MA200"),
        F.stddev_samp("value").over(w.rowsBetween(-19, 0)).alias("BB_Std"),
    )


def _compare(a, b, cols, tol=1e-9):
    ra = {r["event_id"]: r for r in a.collect()}
    rb = {r["event_id"]: r for r in b.collect()}
    assert ra.keys() == rb.keys()
    for k in ra:
        for c in cols:
            x, y = ra[k][c], rb[k][c]
            if x is None or y is None:
                assert x is None and y is None, (k, c, x, y)
            else:
                assert math.isclose(x, y, rel_tol=tol, abs_tol=tol), (k, c, x, y)


@pytest.mark.parametrize("keys", [["event_type"], []])
@pytest.mark.parametrize("block_rows,ranges", [(256, 3), (200, 7), (1000, 1)])
def test_blocks_equal_plain_window(spark, keys, block_rows, ranges):
    df = _events(spark).select("event_id", "event_type", "ts", "value")
    got = windows.indicators(
        df.withColumnRenamed("ts", "Date").withColumnRenamed("value", "Close"),
        keys=keys, tie_break=["event_id"], block_rows=block_rows, ranges=ranges,
    ).select("event_id", "MA20", "MA200", "BB_Std")
    want = _plain_indicators(df, keys)
    _compare(got, want, ["MA20", "MA200", "BB_Std"])


def test_block_layout_bounds_groups(spark):
    df = _events(spark).select("event_id", "event_type", "ts", "value")
    laid = windows.block_layout(df, ["event_type"], ["ts", "event_id"], halo=19, block_rows=64, ranges=5)
    sizes = laid.groupBy("event_type", windows.BLK).count().agg(F.max("count")).first()[0]
    assert sizes <= 64 + 19
    own = laid.filter(~F.col(windows.HALO)).count()
    assert own == df.count()
    # positions are a permutation of 0..n-1
    pos = laid.filter(~F.col(windows.HALO)).agg(F.min(windows.POS), F.max(windows.POS), F.countDistinct(windows.POS)).first()
    assert (pos[0], pos[1], pos[2]) == (0, own - 1, own)


@settings(max_examples=6, deadline=None)
@given(block=st.integers(min_value=40, max_value=400), ranges=st.integers(min_value=1, max_value=9))
def test_property_lag_and_roll(spark, block, ranges):
    df = _events(spark).select(F.col("user_id").alias("device_id"), "event_id", "ts", F.col("value").alias("temperature"))
    got = sequences.lag_features(df, ["device_id"], ["ts", "event_id"], "temperature",
                                 block_rows=block, ranges=ranges)
    w = Window.partitionBy("device_id").orderBy("ts", "event_id")
    want = df.select(
        "event_id",
        F.lag("temperature", 1).over(w).alias("temp_lag_1"),
        F.avg("temperature").over(w.rowsBetween(-4, 0)).alias("temp_roll_mean_5"),
    )
    _compare(got, want, ["temp_lag_1", "temp_roll_mean_5"])


def test_ema_long_keys_match_recursion(spark):
    """Keys of many blocks."""
    df = spark.read.parquet(f"{SF_CHECK}/events.parquet").select("event_type", "event_id", "ts", "value")
    got = sequences.ema(df, ["event_type"], ["ts", "event_id"], "value", block_rows=450, ranges=4)
    rows = sorted(got.collect(), key=lambda r: (r["event_type"], r["ts"], r["event_id"]))
    state: dict[str, float] = {}
    worst = 0.0
    for r in rows:
        s = state.get(r["event_type"], 0.0) * 0.9 + r["value"] * 0.1
        state[r["event_type"]] = s
        worst = max(worst, abs(s - r["ema"]) / max(1.0, abs(s)))
    assert worst < 1e-12
    assert max(df.groupBy("event_type").count().collect(), key=lambda r: r[1])[1] > 450


def test_sequence_window_heads(spark):
    df = _events(spark).select(F.col("user_id").alias("device_id"), "event_id", "ts", F.col("value").alias("temperature"))
    out = sequences.trailing_window(df, ["device_id"], ["ts", "event_id"], "temperature", block_rows=50, ranges=3)
    first = out.filter("window_len = 1").count()
    assert first == df.select("device_id").distinct().count()
    assert out.filter("prediction_ready AND window_len <> 20").count() == 0
    assert out.agg(F.max("window_len")).first()[0] <= 20


def test_score_records(spark):
    df = _events(spark).select(F.col("user_id").alias("device_id"), "event_id", "ts", F.col("value").alias("temperature"))
    out = sequences.score_sequences(df, ["device_id"], ["ts", "event_id"], "temperature")
    kinds = {r["kind"]: r["count"] for r in out.groupBy("kind").count().collect()}
    assert kinds["warmup"] + kinds["prediction"] == df.count()
    alerts = out.filter("kind = 'alert'")
    assert alerts.filter("abs(observed - prediction) <= 5").count() == 0
    assert abs(sum(sequences.linear_weights()) - 1.0) < 1e-12


def test_fixed_point_averages_exact_across_blocks(spark):
    from fractions import Fraction

    df = _events(spark).select("event_id", "event_type", F.col("ts").alias("Date"), F.col("value").alias("Close"))
    got = windows.indicators(df, keys=["event_type"], tie_break=["event_id"], digits=6,
                             block_rows=256, ranges=3).collect()
    rows = sorted(df.collect(), key=lambda r: (r["event_type"], r["Date"], r["event_id"]))
    hist: dict[str, list[int]] = {}
    want = {}
    for r in rows:
        h = hist.setdefault(r["event_type"], [])
        h.append(round(r["Close"] * 100))
        win = h[-50:]
        q = Fraction(sum(win), 100 * len(win))
        m = (q * 10**6 * 2 + 1) // 2  # HALF_UP for non-negative
        want[r["event_id"]] = float(m) / 10**6
    assert {r["event_id"]: r["MA50"] for r in got} == want


def _loop(values):
    s, out = 0.0, []
    for v in values:
        s = s * 0.9 + v * 0.1
        out.append(s)
    return out


@pytest.mark.parametrize("block_rows", [None, 60, 7])
def test_ema_forgets_nothing(spark, block_rows):
    """A spike 500 rows back still shows; NULL keys are a series; ties of blocks and keys."""
    series = {"spike": [1e20] + [1.0] * 600, None: [float(i % 17) for i in range(130)], "one": [3.5]}
    df = spark.createDataFrame(
        [(k, i, v) for k, vs in series.items() for i, v in enumerate(vs)] + [("spike", -1, None)], "k string, i int, v double"
    )
    got = sequences.ema(df, ["k"], ["i"], "v", block_rows=block_rows, ranges=3).collect()
    assert len(got) == df.count() - 1
    for k, vs in series.items():
        mine = [r["ema"] for r in sorted((r for r in got if r["k"] == k), key=lambda r: r["i"])]
        assert mine == pytest.approx(_loop(vs), rel=1e-12)
    assert next(r for r in got if r["k"] == "spike" and r["i"] == 500)["ema"] > 1.0001


def test_ema_odd_readings_stay(spark):
    for odd in (float("nan"), float("inf")):
        vs = [1.0] * 20 + [odd] + [2.0] * 40
        df = spark.createDataFrame(list(enumerate(vs)), "i int, v double")
        got = [r["ema"] for r in sequences.ema(df, [], ["i"], "v", block_rows=16, ranges=2).orderBy("i").collect()]
        assert got[:20] == pytest.approx(_loop(vs[:20]))
        assert [repr(g) for g in got[20:]] == [repr(w) for w in _loop(vs)[20:]]


def test_hot_key_is_split_and_exact(spark):
    """One key with a third of the rows: bounded groups, same answer as the plain window."""
    ev = spark.read.parquet(f"{SF_CHECK}/events.parquet")
    df = ev.select(
        F.when(F.col("event_id") < F.lit(ev.count() // 3), F.lit(0)).otherwise(F.col("user_id")).alias("device_id"),
        "event_id", "ts", F.col("value").alias("temperature"),
    )
    laid = windows.block_layout(df, ["device_id"], ["ts", "event_id"], halo=4, block_rows=256, ranges=8)
    biggest = laid.groupBy("device_id", windows.BLK).count().agg(F.max("count")).first()[0]
    assert biggest <= 256 + 4
    hot_blocks = laid.filter("device_id = 0").select(windows.BLK).distinct().count()
    assert hot_blocks >= 10  # the hot key is spread over many bounded window groups
    got = sequences.lag_features(df, ["device_id"], ["ts", "event_id"], "temperature", block_rows=256, ranges=8)
    w = Window.partitionBy("device_id").orderBy("ts", "event_id")
    want = df.select("event_id", F.lag("temperature", 1).over(w).alias("temp_lag_1"),
                     F.avg("temperature").over(w.rowsBetween(-4, 0)).alias("temp_roll_mean_5"))
    _compare(got, want, ["temp_lag_1", "temp_roll_mean_5"])


def test_null_order_values_sort_last(spark):
    rows = [(1, i, None if i in (2, 5) else i * 10.0, float(i)) for i in range(8)]
    df = spark.createDataFrame(rows, "k int, id int, t double, v double")
    got = sequences.lag_features(df, ["k"], ["t", "id"], "v", block_rows=5, ranges=2)
    w = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_last(), "id")
    want = df.select(F.col("id").alias("event_id"), F.lag("v", 1).over(w).alias("temp_lag_1"),
                     F.avg("v").over(w.rowsBetween(-4, 0)).alias("temp_roll_mean_5"))
    _compare(got.withColumnRenamed("id", "event_id"), want, ["temp_lag_1", "temp_roll_mean_5"])
    # the NULL-time rows come after every timed row
    assert {r["event_id"]: r["temp_lag_1"] for r in want.collect()}[2] == 7.0


def test_indicators_keep_four_decimals_and_survive_nan(spark):
    prices = [10.0001, 10.0004, 10.00035, 9.9999, float("nan"), 12.3456]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(prices)], "Date int, Close double")
    got = [r["MA20"] for r in windows.indicators(df, digits=6).orderBy("Date").collect()]
    for i in range(4):
        assert abs(got[i] - sum(prices[: i + 1]) / (i + 1)) <= 5.1e-7
    assert got[4] != got[4] and got[5] != got[5]


@pytest.mark.parametrize("ranges", [1, 5])
def test_averages_of_any_doubles_equal_fsum(spark, ranges):
    """Huge, tiny, negative, seven-decimal and cancelling prices; NULL, NaN and infinite ones act as in avg."""
    import random

    rng = random.Random(1)
    nan, inf = float("nan"), float("inf")
    series = {
        "mixed": [rng.choice([1e13, 4e-7, -1e13, 0.1234567, 2e8, 0.0, None, 3.3]) for _ in range(700)],
        "wide": [rng.choice([1e300, -1e300, 1e-300, 1.5, 5e-324]) for _ in range(300)],
        "odd": [rng.choice([1.1, 2.2, 3.3] + [nan, inf, -inf, None] * (i % 90 == 0)) for i in range(700)],
        "none": [None] * 3,
    }

    def mean(values):
        values = [v for v in values if v is not None]
        if any(math.isnan(v) for v in values) or {inf, -inf} <= set(values):
            return nan
        odd = [v for v in values if math.isinf(v)]
        return odd[0] if odd else math.fsum(values) / len(values) if values else None

    for names in (["mixed"], ["wide", "none"], ["mixed", "odd"]):
        rows = [(k, i, v) for k in names for i, v in enumerate(series[k])]
        df = spark.createDataFrame(rows, "k string, Date int, Close double")
        got = {(r["k"], r["Date"]): r for r in windows.indicators(df, keys=["k"], ranges=ranges).collect()}
        assert len(got) == len(rows)
        for k, i, _ in rows:
            for n in windows.MA_LENGTHS:
                want = mean(series[k][max(0, i - n + 1) : i + 1])
                assert repr(got[k, i][f"MA{n}"]) == repr(want), (k, i, n)


def test_margins_are_moved_back_until_frames_are_whole(spark, monkeypatch):
    """A sample so thin that margins begin too near the bounds; long and short keys, NULLs in keys and order."""
    monkeypatch.setattr(windows, "LEAST_SAMPLES", 40)
    monkeypatch.setattr(windows, "SAMPLES_PER_RANGE", 4)
    df = spark.range(20_000).select(
        F.when(F.col("id") < 9_000, F.lit("hot")).when(F.col("id") < 9_500, F.lit(None)).otherwise((F.col("id") % 90).cast("string")).alias("k"),
        F.when(F.col("id") % 1000 > 0, F.col("id") * 7919 % 20_011).alias("t"), F.col("id").alias("event_id"),
        (F.col("id") % 37).cast("double").alias("v"),
    )
    got = windows.rolling(df, ["k"], ["t", "event_id"], 499, lambda w: {"s": F.sum("v").over(w.rowsBetween(-499, 0)), "l": F.lag("v", 499).over(w)}, ranges=9)
    w = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_last(), "event_id")
    want = df.select("event_id", F.sum("v").over(w.rowsBetween(-499, 0)).alias("s"), F.lag("v", 499).over(w).alias("l"))
    _compare(got, want, ["s", "l"])


def test_one_exchange_and_no_checkpoint(spark):
    """The plan deals the rows out once, by literals; nothing is written for it."""
    from layercake.plans import inspect

    df = spark.read.parquet(f"{SF_CHECK}/events.parquet").select("event_id", F.col("ts").alias("Date"), F.col("value").alias("Close"))
    for keys in ([], ["event_id"]):
        got = windows.indicators(df, keys=keys, tie_break=["event_id"], ranges=6)
        plan = inspect.physical_plan(got)
        assert plan.count("Exchange shufflepartitionidpassthrough") == 1 and plan.count("Exchange") == 1
        assert "from_json" not in plan and "RDDScan" not in plan and plan.count("FileScan parquet") == 1
        assert "Window" in plan
