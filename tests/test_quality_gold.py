"""Edge cases of the gold, cleaning and data-quality operators."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from layercake.functions import clean, reshape
from layercake.operators import gold, quality


def test_integrity_null_keys_and_duplicate_dims(spark):
    fact = spark.createDataFrame([(None,), (1,), (3,)], "id int")
    dim = spark.createDataFrame([(1,), (1,)], "id int")
    got = gold.referential_integrity(fact, dim, "id", "id").first()["invalid_references"]
    assert got == 2  # NULL and 3; the duplicated dimension key never matters


def test_integrity_plan_is_anti_join(spark):
    fact = spark.createDataFrame([(1,)], "id int")
    dim = spark.createDataFrame([(1,)], "id int")
    plan = gold.orphans(fact, dim, "id", "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan


def test_metrics_reject_star_with_groups(spark):
    df = spark.createDataFrame([(1, "a")], "x int, g string")
    try:
        gold.compute_metrics(df, ["g"], None)
    except ValueError:
        pass
    else:
        raise AssertionError("grouping with '*' must be rejected")
    assert gold.compute_metrics(df).count() == 1


def test_dedup_before_impute_keeps_new_duplicates(spark):
    df = spark.createDataFrame([(None, "a"), (-1, "a"), (None, "a")], "q int, s string")
    out = clean.silver_clean(df, null_rules={"q": -1})
    # distinct first: (NULL,a),(-1,a); imputing makes them equal but both survive
    assert out.count() == 2
    assert out.filter("q = -1").count() == 2


def test_impute_text_null_only_for_strings(spark):
    df = spark.createDataFrame([(None, None)], "n int, s string")
    out = clean.impute(df, {}, text_null_for_strings=True).first()
    assert out["n"] is None and out["s"] == "NULL"


def test_cast_half_even(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (2.7,), (-2.5,)], "v double")
    got = [r[0] for r in clean.cast_columns(df, {"v": "int"}).collect()]
    assert got == [2, 4, 3, -2]


def test_try_cast_reject_column(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "v string")
    out = clean.cast_columns(df, {"v": "int"}, strict=False, reject_col="rejected").collect()
    assert [r["rejected"] for r in out] == [False, True, False]


def test_bounds_ignore_nan_and_null(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (30.0,)], "age double")
    stats = quality.check_stats(df, [], {"age": (18, 60)})
    errs = quality.bound_errors_frame(stats, df.columns, {"age": (18, 60)}).collect()
    assert errs == []
    nulls = quality.null_errors_frame(quality.check_stats(df, ["age"]), ["age"]).collect()
    assert nulls[0]["null_count"] == 2  # NaN counts as missing, like pandas


def test_reference_example_validation(spark):
    df = spark.createDataFrame(
        [(1.0, 25, "Alice"), (2.0, 30, "Bob"), (3.0, 40, "Charlie"), (None, 50, "David")],
        "id double, age bigint, name string",
    )
    row = quality.validate_all(
        df, {"id": "float64", "age": "int64", "name": "object"}, ["id", "name"], {"age": (18, 60)}
    ).first()
    assert row["schema_valid"] and not row["nulls_valid"] and row["min_max_valid"]
    assert row["overall_valid"] is False
    errs = quality.schema_errors(df, {"id": "int64", "zip": "object"})
    assert errs == {"id": "Expected int64, got double", "zip": "Missing column"}


def test_min_max_messages(spark):
    df = spark.createDataFrame([(10,), (70,)], "age bigint")
    bounds = {"age": (18, 60), "nope": (None, 1)}
    stats = quality.check_stats(df, [], bounds)
    errs = {r["column_name"]: r["error"] for r in quality.bound_errors_frame(stats, df.columns, bounds).collect()}
    assert errs == {"age": "Values below min 18; Values above max 60", "nope": "Column not found"}


def test_health_counts_duplicates_and_nan(spark):
    df = spark.createDataFrame(
        [("d", 1.0), ("d", 1.0), ("d", float("nan")), ("e", None)], "g string, v double"
    )
    h = {(r["g"], r["metric"], r["column_name"]): r["value"]
         for r in quality.health(df, ["g"], ["g", "v"]).collect()}
    assert h[("d", "row_count", None)] == 3
    assert h[("d", "duplicate_rows", None)] == 1
    assert h[("d", "null_count", "v")] == 1
    assert h[("e", "null_count", "v")] == 1


def test_flatten_names_unique_and_empty_struct(spark, tmp_dir):
    path = f"{tmp_dir}/nested.json"
    with open(path, "w") as f:
        f.write('{"a": {"b": 1, "c": {"d": "x"}, "e": {}}, "l": [1, 2], "a.b2": 3}\n')
    df = spark.read.json(path)
    flat = reshape.flatten(df)
    assert sorted(flat.columns) == sorted(["a.b", "a.c.d", "a.b2", "l"])
    assert len(set(flat.columns)) == len(flat.columns)


def test_unix_detection(spark):
    df = spark.createDataFrame([(1704067207, 1704067207179, 5)], "s bigint, ms bigint, small bigint")
    assert reshape.unix_time_columns(df) == ["s", "ms"]
    row = reshape.convert_unix_times(df, ["s", "ms", "small"]).first()
    assert reshape.convert_unix_times(df, []).schema == df.schema
    assert str(row["s"]) == "2024-01-01 00:00:07"
    assert row["ms"].microsecond == 179000 and row["small"] == 5


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"), 1.0)], "a double, b double")
    assert reshape.nan_to_null(df).first()["a"] is None


def test_infer_logical_types(spark):
    df = spark.createDataFrame([(1, 1.5, True, "x")], "i bigint, f double, b boolean, s string")
    assert quality.infer_schema(df) == {"i": "INTEGER", "f": "FLOAT", "b": "STRING", "s": "STRING"}


def test_map_categories_keeps_unmatched(spark):
    df = spark.createDataFrame([("A",), ("Z",), (None,)], "c string")
    out = [r[0] for r in clean.map_categories(df, "c", {"A": "Type1"}).collect()]
    assert out == ["Type1", "Z", None]


def test_verdict(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "Close double")
    assert quality.verdict(df, F.col("Close").isNull()).first()[0] == "INVALID"
    assert quality.verdict(df.dropna(), "Close IS NULL").first()[0] == "VALID"
    assert math.isfinite(1.0)


def test_cast_decimal_half_away(spark):
    df = spark.createDataFrame([("2.5",), ("-2.5",), ("2.4",)], "v string").selectExpr("CAST(v AS DECIMAL(4,1)) AS v")
    assert [r[0] for r in clean.cast_columns(df, {"v": "int"}).collect()] == [3, -3, 2]


def test_exact_avg_keeps_decimals_and_nan(spark):
    from layercake.functions.numeric import exact_avg, fixed_text

    rows = [("a", 10.0001), ("a", 10.0004), ("a", None), ("b", 1.0), ("b", float("nan")), ("c", None), ("d", -0.25)]
    df = spark.createDataFrame(rows, "k string, v double").groupBy("k").agg(exact_avg("v").alias("m"))
    got = {r["k"]: r["t"] for r in df.select("k", fixed_text("m").alias("t")).collect()}
    assert got == {"a": "10.000250", "b": "NaN", "c": None, "d": "-0.250000"}


def test_missing_features_give_null_predictions(spark):
    from layercake.operators import ml

    rows = [(1.0, 3.0), (2.0, 5.0), (3.0, 7.0), (None, 9.0)]
    feats = ml.assemble(spark.createDataFrame(rows, "x double, y double"), ["x"])
    got = {r["x"]: r["prediction"] for r in ml.predict(ml.fit_linear(feats, "y"), feats).collect()}
    assert got[None] is None and abs(got[2.0] - 5.0) < 1e-9 and len(got) == 4


def test_validate_all_returns_every_message(spark):
    import json

    df = spark.createDataFrame([(1, None), (None, float("nan"))], "a int, b double")
    row = quality.validate_all(df, {"a": "bigint", "z": "int"}, ["a", "b"], {"a": (2, 3), "y": (0, 1)}).first()
    assert json.loads(row["errors"]) == {
        "schema": {"a": "Expected bigint, got int", "z": "Missing column"},
        "nulls": {"a": 1, "b": 2},
        "min_max": {"a": "Values below min 2", "y": "Column not found"},
    }
    assert (row["schema_errors"], row["null_errors"], row["min_max_errors"]) == (2, 2, 2)
