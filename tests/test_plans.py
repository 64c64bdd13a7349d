"""Plan properties: pushdown, no Python on JVM paths, fused scans, bounded windows."""

from __future__ import annotations

import __spark_entry__ as entry
from layercake.plans import inspect
from tests.conftest import SF_SMALL


def _q(spark, key):
    return entry.queries()[key](spark, SF_SMALL)


def test_rule_filter_reaches_scan(spark):
    filters = " ".join(inspect.pushed_filters(_q(spark, "gold_fact")))
    assert "GreaterThan(value,100" in filters


def test_serving_time_bounds_reach_scan(spark):
    filters = " ".join(inspect.pushed_filters(_q(spark, "serve_temperature")))
    assert "GreaterThanOrEqual(ts," in filters and "LessThan(ts," in filters


def test_silver_chain_has_no_python(spark):
    assert inspect.python_nodes(_q(spark, "silver_clean")) == 0
    assert inspect.python_nodes(_q(spark, "silver_indicators")) == 0
    assert inspect.python_nodes(_q(spark, "ema_anomaly")) == 0


def test_fused_checks_scan_once(spark):
    assert inspect.count_nodes(_q(spark, "validate_all"), r"FileScan parquet") == 1
    assert inspect.count_nodes(_q(spark, "health_report"), r"FileScan parquet") == 1


def test_windows_partition_by_range(spark):
    """With or without keys, a window's rows meet by range: nothing goes to a single partition."""
    from layercake.operators import windows
    from layercake.plans.silver_keys import bars

    for keys in (["event_type"], []):
        plan = inspect.physical_plan(windows.indicators(bars(spark, SF_SMALL), keys=keys, tie_break=["event_id"], ranges=3))
        window_lines = [line for line in plan.splitlines() if "Window [" in line and "_lc_blk" in line]
        assert window_lines and "SinglePartition" not in plan, plan


def test_integrity_is_anti_join(spark):
    assert inspect.count_nodes(_q(spark, "referential_integrity"), r"LeftAnti") == 1


def test_serving_prunes_day_partitions(spark, tmp_dir):
    import os

    from pyspark.sql import functions as F

    from layercake.operators import serving
    from layercake.plans.event_keys import points
    from layercake.sinks import tables

    path = os.path.join(tmp_dir, "points")
    pts = points(spark, SF_SMALL).withColumn("dt", F.date_format("time", "yyyy-MM-dd"))
    tables.write_layout(pts, path, ["dt"])
    stored = spark.read.parquet(path)
    got = serving.field_points(stored, "2024-01-31 00:00:00", "2 days", day_col="dt")
    plan = inspect.physical_plan(got)
    assert "PartitionFilters: [isnotnull(dt" in plan and "2024-01-29" in plan
    want = serving.field_points(pts, "2024-01-31 00:00:00", "2 days")
    assert sorted(got.collect()) == sorted(want.collect())


def test_landing_a_day_reads_that_day(spark, tmp_dir):
    """Bronze prunes to the run's partitions by literals: two runs read two days, not three."""
    from pyspark.sql import functions as F

    from layercake.sinks import tables

    def day(d, kinds):
        return spark.createDataFrame([(i, d, k) for i in range(5) for k in kinds], "id int, dt string, dataset string")

    first = tables.land_layout(day("2024-01-01", ["a", None]), tmp_dir, ["dt", "dataset"])
    second = tables.land_layout(day("2024-01-02", ["a", "b=c", "d e"]), tmp_dir, ["dt", "dataset"])
    plan = inspect.physical_plan(second)
    filters = plan.split("PartitionFilters: [")[1]  # shown up to its first hundred characters
    assert filters.startswith("concat_ws(") and "2024-01-01" not in plan
    rows = {(r["dt"], r["dataset"]): r["count"] for f in (first, second) for r in f.groupBy("dt", "dataset").count().collect()}
    assert rows == {("2024-01-01", "a"): 5, ("2024-01-01", None): 5, **{("2024-01-02", k): 5 for k in ("a", "b=c", "d e")}}
    files = second.select(F.input_file_name()).distinct().collect()
    assert files and all("dt=2024-01-02" in f[0] for f in files)
    assert tables.land_layout(day("2024-01-03", []), tmp_dir, ["dt", "dataset"]).count() == 0
