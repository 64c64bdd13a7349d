"""Plan inspection helpers: what the optimizer actually chose.

Used by tests and while tuning: the executed physical plan as text (AQE's
final plan once the frame has run), the filters pushed into each scan, and
counts of operators such as exchanges, scans or Python evaluation nodes.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame) -> str:
    """The executed physical plan (``explain("formatted")`` equivalent text)."""
    return df._jdf.queryExecution().executedPlan().toString()


def count_nodes(df: DataFrame, pattern: str) -> int:
    """Number of plan lines matching ``pattern`` (a regular expression)."""
    rx = re.compile(pattern)
    return sum(1 for line in physical_plan(df).splitlines() if rx.search(line))


def pushed_filters(df: DataFrame) -> list[str]:
    """``PushedFilters`` of every file scan in the plan."""
    return re.findall(r"PushedFilters: \[([^\]]*)\]", physical_plan(df))


def python_nodes(df: DataFrame) -> int:
    """Operators that move rows to Python workers."""
    return count_nodes(df, r"(ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas|PythonUDF)")
