"""layercake: a PySpark-native medallion analytics engine.

Raw data lands in a bronze layer, is profiled and checked, cleaned into
silver tables, rolled up into gold facts and metrics, and the same logic
runs over live events with Structured Streaming. Every operator is a
``DataFrame -> DataFrame`` function so Catalyst plans, distributes and
spills the work.
"""

from layercake.session import configure, scratch_path, table

__all__ = ["configure", "scratch_path", "table"]
