"""Keyed stream state in ``foreachBatch``: a hot key of a micro-batch is spread over tasks.

A stateful operator hands all rows of a key in a micro-batch to one task.
The EMA is affine, so a block of readings acts on the average before it as
one pair of numbers; the batch operator (:func:`layercake.operators.sequences.ema`)
cuts each key into such blocks, carries one number from block to block and
finishes every block by itself.  Between micro-batches the keys' averages
live in a bucketed table that is committed together with the batch's number.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.operators import sequences
from layercake.sinks import tables

_STATE, _BATCH, _BUCKET = "state", "batch", "bucket"


def ema_batches(
    base: str,
    out: str,
    key: str,
    order: Sequence[str],
    value: str,
    passthrough: Sequence[str],
    buckets: int = 64,
    **kw,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: EMA and alerts of each micro-batch to ``out/batch=<id>``, state at ``base``.

    Readings are ordered within a micro-batch and taken in arrival order
    across them.  The batch's output is complete before its state and number
    are committed, so a batch that is replayed after a failure either
    repeats the same work from the same state or is already done.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        parts = tables.current_parts(spark, base)
        if batch_id <= int(parts.get(_BATCH, {}).get("last", -1)):
            return
        run = uuid.uuid4().hex
        rows_at = f"{base}/rows/run={run}"  # the batch is read several times
        batch.select(*dict.fromkeys([*passthrough, key, *order, value])).write.parquet(rows_at)
        rows = spark.read.schema(batch.select(*dict.fromkeys([*passthrough, key, *order, value])).schema).parquet(rows_at)
        state = parts.get(_STATE, {})
        kind = f"{key} {rows.schema[key].dataType.simpleString()}, ema double"
        known = spark.read.schema(kind).parquet(*state.values()) if state else spark.createDataFrame([], kind)
        made = sequences.ema_anomalies(rows, [key], order, value, initial=known, **kw)
        path = f"{out}/batch={batch_id}"
        made.select(*passthrough, "ema", "alert").write.mode("overwrite").parquet(path)
        place = F.struct(*[x for o in order for x in (F.col(o).isNull(), F.col(o))])
        # The last average of each key: one row a key and task before the shuffle.
        last = made.groupBy(key).agg(F.max_by("ema", place).alias("ema"))
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
        last.withColumn(_BUCKET, bucket).write.partitionBy(_BUCKET).parquet(f"{base}/last/run={run}")
        entries = [(_BATCH, "last", str(batch_id))]
        if tables.exists(spark, f"{base}/last/run={run}/{_BUCKET}=*"):
            fresh = spark.read.schema(f"{kind}, {_BUCKET} int").parquet(f"{base}/last/run={run}")
            touched = sorted(str(r[0]) for r in fresh.select(_BUCKET).distinct().collect())
            fresh = fresh.drop(_BUCKET)
            held = [state[b] for b in touched if b in state]
            merged = fresh
            if held:
                old = spark.read.schema(kind).parquet(*held)
                merged = old.join(fresh, old[key].eqNullSafe(fresh[key]), "left_anti").unionByName(fresh)
            merged.withColumn(_BUCKET, bucket).hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(f"{base}/{_STATE}/run={run}")
            entries += [(_STATE, b, f"{base}/{_STATE}/run={run}/{_BUCKET}={b}") for b in touched]
        tables.commit_parts(spark, base, entries)

    return write
