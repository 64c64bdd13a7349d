"""What the operators of this package share: session set-up, staging, runs of sorted batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from layercake.session import configure, scratch_path

#: Rows and bytes of one Arrow batch sent to Python; bounds a task's memory whatever the texts' lengths.
BATCH_ROWS = "1000"
BATCH_BYTES = "8m"


def prepare(spark: SparkSession) -> SparkSession:
    """The library's session settings, and small Arrow batches for long texts."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def staged(frame: DataFrame, name: str, *parts: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back: later steps, and
    retries after a lost executor, start from the files instead of the whole lineage.
    With ``parts`` the files lie by those columns, and filters on them prune."""
    spark = frame.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    frame.write.partitionBy(*parts).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def map_arrow(frame: DataFrame, function, schema: StructType) -> DataFrame:
    """``mapInArrow`` for columns of any name (it takes none with a dot); the function sees them by position."""
    plain = StructType([StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(schema.fields)])

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in function(batches):
            yield batch.rename_columns(plain.names)

    return frame.toDF(*[f"c{i}" for i in range(len(frame.columns))]).mapInArrow(renamed, plain).toDF(*schema.names)


def with_column(schema: StructType, name: str, kind: str) -> StructType:
    """A copy of a schema with one more column."""
    return StructType(list(schema.fields)).add(name, kind)


def held_out(key: str, folds: int, held: int):
    """crc32(key as text) % folds = held; a NULL key counts as held out (never learnt from)."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == held, F.lit(True))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """One table for each run of equal (non-null) keys in sorted batches."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        table = table.combine_chunks()
        n = table.num_rows
        if not n:
            continue
        new = np.zeros(n, dtype=bool)
        new[0] = True
        for key in keys:
            values = table[key].to_numpy()
            new[1:] |= values[1:] != values[:-1]
        at = np.flatnonzero(new)
        for a, b in zip(at[:-1], at[1:]):
            yield table.slice(a, b - a)
        rest = table.slice(at[-1])
    if rest is not None and rest.num_rows:
        yield rest


def list_parts(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The flat values of a list column without NULL lists, and the offsets of its rows in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], offsets - offsets[0]


def fixed_bytes(column: pa.ChunkedArray | pa.Array, dtype, width: int) -> np.ndarray:
    """A binary column of equally long values as a matrix (rows, width)."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=dtype).reshape(len(values), width)
