"""Stream sources and sinks.

Sources: Kafka (when its connector is on the classpath) or a directory of
files, always with an explicit schema.  Sinks: ``foreachBatch`` writes that
are idempotent per ``batchId`` (a replayed batch overwrites its own folder),
with the checkpoint in shared storage, so a restarted query neither loses
nor duplicates rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType


def kafka_source(spark: SparkSession, servers: str, topics: Sequence[str] | str,
                 starting_offsets: str = "earliest", **options) -> DataFrame:
    """Kafka topics as ``(topic, key, value string, timestamp)`` rows.

    Several topics (one per device type) are one subscription; the value
    bytes are cast to a UTF-8 string.  Needs the Kafka connector jar.
    """
    subscribe = topics if isinstance(topics, str) else ",".join(topics)
    df = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", subscribe)
        .option("startingOffsets", starting_offsets)
        .options(**options)
        .load()
    )
    return df.select("topic", F.col("key").cast("string"), F.col("value").cast("string"), "timestamp")


def file_source(spark: SparkSession, path: str, fmt: str, schema: StructType | str | None = None,
                max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None,
                **options) -> DataFrame:
    """A directory of files as a stream; new files are new data.

    A micro-batch admits files up to a number of bytes (at least one file),
    which bounds it whatever the directory holds, or up to a number of files.

    ``fmt='text'`` yields one ``value`` string per line (the offline stand-in
    for a message topic).  Other formats require ``schema``: a streaming
    file source never infers one.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt != "text":
        raise ValueError("streaming file sources need an explicit schema")
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def topic_files(spark: SparkSession, paths: dict[str, str], **kw) -> DataFrame:
    """Offline multi-topic subscription: a union of text streams with a topic column."""
    streams = [file_source(spark, p, "text", **kw).withColumn("topic", F.lit(t)) for t, p in paths.items()]
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s)
    return out


def parquet_batch_writer(path: str, partition_by: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function writing each micro-batch to ``path/batch=<id>``.

    Overwriting the batch's own folder makes a replay after a failure a
    no-op rather than a duplicate.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        w = batch.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{path}/batch={batch_id}")

    return write


def run_available(df: DataFrame, sink: Callable[[DataFrame, int], None] | str, checkpoint: str,
                  output_mode: str = "append", name: str | None = None,
                  state_partitions: int | None = None) -> StreamingQuery:
    """Process everything available now (in trigger-sized batches) and stop.

    ``sink`` is a ``foreachBatch`` function or a built-in sink format name
    (``"console"``, or ``"memory"`` with ``name`` as the table).

    ``state_partitions`` fixes the number of state-store partitions of a new
    stateful query (AQE does not resize stateful shuffles; every micro-batch
    commits every state partition).  The session's shuffle setting is
    changed only while the query starts: the stream copies its conf at
    ``start()``, and a restart reads the count back from the checkpoint.
    """
    writer = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    writer = writer.format(sink) if isinstance(sink, str) else writer.foreachBatch(sink)
    writer = writer.trigger(availableNow=True)
    if name:
        writer = writer.queryName(name)
    spark = df.sparkSession
    key = "spark.sql.shuffle.partitions"
    previous = spark.conf.get(key)
    if state_partitions:
        spark.conf.set(key, str(int(state_partitions)))
    try:
        q = writer.start()
    finally:
        spark.conf.set(key, previous)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def read_batches(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """All micro-batch outputs written by :func:`parquet_batch_writer`."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.option("basePath", path).parquet(f"{path}/batch=*")
    return df.drop("batch") if "batch" in df.columns else df


def land_in_order(df: DataFrame, path: str, chunk: Column, n_chunks: int, key: str | None = None,
                  fmt: str = "parquet", columns: Sequence[str] | None = None, files: int | None = None,
                  stage: str | None = None) -> None:
    """Land ``df`` as files in ``n_chunks`` arrival waves (chunk 0 first).

    Each wave is its own write, so file modification times follow ``chunk``;
    with ``key``, each key's rows of one wave sit in one file, so a stream
    reading a few files per trigger still sees each key in arrival order.
    ``files`` bounds the files of a wave.  With a scratch folder ``stage``
    the rows are first written there by wave, so that a wave reads its own
    part instead of all of ``df``.
    """
    if stage:
        df.withColumn("_lc_part", chunk).write.partitionBy("_lc_part").parquet(stage)
        df = df.sparkSession.read.schema(StructType([*df.schema.fields, StructField("_lc_part", IntegerType())])).parquet(stage)
        chunk = F.col("_lc_part")
    for i in range(n_chunks):
        part = df.filter(chunk == F.lit(i))
        if key:
            part = part.repartition(files, key) if files else part.repartition(key)
        elif files:
            part = part.repartition(files)
        if columns:
            part = part.select(*columns)
        part.write.mode("append").format(fmt).save(path)
