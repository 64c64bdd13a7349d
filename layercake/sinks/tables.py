"""Sinks: tables, Parquet snapshots, CSV export, layouts, schema history.

Writers are distributed (one file per task); nothing is funnelled through
the driver.  Paths are Hadoop paths, so the same code writes to local
disk in tests and to shared object storage on a cluster.
"""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


# --------------------------------------------------------------------- K1/K3
def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create-or-replace a table from a query (CTAS)."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def save_or_append(df: DataFrame, name: str, path: str | None = None, by_name: bool = True) -> str:
    """Create the table if missing, otherwise append to it.

    Appending is by column name (``by_name``) after checking the incoming
    columns are the table's; ``by_name=False`` keeps SQL's positional
    ``INSERT INTO`` behaviour.  Returns ``"created"`` or ``"appended"``.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        replace_table(df, name, path)
        return "created"
    target_cols = spark.table(name).columns
    if by_name:
        missing = set(target_cols) ^ set(df.columns)
        if missing:
            raise ValueError(f"append to {name}: column mismatch {sorted(missing)}")
        df = df.select(*target_cols)
    df.write.insertInto(name, overwrite=False)
    return "appended"


# ------------------------------------------------------------------------ K4
_COMMITS = "commits"


def write_snapshot(df: DataFrame, base: str) -> str:
    """Write ``df`` as a new immutable snapshot under ``base`` and commit it.

    Spark cannot overwrite a path it is reading in the same plan, and a
    plain overwrite leaves readers with a half-written folder.  Each call
    writes ``base/v=<id>`` completely, then APPENDS a numbered commit to
    ``base/commits``; readers take the newest.  Nothing is ever deleted or
    rewritten, so there is no moment without a current snapshot, and a crash
    before the commit leaves the former one current.  One writer at a time.
    """
    spark = df.sparkSession
    number = (_newest_commit(spark, base) or (0, ""))[0] + 1
    version = f"{base}/v={uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(version)
    spark.createDataFrame([(number, version)], _COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/{_COMMITS}")
    return version


_COMMIT_SCHEMA = "number long, path string"


def exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a path (with wildcards) is there; every other failure is raised."""
    try:
        spark.read.schema("x long").parquet(pattern)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def _newest_commit(spark: SparkSession, base: str) -> tuple[int, str] | None:
    if not exists(spark, f"{base}/{_COMMITS}"):
        if exists(spark, f"{base}/v=*"):
            raise RuntimeError(f"{base} holds snapshots but no commit: restore {base}/{_COMMITS} or remove the folders")
        return None
    row = spark.read.schema(_COMMIT_SCHEMA).parquet(f"{base}/{_COMMITS}").orderBy(F.desc("number")).first()
    if row is None:
        raise RuntimeError(f"{base}/{_COMMITS} holds no commit")
    return row["number"], row["path"]


def current_snapshot(spark: SparkSession, base: str) -> str | None:
    """Path of the newest committed snapshot; None only if ``base`` has none at all."""
    newest = _newest_commit(spark, base)
    return newest[1] if newest else None


def read_snapshot(spark: SparkSession, base: str, schema: StructType | None = None) -> DataFrame | None:
    path = current_snapshot(spark, base)
    if path is None:
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


# ---------------------------------------------------------- partition manifest
_PARTS = "parts"
_PARTS_SCHEMA = "number long, kind string, part string, path string"


def commit_parts(spark: SparkSession, base: str, entries: list[tuple[str, str, str]]) -> int:
    """Make (kind, part, path) entries current, all at once, by appending one numbered file to ``base/parts``.

    Later numbers win; an empty path takes a part out.  Like snapshots,
    nothing is rewritten, and files that no entry names do not count.  One
    writer at a time.
    """
    number = 1
    if exists(spark, f"{base}/{_PARTS}"):
        number += spark.read.schema(_PARTS_SCHEMA).parquet(f"{base}/{_PARTS}").agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    rows = [(number, *entry) for entry in entries]
    spark.createDataFrame(rows, _PARTS_SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/{_PARTS}")
    return number


def current_parts(spark: SparkSession, base: str) -> dict[str, dict[str, str]]:
    """kind -> part -> path; the driver holds one row per kind and part (a day, say)."""
    if not exists(spark, f"{base}/{_PARTS}"):
        return {}
    newest = spark.read.schema(_PARTS_SCHEMA).parquet(f"{base}/{_PARTS}").groupBy("kind", "part").agg(F.max_by("path", "number").alias("path"))
    out: dict[str, dict[str, str]] = {}
    for row in newest.where("path <> ''").collect():
        out.setdefault(row["kind"], {})[row["part"]] = row["path"]
    return out


# ------------------------------------------------------------------ JSON/K6
# Spark's JSON default keeps milliseconds only; bronze keeps microseconds.
TS_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
JSON_OPTIONS = {"timestampNTZFormat": TS_MICROS, "timestampFormat": TS_MICROS + "XXX"}


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """JSON Lines, timestamps at full microsecond precision."""
    df.write.mode(mode).options(**JSON_OPTIONS).json(path)
    return path


# ------------------------------------------------------------------------ K5
def export_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """CSV with header and comma delimiter; one file per task by default.

    ``single_file`` is an explicit opt-in for small BI extracts: it funnels
    the rows through one task, so it is never the default.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("delimiter", ",").csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read.option("header", True).option("delimiter", ",")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


# ------------------------------------------------------------------------ K6
def write_layout(
    df: DataFrame,
    path: str,
    partition_cols: list[str],
    fmt: str = "parquet",
    cluster_by: list[str] | None = None,
) -> str:
    """Partitioned bronze layout (``dt=/dataset=/...``), rerun-safe.

    Dynamic partition overwrite replaces only the partitions present in
    ``df``, so re-landing one day never deletes the others.  Rows are
    rebalanced on the partition columns first (``REBALANCE``): each output
    folder gets few large files instead of one small file per task, and AQE
    splits a hot folder (one day holding a third of the data) across many
    writer tasks instead of one.  ``cluster_by`` sorts within files (e.g.
    by symbol when symbols are many).
    """
    out = df.hint("rebalance", *partition_cols)
    if cluster_by:
        out = out.sortWithinPartitions(*cluster_by)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")  # per write, not session-wide
        .partitionBy(*partition_cols)
        .format(fmt)
        .save(path)
    )
    return path


_PART_TEXT = "\x1f"


def _part_text(cols: list[str]) -> Column:
    """A row's partition as one text (NULL is told from every value)."""
    return F.concat_ws(_PART_TEXT, *[F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("")) for c in cols])


def land_layout(df: DataFrame, path: str, partition_cols: list[str], **kw) -> DataFrame:
    """:func:`write_layout`, and what it wrote read back: the partitions of this run alone.

    The write itself reports the partitions it meets (an observed set, as
    many texts as folders written), so the input is read once.  They become
    literals of a partition filter: reading back costs the run, whatever the
    layout holds besides.
    """
    back = df.sparkSession.read.schema(df.schema)
    if df.isEmpty():  # a frame that is empty by its plan reports nothing
        write_layout(df, path, partition_cols, **kw)
        return back.parquet(path).limit(0)
    seen = Observation()
    observed = df.observe(seen, F.collect_set(_part_text(partition_cols)).alias("parts"))
    write_layout(observed, path, partition_cols, **kw)
    return back.parquet(path).where(_part_text(partition_cols).isin(seen.get["parts"]))


# ------------------------------------------------------------------------ K7
def schema_snapshots(df: DataFrame, keys: list[str]) -> DataFrame:
    """One schema row per key group present in ``df`` (e.g. day x dataset).

    The schema text is the frame's own ``simpleString``; the distinct key
    groups come from a map-side partial aggregation, so the result grows
    only with the number of groups.
    """
    return df.select(*keys).distinct().withColumn(
        "schema_ddl", F.lit(df.schema.simpleString())
    )


# ----------------------------------------------------------------------- K13
def _below(path: Column, root: str | None) -> Column:
    """The part of a path below ``root``, whatever scheme either is written with."""
    bare = F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:/*", "/")
    if root is None:
        return bare
    top = re.sub("^[A-Za-z][A-Za-z0-9+.-]*:/*", "/", root).rstrip("/") + "/"
    return F.when(bare.startswith(top), F.substr(bare, F.lit(len(top) + 1))).otherwise(bare)


def store_objects(objects: DataFrame, dest: str, key_prefix: str = "", root: str | None = None) -> DataFrame:
    """Copy binary objects (``binaryFile`` rows) into an object table at ``dest``.

    An object's key is its path below ``root``, the scanned folder (the whole
    path without one): part files of different folders keep different keys.
    Each task writes its own files, so bytes never pass through the driver.
    Returns a lazy status frame over the written table (one row per object
    with its key and size) for the caller to check or log.
    """
    keyed = objects.select(
        F.concat(F.lit(key_prefix), _below(F.col("path"), root)).alias("key"),
        "path",
        "length",
        "modificationTime",
        "content",
        *[c for c in objects.columns if c not in {"path", "length", "modificationTime", "content"}],
    )
    keyed.write.mode("append").parquet(dest)
    spark = objects.sparkSession
    return spark.read.parquet(dest).select(
        *[c for c in keyed.columns if c != "content"], F.lit("uploaded").alias("status")
    )
