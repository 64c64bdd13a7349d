"""Change-data-capture messages to rows.

A message is a JSON payload holding a list of changes, under ``changes``
or (wal2json's own name) ``change``; both are accepted.  Each change has
``kind, schema, table, columnnames, columnvalues``.  The stream's offset
log plays the part of acknowledging a position: a change is acknowledged
once the micro-batch that read it commits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

OLD_KEYS = StructType(
    [
        StructField("keynames", ArrayType(StringType())),
        StructField("keyvalues", ArrayType(StringType())),
    ]
)
CHANGE = StructType(
    [
        StructField("kind", StringType()),
        StructField("schema", StringType()),
        StructField("table", StringType()),
        StructField("columnnames", ArrayType(StringType())),
        StructField("columnvalues", ArrayType(StringType())),
        StructField("oldkeys", OLD_KEYS),
    ]
)
MESSAGE = StructType(
    [
        StructField("changes", ArrayType(CHANGE)),
        StructField("change", ArrayType(CHANGE)),
        StructField("_corrupt_record", StringType()),
    ]
)


def _well_formed(c: Column) -> Column:
    """A change whose columns, or else whose old keys, pair distinct names with values."""

    def pairs(names: Column, values: Column) -> Column:
        named = F.size(F.array_distinct(F.array_compact(names)))
        return F.coalesce((named == F.size(names)) & (F.size(names) == F.size(values)), F.lit(False))

    names, values, old = c["columnnames"], c["columnvalues"], c["oldkeys"]
    return (
        F.when(c.isNull(), F.lit(False))
        .when(names.isNotNull() | values.isNotNull(), pairs(names, values))
        .when(old.isNotNull(), pairs(old["keynames"], old["keyvalues"]))
        .otherwise(c["kind"].isNotNull())
    )


def explode_changes(messages: DataFrame, col: str = "value") -> DataFrame:
    """One row per change: ``kind, schema, table, columns map<string,string>, rejected``.

    Column values are kept as JSON text (numbers as their literal), typed
    later by :func:`typed_columns`.  A delete carries only its key, under
    ``oldkeys``; its ``columns`` are those key columns.

    Nothing is lost: a message that is no JSON object, names no list of
    changes, or holds a change whose names and values do not pair up comes
    out as one row with its whole text in ``rejected`` (NULL elsewhere) and
    every other column NULL.  A message with an empty list has no rows.
    """
    payload = F.col(col).cast("string")
    parsed = messages.select(payload.alias("text"), F.from_json(payload, MESSAGE).alias("m")).select(
        "text", F.when(F.col("m._corrupt_record").isNull(), F.coalesce("m.changes", "m.change")).alias("cs")
    )
    bad = ~F.coalesce(F.forall("cs", _well_formed), F.lit(False))
    nothing = F.array(F.lit(None).cast(CHANGE))
    return (
        parsed.withColumn("bad", bad)
        .select("text", "bad", F.explode(F.when(F.col("bad"), nothing).otherwise(F.col("cs"))).alias("c"))
        .select(
            F.col("c.kind").alias("kind"),
            F.col("c.schema").alias("schema"),
            F.col("c.table").alias("table"),
            F.coalesce(
                F.map_from_arrays("c.columnnames", "c.columnvalues"),
                F.map_from_arrays("c.oldkeys.keynames", "c.oldkeys.keyvalues"),
            ).alias("columns"),
            F.when(F.col("bad"), F.col("text")).alias("rejected"),
        )
    )


def typed_columns(changes: DataFrame, schema: StructType | str, keep: tuple[str, ...] = ("kind",)) -> DataFrame:
    """Project the ``columns`` map onto typed columns (strict casts)."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    return changes.select(
        *keep,
        *[F.col("columns").getItem(f.name).cast(f.dataType).alias(f.name) for f in schema.fields],
    )


def pack_changes(rows: DataFrame, table: str, group: str, kind: Column, key: str, key_name: str = "changes") -> DataFrame:
    """Stand-in producer: rows packed into change messages, grouped by ``group``.

    ``group`` must bound the group size (e.g. ``key div 16``); the message
    key alternates between ``changes`` and ``change`` by group parity so
    both spellings are exercised.  ``kind`` is each row's change; a delete
    carries only its ``key`` column, as ``oldkeys``.
    """
    cols = [c for c in rows.columns if c != group]
    gone = kind == "delete"
    whole = lambda c: F.when(~gone, c)
    change = F.struct(
        kind.alias("kind"),
        F.lit("public").alias("schema"),
        F.lit(table).alias("table"),
        whole(F.array(*[F.lit(c) for c in cols])).alias("columnnames"),
        whole(F.array(*[F.col(c).cast("string") for c in cols])).alias("columnvalues"),
        F.when(
            gone, F.struct(F.array(F.lit(key)).alias("keynames"), F.array(F.col(key).cast("string")).alias("keyvalues"))
        ).alias("oldkeys"),
    )
    grouped = rows.groupBy(group).agg(F.collect_list(change).alias("cs"))
    options = {"ignoreNullFields": "false"}  # a NULL value keeps its place
    return grouped.select(
        F.when(F.col(group) % 2 == 0, F.to_json(F.struct(F.col("cs").alias(key_name)), options))
        .otherwise(F.to_json(F.struct(F.col("cs").alias("change")), options))
        .alias("value"),
        F.col(group).alias("msg_id"),
    )
