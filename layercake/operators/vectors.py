"""Text -> vector rows for a vector mart.

The default embedder is deterministic and JVM-side (tokenize + feature
hashing to a fixed width).  A remote or model embedder plugs in as a
function ``texts (pd.Series) -> list of float lists``, called through an
Arrow-batched pandas UDF: one call per batch, never per row, and never
through the driver.

A hashed embedding has as many entries as its text has words, and 1,536
numbers.  With ``sparse`` it stays an ML vector of its entries from the hash
to the collection's files, and :func:`read_vectors` spreads it out; spread
out before, every shuffle, sort, write and read of an upsert would carry
and step through all its zeros.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, LongType, StructField, StructType

from layercake.sinks import tables

# Fixed value: width of the sensor embedding collection.
EMBEDDING_DIM = 1536
TOKEN_PATTERN = "[ \\t\\n\\r\\f]+"


def hashed_embedding(df: DataFrame, text_col: str = "text", out: str = "embedding",
                     dim: int = EMBEDDING_DIM, sparse: bool = False) -> DataFrame:
    """Term counts hashed into ``dim`` buckets, as ``array<float>`` or as a sparse ML vector."""
    tok = RegexTokenizer(inputCol=text_col, outputCol="_lc_tokens", pattern=TOKEN_PATTERN, minTokenLength=1)
    tf = HashingTF(inputCol="_lc_tokens", outputCol="_lc_tf", numFeatures=dim)
    vec = tf.transform(tok.transform(df))
    made = F.col("_lc_tf") if sparse else vector_to_array("_lc_tf", "float32")
    return vec.withColumn(out, made).drop("_lc_tokens", "_lc_tf")


def udf_embedding(embed: Callable[[pd.Series], list], dim: int = EMBEDDING_DIM):
    """Wrap a batch embedder as a pandas UDF returning ``array<float>`` of ``dim`` entries (others are an error)."""

    @F.pandas_udf(ArrayType(FloatType()))
    def _embed(texts: pd.Series) -> pd.Series:
        vectors = list(embed(texts))
        if len(vectors) != len(texts) or any(len(v) != dim for v in vectors):
            raise ValueError(f"the embedder must give {dim} numbers for each text")
        return pd.Series(vectors)

    return _embed


def embed(df: DataFrame, text_col: str = "text", out: str = "embedding", dim: int = EMBEDDING_DIM,
          embedder: Callable[[pd.Series], list] | None = None, sparse: bool = False) -> DataFrame:
    """The texts' vectors: an embedder's as ``array<float>``, the hashed default's also as sparse ML vectors."""
    if embedder is None:
        return hashed_embedding(df, text_col, out, dim, sparse)
    return df.withColumn(out, udf_embedding(embedder, dim)(F.col(text_col)))


def _is_ml(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, VectorUDT)


def _width(vector: str) -> Column:
    v = F.unwrap_udt(vector)
    return F.coalesce(v["size"], F.size(v["values"]))


def _rank(vector: str) -> Column:
    """Sorts ML vectors of one width as their ``array<float>`` sort, by their entries alone.

    At the first place where two differ, the greater number wins: an entry
    above 0 wins over what has its next entry later, one below 0 loses to it.
    """
    v = F.unwrap_udt(vector)
    entry = lambda i, x: F.struct(i.alias("i"), x.cast("float").alias("x"))
    entries = F.when(v["type"] == 0, F.zip_with(v["indices"], v["values"], entry)).otherwise(F.transform(v["values"], lambda x, i: entry(i, x)))
    above = lambda e: e["x"] > 0
    step = lambda e: F.struct(F.when(above(e), 1).otherwise(-1).alias("s"), F.when(above(e), -e["i"]).otherwise(e["i"]).alias("i"), e["x"].alias("x"))
    end = F.struct(F.lit(0).alias("s"), F.lit(0).alias("i"), F.lit(0.0).cast("float").alias("x"))
    return F.when(F.col(vector).isNotNull(), F.concat(F.transform(F.filter(entries, lambda e: e["x"] != 0), step), F.array(end)))


def vector_rows(df: DataFrame, id_col: str, emb_col: str, time_col: str, dim: int = EMBEDDING_DIM) -> DataFrame:
    """``(id bigint, embedding array<float> or ML vector as given, timestamp bigint epoch seconds)``.

    A vector of the wrong width fails the job with the offending id, as a
    vector store with a fixed schema would reject the insert.
    """
    ml = _is_ml(df, emb_col)
    checked = F.when(
        (_width(emb_col) if ml else F.size(emb_col)) == F.lit(dim), F.col(emb_col)
    ).otherwise(F.raise_error(F.concat(F.lit("embedding width mismatch for id "), F.col(id_col).cast("string"))))
    return df.select(
        F.col(id_col).cast("bigint").alias("id"),
        (checked if ml else checked.cast(ArrayType(FloatType()))).alias("embedding"),
        F.unix_seconds(F.col(time_col).cast("timestamp")).alias("timestamp"),
    )


def write_vectors(df: DataFrame, path: str) -> str:
    """Vector rows appended to a Parquet collection (one file per task); a repeated call appends them again."""
    df.write.mode("append").parquet(path)
    return path


#: Buckets of a new collection; a collection keeps the number it began with.
BUCKETS = 64
_VECTORS, _LAYOUT, _BUCKET = "vectors", "layout", "bucket"
#: A stored row's vector is in ``embedding`` or, if it came as an ML vector, in ``vector``.
_STORED = StructType(
    [StructField("id", LongType()), StructField("embedding", ArrayType(FloatType())), StructField("vector", VectorUDT()), StructField("timestamp", LongType())]
)


def upsert_vectors(df: DataFrame, base: str, buckets: int = BUCKETS) -> int:
    """Insert vector rows, or replace those of the same (id, timestamp); returns the commit's number.

    The collection is cut into buckets by a hash of the id.  A run lands its
    rows by bucket, joins only the buckets they fall into, writes those anew
    and makes them current in one commit: the same batch twice leaves one
    copy, a run that fails leaves the former state, and readers never see
    half a batch.  Of several rows of a batch for one (id, timestamp) the
    greatest vector counts.  One writer at a time.  ML vectors are kept as
    they come; those of one collection have one width.
    """
    spark = df.sparkSession
    parts = tables.current_parts(spark, base)
    buckets = int(parts.get(_LAYOUT, {}).get("buckets", buckets))
    current = parts.get(_VECTORS, {})
    run = uuid.uuid4().hex
    keys = ["id", "timestamp"]
    if _is_ml(df, "embedding"):
        once = df.groupBy(*keys).agg(F.max_by("embedding", _rank("embedding")).alias("vector")).withColumn("embedding", F.lit(None).cast("array<float>"))
    else:
        once = df.groupBy(*keys).agg(F.max("embedding").alias("embedding")).withColumn("vector", F.lit(None).cast(VectorUDT()))
    once = once.select(*_STORED.names)
    landed = f"{base}/landed/run={run}"
    by_bucket = F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")
    once.withColumn(_BUCKET, by_bucket).hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(landed)
    if not tables.exists(spark, f"{landed}/{_BUCKET}=*"):
        return 0
    new = spark.read.schema(_STORED).parquet(landed).drop(_BUCKET)
    touched = sorted(str(r[0]) for r in spark.read.schema(f"{_BUCKET} int").parquet(landed).distinct().collect())
    held = [current[b] for b in touched if b in current]
    merged = new
    if held:
        old = spark.read.schema(_STORED).parquet(*held)
        same = [old[k].eqNullSafe(new[k]) for k in keys]
        merged = old.join(new.select(*keys), same, "left_anti").unionByName(new)
    path = f"{base}/{_VECTORS}/run={run}"
    merged.withColumn(_BUCKET, by_bucket).hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(path)
    entries = [(_VECTORS, b, f"{path}/{_BUCKET}={b}") for b in touched]
    return tables.commit_parts(spark, base, [*entries, (_LAYOUT, "buckets", str(buckets))])


def read_vectors(spark: SparkSession, base: str) -> DataFrame:
    """The current rows of a collection, every vector as ``array<float>``."""
    current = tables.current_parts(spark, base).get(_VECTORS, {})
    if not current:
        return spark.createDataFrame([], "id bigint, embedding array<float>, timestamp bigint")
    spread = F.when(F.col("vector").isNotNull(), vector_to_array("vector", "float32")).otherwise(F.col("embedding"))
    return spark.read.schema(_STORED).parquet(*current.values()).select("id", spread.alias("embedding"), "timestamp")
