"""The operators as stages over the documents table: each takes documents and returns the kept ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake.llm import line_dedup, near_dedup, packing, quality, toxicity
from layercake.llm.common import prepare, staged
from layercake.session import table
from public_tokenizers import path as tokenizer_path

MIN_QUALITY = 0.3
MAX_TOXICITY = 0.3
SIMILARITY = 80  # percent of shared shingles that makes near-duplicates


def _named(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row): what operators read, and all other columns as one struct, whatever their names."""
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"]
    return docs.select("doc_id", "text", F.struct(*others).alias("row"))


def _whole(docs: DataFrame, named: DataFrame) -> DataFrame:
    """The rows of ``_named`` with the columns of ``docs``."""
    return named.select(
        *[F.col("text") if c == "text" else F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)]
    )


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of at least MIN_QUALITY.

    Each row is judged by its own text: repeated rows stay or go together,
    NULL and empty texts score the share of good labels.  An empty table
    stays empty; other columns, of any name, are passed on.
    """
    named = _named(docs)
    model = quality.train(named, table(prepare(spark), sf_dir, "labels"))
    return _whole(docs, quality.score(named, model, score_col="score").where(F.col("score") >= MIN_QUALITY))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below MAX_TOXICITY.

    Each row is judged by its own text, as in ``good_quality``; NULL, empty
    and very short texts score the share of toxic labels.
    """
    named = _named(docs)
    model = toxicity.train(named, table(prepare(spark), sf_dir, "labels"))
    return _whole(docs, toxicity.score(named, model, score_col="score").where(F.col("score") < MAX_TOXICITY))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many share; n_chars, where there is one, follows the text.

    Every row stays, also one whose text becomes empty (NULL texts come back
    as empty ones); rows that share a doc_id are one document of a line, and
    a row without one keeps its lines.
    """
    named = _named(docs)
    cut = _whole(docs, line_dedup.drop_repeated_lines(named))
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id.

    Rows are told apart by all their columns: repeated rows stay once, rows
    that share a doc_id but not a text are documents of their own, and so
    are rows without one (which come after the others).  Between rows of
    one doc_id a hash of the row decides, so a repeated task keeps the same.
    Documents without words are near-duplicates of none.
    """
    named = _named(docs)
    fields = [F.col("text"), *[F.col("row")[f.name] for f in named.schema["row"].dataType.fields]]
    parts = [x for f in fields for x in (f.isNull(), f)]  # a hash passes over NULLs
    named = named.withColumns({"print": F.xxhash64(*parts), "again": F.hash(*parts)})
    groups = near_dedup.near_duplicates(named.select(F.col("print").alias("doc_id"), "text"), percent=SIMILARITY)
    member = groups.select(F.col("doc_id").alias("member"), F.col("component_id").alias("component")).distinct()
    place = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("print").alias("c"))
    first = named.join(member, F.col("print") == F.col("member")).groupBy("component").agg(F.min(place).alias("first"))
    kept = staged(first.select(F.col("first.c").alias("kept")), "kept")
    return _whole(docs, named.join(kept, F.col("print") == F.col("kept")).dropDuplicates(["print", "again"]))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in a sequence.

    Every row's text is packed, NULL as the empty one, which is its end token alone;
    repeated rows and ids are packed as often as they are there.
    """
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))
