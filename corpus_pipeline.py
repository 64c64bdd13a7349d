"""The corpus pipeline: from raw documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from layercake.llm import stages
from layercake.llm.common import prepare, staged
from layercake.session import table

#: (name, function of (spark, docs, sf_dir)); each result is written and is the next one's docs.
STAGES = [
    ("quality", stages.good_quality),
    ("toxicity", stages.not_toxic),
    ("line_dedup", stages.without_repeated_lines),
    ("near_dedup", stages.without_near_duplicates),
    ("packing", stages.packed),
]

#: Two stages are trained models, which SQL cannot express; tests compare the
#: stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
