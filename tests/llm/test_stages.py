"""The pipeline's stages on odd tables: nothing lost, nothing renamed, the same rows kept every time."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from layercake.llm import stages
from tests.conftest import SF_SMALL

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i}" for i in range(60))


def _rows(frame):
    return sorted(map(repr, frame.collect()))


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_columns_of_any_name_pass(spark, name, stage):
    """Names that the stages use inside, with dots, and of NULL values; NULL and empty texts, repeated rows."""
    rows = _docs(spark, [(1, LONG), (1, LONG), (None, "a plain sentence of no note"), (2, None), (3, ""), (4, "x")])
    extra = ["_kept", "_score", "score", "row", "print", "again", "kept", "_doc", "block", "a.b", "c0", "doc", "hash", "n_lines2"]
    wide = rows.select("*", *[F.lit(f"v{i}").alias(c) for i, c in enumerate(extra)], F.lit(None).cast("int").alias("none"))
    out = stage(spark, wide, SF_SMALL)
    assert out.columns == wide.columns
    for r in out.collect():
        assert [r[c] for c in extra] == [f"v{i}" for i in range(len(extra))] and r["none"] is None
    narrow = stage(spark, rows, SF_SMALL)
    assert _rows(narrow) == _rows(out.select(*rows.columns))
    empty = stage(spark, wide.limit(0), SF_SMALL)
    assert empty.columns == wide.columns and empty.collect() == []


def test_near_dedup_keeps_texts_that_share_an_id(spark):
    """Two different texts with one doc_id both stay; a repeated row stays once; of near copies the smallest id does."""
    near = LONG.replace("word59", "other")
    rows = [(1, LONG), (1, "something else entirely, in seven or so words"), (1, LONG), (5, near), (None, near), (0, None), (0, None), (7, "")]
    docs = _docs(spark, rows)
    kept = [(r["doc_id"], r["text"]) for r in stages.without_near_duplicates(spark, docs, SF_SMALL).collect()]
    assert sorted(kept, key=repr) == sorted([(1, LONG), (1, rows[1][1]), (0, None), (7, "")], key=repr)
    again = stages.without_near_duplicates(spark, docs.repartition(5), SF_SMALL)
    assert _rows(again) == _rows(stages.without_near_duplicates(spark, docs, SF_SMALL))
    other = docs.withColumn("lang", F.when(F.monotonically_increasing_id() % 2 == 0, "fr").otherwise(F.col("lang")))
    assert {r["text"] for r in stages.without_near_duplicates(spark, other, SF_SMALL).collect()} == {t for _, t in kept}


def test_the_pipeline_is_its_stages_in_turn(spark):
    """run() gives what the stages give one after the other, and packs all that they keep."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF_SMALL).cache()
        assert docs.columns == before.columns and docs.select("doc_id").subtract(before.select("doc_id")).count() == 0
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    packed = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r["doc_id"] for r in packed} == set(kept)
    fill = {}
    for r in sorted(packed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fill.get(r["sequence_id"], 0)
        fill[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(fill.values()) <= 2048
