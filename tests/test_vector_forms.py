"""Vectors that travel and stay as their entries give the rows of those that are spread out."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.linalg import DenseVector, SparseVector, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from layercake.operators import vectors


def test_hashed_vectors_travel_and_stay_as_their_entries(spark, tmp_dir):
    rows = [(i, f"Sensor {i}: avg_temp={i % 7}.0, avg_power={i}.5", 1_700_000_000 + i % 3) for i in range(60)]
    text = spark.createDataFrame(rows, "id bigint, text string, t bigint").withColumn("t", F.timestamp_seconds("t"))
    made = [vectors.vector_rows(vectors.embed(text, sparse=sparse), "id", "embedding", "t") for sparse in (True, False)]
    for frame, path in zip(made, ("sparse", "dense")):
        vectors.upsert_vectors(frame.where("id % 2 = 0"), f"{tmp_dir}/{path}")
        vectors.upsert_vectors(frame, f"{tmp_dir}/{path}")
    sparse, dense = (vectors.read_vectors(spark, f"{tmp_dir}/{path}") for path in ("sparse", "dense"))
    assert sparse.schema["embedding"].dataType.simpleString() == "array<float>"
    assert sorted(sparse.collect()) == sorted(dense.collect()) == sorted(made[1].collect())
    for part in ("landed", "vectors"):  # what an upsert carries: no zero
        files = spark.read.schema(vectors._STORED).parquet(f"{tmp_dir}/sparse/{part}/run=*/bucket=*")
        assert files.count() == 90 and files.where("embedding IS NOT NULL OR vector IS NULL").isEmpty()
        assert files.agg(F.max(F.size(F.unwrap_udt("vector")["values"]))).first()[0] <= 4
    vectors.upsert_vectors(made[1].where("id < 9"), f"{tmp_dir}/sparse")  # both forms in one collection
    assert sorted(vectors.read_vectors(spark, f"{tmp_dir}/sparse").collect()) == sorted(made[1].collect())
    with pytest.raises(Exception, match="width mismatch"):
        vectors.vector_rows(vectors.embed(text, dim=8, sparse=True), "id", "embedding", "t").collect()


def test_the_greatest_vector_counts_in_either_form(spark, tmp_dir):
    draw = random.Random(5)
    lists = [[draw.choice([0.0, 0.0, -1.5, 2.0, 0.5, float("nan")]) for _ in range(4)] for _ in range(400)]
    schema = StructType([StructField("id", LongType()), StructField("embedding", VectorUDT()), StructField("timestamp", LongType())])
    entries = lambda v: SparseVector(4, [(i, x) for i, x in enumerate(v) if x != 0 or i == 2])
    ml = [(i % 80, entries(v) if i % 3 else DenseVector(v), 7) for i, v in enumerate(lists)] + [(3, None, 7), (999, None, 7)]
    plain = [(i % 80, v, 7) for i, v in enumerate(lists)] + [(3, None, 7), (999, None, 7)]
    vectors.upsert_vectors(spark.createDataFrame(ml, schema), f"{tmp_dir}/ml", buckets=4)
    vectors.upsert_vectors(spark.createDataFrame(plain, "id bigint, embedding array<float>, timestamp bigint"), f"{tmp_dir}/plain", buckets=4)
    got, want = (sorted(map(str, vectors.read_vectors(spark, f"{tmp_dir}/{x}").collect())) for x in ("ml", "plain"))
    assert got == want and len(got) == 81
