"""Feature assembly and linear-model scoring with Spark ML (JVM side)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layercake.session import scratch_path


def assemble(df: DataFrame, inputs: Sequence[str], out: str = "features", handle_invalid: str = "keep") -> DataFrame:
    """Dense feature vector; no row is lost.

    With ``keep`` a NULL input is a NaN in the vector (the first row of every
    device has no lag), which :func:`fit_linear` leaves out and
    :func:`predict` answers with NULL; ``skip`` drops such rows.
    """
    return VectorAssembler(inputCols=list(inputs), outputCol=out, handleInvalid=handle_invalid).transform(df)


def _complete(features: str) -> Column:
    return ~F.exists(vector_to_array(features), F.isnan)


def fit_linear(df: DataFrame, label: str, features: str = "features") -> LinearRegressionModel:
    """Least-squares fit (normal equations) over the rows without a missing value.

    Spark ML asks for the rows three times (their partitions, the sums, the
    training summary), so they are written to scratch storage first: what
    ``df`` is computed from runs once.
    """
    spark = df.sparkSession
    whole = df.filter(_complete(features) & F.col(label).isNotNull() & ~F.isnan(label)).select(features, label)
    path = scratch_path(spark, "fit_rows")
    whole.write.parquet(path)
    rows = spark.read.schema(whole.schema).parquet(path)
    return LinearRegression(featuresCol=features, labelCol=label, solver="normal", regParam=0.0).fit(rows)


def load_linear(path: str) -> LinearRegressionModel:
    return LinearRegressionModel.load(path)


def predict(model: LinearRegressionModel, df: DataFrame) -> DataFrame:
    """Adds the model's prediction: NULL where a feature is missing."""
    out = model.getPredictionCol()
    scored = model.transform(df)
    return scored.withColumn(out, F.when(_complete(model.getFeaturesCol()), F.col(out)))
