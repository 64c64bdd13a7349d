"""Quality by supervised subword embeddings.

Words, pairs of neighbouring words and character n-grams (three and four
bytes) are hashed into a fixed number of buckets, each with a learnt vector.
A document is the average of its vectors; a linear layer and softmax give
the label.  Vectors and layer are trained by stochastic gradient descent in
numpy on a bounded sample of labelled rows; scoring runs over whole texts of
any number of documents.  For scoring, vector and layer of a bucket fold
into one number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.llm.common import held_out, list_parts, prepare, with_column
from layercake.llm.textscan import SEGMENT, SPACED, U64, byte_values, joined, mix, words

BUCKET_BITS = 16
DIM = 10
SAMPLE_ROWS = 1_000  # labelled rows of each class that train the model, at most
EPOCHS = 16
RATE = 1.0

_EXACT = byte_values(lower=False)
_MASK = U64((1 << BUCKET_BITS) - 1)


def _bucket(codes: np.ndarray) -> np.ndarray:
    return (mix(codes) & _MASK).astype(np.int64)


def features(data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, place in ``data``) of all features of texts that lie one after another.

    Each kind of feature is yielded a megabyte of text at a time, in
    order of place; n-grams stay within a text, and pairs of words too.
    """
    for at in range(0, len(data), SEGMENT):
        end = min(at + SEGMENT, len(data))
        part = data[at : min(end + 3, len(data))].astype(np.uint32)
        code = part[: len(part) - 2] << np.uint32(16) | part[1 : len(part) - 1] << np.uint32(8) | part[2:] if len(part) > 2 else part[:0]
        for width in (3, 4):
            if width == 4:
                code = code[: max(0, len(code) - 1)] << np.uint32(8) | part[3:]
            place = np.arange(at, min(at + len(code), end))
            inside = place + width <= starts[np.searchsorted(starts, place, side="right")]
            yield _bucket(code[: len(place)][inside].astype(U64) + U64(width << 40)), place[inside]
    s, e, h = words(data, SPACED, _EXACT)
    yield _bucket(h), s
    if len(s) > 1:
        # The same pair either way round; a repeated word is the pair zero, whatever the word.
        same = np.searchsorted(starts, s[:-1], side="right") == np.searchsorted(starts, s[1:], side="right")
        yield _bucket((h[:-1] ^ h[1:])[same] + U64(5 << 40)), s[:-1][same]


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, label) to (id, label, buckets, counts): at most one entry a bucket, however long the text."""
    for batch in batches:
        texts = batch.column(1)
        kinds, counts = [], []
        for i in range(len(texts)):
            data, starts = joined(texts.slice(i, 1))
            bag = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
            for bucket, _ in features(data, starts):
                bag += np.bincount(bucket, minlength=len(bag))
            kinds.append(np.flatnonzero(bag).astype(np.int32))
            counts.append(bag[kinds[-1]].astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2).cast(pa.int32()), pa.array(kinds, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
            names=["id", "label", "buckets", "counts"],
        )


@dataclass
class Model:
    weight: np.ndarray  # of each bucket: its vector times the layer, label 1 minus label 0
    bias: float
    base: float  # share of label 1

    def scores(self, texts: pa.Array) -> np.ndarray:
        data, starts = joined(texts)
        n = len(starts) - 1
        total, count = np.zeros(n), np.zeros(n, dtype=np.int64)
        for bucket, place in features(data, starts):
            edge = np.searchsorted(place, starts)
            upto = np.concatenate([[0.0], np.cumsum(self.weight[bucket], dtype=np.float64)])
            total += upto[edge[1:]] - upto[edge[:-1]]
            count += np.diff(edge)
        z = total / np.maximum(count, 1) + self.bias
        return np.where(count > 0, 1 / (1 + np.exp(-np.clip(z, -500, 500))), self.base)


def fit(buckets: list[np.ndarray], counts: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, rate: float = RATE) -> tuple[np.ndarray, float]:
    """(weight of each bucket, bias) by per-document gradient steps with a falling rate.

    ``buckets`` and ``counts`` may be views of one flat array each; nothing of their size is copied.
    """
    rng = np.random.default_rng(11)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, size=(1 << BUCKET_BITS, DIM))
    layer, bias = np.zeros((DIM, 2)), np.zeros(2)
    steps, step = epochs * len(y), 0
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            lr = rate * (1 - step / steps)
            step += 1
            if not len(buckets[i]):
                continue
            share = counts[i] / counts[i].sum()
            hidden = share @ vectors[buckets[i]]
            z = hidden @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1  # gradient of the softmax's log-loss
            back = layer @ p
            layer -= lr * np.outer(hidden, p)
            bias -= lr * p
            vectors[buckets[i]] -= lr * np.outer(share, back)
    return vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0])


def train(
    docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> Model:
    """Fit on at most SAMPLE_ROWS rows of each class outside fold ``held``, the first by a hash of their id.

    Only labels 0 and 1 with a doc_id count; of several labels of a document
    the smaller holds.  The sample has the classes evenly; the bias is then
    set for their true shares among all labelled rows.  Without rows of both
    classes every score is the share of label 1 (a half without any).
    """
    spark = prepare(docs.sparkSession)
    marks = (
        labels.where(F.col("quality").isin(0, 1) & ~held_out("doc_id", folds, held))
        .groupBy(F.col("doc_id").cast("long").alias("_doc")).agg(F.min("quality").alias("label"))
    )
    shares = {r["label"]: r["count"] for r in marks.groupBy("label").count().collect()}  # two rows
    # Labels of documents that are not there are passed over, so that they do not use up the sample.
    there = docs.select(F.col(id_col).cast("long").alias("_doc")).distinct()
    known = marks.join(there, "_doc", "left_semi")
    order = F.xxhash64("_doc", F.lit("quality"))
    picked = known.where("label = 0").orderBy(order, "_doc").limit(SAMPLE_ROWS).unionByName(
        known.where("label = 1").orderBy(order, "_doc").limit(SAMPLE_ROWS)
    )
    # At most 2 * SAMPLE_ROWS ids: broadcast.
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text")).join(
        F.broadcast(picked), F.col("_id") == F.col("_doc")
    )
    bags = (
        rows.select("_id", "text", "label").mapInArrow(_bags, "id long, label int, buckets array<int>, counts array<int>")
        .dropDuplicates(["id"]).toArrow()
    ).sort_by("id")
    y = bags["label"].to_numpy()
    zero, one = shares.get(0, 0), shares.get(1, 0)
    base = (one + 1) / (zero + one + 2)
    if not 0 < y.sum() < len(y):
        return Model(np.zeros(1 << BUCKET_BITS), float(np.log(base / (1 - base))), base)
    flat, at = list_parts(bags["buckets"])
    number, _ = list_parts(bags["counts"])
    parts = list(zip(at[:-1], at[1:]))
    weight, bias = fit([flat[a:b] for a, b in parts], [number[a:b] for a, b in parts], y)
    bias += np.log(one / zero) - np.log(y.sum() / (len(y) - y.sum()))
    return Model(weight.astype(np.float32), float(bias), base)


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "quality") -> DataFrame:
    """All rows and columns of ``docs`` plus ``score_col`` (double, 0 to 1).

    A text without any feature (NULL and empty too) scores the share of
    label 1.  A column of the same name is replaced.
    """
    docs = docs.drop(score_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shared.value.scores(batch.column(at)))], names=[*batch.schema.names, score_col]
            )

    return docs.mapInArrow(run, with_column(docs.schema, score_col, "double"))
