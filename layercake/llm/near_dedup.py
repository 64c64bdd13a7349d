"""Near-duplicate documents: b-bit MinHash signatures and a multi-index Hamming join.

1. Every document becomes the set of its distinct word shingles.  Documents
   with the same set form one class; only its smallest id goes on.
2. A set's signature has ``chunks * width`` symbols, the low 16 bits of that
   many MinHash values.  Two sets of similarity J differ in about (1 - J) of
   them.
3. By the pigeonhole principle two signatures that differ in at most
   ``2 * chunks - 1`` symbols have a chunk with at most ONE differing symbol.
   Enumerating the allowed error as a wildcard gives ``width`` keys per chunk
   (the other symbols of the chunk); such a pair shares a key.  With 12
   chunks of 5 symbols every pair up to distance 23 of 60 is found; at
   J = 0.85 a pair lies beyond it with probability 1e-6 (mean 9, deviation
   2.8), at J = 0.8 with 3e-4, and most pairs beyond still share a key.
4. All rows with a key meet at the key's smallest id (its pivot): one row per
   id and pivot, not per pair.  A pivot's group is cut into blocks, each
   pair of blocks is a row group of its own, and within it the pairs under
   the distance bound are confirmed on the full sets.  A block returns at
   most one row per id (its local component), never its pairs.
5. Connected components join what the blocks found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.llm.common import fixed_bytes, list_parts, prepare, runs, staged
from layercake.llm.graph import components
from layercake.llm.textscan import U64, mix, shingle_hashes, text_words

WORDS = 5  # words in a shingle
CHUNKS = 12
WIDTH = 5  # symbols in a chunk
BLOCK_IDS = 128  # documents, and
BLOCK_SHINGLES = 1_000_000  # shingles of a block

_SYMBOLS = CHUNKS * WIDTH
_DRAWN = np.random.default_rng(20240131).integers(0, 2**64, size=(2, _SYMBOLS), dtype=np.uint64)
_XOR, _ODD = _DRAWN[0][:, None], (_DRAWN[1] | U64(1))[:, None]


def shingle_set(words: np.ndarray, width: int = WORDS) -> np.ndarray:
    """The sorted distinct shingle hashes of one text's words."""
    return np.unique(shingle_hashes(words, width))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The symbols of a non-empty set."""
    low = np.full(_SYMBOLS, 2**64 - 1, dtype=U64)
    for at in range(0, len(shingles), 4096):
        low = np.minimum(low, ((shingles[None, at : at + 4096] ^ _XOR) * _ODD).min(axis=1))
    return (mix(low) & U64(0xFFFF)).astype(np.uint16)


def _sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    h, at = text_words(texts)
    for a, b in zip(at[:-1], at[1:]):
        yield shingle_set(h[a:b], width)


def _sketch(width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("print", pa.binary()), ("sig", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints, sigs = [], [], []
            for s in _sets(batch.column(1), width):
                sizes.append(len(s))
                prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                sigs.append(signature(s).tobytes() if len(s) else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(sigs, pa.binary())],
                schema=schema,
            )

    return run


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, print, sig): set size, 128-bit hash of the set, signature; one row per row."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _sketch(width), "doc_id long, n_shingles long, print binary, sig binary"
    )


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = fixed_bytes(batch.column(1), np.uint16, _SYMBOLS).astype(U64)
        ids = batch.column(0)
        for c in range(CHUNKS):
            chunk = sig[:, c * WIDTH : (c + 1) * WIDTH]
            for j in range(WIDTH):
                key = np.full(len(chunk), c * WIDTH + j + 1, dtype=U64)
                for k in range(WIDTH):
                    if k != j:
                        key = mix(key * U64(0xFF51AFD7ED558CCD) + chunk[:, k])
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), ids], names=["key", "id"])


def _groups(reps: DataFrame) -> DataFrame:
    """(pivot, id): every id beside the smallest id that shares one of its keys, the pivot itself included."""
    keys = reps.select("id", "sig").mapInArrow(_keys, "key long, id long")
    # Written, so that the join below reads two plain shuffles, which adaptive execution can split.
    pivots = staged(
        keys.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).where("pivot < last").select("key", "pivot"),
        "pivots",
    )
    found = staged(keys.join(pivots, "key").where("id <> pivot").select("pivot", "id").distinct(), "found")
    return found.unionByName(found.select("pivot", F.col("pivot").alias("id")).distinct())


def _with_sets(width: int):
    """Adds signature and full set to (doc_id, text, at)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(_sets(batch.column(1), width))
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            sigs = [signature(s).tobytes() if len(s) else b"" for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sigs, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["id", "at", "sig", "shingles"],
            )

    return run


def _overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the given pairs of sets."""
    used, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts >= 2
    column = np.cumsum(shared) - 1
    width = int(shared.sum())
    if len(x) * 2e-5 < len(left) * len(right) * width * 1e-10 + len(inverse) * 2e-8:
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(x, y)], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    keep = shared[inverse]
    owner, col = owner[keep], column[inverse[keep]]
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    place = np.full(len(sets), -1)
    place[left] = np.arange(len(left))
    total = np.zeros((len(left), len(right)))
    other = np.full(len(sets), -1)
    other[right] = np.arange(len(right))
    for at in range(0, width, 4096):
        a, b = np.searchsorted(col, [at, at + 4096])
        one, two = np.zeros((len(left), 4096), np.float32), np.zeros((len(right), 4096), np.float32)
        o, c = owner[a:b], col[a:b] - at
        one[place[o[place[o] >= 0]], c[place[o] >= 0]] = 1
        two[other[o[other[o] >= 0]], c[other[o] >= 0]] = 1
        total += one @ two.T
    return np.rint(total[place[x], other[y]]).astype(np.int64)


def local_components(ids: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest id that each position reaches over the pairs (x, y)."""
    label = ids.copy()
    while True:
        before = label.copy()
        low = np.minimum(label[x], label[y])
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        if (label == before).all():
            return label


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["pivot", "i", "j"]):
            if group.num_rows < 2:
                continue
            ids, block = group["id"].to_numpy(), group["block"].to_numpy()
            i, j = group["i"][0].as_py(), group["j"][0].as_py()
            sig = fixed_bytes(group["sig"], np.uint16, _SYMBOLS)
            flat, offsets = list_parts(group["shingles"])
            flat, size = flat.view(U64), np.diff(offsets)
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            far = np.zeros((len(left), len(right)), dtype=np.int16)
            for k in range(_SYMBOLS):
                far += sig[left, k][:, None] != sig[right, k][None, :]
            near = far <= 2 * CHUNKS - 1
            small, large = np.minimum(size[left][:, None], size[right][None, :]), np.maximum(size[left][:, None], size[right][None, :])
            near &= 100 * small >= percent * large
            if i == j:
                near = np.triu(near, 1)
            x, y = np.nonzero(near)
            x, y = left[x], right[y]
            if not len(x):
                continue
            sets = [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
            both = _overlaps(sets, left, right, x, y)
            linked = 100 * both >= percent * (size[x] + size[y] - both)
            label = local_components(ids, x[linked], y[linked])
            moved = label != ids
            yield pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(label[moved])], names=["a", "b"])

    return run


def near_duplicates(
    docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text", width: int = WORDS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * |intersection| >= percent * |union| of
    their shingle sets; ``component_id`` is the smallest doc_id reachable and
    ``kept`` marks the document that bears it.  Texts without words (NULL and
    empty ones too) have no shingles and link with nothing, whatever their
    number.  Repeated rows belong together; rows that share a doc_id are one
    document with the links of all its texts.  A NULL doc_id is never kept:
    its row bears the component of its exact copies, else NULL.  Other
    columns of ``docs`` are ignored, an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    drawn = staged(sketches(docs, id_col, text_col, width), "sketches")
    reps = staged(
        drawn.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("print", "sig", "n_shingles").agg(F.min("doc_id").alias("id")),
        "classes",
    )
    groups = staged(_groups(reps), "groups")
    # Only groups of more than one block need an entry.
    blocks = staged(
        groups.join(reps.select("id", "n_shingles"), "id")
        .groupBy("pivot")
        .agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
        .select("pivot", F.greatest(F.ceil(F.col("n") / BLOCK_IDS), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
        .where("blocks > 1"),
        "blocks",
    )
    meets = (
        groups.join(blocks, "pivot", "left")
        .groupBy("id")
        .agg(F.collect_list(F.struct("pivot", F.coalesce("blocks", F.lit(1)).alias("blocks"))).alias("at"))  # one entry a key at most
    )
    members = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .join(meets, F.col("doc_id") == F.col("id"))
        .select("doc_id", "text", "at")
        .mapInArrow(_with_sets(width), "id long, at array<struct<pivot:long,blocks:int>>, sig binary, shingles array<long>")
        .where("size(shingles) > 0")
        .select("id", "sig", "shingles", F.explode("at").alias("to"))
        .select("id", "sig", "shingles", "to.pivot", "to.blocks", F.expr("CAST(pmod(xxhash64(id), to.blocks) AS INT)").alias("block"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select("pivot", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "id", "block", "sig", "shingles")
    )
    edges = (
        members.repartition("pivot", "i", "j")
        .sortWithinPartitions("pivot", "i", "j", "id")
        .mapInArrow(_confirm(percent), "a long, b long")
    )
    # A document with several texts ties their classes together.
    several = (
        drawn.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("doc_id").agg(F.min(F.xxhash64("print")).alias("x"), F.max(F.xxhash64("print")).alias("y"))
        .where("x < y").select("doc_id")
    )
    ties = drawn.where("n_shingles > 0").join(several, "doc_id").join(reps.select("print", "id"), "print")
    found = components(edges.unionByName(ties.select(F.col("doc_id").alias("a"), F.col("id").alias("b"))))
    classes = staged(
        reps.join(found, F.col("id") == F.col("node"), "left").select(
            F.col("print").alias("p"), F.coalesce("component", "id").alias("component")
        ),
        "components",
    )
    lone = F.when(F.col("n_shingles") == 0, F.col("doc_id"))
    return (
        drawn.join(classes, (F.col("print") == F.col("p")) & (F.col("n_shingles") > 0), "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce(F.col("component"), lone).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )
