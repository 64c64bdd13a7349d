"""Near-duplicate embeddings: spherical k-means cells and blocked cosine products.

Unit vectors are assigned to the cell of the nearest centre.  A pair of
cosine t or more is at most d = sqrt(2 - 2 t) apart, so a partner of x in
another cell can only lie there if x is within d of the plane midway between
the two centres.  Partners in all such cells at once do not exist: most lie
far nearer.  So that distance is scaled by a factor calibrated on a hashed
sample (:func:`border_factor`): each sampled vector gets partners at exactly
cosine t in random directions, the hardest there are, and all but a share of
``1 - recall`` of them must lie in a cell within the scaled distance.  x is
copied to those cells (only to cells of larger number: each pair meets
once).  ``recall=1`` keeps the whole distance and loses no link.
Equal vectors are one row with a weight.  Cells are cut into blocks, each
pair of blocks is a row group of its own, and a block returns at most one
row per vector: its links and the smallest id that it reaches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.llm.common import prepare, runs, staged
from layercake.llm.graph import components
from layercake.llm.vectors import matrix, usable

CELL_ROWS = 8192  # vectors of a cell, on average
SAMPLE_ROWS = 20_000  # vectors that train the centres, at most
ROWS_A_CENTRE = 8  # at least: larger tables have larger cells, which blocks cut
RECALL = 0.9995  # share of partners at exactly the threshold that the cells must hold; closer ones are safer
PARTNERS = 8  # simulated for each vector of the sample
CALIBRATION_ROWS = 4096  # vectors that they are simulated for, at most
BLOCK = 2048  # vectors of a block
TILE = 1024
MARGIN = 1e-9  # rounding, in favour of comparing
ROUNDING = 1e-12  # of a squared distance, in favour of comparing


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """k unit centres of unit vectors."""
    rng = np.random.default_rng(3)
    centres = x[rng.choice(len(x), size=k, replace=False)]
    for _ in range(rounds):
        home = np.concatenate([np.argmax(x[at : at + TILE] @ centres.T, axis=1) for at in range(0, len(x), TILE)])
        total = np.zeros_like(centres)
        np.add.at(total, home, x)
        size = np.linalg.norm(total, axis=1)
        empty = size < 1e-12
        total[empty], size[empty] = x[rng.choice(len(x), size=int(empty.sum()))], 1.0
        centres = total / size[:, None]
    return centres


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps tiny and huge vectors from under- and overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _excess(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(home cells, how far each vector lies from the plane towards each cell, times the centres' distance)."""
    near = x @ centres.T
    home = np.argmax(near, axis=1)
    return home, near[np.arange(len(home)), home][:, None] - near


def _apart(home: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Distances of all centres from the home cells' ones, by products; what rounding takes from one is less than ROUNDING."""
    square = (centres**2).sum(axis=1)
    kinds, at = np.unique(home, return_inverse=True)
    far = np.sqrt(np.maximum(square[kinds][:, None] + square[None, :] - 2 * (centres[kinds] @ centres.T), 0) + ROUNDING)
    return far[at]


def _goes(x: np.ndarray, centres: np.ndarray, cosine: float, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """(home cells, whether a vector may have a partner in each cell)."""
    reach = factor * (np.sqrt(2 - 2 * cosine) + MARGIN)
    home, excess = _excess(x, centres)
    return home, excess <= reach * _apart(home, centres) + MARGIN


def cells_met(x: np.ndarray, centres: np.ndarray, cosine: float, factor: float) -> float:
    """Share of all cells that unit vectors are compared in, on average."""
    return float(_goes(x, centres, cosine, factor)[1].mean())


def border_factor(x: np.ndarray, centres: np.ndarray, cosine: float, recall: float) -> float:
    """The part of the border distance within which a share ``recall`` of partners at the threshold are found."""
    if recall >= 1 or len(centres) < 2:
        return 1.0
    rng = np.random.default_rng(4)
    x, reach = x[:CALIBRATION_ROWS], np.sqrt(2 - 2 * cosine) + MARGIN
    needed = []
    for _ in range(PARTNERS):
        away = rng.normal(size=x.shape)
        away -= (away * x).sum(axis=1)[:, None] * x
        norm = np.linalg.norm(away, axis=1)[:, None]
        other = cosine * x + np.sqrt(max(1 - cosine**2, 0)) * away / np.where(norm > 0, norm, 1)
        for at in range(0, len(x), TILE):
            some, partner = x[at : at + TILE], other[at : at + TILE]
            home, excess = _excess(some, centres)
            there, back = _excess(partner, centres)
            rows = np.arange(len(some))
            # Either end may be the copied one: the one with the home cell of smaller number.
            far = _apart(home, centres)[rows, there]
            asks = np.where(home < there, excess[rows, there], back[rows, home])
            needed.append(np.where(home == there, 0.0, asks / (reach * far)))
    return float(min(1.0, np.quantile(np.concatenate(needed), recall, method="higher")))


def _assign(dim: int, centres: np.ndarray, cosine: float, factor: float = 1.0):
    """(vec_id, weight, vec) to (.., cell, home): the home cell, and the later cells that may hold partners."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home, goes = _goes(_unit(matrix(batch.column(2), dim)), centres, cosine, factor)
            goes &= np.arange(len(centres))[None, :] >= home[:, None]
            row, cell = np.nonzero(goes)
            table = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [*table.columns, pa.array(cell.astype(np.int32)), pa.array(cell == home[row])],
                names=["vec_id", "weight", "vec", "cell", "home"],
            )

    return run


def _compare(dim: int, cosine: float):
    """Links between the rows of block ``i`` (all in the cell) and those of block ``j`` (at home in it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["cell", "i", "j"]):
            left = group["left"].to_numpy()
            if left.all() or not left.any():
                continue
            a, b = group.filter(pa.array(left)), group.filter(pa.array(~left))
            x, y = _unit(matrix(a["vec"], dim)), _unit(matrix(b["vec"], dim))
            ida, idb = a["vec_id"].to_numpy(), b["vec_id"].to_numpy()
            home, weight_a, weight_b = a["home"].to_numpy(), a["weight"].to_numpy(), b["weight"].to_numpy()
            links_a, links_b = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
            tiles: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for at in range(0, len(x), TILE):
                some = slice(at, at + TILE)
                linked = x[some] @ y.T >= cosine
                linked &= ~home[some][:, None] | (ida[some][:, None] < idb[None, :])  # two at home: once
                p, q = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
                if len(p):
                    part = linked[np.ix_(p, q)]
                    links_a[at + p] += part @ weight_b[q]
                    links_b[q] += weight_a[at + p] @ part
                    tiles.append((at + p, q, np.packbits(part, axis=1)))
            if not tiles:
                continue
            low_a, low_b = ida.copy(), idb.copy()
            top = np.iinfo(np.int64).max
            while True:
                before = low_a.sum(dtype=np.float64), low_b.sum(dtype=np.float64), low_a.copy(), low_b.copy()
                for p, q, bits in tiles:
                    part = np.unpackbits(bits, axis=1, count=len(q)).astype(bool)
                    low_a[p] = np.minimum(low_a[p], np.where(part, low_b[q][None, :], top).min(axis=1))
                    low_b[q] = np.minimum(low_b[q], np.where(part, low_a[p][:, None], top).min(axis=0))
                if (low_a == before[2]).all() and (low_b == before[3]).all():
                    break
            for ids, links, low in ((ida, links_a, low_a), (idb, links_b, low_b)):
                some = links > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[some]), pa.array(links[some]), pa.array(low[some])], names=["vec_id", "links", "low"]
                )

    return run


def near_duplicates(
    frame: DataFrame,
    cosine: float = 0.9,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    recall: float = RECALL,
) -> DataFrame:
    """One row per row of ``frame``: vec_id, n_links, component_id, kept.

    Two vectors are linked when their cosine, in double precision, is at least
    ``cosine`` and they meet in a cell: all but a share of ``1 - recall`` of
    pairs at exactly that cosine do, closer ones more surely, equal ones
    always, and with ``recall=1`` all.  ``n_links`` counts the other rows linked directly, repeated
    ones too; ``component_id`` is the smallest vec_id reachable, and ``kept``
    marks the row that bears it.  Vectors that are NULL, zero, hold NULL or
    non-finite components or have another dimension than most link with
    nothing; a row with a NULL id links with nothing either, has no component
    and is not kept.  Other columns are ignored; an empty table gives no rows.
    """
    spark = prepare(frame.sparkSession)
    every = frame.select(F.col(id_col).cast("long").alias("vec_id"))
    rows, dim = usable(frame, id_col, vector_col)
    alone = every.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    if not dim:
        return alone.withColumn("kept", kept)
    rows = rows.select("vec_id", F.col("vec").cast("array<double>").alias("vec"))
    classes = staged(rows.groupBy("vec").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("weight")).select("vec_id", "weight", "vec"), "equal-vectors")
    count = classes.count()
    cells = max(1, -(-count // CELL_ROWS))
    sample = classes.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("vec").toArrow()
    x = _unit(matrix(sample["vec"], dim))
    centres = spherical_kmeans(x, min(max(1, len(x) // ROWS_A_CENTRE), cells))
    factor = border_factor(x, centres, cosine, recall)
    placed = staged(
        classes.mapInArrow(_assign(dim, centres, cosine, factor), "vec_id long, weight long, vec array<double>, cell int, home boolean"), "cells"
    )
    # One row a cell, of which there are as many as centres on the driver.
    sizes = F.broadcast(
        placed.groupBy("cell").agg(
            F.ceil(F.count("*") / BLOCK).cast("int").alias("lefts"),
            F.ceil(F.sum(F.col("home").cast("int")) / BLOCK).cast("int").alias("rights"),
        )
    )
    sized = placed.join(sizes, "cell")
    to = "CAST(pmod(xxhash64(vec_id), {}) AS INT)"
    lefts = sized.where("rights > 0").select(
        "cell", F.expr(to.format("lefts")).alias("i"), F.explode(F.expr("sequence(0, rights - 1)")).alias("j"),
        F.lit(True).alias("left"), "vec_id", "weight", "vec", "home",
    )
    rights = sized.where("home").select(
        "cell", F.explode(F.expr("sequence(0, lefts - 1)")).alias("i"), F.expr(to.format("rights")).alias("j"),
        F.lit(False).alias("left"), "vec_id", "weight", "vec", "home",
    )
    found = staged(
        lefts.unionByName(rights)
        .repartition("cell", "i", "j")
        .sortWithinPartitions("cell", "i", "j", "left", "vec_id")
        .mapInArrow(_compare(dim, cosine), "vec_id long, links long, low long"),
        "vector-links",
    )
    links = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("vec_id").alias("a"), F.col("low").alias("b")))
    known = staged(
        classes.join(links, "vec_id", "left").join(groups, F.col("vec_id") == F.col("node"), "left").select(
            F.col("vec").alias("v"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"),
            F.coalesce("component", "vec_id").alias("c"),
        ),
        "vector-classes",
    )
    whole = frame.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.when(F.col(id_col).isNotNull(), F.col(vector_col).cast("array<double>")).alias("vec"),
    )
    return whole.join(known, F.col("vec") == F.col("v"), "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id")
    ).withColumn("kept", kept)
