"""Nearest neighbours by inner product: multi-index hashing of learnt binary codes.

1. Vectors get one more component that makes all norms equal (queries get a
   zero there), so that the largest inner product is the smallest angle.
   A rotation learnt on a bounded sample (principal directions, then
   iterative quantisation) turns a vector into 64 bits.
2. The code is cut into eight substrings, and each row is indexed once per
   substring under the substring's value, its cell.
3. Two codes within Hamming distance ``radius`` have a substring within
   ``radius // 8``: probing all cells that near, in all eight indexes, meets
   every code within the radius.  Those are ranked by their inner products
   on the original vectors, in double precision.
4. The radius is measured on this table: the true neighbours of a bounded
   sample of its queries, found exactly, are looked up among their codes.
   The smallest radius of ``RADII`` that holds at least ``recall`` of them,
   and half of every sampled query's own, is taken, if its probes multiply
   fewer pairs than there are.  Otherwise codes tell too little here (norms
   far apart, many dimensions, vectors without clusters), and all queries are
   searched at the full radius, which is exact: one index serves it and
   meets each row once.  So are single queries whose radius holds fewer
   neighbours than asked for.

Cells are dealt to tasks in groups.  The rows of a group are split into
blocks, and so are the queries that probe it: each pair of blocks is a row
group of its own, so that a task holds about ``TASK_ROWS`` rows and
``TASK_QUERIES`` queries (fewer of more than 64 dimensions) however many
vectors share a code and however many queries there are.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from layercake.llm.common import prepare, runs, staged
from layercake.llm.vectors import matrix, usable

BITS, PARTS = 64, 8
CELLS = 1 << (BITS // PARTS)
SAMPLE_ROWS = 10_000  # vectors that train the rotation, at most
RADII = (7, 15, 23, 31)
RECALL = 0.98  # share of the sampled queries' true neighbours that the radius must hold
SAMPLE_QUERIES = 256  # queries that measure it, at most
TASK_ROWS = 65_536  # a query returns at most k rows from each task that it probes
TASK_QUERIES = 32_768
TILE = 4096  # rows whose products with 1,024 queries are held at a time
ULPS = 16  # rounding of a sum of products, a component and unit of the norms; products this near get a second look


def learn_rotation(sample: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """(centre, projection to BITS numbers) by iterative quantisation."""
    rng = np.random.default_rng(5)
    centre = sample.mean(axis=0)
    x = sample - centre
    if x.shape[1] >= BITS:
        _, basis = np.linalg.eigh(x.T @ x)
        basis = basis[:, ::-1][:, :BITS]
    else:
        basis = rng.normal(size=(x.shape[1], BITS))
    v = x @ basis
    turn, _ = np.linalg.qr(rng.normal(size=(BITS, BITS)))
    for _ in range(rounds):
        u, _, w = np.linalg.svd(np.where(v @ turn >= 0, 1.0, -1.0).T @ v)
        turn = (u @ w).T
    return centre, basis @ turn


def codes(x: np.ndarray, centre: np.ndarray, projection: np.ndarray) -> np.ndarray:
    bits = (x - centre) @ projection >= 0
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


def _encoder(dim: int, scale: float, norm: float, centre: np.ndarray, projection: np.ndarray, query: bool):
    """Codes of vectors divided by ``scale``, the table's largest component: huge and tiny numbers have codes too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), dim) / scale
            more = np.zeros(len(x)) if query else np.sqrt(np.maximum(norm**2 - (x**2).sum(axis=1), 0))
            code = codes(np.column_stack([x, more]), centre, projection)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code.view(np.int64))], names=["vec_id", "vec", "code"])

    return run


def _parts(radius: int) -> int:
    """Indexes that a search needs: at the full radius each holds all rows within reach."""
    return PARTS if radius < BITS else 1


def _reach(radius: int, groups: int) -> np.ndarray:
    """(cell of a query, group): whether the group has a cell within the substrings' radius."""
    near = radius // PARTS
    value = np.arange(CELLS, dtype=np.uint8)
    reach = np.zeros((CELLS, groups), dtype=bool)
    for cell in range(CELLS):
        reach[cell, np.unique(np.flatnonzero(np.bitwise_count(value ^ np.uint8(cell)) <= near) % groups)] = True
    return reach


def _blocks(rows: DataFrame, queries: DataFrame, dim: int, count: int, radius: int) -> tuple[DataFrame, int]:
    """((part, cells, salts, asks): blocks of rows and of queries of each group of cells, number of groups)."""
    most_rows, most_asks = (max(1, n * BITS // max(BITS, dim)) for n in (TASK_ROWS, TASK_QUERIES))
    groups = int(min(CELLS, max(1, count // most_rows)))

    held, asked = _histogram(rows, radius), _histogram(queries, radius) @ _reach(radius, groups)
    sizes = []
    for part in range(_parts(radius)):
        of = np.bincount(np.arange(CELLS) % groups, weights=held[part], minlength=groups).astype(np.int64)
        sizes += [(part, g, int(-(-of[g] // most_rows)), int(-(-asked[part, g] // most_asks))) for g in range(groups) if of[g] and asked[part, g]]
    return rows.sparkSession.createDataFrame(sizes, "part int, cells int, salts int, asks int"), groups


def _cell() -> Column:
    return F.expr(f"CAST(shiftrightunsigned(code, 8 * part) & {CELLS - 1} AS INT)")


def _probes(radius: int, groups: int):
    """(vec_id, vec, code) of queries, once for each group of cells within the substrings' radius."""
    reach = _reach(radius, groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column(2).to_numpy().view(np.uint64)
            for j in range(_parts(radius)):
                row, group = np.nonzero(reach[((code >> np.uint64(8 * j)) & np.uint64(CELLS - 1)).astype(np.int64)])
                table = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*table.columns, pa.array(np.full(len(row), j, np.int32)), pa.array(group.astype(np.int32))],
                    names=["vec_id", "vec", "code", "part", "cells"],
                )

    return run


def _slack(x: np.ndarray, y: np.ndarray) -> float:
    """What two ways of summing a product of these rows can differ by."""
    if not len(x) or not len(y):
        return 0.0
    with np.errstate(over="ignore"):
        norms = np.abs(x).max() * np.abs(y).max() * x.shape[1]
    return float(ULPS * x.shape[1] * np.finfo(float).eps * norms) if np.isfinite(norms) else 0.0


def _products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All inner products; where infinities of both signs meet, the smallest double."""
    with np.errstate(over="ignore", invalid="ignore"):
        out = x @ y.T
    out[np.isnan(out)] = -np.inf
    return out


def _best(query: np.ndarray, score: np.ndarray, k: int, slack: float) -> np.ndarray:
    """Positions whose score is not below their query's k-th best by more than ``slack``."""
    order = np.lexsort((-score, query))
    q = query[order]
    first = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
    size = np.diff(np.append(first, len(q)))
    bound = score[order][first + np.minimum(size, k) - 1]
    return order[score[order] >= np.repeat(bound, size) - slack]


def _search(dim: int, radius: int, k: int):
    near = radius // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["part", "cells", "salt", "ask"]):
            is_query = group["is_query"].to_numpy()
            if is_query.all() or not is_query.any():
                continue
            asks, rows = group.filter(pa.array(is_query)), group.filter(pa.array(~is_query))
            shift = np.uint64(8 * group["part"][0].as_py())
            x, y = matrix(asks["vec"], dim), matrix(rows["vec"], dim)
            close = _slack(x, y)
            ids, own = rows["vec_id"].to_numpy(), asks["vec_id"].to_numpy()
            a, b = asks["code"].to_numpy().view(np.uint64), rows["code"].to_numpy().view(np.uint64)
            cell_a, cell_b = ((c >> shift) & np.uint64(CELLS - 1) for c in (a, b))
            order = np.argsort(cell_b, kind="stable")
            edges = np.flatnonzero(np.append(True, np.diff(cell_b[order]) != 0))
            held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
            bound = np.full(len(x), -np.inf)
            for lo, hi in zip(edges, np.append(edges[1:], len(order))):
                # The rows of one cell, and the queries that probe it.
                q = np.flatnonzero(np.bitwise_count(cell_a ^ cell_b[order[lo]]) <= near)
                for at, to in itertools.product(range(0, len(q), 1024), range(lo, hi, TILE)):
                    p, e = q[at : at + 1024], order[to : min(to + TILE, hi)]
                    product = _products(x[p], y[e])
                    good = (np.bitwise_count(a[p][:, None] ^ b[e][None, :]) <= radius) & (own[p][:, None] != ids[e][None, :])
                    good &= product >= bound[p][:, None] - close
                    i, j = np.nonzero(good)
                    held = tuple(np.concatenate(z) for z in zip(held, (p[i], e[j], product[i, j])))
                    if len(held[0]) > 4 * k * len(x):
                        keep = _best(held[0], held[2], k, close)
                        held = tuple(z[keep] for z in held)
                        n = np.bincount(held[0], minlength=len(x))
                        low = np.full(len(x), np.inf)
                        np.minimum.at(low, held[0], held[2])
                        bound = np.where(n >= k, low, -np.inf)
            if not len(held[0]):
                continue
            q, e, _ = (z[_best(held[0], held[2], k, close)] for z in held)
            score = np.zeros(len(q))
            with np.errstate(over="ignore", invalid="ignore"):
                for d in range(dim):  # one order of summing for every pair: equal vectors score alike
                    score += x[q, d] * y[e, d]
            score[np.isnan(score)] = -np.inf
            order = np.lexsort((ids[e], -score, q))
            q, e, score = q[order], e[order], score[order]
            first = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
            rank = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
            q, e, score = q[rank < k], e[rank < k], score[rank < k]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[q]), pa.array(ids[e]), pa.array(score)], names=["query_id", "vec_id", "score"]
            )

    return run


def _neighbours(rows: DataFrame, queries: DataFrame, dim: int, count: int, radius: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): the k best of each query within the radius, and pairs found twice once."""
    sizes, groups = _blocks(rows, queries, dim, count, radius)
    sizes = F.broadcast(sizes)  # at most PARTS * CELLS rows
    index = rows.select(
        "vec_id", "vec", "code", F.explode(F.array(*[F.lit(j) for j in range(_parts(radius))])).alias("part")
    ).withColumn("cells", _cell() % groups)

    def dealt(frame: DataFrame, own: str, other: str, is_query: bool) -> DataFrame:
        """Each row in its own block, once for each block of the other side."""
        block = {own: F.pmod(F.xxhash64("vec_id"), F.col(f"{own}s")).cast("int"), other: F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))}
        return frame.join(sizes, ["part", "cells"]).select(
            "part", "cells", block["salt"].alias("salt"), block["ask"].alias("ask"), F.lit(is_query).alias("is_query"), "vec_id", "vec", "code"
        )

    asked = queries.mapInArrow(_probes(radius, groups), "vec_id long, vec array<double>, code long, part int, cells int")
    found = (
        dealt(index, "salt", "ask", False).unionByName(dealt(asked, "ask", "salt", True))
        .repartition("part", "cells", "salt", "ask")
        .sortWithinPartitions("part", "cells", "salt", "ask", "is_query", "vec_id")
        .mapInArrow(_search(dim, radius, k), "query_id long, vec_id long, score double")
    )
    return found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))


def _exact(dim: int, ids: np.ndarray, x: np.ndarray, code: np.ndarray, k: int):
    """(vec_id, vec, code) to the k best rows of a task for each sampled query, with the distance of their codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int32))
        low = np.full(len(x), -np.inf)
        for batch in batches:
            own, there = batch.column(0).to_numpy(), batch.column(2).to_numpy().view(np.uint64)
            y = matrix(batch.column(1), dim)
            product = _products(x, y)
            q, e = np.nonzero((ids[:, None] != own[None, :]) & (product >= low[:, None] - _slack(x, y)))
            apart = np.bitwise_count(code[q] ^ there[e]).astype(np.int32)
            held = tuple(np.concatenate(z) for z in zip(held, (q, own[e], product[q, e], apart)))
            order = np.lexsort((held[1], -held[2], held[0]))
            held = tuple(z[order] for z in held)
            new = np.append(True, (held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1]))[: len(order)]
            held = tuple(z[new] for z in held)  # a row that is there twice counts once
            first = np.flatnonzero(np.append(True, held[0][1:] != held[0][:-1])[: len(held[0])])
            rank = np.arange(len(held[0])) - np.repeat(first, np.diff(np.append(first, len(held[0]))))
            held = tuple(z[rank < k] for z in held)
            last = rank[rank < k] == k - 1
            low[held[0][last]] = held[2][last]
        yield pa.RecordBatch.from_arrays([pa.array(z) for z in held], names=["ask", "vec_id", "score", "apart"])

    return run


def _radius(coded: DataFrame, asked: DataFrame, dim: int, count: int, radii: tuple[int, ...], k: int, recall: float) -> int:
    """The smallest radius that holds enough of the true neighbours of a sample of the queries; BITS if none pays."""
    # At most SAMPLE_QUERIES rows, and k neighbours of each.
    sample = asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_QUERIES).toArrow()
    if not sample.num_rows:
        return BITS
    run = _exact(dim, sample["vec_id"].to_numpy(), matrix(sample["vec"], dim), sample["code"].to_numpy().view(np.uint64), k)
    best = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id")
    within = [F.avg((F.col("apart") <= r).cast("double")).alias(f"r{r}") for r in radii]
    shares = (
        coded.mapInArrow(run, "ask long, vec_id long, score double, apart int")
        .groupBy("ask", "vec_id").agg(F.max("score").alias("score"), F.min("apart").alias("apart"))
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .groupBy("ask").agg(*within)
        .agg(*[F.avg(f"r{r}").alias(f"mean{r}") for r in radii], *[F.min(f"r{r}").alias(f"low{r}") for r in radii]).first()
    )
    for r in sorted(radii):
        mean, low = shares[f"mean{r}"], shares[f"low{r}"]
        if mean is not None and mean >= recall and low > 0.5:
            return r if products(coded, asked, r, count) < 1 else BITS
    return BITS


def products(coded: DataFrame, asked: DataFrame, radius: int, count: int) -> float:
    """How many products a radius computes per row and query: 1 is a comparison of all."""
    held, queries = _histogram(coded, radius), _histogram(asked, radius)
    total = float(queries[0].sum()) * count
    return float((held * (queries @ _reach(radius, CELLS))).sum()) / total if total else 0.0


def _histogram(frame: DataFrame, radius: int) -> np.ndarray:
    """How many codes have each value of each substring; PARTS * CELLS rows are collected at most."""
    out = np.zeros((PARTS, CELLS), dtype=np.int64)
    parts = F.explode(F.array(*[F.lit(j) for j in range(_parts(radius))])).alias("part")
    for r in frame.select("code", parts).groupBy("part", _cell().alias("cell")).count().collect():
        out[r["part"], r["cell"]] = r["count"]
    return out


def nearest(
    frame: DataFrame,
    queries: DataFrame,
    k: int = 20,
    radius: int | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    recall: float = RECALL,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``frame`` with the largest inner product for each query.

    Approximate: a neighbour beyond Hamming distance ``radius`` of the query's
    code is missed.  Without one, the radius is the smallest that holds
    ``recall`` of the neighbours of a sample of the queries; where none does
    at less cost than comparing all, and with radius 64, the search is exact.
    Scores are sums of products in double precision on the vectors as they
    are (infinite where they overflow, the least where infinities of both signs meet).  Both frames have the same columns;
    a query never finds a row with its own id.  Vectors that are NULL, zero,
    hold NULL or non-finite components, or have another dimension than most,
    take no part, nor do rows with a NULL id; repeated rows count once.  Ties
    go to the smaller id.  With fewer than k candidates all are returned;
    empty tables give no rows.
    """
    spark = prepare(frame.sparkSession)
    schema = "query_id long, rank int, vec_id long, score double"
    rows, dim = usable(frame, id_col, vector_col)
    if not dim:
        return spark.createDataFrame([], schema)
    as_double = F.col("vec").cast("array<double>").alias("vec")
    rows = rows.select("vec_id", as_double)
    scale = rows.agg(F.max(F.array_max(F.transform("vec", F.abs)))).first()[0]
    norms = rows.select(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, v: s + (v / scale) * (v / scale))).alias("norm"))
    stats = norms.agg(F.max("norm").alias("norm"), F.count("*").alias("n")).first()
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).toArrow()
    x = matrix(sample["vec"], dim) / scale
    more = np.sqrt(np.maximum(stats["norm"] ** 2 - (x**2).sum(axis=1), 0))
    learnt = (scale, stats["norm"], *learn_rotation(np.column_stack([x, more])))
    code_schema = "vec_id long, vec array<double>, code long"
    coded = rows.mapInArrow(_encoder(dim, *learnt, query=False), code_schema)
    asks, _ = usable(queries, id_col, vector_col)
    asks = asks.where(F.size("vec") == dim).select("vec_id", as_double)
    asked = asks.mapInArrow(_encoder(dim, *learnt, query=True), code_schema)
    if radius is None:
        radius = _radius(coded, asked, dim, stats["n"], RADII, k, recall)
    found = staged(_neighbours(coded, asked, dim, stats["n"], radius, k), "ann-found")
    enough = found.groupBy("query_id").count().where(F.col("count") >= k)
    short = staged(asked.join(enough, F.col("vec_id") == F.col("query_id"), "left_anti"), "ann-short")
    if radius < BITS and not short.isEmpty():
        again = _neighbours(coded, short, dim, stats["n"], BITS, k)
        found = found.unionByName(again).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
