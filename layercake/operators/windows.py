"""Exact bounded row-frame windows that scale past one partition per key.

A ROWS frame of ``h`` preceding rows (moving averages, rolling stddev,
lag, trailing sequences) is normally written as
``Window.partitionBy(key).orderBy(t)``.  That plan puts every row of one
key into one task: a key holding a third of 100 TB sinks the job, and the
keyless form (``Window.orderBy(t)``) is a single-partition sort of
everything.

:func:`rolling` cuts the rows into ranges of (keys, order) whose bounds are
literals (:func:`range_layout`) and sends the last ``h`` rows before a bound
on to the next range, all in one exchange.

:func:`block_layout` cuts rows at exact positions instead, for recurrences
that need a row's place (the EMA of :mod:`layercake.operators.sequences`):

1. range-partition on ``(keys, order)`` (sampled bounds, so equal-sized
   ranges even when one key dominates) and sort within each range;
2. give each row a global position = rows in earlier ranges + its index in
   its own range.  The earlier-ranges offsets form a table of exactly one
   row per range, so broadcasting it is size-proven;
3. cut positions into blocks of ``block_rows``; the last ``halo`` rows of
   each block are also emitted, flagged as halo, into the next block.

The tagged ranges are pinned with a reliable ``checkpoint()`` into the
session's shared checkpoint folder, so the counts and the rows agree even
if executors are lost and partitions are recomputed.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import reduce
from itertools import chain
from operator import add

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType

from layercake.functions.numeric import MOST_PARTS, exact_mean, exact_parts, finite, round_half_up
from layercake.sinks.tables import JSON_OPTIONS

POS = "_lc_pos"
BLK = "_lc_blk"
HALO = "_lc_halo"
_PID = "_lc_pid"
_LOCAL = "_lc_local"
_OFF = "_lc_off"
_INTERNAL = (POS, BLK, HALO)

DEFAULT_BLOCK_ROWS = 65536


def block_layout(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    halo: int,
    block_rows: int | None = None,
    ranges: int | None = None,
    pin: str = "checkpoint",
) -> DataFrame:
    """Add ``_lc_pos``, ``_lc_blk``, ``_lc_halo`` (see module docstring).

    ``order`` must make rows unique within a key (add an id tie-break),
    otherwise a ROWS frame is not deterministic in any engine.
    ``pin`` is ``"checkpoint"`` (reliable, lineage cut in the shared
    checkpoint folder) or ``"persist"`` (one range exchange, cached; a lost
    block is recomputed through the same shuffle dependency, whose range
    bounds are fixed).  There is deliberately no unpinned mode: the range
    sampler is seeded per RDD, so two recomputations of the exchange can
    choose different bounds and the counts would not match the rows.
    """
    keys, order = list(keys), list(order)
    block_rows = int(block_rows or max(DEFAULT_BLOCK_ROWS, 8 * halo))
    if halo < 0 or block_rows <= halo:
        raise ValueError("block_rows must exceed halo")
    # NULL order values sort last, as SQL's ascending ORDER BY does.
    sort_cols = [F.col(k) for k in keys] + [F.col(o).asc_nulls_last() for o in order]
    # Without an explicit count the range exchange starts from the session's
    # shuffle partitions and AQE merges adjacent small ranges (order is kept);
    # positions are taken after that, inside the pinned stage.
    ranged = df.repartitionByRange(int(ranges), *sort_cols) if ranges else df.repartitionByRange(*sort_cols)
    tagged = (
        ranged.sortWithinPartitions(*sort_cols)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(
            _LOCAL,
            F.monotonically_increasing_id() - F.shiftleft(F.col(_PID).cast("long"), 33),
        )
    )
    if pin == "checkpoint":
        tagged = tagged.checkpoint(eager=True)
    elif pin == "persist":
        tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK)
    else:
        raise ValueError(f"unknown pin {pin!r}")
    # One row per range: proven bound, safe to broadcast.
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy(_PID)
        .agg(F.count(F.lit(1)).alias("_lc_n"))
        .select(_PID, F.coalesce(F.sum("_lc_n").over(before), F.lit(0)).alias(_OFF))
    )
    pos = F.col(_OFF) + F.col(_LOCAL)
    placed = tagged.join(F.broadcast(offsets), _PID).withColumn(POS, pos)
    blk = F.expr(f"{POS} div {block_rows}")  # exact integer division
    own = F.struct(blk.alias("b"), F.lit(False).alias("h"))
    nxt = F.struct((blk + 1).alias("b"), F.lit(True).alias("h"))
    in_tail = (F.col(POS) % F.lit(block_rows)) >= F.lit(block_rows - halo)
    copies = F.when(in_tail & F.lit(halo > 0), F.array(own, nxt)).otherwise(F.array(own))
    return (
        placed.withColumn("_lc_copy", F.explode(copies))
        .withColumn(BLK, F.col("_lc_copy.b"))
        .withColumn(HALO, F.col("_lc_copy.h"))
        .drop("_lc_copy", _PID, _LOCAL, _OFF)
    )


# ------------------------------------------------------------- one exchange
#: Rows that one range of :func:`range_layout` aims at, and the fewest worth a task of their own.
RANGE_ROWS, SMALL_RANGE = 1 << 20, 1 << 13
#: Ranges at most: their bounds are literals of the plan.  Beyond, ranges grow.
MAX_RANGES = 8192
#: Sampled rows a range, and in all at least; the driver sorts out the bounds from them.
SAMPLES_PER_RANGE, LEAST_SAMPLES = 32, 2048
#: Places up to which comparing with each is cheaper than a search.
FEW_PLACES = 32
_ROW = "_lc_row"


def _place(keys: Sequence[str], order: Sequence[str]) -> Column:
    """What rows are ordered by, as one struct: keys (NULL first), then each order value (NULL last)."""
    parts = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    for i, o in enumerate(order):
        parts += [F.col(o).isNull().alias(f"n{i}"), F.col(o).alias(f"o{i}")]
    return F.struct(*parts)


def _upto(row: Column, places: list[str], kind: DataType) -> Column:
    """How many of the sorted places (JSON texts) lie at or before a row; a binary search in a literal array if many."""
    if len(places) <= FEW_PLACES:
        return reduce(add, [(F.from_json(F.lit(p), kind, JSON_OPTIONS) <= row).cast("int") for p in places])
    array = F.from_json(F.lit("[" + ",".join(places) + "]"), ArrayType(kind), JSON_OPTIONS)
    steps = [1 << b for b in range(len(places).bit_length() - 1, -1, -1)]

    def step(low: Column, width: Column) -> Column:
        at = low + width
        inside = F.element_at(array, F.least(at, F.lit(len(places)))) <= row
        return F.when((at <= len(places)) & inside, at).otherwise(low)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def range_layout(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    halo: int,
    block_rows: int | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``_lc_blk`` and ``_lc_halo``: ranges of rows in (keys, order), each with the rows before it, one a partition.

    Rows are cut into ranges by *places* (values of keys and order) that
    stand in the plan as literals, so a row's range is a deterministic
    expression: nothing is written, a window over ``(keys, _lc_blk)`` needs
    one exchange, and a repeated task deals its rows out as before.

    The places come from a hash sample of the rows (mergeable, the same
    whatever the partitioning) of bounded size.  A range's *margin* is an
    earlier sampled place with at least ``halo`` rows of the bound's key in
    between; rows from there to the bound are also sent to the range,
    flagged as halo.  Rows between are counted, and a margin with too few is
    moved back, so frames are whole for certain.

    ``order`` must make rows unique within a key, otherwise a ROWS frame is
    not deterministic in any engine.  ``df`` is read up to three times for
    its key and order columns alone, so it should be a table rather than a
    long computation.
    """
    keys, order = list(keys), list(order)
    spark = df.sparkSession
    rows = df.select(_place(keys, order).alias(_ROW))
    kind = rows.schema[_ROW].dataType
    total = rows.count()
    if ranges is None:
        few = min(spark.sparkContext.defaultParallelism, total // SMALL_RANGE)
        ranges = min(max(-(-total // (block_rows or RANGE_ROWS)), few), MAX_RANGES)
    whole = df.withColumns({BLK: F.lit(0), HALO: F.lit(False)})
    if ranges <= 1 or not total:
        return whole
    one_in = max(1, total // max(LEAST_SAMPLES, SAMPLES_PER_RANGE * ranges))
    chosen = F.pmod(F.xxhash64(_ROW), F.lit(one_in)) == 0
    picked = rows.where(chosen).agg(F.array_sort(F.collect_set(_ROW)).alias("s"))
    sample = picked.select(F.transform("s", lambda r: F.to_json(r, JSON_OPTIONS)).alias("t")).first()["t"]
    at = sorted({i * len(sample) // ranges for i in range(1, ranges)} - {0})
    if not at:
        return whole
    bounds = [sample[i] for i in at]
    own = _upto(F.col(_ROW), bounds, kind)
    back = [max(0, i - (halo if one_in == 1 else 4 * halo // one_in + 2)) if halo else i for i in at]

    def key_of(place: str) -> list:
        fields = json.loads(place)
        return [fields.get(f"k{i}") for i in range(len(keys))]

    while True:
        # The empty object is the place of all NULLs, before every row.
        margins = [sample[i] if i else "{}" for i in back]
        last = _upto(F.col(_ROW), margins, kind)
        if one_in == 1 or not halo:
            break
        # Only where a margin lies within the bound's own key can it have too few of that key's rows.
        doubtful = [i for i, m in enumerate(back) if m and key_of(sample[m]) == key_of(bounds[i])]
        if not doubtful:
            break
        place = rows.select(own.alias("own"), last.alias("last")).where("last > own")
        between = place.select(F.explode(F.sequence(F.col("own") + 1, "last")).alias("b"))
        found = {r["b"]: r["count"] for r in between.groupBy("b").count().collect()}
        short = [i for i in doubtful if found.get(i + 1, 0) < halo]
        if not short:
            break
        for i in short:
            back[i] = max(0, at[i] - 4 * (at[i] - back[i]))
        back = [min(back[i:]) for i in range(len(back))]
    blocks = F.transform(F.sequence("_lc_own", "_lc_last"), lambda b: F.struct(b.alias(BLK), (b > F.col("_lc_own")).alias(HALO)))
    return (
        df.withColumn(_ROW, _place(keys, order))
        .withColumns({"_lc_own": own, "_lc_last": last})
        .select(*df.columns, F.inline(blocks))
        .repartitionById(len(bounds) + 1, BLK)
    )


def rolling(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    halo: int,
    make_columns: Callable[[WindowSpec], dict[str, Column] | list[dict[str, Column]]],
    block_rows: int | None = None,
    ranges: int | None = None,
    method: str = "ranges",
) -> DataFrame:
    """Add window columns whose frames reach at most ``halo`` rows back.

    ``make_columns(w)`` receives the ordered window spec (partitioned by the
    keys) and returns ``{name: column}``, or a list of such dicts applied in
    turn (a later stage may window over an earlier one; all stages share one
    exchange and sort); frames are set by the caller with
    ``w.rowsBetween(-n, 0)`` (``n <= halo``).  Running aggregates
    (``unboundedPreceding``) start at the range's halo, which is exact for
    anything that forgets history older than ``halo`` rows.

    Rows are dealt out by :func:`range_layout`: one exchange, and a key of
    any size meets many tasks.  ``method="partition"`` is the plain
    ``partitionBy(keys)`` plan (one task per key, one task overall without
    keys), kept as a yardstick.
    """
    keys, order = list(keys), list(order)
    ordered = [F.col(o).asc_nulls_last() for o in order]
    if method == "partition":
        w = Window.partitionBy(*keys).orderBy(*ordered) if keys else Window.orderBy(*ordered)
        return _apply(df, make_columns(w))
    laid = range_layout(df, keys, order, halo, block_rows, ranges)
    w = Window.partitionBy(*keys, BLK).orderBy(*ordered)
    return _apply(laid, make_columns(w)).filter(~F.col(HALO)).drop(BLK, HALO)


def _apply(df: DataFrame, stages) -> DataFrame:
    for stage in stages if isinstance(stages, list) else [stages]:
        df = df.withColumns(stage)
    return df


# --------------------------------------------------------------- indicators
# Moving-average lengths and Bollinger width of the silver job.
MA_LENGTHS = (20, 50, 200)
BB_LENGTH = 20
BB_WIDTH = 2


def indicators(
    df: DataFrame,
    date_col: str = "Date",
    close_col: str = "Close",
    keys: Sequence[str] = (),
    tie_break: Sequence[str] = (),
    digits: int | None = None,
    **layout,
) -> DataFrame:
    """MA20/MA50/MA200, Bollinger mid/std/upper/lower over ROWS frames.

    Short head windows average what exists; BB_Std is the sample stddev
    (NULL for a one-row frame).  ``keys`` makes one series per key; with no
    keys the whole table is one series (exact, without a one-task sort).

    The averages are exact sums of any doubles, divided by their count: a
    price is split into whole parts of 31 bits (as many as the table's
    largest and smallest prices need, see ``numeric.exact_parts``), whose
    running sums are integers, so ``sum(last n) = C_t - C_(t-n)`` costs O(1)
    per row for any n, cancels without loss and does not depend on the order
    of summation.  Where prices differ by more than about ``2**70``, frames
    are summed one by one by ``math.fsum`` in Arrow batches: the same values
    at O(n) per row.  NULL prices do not count; NaN and infinite ones act as in
    ``avg``.  ``digits`` rounds the results half up, after the noise of the
    last bits.
    """
    close = F.col(close_col).cast("double")
    parts, odd = exact_parts(df, close)

    def cols(w: WindowSpec) -> list[dict[str, Column]]:
        upto = w.rowsBetween(Window.unboundedPreceding, 0)
        split = {f"_lc_p{i}": part for i, part in enumerate(parts.split(close))}
        pieces = list(split)
        counted = F.when(finite(close), 1) if odd else close
        first = {p: F.coalesce(F.sum(p).over(upto), F.lit(0)) for p in pieces} | {"_lc_n": F.count(counted).over(upto)}
        if odd:  # a row's number, and where a NaN or an infinite price stood last
            split["_lc_i"] = F.row_number().over(w)
            first |= {f"_lc_odd{i}": F.max(F.when(test, F.col("_lc_i"))).over(upto) for i, test in enumerate(_odd_tests(close))}
        second = {f"_lc_b{n}": F.lag(F.struct(*pieces, "_lc_n"), n).over(w) for n in MA_LENGTHS}
        second["BB_Std"] = F.stddev_samp(close).over(w.rowsBetween(-(BB_LENGTH - 1), 0))
        sums = {n: [F.col(c) - F.coalesce(F.col(f"_lc_b{n}.{c}"), F.lit(0)) for c in [*pieces, "_lc_n"]] for n in MA_LENGTHS}
        # The steps of all lengths run together.
        steps = [dict(chain(*(s.items() for s in each))) for each in zip(*(parts.total(sums[n][:-1], f"MA{n}") for n in MA_LENGTHS))]
        means = {}
        for n in MA_LENGTHS:
            mean = F.when(sums[n][-1] > 0, F.col(f"MA{n}") / sums[n][-1])
            if odd:
                nan, up, down = [F.coalesce(F.col(f"_lc_odd{i}") > F.col("_lc_i") - n, F.lit(False)) for i in range(3)]
                mean = F.when(nan | (up & down), float("nan")).when(up, float("inf")).when(down, float("-inf")).otherwise(mean)
            means[f"MA{n}"] = mean
        return [split, first, second, *steps, means]

    def listed(w: WindowSpec) -> list[dict[str, Column]]:
        frames = {f"MA{n}": F.collect_list(close).over(w.rowsBetween(-(n - 1), 0)) for n in MA_LENGTHS}
        frames["BB_Std"] = F.stddev_samp(close).over(w.rowsBetween(-(BB_LENGTH - 1), 0))
        mean = exact_mean()
        return [frames, {f"MA{n}": mean(f"MA{n}") for n in MA_LENGTHS}]

    halo = max(MA_LENGTHS + (BB_LENGTH,)) - 1
    made = cols if parts.count <= MOST_PARTS else listed
    out = rolling(df, keys, [date_col, *tie_break], halo, made, **layout)
    mid = F.col(f"MA{BB_LENGTH}")
    out = out.withColumns(
        {
            "BB_Mid": mid,
            "BB_Upper": mid + BB_WIDTH * F.col("BB_Std"),
            "BB_Lower": mid - BB_WIDTH * F.col("BB_Std"),
        }
    )
    names = ["MA20", "MA50", "MA200", "BB_Mid", "BB_Std", "BB_Upper", "BB_Lower"]
    if digits is not None:
        out = out.withColumns({n: round_half_up(round_half_up(n, digits + 3), digits) for n in names})
    return out.select(*[c for c in df.columns if c not in names], *names)


def _odd_tests(x: Column) -> list[Column]:
    return [F.isnan(x), x == float("inf"), x == float("-inf")]
