"""Per-key sequence operators in batch: EMA anomalies, trailing windows, scoring.

All of them ride on :func:`layercake.operators.windows.rolling`, so a key
that holds a third of the data is still spread over many bounded tasks.

EMA without a per-row loop
--------------------------
``s_n = d * s_(n-1) + a * x_n`` with ``s_0 = 0`` (``d = 1 - a``) unrolls to
``s_n = a * sum_i d^(n-i) x_i``.  Rows are cut into blocks of positions; with
``j`` the row's place in its block, the readings of the block itself give
``d^j * cumsum(a * d^-j * x)``: one running sum, O(1) per row, no arrays.
What came before is ONE number per block: each block is summed up as its own
weighted total, and the block totals follow the same recurrence with the
decay ``d^block_rows``.  That state enters the next block as a reading at
place -1, so no history is cut.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from layercake.functions.numeric import round_half_up
from layercake.operators.windows import BLK, HALO, POS, block_layout, rolling

# Fixed values of the reference's detectors.
EMA_ALPHA = 0.1  # new_avg = 0.9 * prev + 0.1 * x
EMA_THRESHOLD = 5.0  # alert when |x - new_avg| > 5
SEQUENCE_LENGTH = 20  # sliding window of the sequence scorer
SCORE_THRESHOLD = 5.0  # alert when |observed - predicted| > 5.0

# Places of a block whose weights d^-j stay below 1e72.
_EMA_WEIGHT_DIGITS = 72
# A finite double times less than 1e-640 is zero, whatever its value.
_VANISHED_DIGITS = 640


def _rows_of_decay(decay: float, digits: int) -> int:
    """Rows after which a reading weighs ``10^-digits``."""
    return int(math.ceil(digits * math.log(10) / -math.log(decay)))


def ema(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    alpha: float = EMA_ALPHA,
    out: str = "ema",
    block_rows: int | None = None,
    initial: DataFrame | None = None,
    **layout,
) -> DataFrame:
    """Exponential moving average per key, seeded with 0 (see module doc).

    ``initial`` (the keys and a column ``ema``, one row a key at most) seeds
    keys with what they had before: the average enters as a reading of
    ``ema / alpha`` before the first.

    Agrees with a sequential loop within ~1e-15 relative, whatever the
    history (readings of more than about 1e230 would overflow a block's
    sum).  Rows with a NULL reading are left out.  From a NaN or infinite
    reading on, a key's average is NaN or infinite, as in the recurrence.
    The block totals of one key (a row per ``block_rows`` readings) are the
    only rows that meet in one task.
    """
    decay = 1.0 - alpha
    if not 0.0 < decay < 1.0:
        raise ValueError("alpha must be in (0, 1)")
    size = int(block_rows or _rows_of_decay(decay, _EMA_WEIGHT_DIGITS))
    base = df.filter(F.col(value).isNotNull())
    if initial is not None:
        here = base.select(*keys).distinct()
        seeds = initial.join(here, [initial[k].eqNullSafe(here[k]) for k in keys], "left_semi")
        seeds = seeds.select(*keys, (F.col("ema") / F.lit(alpha)).cast(base.schema[value].dataType).alias(value), F.lit(0).alias("_lc_turn"))
        base = base.withColumn("_lc_turn", F.lit(1)).unionByName(seeds, allowMissingColumns=True)
        order = ["_lc_turn", *order]
    laid = block_layout(base, keys, order, 0, size, **layout)
    x = F.col(value).cast("double")
    finite = ~F.isnan(x) & (F.abs(x) < float("inf"))
    place = (F.col(POS) - F.col(BLK) * size).cast("double")
    power = lambda exponent: F.pow(F.lit(decay), exponent)
    totals = laid.groupBy(*keys, BLK).agg(
        F.coalesce(F.sum(F.when(finite, alpha * x * power(size - 1 - place))), F.lit(0.0)).alias("_lc_total"),
        F.sum(F.when(~finite, x)).alias("_lc_odd"),
    )
    # The state at a block's start: the recurrence over the totals before it.
    # The frame ends where nothing that a double can hold is left.
    per_key = Window.partitionBy(*keys).orderBy(BLK)
    reach = _rows_of_decay(decay, _VANISHED_DIGITS) // size + 2
    before = F.collect_list("_lc_total").over(per_key.rowsBetween(-reach, -1))
    state = F.aggregate(before, F.lit(0.0), lambda acc, t: acc * F.lit(decay**size) + t)
    carried = totals.select(
        *keys,
        BLK,
        (F.col(BLK) * size - 1).alias(POS),
        F.lit(True).alias(HALO),
        (state * decay).alias("_lc_part"),
        F.sum("_lc_odd").over(per_key.rowsBetween(Window.unboundedPreceding, -1)).alias("_lc_odd"),
        F.row_number().over(per_key).alias("_lc_nth"),
    ).filter("_lc_nth > 1").drop("_lc_nth")
    own = laid.withColumns(
        {"_lc_part": F.when(finite, alpha * x * power(-place)), "_lc_odd": F.when(~finite, x)}
    )
    running = Window.partitionBy(*keys, BLK).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    smooth = power(place) * F.sum("_lc_part").over(running)
    done = (
        own.unionByName(carried, allowMissingColumns=True)
        .withColumn(out, F.coalesce(F.sum("_lc_odd").over(running), smooth))
        .filter(~F.col(HALO))
        .drop("_lc_part", "_lc_odd", POS, BLK, HALO)
    )
    return done if initial is None else done.filter("_lc_turn = 1").drop("_lc_turn")


def ema_anomalies(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    alpha: float = EMA_ALPHA,
    threshold: float = EMA_THRESHOLD,
    digits: int | None = None,
    **layout,
) -> DataFrame:
    """EMA per key plus ``alert = |x - new_ema| > threshold`` (strict)."""
    out = ema(df, keys, order, value, alpha, **layout)
    out = out.withColumn("alert", F.abs(F.col(value) - F.col("ema")) > F.lit(threshold))
    if digits is not None:
        out = out.withColumn("ema", round_ema("ema", digits))
    return out


def round_ema(col: str | Column, digits: int) -> Column:
    """Round an average, noise first: early ones are often exact decimal ties,
    which the last bits of a double must not decide."""
    return round_half_up(round_half_up(col, digits + 3), digits)


def _frame_values(value: str | Column, w: WindowSpec, length: int) -> Column:
    """The last ``length`` readings, oldest first; a NULL reading keeps its place."""
    x = F.col(value) if isinstance(value, str) else value
    return F.transform(F.collect_list(F.struct(x.alias("x"))).over(w.rowsBetween(-(length - 1), 0)), lambda s: s["x"])


def trailing_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    length: int = SEQUENCE_LENGTH,
    out: str = "window",
    **layout,
) -> DataFrame:
    """Last ``length`` readings per key (oldest first) and ``prediction_ready``.

    ``collect_list`` over a bounded ROWS frame keeps frame order, so the
    array is the truncated sliding window the streaming scorer keeps.  A
    NULL reading is an element of it, as it is a row of a ROWS frame.
    """

    def cols(w: WindowSpec) -> dict[str, Column]:
        return {out: _frame_values(value, w, length)}

    res = rolling(df, keys, order, length - 1, cols, **layout)
    return res.withColumns(
        {"window_len": F.size(out), "prediction_ready": F.size(out) == F.lit(length)}
    )


def linear_weights(length: int = SEQUENCE_LENGTH) -> list[float]:
    """Fixture scorer: linearly increasing weights, oldest first, summing to 1."""
    total = length * (length + 1) / 2
    return [(i + 1) / total for i in range(length)]


def linear_score(value: str, w: WindowSpec, length: int = SEQUENCE_LENGTH) -> Column:
    """``sum_j (j+1) * x_(t-length+1+j) / (length(length+1)/2)`` via lags.

    ``length`` lag expressions over one window spec: O(1) each, evaluated
    in a single Window operator (no arrays).
    """
    terms = [F.lit(float(j + 1)) * F.lag(value, length - 1 - j).over(w) for j in range(length)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total / F.lit(float(length * (length + 1) / 2))


def score_sequences(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    length: int = SEQUENCE_LENGTH,
    threshold: float = SCORE_THRESHOLD,
    scorer: Callable[[str, WindowSpec, int], Column] | None = None,
    digits: int | None = None,
    **layout,
) -> DataFrame:
    """Warm-up, prediction and alert records as one tagged frame.

    Every input row yields ``kind='warmup'`` (fewer than ``length`` values
    seen) or ``kind='prediction'``; a prediction with
    ``|observed - prediction| > threshold`` adds a ``kind='alert'`` row.  A
    NULL reading takes a place in the window, which then has no prediction;
    with a NaN one the prediction is NaN.  Neither alerts.
    ``scorer(value, window, length)`` returns the prediction column; the
    default is the linear fixture scorer.  A model scorer can be plugged in
    with :func:`model_scorer` (Arrow batches, model loaded once per worker).
    """
    scorer = scorer or linear_score

    def cols(w: WindowSpec) -> dict[str, Column]:
        return {
            "window_len": F.count(F.lit(1)).over(w.rowsBetween(-(length - 1), 0)).cast("int"),
            "prediction": scorer(value, w, length),
        }

    scored = rolling(df, keys, order, length - 1, cols, **layout)
    ready = F.col("window_len") == F.lit(length)
    pred = F.when(ready, F.col("prediction"))
    if digits is not None:
        pred = round_half_up(pred, digits)
    gap = F.abs(F.col(value) - F.col("prediction"))
    alert = ready & ~F.isnan(gap) & (gap > F.lit(threshold))  # NaN is the greatest double in SQL
    kinds = F.when(alert, F.array(F.lit("prediction"), F.lit("alert"))).otherwise(
        F.array(F.when(ready, F.lit("prediction")).otherwise(F.lit("warmup")))
    )
    return (
        scored.withColumn("prediction", pred)
        .withColumn("kind", F.explode(kinds))
        .withColumn("observed", F.col(value))
    )


def model_scorer(make_predict_fn: Callable, length: int = SEQUENCE_LENGTH, batch_size: int = 1024):
    """Wrap a batch model as a scorer for :func:`score_sequences`.

    ``make_predict_fn()`` loads the model (once per Python worker) and
    returns ``f(np.ndarray[batch, length]) -> np.ndarray[batch]``.  Built on
    ``predict_batch_udf`` so inputs travel as Arrow batches.
    """
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import DoubleType

    udf = predict_batch_udf(
        make_predict_fn, return_type=DoubleType(), batch_size=batch_size, input_tensor_shapes=[[length]]
    )

    def scorer(value: str, w: WindowSpec, n: int) -> Column:
        window = _frame_values(F.col(value).cast("double"), w, n)
        # Fixed-width tensors: short (warm-up) windows are left-padded with
        # zeros; their predictions are masked by score_sequences.  So are
        # those of windows with gaps, which the model never sees.
        known = F.transform(window, lambda x: F.when(x.isNull() | F.isnan(x), 0.0).otherwise(x))
        pad = F.array_repeat(F.lit(0.0), F.lit(n) - F.size(window))
        made = F.when(F.exists(window, lambda x: F.isnan(x)), float("nan")).otherwise(udf(F.concat(pad, known)))
        return F.when(~F.exists(window, lambda x: x.isNull()), made)

    return scorer


def lag_features(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    roll: int = 5,
    **layout,
) -> DataFrame:
    """``<value>_lag_1`` and ``<value>_roll_mean_<roll>`` per key.

    ``lag`` takes no frame (Spark rejects one); the rolling mean is a
    ``roll``-row frame ending at the current row.
    """

    def cols(w: WindowSpec) -> dict[str, Column]:
        return {
            "temp_lag_1": F.lag(value, 1).over(w),
            f"temp_roll_mean_{roll}": F.avg(value).over(w.rowsBetween(-(roll - 1), 0)),
        }

    return rolling(df, keys, order, roll - 1, cols, **layout)
