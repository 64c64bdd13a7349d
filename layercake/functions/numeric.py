"""Numeric helpers."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import add

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def round_half_up(col: str | Column, digits: int) -> Column:
    """Round a double to ``digits`` decimals, half away from zero, by scaling.

    ``round(x, d)`` on a double rounds the shortest decimal text of ``x``;
    for values of decimal origin that sit one ulp below a tie (e.g.
    ``10.087538499999999`` for the exact ``10.0875385``) it goes down.
    Scaling first lets the IEEE product land on the tie, so decimal-origin
    ties round up as they would in exact arithmetic, the same convention as
    SQL engines that round by scaling.
    """
    c = F.col(col) if isinstance(col, str) else col
    scale = float(10**digits)
    return F.round(c * F.lit(scale), 0) / F.lit(scale)


def finite(x: Column) -> Column:
    """Whether a double is a number (NULL for NULL)."""
    return ~F.isnan(x) & (F.abs(x) < float("inf"))


PART_BITS = 31  # sums of 2**32 parts fit a long
MOST_PARTS = 4  # parts up to which running sums are worth their columns


def exact_mean():
    """An Arrow UDF: the mean of an array of doubles by ``math.fsum``; NULL of none, NaN and infinity as in ``avg``."""

    def mean(values: list[float]) -> float | None:
        odd = [v for v in values if not math.isfinite(v)]
        return None if not values else sum(odd) if odd else math.fsum(values) / len(values)

    @F.arrow_udf("double")
    def means(frames: pa.Array) -> pa.Array:
        return pa.array([mean(f.as_py()) for f in frames], pa.float64())

    return means


@dataclass(frozen=True)
class ExactParts:
    """How doubles below ``2**top`` are split into ``count`` whole parts, each PART_BITS lower than the one before.

    ``x = sum_i part_i * 2**(top - PART_BITS * (i + 1))`` holds exactly, and
    parts are at most ``2**PART_BITS``, so their sums are exact integers in any order.
    """

    top: int
    count: int

    def unit(self, i: int) -> int:
        return self.top - PART_BITS * (i + 1)

    def split(self, x: Column) -> list[Column]:
        """The parts of a double as longs; NULL if it is not finite."""
        out, rest = [], F.when(finite(x), x)
        for i in range(self.count):
            part = F.rint(scaled(rest, -self.unit(i)))
            out.append(part.cast("long"))
            rest = rest - scaled(part, self.unit(i))
        return out

    def total(self, sums: list[Column], name: str) -> list[dict[str, Column]]:
        """Steps that add column ``name``: the double nearest to the value of summed parts.

        Carries are passed up, so that each term but the first is below the
        unit of the one before; then the terms are added from the top, their
        errors after them.  Up to three parts the errors' sum is exact; the
        fourth may lose bits of it, which then decide a tie.
        """
        unit, whole, terms = 1 << PART_BITS, list(sums), [f"{name}_t{i}" for i in range(self.count)]
        for i in range(self.count - 1, 0, -1):
            carry = F.shiftright(whole[i] + F.lit(unit >> 1), PART_BITS)
            whole[i - 1], whole[i] = whole[i - 1] + carry, whole[i] - carry * F.lit(unit)
        steps = [{t: scaled(v.cast("double"), self.unit(i)) for i, (t, v) in enumerate(zip(terms, whole))}]

        def rounding(a: Column, b: Column, c: Column) -> Column:
            """What the double c = a + b lost."""
            return (a - (c - (c - a))) + (b - (c - a))

        upto = [F.col(terms[0])] + [F.col(f"{name}_u{i}") for i in range(1, self.count)]
        errors = []
        for i in range(1, self.count):
            steps.append({f"{name}_u{i}": upto[i - 1] + F.col(terms[i])})
            if errors:
                steps[-1] |= {f"{name}_e{i - 1}": errors[-1]}
            errors.append(rounding(upto[i - 1], F.col(terms[i]), upto[i]))
        if not errors:
            return [*steps, {name: upto[-1]}]
        known = [F.col(f"{name}_e{i}") for i in range(1, len(errors))] + [errors[-1]]
        if len(known) < 3:
            return [*steps, {name: upto[-1] + reduce(add, known)}]
        error, total = F.col(f"{name}_e"), F.col(f"{name}_u")
        steps.append({f"{name}_f": known[0] + known[1], f"{name}_e{len(known)}": known[2]})
        most, least = F.col(f"{name}_f"), F.col(f"{name}_e{len(known)}")
        steps.append({f"{name}_e": most + least, f"{name}_u": upto[-1] + (most + least)})
        left = error - (total - upto[-1])
        beyond = F.signum(left) * F.signum(rounding(most, least, error)) > 0  # left alone was half a unit, the rest lies beyond
        return [*steps, {name: F.when(beyond & ((total + 2 * left) - total == 2 * left), total + 2 * left).otherwise(total)}]


def scaled(x: Column, power: int) -> Column:
    """``x * 2**power``, in steps that a double can hold."""
    while abs(power) > 1000:
        step = 1000 if power > 0 else -1000
        x, power = x * F.lit(2.0**step), power - step
    return x * F.lit(2.0**power)


def exact_parts(df: DataFrame, x: Column) -> tuple[ExactParts, bool]:
    """(parts that every finite value of a column fits, whether there are others): one row to the driver."""
    size = F.when(finite(x) & (x != 0), F.abs(x))
    row = df.agg(F.max(size).alias("hi"), F.min(size).alias("lo"), F.max((~finite(x)).cast("int")).alias("odd")).first()
    if row["hi"] is None:
        return ExactParts(0, 1), bool(row["odd"])
    top = math.frexp(row["hi"])[1]
    lowest = max(math.frexp(row["lo"])[1] - 53, -1074)
    return ExactParts(top, max(1, -(-(top - lowest) // PART_BITS))), bool(row["odd"])


def fixed_point_avg(total: Column, count: Column, unit: int, digits: int) -> Column:
    """``total / (count * unit)`` rounded HALF_UP to ``digits``, exactly.

    ``total`` is an integer sum of values scaled by ``unit``.  The rounding
    is integer arithmetic on decimal(38,0), so no summation order or float
    error can move a value across a rounding boundary.
    """
    num = F.abs(total).cast("decimal(38,0)") * F.lit(2 * 10**digits) + count * F.lit(unit)
    den = (count * F.lit(2 * unit)).cast("decimal(38,0)")
    mag = (num - num % den) / den  # whole by construction
    signed = F.when(total < 0, -mag).otherwise(mag)
    return F.when(count > 0, signed.cast("double") / F.lit(float(10**digits)))


#: Decimals that :func:`exact_avg` keeps of a double (more than a double of ordinary size has).
EXACT_DECIMALS = 9


def exact_avg(col: str | Column, digits: int = 6) -> Column:
    """Aggregate: the mean of a double column, rounded HALF_UP to ``digits``.

    Values are summed as whole billionths, so the result does not depend on
    the order of rows.  NULLs do not count; a NaN or infinite value makes
    the mean NaN; no value makes it NULL.
    """
    c = F.col(col) if isinstance(col, str) else col
    unit = 10**EXACT_DECIMALS
    odd = F.isnan(c) | (F.abs(c) == float("inf"))
    total = F.sum(F.when(~odd, F.round(c * F.lit(float(unit))).cast("decimal(28,0)")))
    mean = fixed_point_avg(total, F.count(c).cast("decimal(20,0)"), unit, digits)
    return F.when(F.coalesce(F.bool_or(odd), F.lit(False)), float("nan")).otherwise(mean)


def fixed_text(col: str | Column, digits: int = 6) -> Column:
    """A double as text with ``digits`` decimals (``NaN`` as it is)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.isnan(c), "NaN").otherwise(c.cast(f"decimal(38,{digits})").cast("string"))
