"""Row-window indicators kept up to date by the day: a run costs the days that it changes.

A store is a folder of day partitions with an appended manifest
(:func:`layercake.sinks.tables.commit_parts`):

* ``raw``: the rows of a day, one per id; the newest run's row wins;
* ``indicators``: the same rows with their window columns, in date order:
  a day's files hold neighbouring ranges of time and are sorted inside;
* ``files``: of each of those files the first and last date and the rows;
* ``counts``: rows per series of a day;
* ``tails``: of the last two days, the rows of each series up to the day's
  end that a window can still reach (199 for MA200).

A run lands its rows by day, finds those that are new or differ from the
stored ones, and rewrites only the days with such rows.  A ROWS frame of 200
lets a change reach 199 rows forward, and a window needs 199 rows before it,
so indicators are computed again from the first changed day to the day that
holds the 199th row after the last change.  For an appended day the rows
before it are the tails; for a correction far back the counts tell which days to read.
Everything counts at once when the run's manifest rows are written; a run
that fails before leaves the former state.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from layercake.operators import windows
from layercake.sinks import tables

DAY = "_day"
REACH = max(windows.MA_LENGTHS) - 1
RAW, INDICATORS, COUNTS, TAILS, FILES = "raw", "indicators", "counts", "tails", "files"


@dataclass
class Run:
    """What a run did: the days it changed, those it computed again, and the files it read for that."""

    changed: list[str] = field(default_factory=list)
    computed: list[str] = field(default_factory=list)
    files: list[str] = field(default_factory=list)


def day_of(date: str) -> Column:
    """A row's partition: its date as text; rows without one come last, as in their series."""
    return F.coalesce(F.date_format(date, "yyyy-MM-dd"), F.lit("null"))


def _same(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> list[Column]:
    return [a[f"`{c}`"].eqNullSafe(b[f"`{c}`"]) for c in columns]


def _join(rows: DataFrame, other: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    """A semi or anti join that takes NULLs as equal; without columns every row has a partner."""
    if not columns:
        return rows if how == "left_semi" else rows.limit(0)
    other = other.select(*[F.col(f"`{c}`").alias(f"_other_{c}") for c in columns])
    return rows.join(other, [rows[f"`{c}`"].eqNullSafe(other[f"`_other_{c}`"]) for c in columns], how)


class Store:
    """A day-partitioned store of series at ``base``; one writer at a time."""

    def __init__(self, spark: SparkSession, base: str, keys: Sequence[str], date: str, close: str,
                 tie_break: Sequence[str], digits: int | None = 6):
        self.spark, self.base = spark, base
        self.keys, self.date, self.close, self.tie_break, self.digits = list(keys), date, close, list(tie_break), digits
        self.ids = [*keys, *tie_break, date]

    def _read(self, paths: Sequence[str]) -> DataFrame:
        return self.spark.read.option("mergeSchema", True).parquet(*paths)

    def _write(self, rows: DataFrame, kind: str, run: str) -> str:
        """Write rows by day; a hot day is split over tasks, and files are sorted as their series are."""
        path = f"{self.base}/{kind}/run={run}"
        place = [c for c in [*self.keys, self.date, *self.tie_break] if c in rows.columns]
        ordered = [F.col(f"`{c}`").asc_nulls_last() if c == self.date else F.col(f"`{c}`") for c in place]
        rows.hint("rebalance", DAY).sortWithinPartitions(DAY, *ordered).write.partitionBy(DAY).parquet(path)
        return path

    def _write_in_order(self, rows: DataFrame, run: str) -> str:
        """Write indicators by day and time, ranges of rows to a file, and record what each file holds."""
        path = f"{self.base}/{INDICATORS}/run={run}"
        place = [F.col(DAY), F.col("Date").asc_nulls_last(), *self.tie_break, *self.keys]
        rows.repartitionByRange(*place).sortWithinPartitions(*place).write.partitionBy(DAY).parquet(path)
        written = self.spark.read.schema(rows.schema).parquet(path)
        held = written.groupBy(F.col("_metadata.file_path").alias("file"), DAY).agg(
            F.min("Date").alias("first"), F.max("Date").alias("last"), F.count(F.lit(1)).alias("n"),
            F.min(F.struct("Date", *self.tie_break, *self.keys)).alias("least"),
        )
        held.withColumn("day", F.col(DAY)).write.partitionBy(DAY).parquet(f"{self.base}/{FILES}/run={run}")
        return path

    def files(self) -> DataFrame | None:
        """The current indicator files in date order: file, day, first, last, n, and ``before``, the rows of all files before."""
        days = tables.current_parts(self.spark, self.base).get(FILES)
        if not days:
            return None
        # One row a file: that many the driver lists for every scan.
        order = Window.orderBy("day", "least").rowsBetween(Window.unboundedPreceding, -1)
        held = self._read([days[d] for d in sorted(days)])
        return held.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0))).drop("least")

    def positions(self) -> DataFrame | None:
        """The indicators with ``position``: a row's place in date order, read off its file and its place there."""
        days = tables.current_parts(self.spark, self.base).get(INDICATORS)
        if not days:
            return None
        rows = self._read([days[d] for d in sorted(days)])
        placed = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))
        at = self.files().select(F.col("file").alias("_file"), "before")
        return placed.join(at, "_file").withColumn("position", F.col("before") + F.col("_index")).drop("_file", "_index", "before")

    def indicators(self) -> DataFrame | None:
        """The current indicators; None if nothing was ever committed."""
        days = tables.current_parts(self.spark, self.base).get(INDICATORS)
        return self._read([days[d] for d in sorted(days)]) if days else None

    def raw(self) -> DataFrame | None:
        days = tables.current_parts(self.spark, self.base).get(RAW)
        return self._read([days[d] for d in sorted(days)]) if days else None

    def _series(self, rows: DataFrame) -> DataFrame:
        """The columns that indicators need, under fixed names."""
        return rows.select(*self.keys, *self.tie_break, F.col(self.date).alias("Date"), F.col(self.close).alias("Close"))

    def _days_around(self, counts: dict[str, str], days: list[str], changed: DataFrame, backwards: bool) -> str | None:
        """The farthest of some days that a changed series needs for REACH rows on one side."""
        if not days:
            return None
        table = _join(self._read([counts[d] for d in days]), changed, self.keys, "left_semi")
        order = F.col("day").desc() if backwards else F.col("day").asc()
        nearer = Window.partitionBy(*self.keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        needed = table.withColumn("nearer", F.coalesce(F.sum("n").over(nearer), F.lit(0))).where(F.col("nearer") < REACH)
        return needed.agg(F.min("day") if backwards else F.max("day")).first()[0]

    def _tail(self, rows: DataFrame, last: str) -> DataFrame:
        """The last REACH rows of each series up to a day's end."""
        order = [F.col("Date").desc_nulls_first(), *[F.col(t).desc() for t in self.tie_break]]
        newest = Window.partitionBy(*self.keys).orderBy(*order)
        upto = rows.where(day_of("Date") <= last)
        return upto.withColumn("_nth", F.row_number().over(newest)).where(F.col("_nth") <= REACH).drop("_nth").withColumn(DAY, F.lit(last))

    def update(self, new: DataFrame) -> Run:
        """Add rows, or replace those with the same ids.

        Of several rows of a batch with one id the greatest (by its other
        columns) counts.  A batch that changes nothing commits nothing.
        """
        run, parts = uuid.uuid4().hex, tables.current_parts(self.spark, self.base)
        raw, computed, counts, tails = (dict(parts.get(k, {})) for k in (RAW, INDICATORS, COUNTS, TAILS))
        rest = [c for c in new.columns if c not in self.ids]
        once = new.distinct() if not rest else new
        if rest:
            greatest = once.groupBy(*self.ids).agg(F.max(F.struct(*rest)).alias("_rest"))
            once = greatest.select(*[F.col(c) if c in self.ids else F.col("_rest")[c].alias(c) for c in new.columns])
        landed = self._write(once.withColumn(DAY, day_of(self.date)), "landed", run)
        arrived = []  # an empty batch leaves no day
        if tables.exists(self.spark, f"{landed}/{DAY}=*"):
            arrived = [r[0] for r in self.spark.read.schema(f"{DAY} string").parquet(landed).distinct().collect()]
        fresh = self.spark.read.schema(StructType([*new.schema.fields, StructField(DAY, StringType())])).parquet(landed) if arrived else None
        stored = [d for d in arrived if d in raw]
        old = self._read([raw[d] for d in stored]) if stored else None
        changes = fresh
        if old is not None and fresh is not None:
            both = [c for c in new.columns if c in old.columns]
            added = [c for c in new.columns if c not in both]  # a new column counts as a change where it holds something
            same = _join(fresh, old, both, "left_anti")
            changes = same.unionByName(_join(fresh, old, both, "left_semi").where(F.coalesce(*added).isNotNull())) if added else same
        changed = sorted(r[0] for r in changes.select(DAY).distinct().collect()) if changes is not None else []
        if not changed:
            return Run()

        # Raw days: the stored rows that no row of the batch replaces, and the batch.
        merged = fresh.where(F.col(DAY).isin(changed))
        if old is not None:
            kept = _join(old.withColumn(DAY, day_of(self.date)).where(F.col(DAY).isin(changed)), fresh, self.ids, "left_anti")
            merged = kept.unionByName(merged, allowMissingColumns=True)
        path = self._write(merged, RAW, run)
        raw |= {d: f"{path}/{DAY}={d}" for d in changed}
        per_day = self._read([raw[d] for d in changed]).withColumn("day", day_of(self.date))
        path = self._write(per_day.groupBy(*self.keys, "day").agg(F.count(F.lit(1)).alias("n")).withColumn(DAY, F.col("day")), COUNTS, run)
        counts |= {d: f"{path}/{DAY}={d}" for d in changed}

        # Which series changed, and which days their windows reach.
        path = f"{self.base}/series/run={run}"
        changes.select(*(self.keys or [F.lit(0).alias("_all")])).distinct().write.parquet(path)
        series = self.spark.read.parquet(path)
        days = sorted(raw)
        before = [d for d in days if d < changed[0]]
        end = self._days_around(counts, [d for d in days if d > changed[-1]], series, backwards=False) or changed[-1]
        body_days = [d for d in days if changed[0] <= d <= end]
        near_tails = bool(before) and before[-1] in tails
        if near_tails:
            context = self._read([tails[before[-1]]])
        elif before:
            start = self._days_around(counts, before, series, backwards=True) or changed[0]
            reached = [raw[d] for d in before if d >= start]
            context = self._series(self._read(reached)) if reached else None
        else:
            context = None
        body = self._series(self._read([raw[d] for d in body_days]))
        rows = body if context is None else context.select(*body.columns).unionByName(body)
        touched = _join(rows, series, self.keys, "left_semi")
        made = windows.indicators(touched, keys=self.keys, tie_break=self.tie_break, digits=self.digits)
        made = made.withColumn(DAY, day_of("Date")).where(F.col(DAY) >= changed[0])
        others = [computed[d] for d in body_days if d in computed]
        if others and self.keys:
            made = made.unionByName(_join(self._read(others), series, self.keys, "left_anti").withColumn(DAY, day_of("Date")))
        path = self._write_in_order(made, run)
        entries = [(INDICATORS, d, f"{path}/{DAY}={d}") for d in body_days]
        entries += [(FILES, d, f"{self.base}/{FILES}/run={run}/{DAY}={d}") for d in body_days]
        entries += [(kind, d, known[d]) for kind, known in ((RAW, raw), (COUNTS, counts)) for d in changed]

        # Tails of the last two days, where this run reached them.
        for d in days[-2:]:
            if d not in body_days:
                continue
            if near_tails or not before:
                tail = self._tail(rows, d)
            elif d in tails:
                tail = self._tail(touched.unionByName(_join(self._read([tails[d]]), series, self.keys, "left_anti").select(*rows.columns)), d)
            else:
                continue
            path = self._write(tail, f"{TAILS}/{d}", run)
            entries.append((TAILS, d, f"{path}/{DAY}={d}"))
        known = {d for kind, d, _ in entries if kind == TAILS}
        entries += [(TAILS, d, "") for d in tails if d not in known and (d not in days[-2:] or d in body_days)]
        tables.commit_parts(self.spark, self.base, entries)
        return Run(changed, body_days, sorted(touched.inputFiles()))
