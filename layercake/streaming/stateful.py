"""Keyed stateful stream operators (``applyInPandasWithState`` or ``transformWithStateInPandas``).

State per device is small (the last EMA, or the last N readings).  Devices
are dealt into :data:`BUCKETS` by a hash, and a bucket is what the stream
groups by: a micro-batch hands a bucket's new rows to one pandas call, which
orders them by device, event time and id, continues all its devices'
recurrences vectorised with numpy, and updates their state as one packed
table.  So a call's fixed cost is paid per bucket and micro-batch, however
many devices there are.  Rows of a NULL device have a bucket of their own.
The RocksDB state store (set by :func:`layercake.session.configure`) keeps
state off-heap and checkpointed.

Order of rows.  With a ``delay``, rows wait in the bucket's state until the
watermark passes them, and are released in event order by rows or by a
timer: files may arrive in any order within the delay, and results do not
depend on how they are cut into micro-batches.  Rows later than the delay
are dropped, as by every watermark; rows without a time have no place in a
series and come out at once, with NULL results.  Without a ``delay`` rows
are ordered within a micro-batch and taken in arrival order across them.

One reading rule, the same as in batch (:mod:`layercake.operators.sequences`):
a NULL reading takes a place in every window and has no value, a NaN one has
the value NaN.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    ByteType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

from layercake.operators.sequences import EMA_ALPHA, EMA_THRESHOLD, SCORE_THRESHOLD, SEQUENCE_LENGTH

#: Groups that a stream's devices are dealt into; a checkpoint belongs to the number that it began with.
BUCKETS = 256

# Names without a leading underscore: the transform API renames such columns.
_TIME = "lc_time"
_KEY, _BUCKET = "lc_key", "lc_bucket"
_MISSING = "lc_missing_"  # + column: whether its number is NULL (pandas cannot tell a double from NaN, and makes integers doubles)
_NO_TIME = np.iinfo(np.int64).min


def ema_continue(x: np.ndarray, start: float, alpha: float) -> np.ndarray:
    """EMA of ``x`` continuing from ``start``: ``s = (1-a)*s + a*x`` per reading.

    Applied in reading order with the operations of the recurrence itself
    (``itertools.accumulate`` iterates in C), so a device's stream matches
    the definition to the last bit whatever the micro-batch boundaries.
    """
    d = 1.0 - alpha
    steps = accumulate(x.astype(np.float64).tolist(), lambda s, v: s * d + v * alpha, initial=float(start))
    return np.fromiter(steps, dtype=np.float64, count=len(x) + 1)[1:]


def _doubles(values: np.ndarray, missing: np.ndarray) -> pd.arrays.FloatingArray:
    """Doubles in which NULL and NaN differ."""
    return pd.arrays.FloatingArray(np.ascontiguousarray(values, dtype=np.float64), np.ascontiguousarray(missing, dtype=bool))


def _pack(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(packed: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(packed)).read_all().to_pandas()


def _by_key(state: pd.Series | None, rows: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Rows of the state, then new rows, brought together by key, each key's in the order they came:
    (their places, their keys' numbers, the keys, how many rows the state has)."""
    held = 0 if state is None else len(state)
    codes, keys = pd.factorize(pd.concat([state, rows], ignore_index=True) if held else rows)
    place = np.argsort(codes, kind="stable")
    return place, codes[place], np.asarray(keys), held


class _Steps:
    """A recurrence over the rows of a bucket's devices: ``step(ordered rows, state)`` gives (output, new state).

    The state is a frame with the keys in ``_KEY``; None before the first rows.
    """

    def __init__(self, value: str, passthrough: Sequence[str], numbers: dict[str, str]):
        self.value, self.passthrough, self.numbers = value, list(passthrough), numbers

    def readings(self, rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        missing = rows[_MISSING + self.value].to_numpy(dtype=bool)
        return np.where(missing, 0.0, rows[self.value].to_numpy(dtype=np.float64)), missing

    def passed(self, rows: pd.DataFrame) -> pd.DataFrame:
        out = rows[self.passthrough].reset_index(drop=True)
        for c in self.passthrough:
            if self.numbers.get(c):
                missing = rows[_MISSING + c].to_numpy(dtype=bool)
                if self.numbers[c] == "double":
                    out[c] = _doubles(rows[c].to_numpy(), missing)
                else:
                    out[c] = pd.arrays.IntegerArray(rows[c].to_numpy(dtype=self.numbers[c]).copy(), missing.copy())
        return out


class EmaSteps(_Steps):
    """State: a device's EMA (0 before its first reading).  Rows with a NULL reading are left out."""

    def __init__(self, value, passthrough, numbers, alpha: float = EMA_ALPHA, threshold: float = EMA_THRESHOLD):
        super().__init__(value, passthrough, numbers)
        self.alpha, self.threshold = alpha, threshold

    def step(self, rows: pd.DataFrame, state: pd.DataFrame | None) -> tuple[pd.DataFrame | None, pd.DataFrame | None]:
        rows = rows[~rows[_MISSING + self.value].to_numpy(dtype=bool)]
        if rows.empty:
            return None, state
        place, codes, keys, held = _by_key(None if state is None else state[_KEY], rows[_KEY])
        last = np.zeros(len(keys))
        if held:
            last[codes[place < held]] = state["ema"].to_numpy()[place[place < held]]
        new = place >= held
        rows, codes = rows.take(place[new] - held), codes[new]
        x, _ = self.readings(rows)
        starts = np.flatnonzero(np.diff(codes, prepend=-1))
        ema = np.empty(len(x))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(x)]):
            ema[a:b] = ema_continue(x[a:b], last[codes[a]], self.alpha)
            last[codes[a]] = ema[b - 1]
        out = self.passed(rows)
        out["ema"] = _doubles(ema, np.zeros(len(ema), bool))
        with np.errstate(invalid="ignore"):
            out["alert"] = np.abs(x - ema) > self.threshold
        return out, pd.DataFrame({_KEY: keys, "ema": last})

    def untimed(self, rows: pd.DataFrame) -> pd.DataFrame:
        out = self.passed(rows)
        out["ema"] = _doubles(np.zeros(len(out)), np.ones(len(out), bool))
        out["alert"] = pd.array([pd.NA] * len(out), dtype="boolean")
        return out


class TrailingSteps(_Steps):
    """State: a device's last readings (oldest first) and which of them are NULL.

    ``mode='features'`` gives lag-1 and the ``roll``-row mean; ``mode='score'``
    warm-up / prediction / alert records of the linear sequence scorer.
    """

    def __init__(self, value, passthrough, numbers, mode: str, length: int = SEQUENCE_LENGTH, roll: int = 5,
                 threshold: float = SCORE_THRESHOLD):
        super().__init__(value, passthrough, numbers)
        self.mode, self.length, self.roll, self.threshold = mode, length, roll, threshold
        self.keep = max((length if mode == "score" else roll) - 1, 1)

    def step(self, rows: pd.DataFrame, state: pd.DataFrame | None) -> tuple[pd.DataFrame | None, pd.DataFrame]:
        x, missing = self.readings(rows)
        place, codes, keys, held = _by_key(None if state is None else state[_KEY], rows[_KEY])
        if held:
            x, missing = np.concatenate([state["reading"].to_numpy(), x]), np.concatenate([state["missing"].to_numpy(dtype=bool), missing])
        full, gone, new = x[place], missing[place], place >= held
        first = np.searchsorted(codes, codes, "left")  # of the row's key
        made = self._features if self.mode == "features" else self._score
        at = np.flatnonzero(new)
        with np.errstate(invalid="ignore", over="ignore"):
            out = made(self.passed(rows.take(place[new] - held)), full, gone, at, (np.arange(len(full)) - first)[at])
        tail = np.searchsorted(codes, codes, "right") - np.arange(len(full)) <= self.keep
        return out, pd.DataFrame({_KEY: keys[codes[tail]], "reading": full[tail], "missing": gone[tail]})

    def _frames(self, full: np.ndarray, gone: np.ndarray, at: np.ndarray, nth: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The last n readings at each new row, which of them are NULL, and which lie before its device's first."""
        view = np.lib.stride_tricks.sliding_window_view
        values = view(np.concatenate([np.zeros(n - 1), full]), n)[at]
        missing = view(np.concatenate([np.zeros(n - 1, bool), gone]), n)[at]
        before = np.arange(n) < (n - 1 - nth)[:, None]
        return np.where(before, 0.0, values), missing & ~before, before

    def _features(self, out: pd.DataFrame, full: np.ndarray, gone: np.ndarray, at: np.ndarray, nth: np.ndarray) -> pd.DataFrame:
        last = np.maximum(at - 1, 0)
        out["temp_lag_1"] = _doubles(full[last], gone[last] | (nth == 0))
        values, missing, before = self._frames(full, gone, at, nth, self.roll)
        none = missing | before
        count = (~none).sum(axis=1)
        mean = np.where(none, 0.0, values).sum(axis=1) / np.maximum(count, 1)
        out[f"temp_roll_mean_{self.roll}"] = _doubles(mean, count == 0)
        return out

    def _score(self, out: pd.DataFrame, full: np.ndarray, gone: np.ndarray, at: np.ndarray, nth: np.ndarray) -> pd.DataFrame:
        n = self.length
        values, missing, before = self._frames(full, gone, at, nth, n)
        ready = ~before.any(axis=1)
        prediction = values @ np.arange(1, n + 1, dtype=np.float64) / float(n * (n + 1) / 2)
        unknown = ~ready | missing.any(axis=1)
        out["window_len"] = (n - before.sum(axis=1)).astype(np.int32)
        out["prediction"] = _doubles(np.where(unknown, 0.0, prediction), unknown)
        out["observed"] = _doubles(full[at], gone[at])
        out["kind"] = np.where(ready, "prediction", "warmup")
        alerts = out[~unknown & (np.abs(full[at] - prediction) > self.threshold)].copy()
        alerts["kind"] = "alert"
        return pd.concat([out, alerts], ignore_index=True)

    def untimed(self, rows: pd.DataFrame) -> pd.DataFrame:
        out = self.passed(rows)
        none = _doubles(np.zeros(len(out)), np.ones(len(out), bool))
        if self.mode == "features":
            return out.assign(**{"temp_lag_1": none, f"temp_roll_mean_{self.roll}": none})
        x, missing = self.readings(rows)
        empty = pd.array([pd.NA] * len(out), dtype="Int32")
        return out.assign(window_len=empty, prediction=none, observed=_doubles(x, missing), kind="warmup")


def _times(rows: pd.DataFrame) -> np.ndarray:
    """Event times in microseconds; _NO_TIME where there is none."""
    return rows[_TIME].to_numpy(dtype="datetime64[us]").view(np.int64)


def _released(rows: pd.DataFrame, order: Sequence[str], watermark: int | None) -> tuple[pd.DataFrame, pd.DataFrame, pd.DataFrame]:
    """(rows to take now in event order, rows that wait, rows without a time)."""
    if watermark is None:
        now, wait, untimed = rows, rows.iloc[:0], rows.iloc[:0]
    else:
        t = _times(rows)
        due = t <= watermark * 1000
        now, wait, untimed = rows[due & (t != _NO_TIME)], rows[~due], rows[t == _NO_TIME]
    # lexsort: the last key is the primary one (NULLs last); numpy avoids pandas' per-call overhead.
    by = [now[c].to_numpy() for o in reversed(list(order)) for c in (o, _MISSING + o) if c in now]
    return now.take(np.lexsort(by)), wait, untimed


def _wake(wait: pd.DataFrame, watermark: int) -> int:
    """When (in milliseconds of the watermark) the first waiting row can go."""
    return max(int(_times(wait).min()) // 1000, watermark) + 1


class KeyedProcessor(StatefulProcessor):
    """The steps on ``transformWithStateInPandas``: value state (packed), list state of waiting rows (packed per
    micro-batch), event-time timers.  A key is a bucket of devices."""

    def __init__(self, steps: _Steps, order: Sequence[str], delayed: bool):
        self.steps, self.order, self.delayed = steps, list(order), delayed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", StructType([StructField("state", BinaryType())]))
        if self.delayed:
            self.waiting = handle.getListState("waiting", StructType([StructField("rows", BinaryType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self._advance(list(rows), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance([], timerValues)

    def _advance(self, chunks: list[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        watermark = timers.getCurrentWatermarkInMs() if self.delayed else None
        held = [_unpack(row[0]) for row in self.waiting.get()] if self.delayed and self.waiting.exists() else []
        if not held and not chunks:
            return
        now, wait, untimed = _released(pd.concat([*held, *chunks], ignore_index=True), self.order, watermark)
        if self.delayed:
            if len(wait):
                self.waiting.put([(_pack(wait),)])
                self.handle.registerTimer(_wake(wait, watermark))
            else:
                self.waiting.clear()
        if len(untimed):
            yield self.steps.untimed(untimed)
        if len(now):
            packed = self.state.get()
            out, state = self.steps.step(now, _unpack(packed[0]) if packed else None)
            if state is not None:
                self.state.update((_pack(state),))
            if out is not None:
                yield out

    def close(self) -> None:
        pass


def _grouped(steps: _Steps, order: Sequence[str], delayed: bool):
    """The steps on ``applyInPandasWithState``; waiting rows travel with the state."""

    def run(key, pdfs, group):
        known, packed = group.get if group.exists else (None, None)
        watermark = group.getCurrentWatermarkMs() if delayed else None
        chunks = ([_unpack(packed)] if packed else []) + ([] if group.hasTimedOut else list(pdfs))
        if not chunks:
            return
        now, wait, untimed = _released(pd.concat(chunks, ignore_index=True), order, watermark)
        if len(untimed):
            yield steps.untimed(untimed)
        if len(now):
            out, state = steps.step(now, _unpack(known) if known else None)
            known = _pack(state) if state is not None else None
            if out is not None:
                yield out
        group.update((known, _pack(wait) if len(wait) else None))
        if len(wait):
            group.setTimeoutTimestamp(_wake(wait, watermark))

    return run


_WIDTHS = {ByteType: "int8", ShortType: "int16", IntegerType: "int32", LongType: "int64"}


def _key_value(df: DataFrame, key: str) -> Column:
    """The key as an integer or a text that pandas can tell apart; NULL keys have their own bucket."""
    kind, c = df.schema[key].dataType, F.col(key)
    if type(kind) in _WIDTHS:
        return F.coalesce(c.cast("bigint"), F.lit(0))
    if isinstance(kind, (DoubleType, FloatType)):
        c = c + F.lit(0.0)  # one zero
    text = F.hex(c) if isinstance(kind, BinaryType) else F.to_json(F.struct(c)) if isinstance(kind, (ArrayType, StructType)) else c.cast("string")
    return F.coalesce(text, F.lit(""))


def _run_keyed(df: DataFrame, key: str, order: Sequence[str], steps: _Steps, out: StructType, api: str,
               delay: str | None) -> DataFrame:
    """Apply ``steps`` to the keys' rows, bucket by bucket, with the chosen state API.

    ``api="grouped"`` (default) uses ``applyInPandasWithState``: the state
    travels in-band with each group's Arrow batch; the state calls of
    ``api="transform"`` (``transformWithStateInPandas``) are separate round
    trips.
    """
    made = {_MISSING + c: F.col(c).isNull() for c in steps.numbers}
    made |= {c: F.coalesce(c, F.lit(0).cast(df.schema[c].dataType)) for c, kind in steps.numbers.items() if kind.startswith("int")}
    made[_KEY] = _key_value(df, key)
    made[_BUCKET] = F.when(F.col(key).isNull(), -1).otherwise(F.pmod(F.xxhash64(made[_KEY]), F.lit(BUCKETS))).cast("int")
    if delay:
        made[_TIME] = F.col(order[0]).cast("timestamp")
    df = df.withColumns(made).select(*dict.fromkeys([*steps.passthrough, *order, steps.value, *made]))
    if delay:
        df = df.withWatermark(_TIME, delay)
    if api == "grouped":
        state = StructType([StructField("state", BinaryType()), StructField("waiting", BinaryType())])
        timeout = GroupStateTimeout.EventTimeTimeout if delay else GroupStateTimeout.NoTimeout
        return df.groupBy(_BUCKET).applyInPandasWithState(_grouped(steps, list(order), bool(delay)), out, state, "append", timeout)
    if api == "transform":
        return df.groupBy(_BUCKET).transformWithStateInPandas(
            statefulProcessor=KeyedProcessor(steps, order, bool(delay)), outputStructType=out, outputMode="Append",
            timeMode="EventTime" if delay else "None",
        )
    raise ValueError(f"unknown state api {api!r}")


def _keyed(df: DataFrame, key, order, value, passthrough, made, extra: list[StructField], api, delay) -> DataFrame:
    kinds = {c: df.schema[c].dataType for c in [*passthrough, *order, value]}
    widths = {c: "double" if isinstance(t, (DoubleType, FloatType)) else _WIDTHS.get(type(t), "") for c, t in kinds.items()}
    numbers = {c: width for c, width in widths.items() if width or c == value}  # a decimal value passes as it is
    out = StructType([df.schema[c] for c in passthrough] + extra)
    return _run_keyed(df, key, order, made(value, passthrough, numbers), out, api, delay)


def stream_ema_anomalies(df: DataFrame, key: str, order: Sequence[str], value: str, passthrough: Sequence[str],
                         api: str = "grouped", delay: str | None = None, **kw) -> DataFrame:
    """Streaming twin of :func:`layercake.operators.sequences.ema_anomalies`."""
    extra = [StructField("ema", DoubleType()), StructField("alert", BooleanType())]
    return _keyed(df, key, order, value, passthrough, lambda *a: EmaSteps(*a, **kw), extra, api, delay)


def stream_lag_features(df: DataFrame, key: str, order: Sequence[str], value: str, passthrough: Sequence[str],
                        roll: int = 5, api: str = "grouped", delay: str | None = None) -> DataFrame:
    """Streaming twin of :func:`layercake.operators.sequences.lag_features`."""
    extra = [StructField("temp_lag_1", DoubleType()), StructField(f"temp_roll_mean_{roll}", DoubleType())]
    return _keyed(df, key, order, value, passthrough, lambda *a: TrailingSteps(*a, "features", roll=roll), extra, api, delay)


def stream_score_sequences(df: DataFrame, key: str, order: Sequence[str], value: str, passthrough: Sequence[str],
                           length: int = SEQUENCE_LENGTH, api: str = "grouped", delay: str | None = None) -> DataFrame:
    """Streaming twin of :func:`layercake.operators.sequences.score_sequences`."""
    extra = [
        StructField("window_len", IntegerType()), StructField("prediction", DoubleType()),
        StructField("observed", DoubleType()), StructField("kind", StringType()),
    ]
    return _keyed(df, key, order, value, passthrough, lambda *a: TrailingSteps(*a, "score", length=length), extra, api, delay)


__all__ = [
    "EmaSteps",
    "KeyedProcessor",
    "TrailingSteps",
    "ema_continue",
    "stream_ema_anomalies",
    "stream_lag_features",
    "stream_score_sequences",
]
