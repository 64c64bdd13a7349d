"""Best-fit packing of token sequences: bounded space, online, with a bitset of free space.

Documents are cut into pieces of at most ``capacity`` tokens, dealt evenly
over tasks and packed as they arrive.  A task keeps a fixed number of open
sequences, whose free space is a bit in one integer: shifting it right by a
piece's length and taking the lowest bit finds the fullest sequence that
still has room.  When none has and all places are taken, the fullest closes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layercake.llm.bpe import encoder
from layercake.llm.common import prepare, staged

CAPACITY = 2048
OPEN = 1024  # open sequences in a task
TASK_PIECES = 65_536  # pieces that a task packs


class BestFit:
    """Bounded-space online best fit of lengths 1 .. capacity."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN):
        self.capacity, self.open_bins = capacity, open_bins
        self._mask = 0
        self._bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self._open = 0
        self.opened = 0

    def _take(self, free: int) -> int:
        bins = self._bins[free]
        number = bins.pop()
        if not bins:
            self._mask ^= 1 << free
        self._open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) of the next piece."""
        if not 1 <= length <= self.capacity:
            raise ValueError(f"a piece has 1 to {self.capacity} tokens, not {length}")
        room = self._mask >> length
        if room:
            free = length + (room & -room).bit_length() - 1
            number = self._take(free)
        else:
            if self._open >= self.open_bins and length < self.capacity:
                self._take((self._mask & -self._mask).bit_length() - 1)  # the fullest closes
            number, free = self.opened, self.capacity
            self.opened += 1
        left = free - length
        if left:
            self._bins[left].append(number)
            self._mask |= 1 << left
            self._open += 1
        return number, self.capacity - free


def piece_lengths(n: int, capacity: int = CAPACITY) -> list[int]:
    """A document of n tokens: whole if it fits, else full pieces behind a first one that takes the rest."""
    if n <= capacity:
        return [n]
    first = n % capacity
    return [first] * bool(first) + [capacity] * (n // capacity)


def token_pieces(
    docs: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, piece, start, length, ids): each document's ids, then ``end_id``, cut to the capacity.

    NULL is the empty text, whose one piece holds ``end_id`` alone.  Repeated
    rows give repeated pieces; a NULL id stays NULL.  Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            ids, begin = coder.encode(batch.column(1))
            owner, piece, start, length, blob = [], [], [], [], []
            for i, (a, b) in enumerate(zip(begin[:-1].tolist(), begin[1:].tolist())):
                raw = ids[a:b].astype("<u4").tobytes() + end
                at = 0
                for k, n in enumerate(piece_lengths(b - a + 1, capacity)):
                    owner.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(n)
                    blob.append(raw[4 * at : 4 * (at + n)])
                    at += n
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(owner, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(blob, pa.binary()),
                ],
                names=["doc_id", "piece", "start", "length", "ids"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids binary"
    )


def pack(
    pieces: DataFrame,
    tasks: int,
    capacity: int = CAPACITY,
    open_bins: int = OPEN,
    length_col: str = "length",
    keys: tuple[str, ...] = ("doc_id", "piece"),
) -> DataFrame:
    """All rows and columns of ``pieces`` plus ``sequence_id`` and ``offset`` (long).

    The pieces are dealt evenly by a hash of ``keys`` and arrive in its order,
    so a task that runs again packs the same way; equal pieces are
    interchangeable.  Sequences of different tasks have different numbers.
    """
    pieces = pieces.drop("sequence_id", "offset")
    at = pieces.columns.index(length_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = BestFit(capacity, open_bins)
        base = TaskContext.get().partitionId() << 33
        for batch in batches:
            placed = [bins.place(n) for n in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([base + number for number, _ in placed], pa.int64()),
                    pa.array([offset for _, offset in placed], pa.int64()),
                ],
                names=[*batch.schema.names, "sequence_id", "offset"],
            )

    order = F.xxhash64(*keys)
    schema = StructType(list(pieces.schema.fields)).add("sequence_id", "long").add("offset", "long")
    return pieces.repartition(tasks, order).sortWithinPartitions(order, *keys).mapInArrow(run, schema)


def pack_documents(docs: DataFrame, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of all documents.

    See ``token_pieces`` for NULL and repeated rows; an empty table gives no
    pieces.  The ids themselves stay out of the shuffle: only their checksum goes on.
    """
    prepare(docs.sparkSession)
    pieces = staged(
        token_pieces(docs, path, end_id, CAPACITY, id_col, text_col).select(
            "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
        ),
        "pieces",
    )
    return pack(pieces, tasks=2 + pieces.count() // TASK_PIECES)
