"""Byte-level BPE over Arrow batches with the tokenizers library; decoding by the byte table.

A text is cut into chunks at places that no match of the pattern can span.  Each distinct chunk of
a batch is encoded once by the library and the ids are laid out by numpy, so
the cost follows the distinct chunks, while the ids are those of the whole
text.  Ids, byte offsets and character offsets come out flat.
"""

from __future__ import annotations

import base64
import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StructType

from layercake.llm.common import map_arrow
from layercake.llm.textscan import SEGMENT, U64, _power_tables, byte_values, joined, mix

_EXACT = byte_values(lower=False)
#: Of a byte: 1 ASCII white space, 2 other visible ASCII, 3 digit, 4 letter, 5 part of a longer character, 0 else.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[0x21:0x7F] = 2
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 1
_KIND[48:58] = 3
_KIND[65:91] = _KIND[97:123] = 4
_KIND[128:] = 5
#: Distinct chunks that an encoder remembers at most; beyond that it begins anew.
CACHE_CHUNKS = 1_000_000


def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for the characters from
    256 on, in order.
    """
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _halves(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two parts whose merge makes a token: merge its bytes by the lower ranks until two are left."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 60))
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return parts[0], parts[1]


@lru_cache(maxsize=4)
def from_ranks(path: str, pattern: str):
    """(tokenizer, bytes of each id) of a rank file; each match of ``pattern`` is merged on its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs as many tasks as there are cores
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks = read_ranks(path)
    shown = byte_alphabet()
    text = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = [
        tuple(text[half] for half in _halves(token, ranks))
        for token, _ in sorted(ranks.items(), key=lambda item: item[1])
        if len(token) > 1
    ]
    tokenizer = Tokenizer(
        models.BPE(vocab={text[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True, cache_capacity=1)
    )
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return tokenizer, table


@lru_cache(maxsize=4)
def from_json(path: str):
    """(tokenizer, bytes of each id) of a tokenizers file with a byte-level vocabulary."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs as many tasks as there are cores
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    with open(path, encoding="utf-8") as file:
        vocab = json.load(file)["model"]["vocab"]
    byte = {c: b for b, c in byte_alphabet().items()}
    table = [b""] * (max(vocab.values()) + 1)
    for token, number in vocab.items():
        table[number] = bytes(byte[c] for c in token)
    return tokenizer, table


def _cuts(data: np.ndarray) -> np.ndarray:
    """Where chunks begin: places at which a match of a PROVEN pattern surely ends and another begins.

    These are white space after a character that is none, a change between
    an ASCII letter, digit and other visible ASCII character, except after
    an apostrophe, which may belong to the letters behind it.
    """
    kind = _KIND[data]
    before, here = kind[:-1], kind[1:]
    cut = ((here == 1) & (before >= 2)) | ((here >= 2) & (here <= 4) & (before >= 2) & (before <= 4) & (here != before))
    cut &= (here == 1) | (data[:-1] != 0x27)
    at = np.flatnonzero(cut) + 1
    # White space beyond ASCII has these lead bytes; no cut behind any such character.
    high = at[data[at - 1] >= 0x80]
    if len(high):
        lead3 = data[np.maximum(high - 3, 0)]
        bad = high[(data[np.maximum(high - 2, 0)] == 0xC2) | ((lead3 >= 0xE1) & (lead3 <= 0xE3))]
        at = at[~np.isin(at, bad)] if len(bad) else at
    return at


def cuttable(path: str, pattern: str | None) -> bool:
    """Whether ``_cuts`` holds for a tokenizer: the proven pattern, or a JSON file with the byte-level one and nothing before it."""
    if pattern is not None:
        return pattern == PATTERN
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    split = whole.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
    return bool(plain and not whole.get("normalizer"))


def encoder(path: str, pattern: str | None = None) -> Encoder:
    """An encoder for a rank file (with a pattern) or a tokenizers JSON file (without)."""
    parts = from_ranks(path, pattern) if pattern is not None else from_json(path)
    return Encoder(*parts, cuttable(path, pattern))


class Encoder:
    """Encodes whole Arrow text columns; keeps the ids of distinct chunks between batches.

    Chunks are told apart by a 64-bit hash of their bytes.
    """

    def __init__(self, tokenizer, table: list[bytes], chunks: bool):
        """With ``chunks`` texts are cut where that is proven to change no id; without, each text is encoded whole."""
        self.tokenizer, self.table, self.chunks = tokenizer, table, chunks
        self.size = np.array([len(t) for t in table], dtype=np.int64)
        self._forget()

    def _forget(self) -> None:
        self._hash, self._start, self._len = np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, chunks: list[bytes]) -> None:
        ids: list[list[int]] = []
        at = 0
        while at < len(chunks):  # bounded calls
            end, total = at + 1, len(chunks[at])
            while end < len(chunks) and total < SEGMENT:
                total += len(chunks[end])
                end += 1
            texts = b"\0".join(chunks[at:end]).decode().split("\0") if end - at > 1 and total < SEGMENT else None
            if texts is None or len(texts) != end - at:
                texts = [c.decode() for c in chunks[at:end]]
            ids += [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            at = end
        size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        start = len(self._ids) + np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)
        flat = np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=int(size.sum()))
        order = np.argsort(np.concatenate([self._hash, hashes]), kind="stable")
        self._ids = np.concatenate([self._ids, flat])
        self._hash = np.concatenate([self._hash, hashes])[order]
        self._start = np.concatenate([self._start, start])[order]
        self._len = np.concatenate([self._len, size])[order]

    def _hashes(self, data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of each chunk of texts that begin at ``begin`` and lie without gaps."""
        n = len(data)
        is_cut = np.zeros(n, dtype=bool)
        if self.chunks:
            is_cut[_cuts(data)] = True
        is_cut[0] = True
        is_cut[begin[begin < n]] = True
        at = np.flatnonzero(is_cut)
        stop = np.append(at[1:], n)
        power, inverse = _power_tables(max(SEGMENT, n) + 1)
        total = np.zeros(n + 1, dtype=U64)
        np.cumsum(_EXACT[data] * power[:n], out=total[1:])
        return at, mix((total[stop] - total[at]) * inverse[at] + (stop - at).astype(U64) * U64(0xD6E8FEB86659FD93))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, where each text's ids begin and, last, where they end); NULL is the empty text."""
        glued, starts = joined(texts)
        n = len(starts) - 1
        keep = np.ones(len(glued), dtype=bool)
        keep[starts[1:] - 1] = False  # the line feed after each text
        data = glued[keep]
        begin = starts[:-1] - np.arange(n)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        bounds = np.append(begin, len(data))
        ats, hashes, lo = [], [], 0
        while lo < len(data):  # a few megabytes at a time, cut between texts or inside a long one
            hi = min(lo + 2 * SEGMENT, len(data))
            if hi < len(data):
                whole = int(bounds[np.searchsorted(bounds, hi, side="right") - 1])
                if whole > lo:
                    hi = whole
                else:
                    inner = _cuts(data[lo:hi]) if self.chunks else ()
                    hi = lo + int(inner[-1]) if len(inner) else int(bounds[np.searchsorted(bounds, hi)])
            at, h = self._hashes(data[lo:hi], begin[np.searchsorted(begin, lo) : np.searchsorted(begin, hi)] - lo)
            ats.append(at + lo)
            hashes.append(h)
            lo = hi
        at, h = np.concatenate(ats), np.concatenate(hashes)
        distinct, back = np.unique(h, return_inverse=True)
        place = np.searchsorted(self._hash, distinct)
        fresh = np.ones(len(distinct), dtype=bool)
        if len(self._hash):
            fresh = self._hash[np.minimum(place, len(self._hash) - 1)] != distinct
        if fresh.any():
            if len(self._hash) + fresh.sum() > CACHE_CHUNKS:
                self._forget()
                fresh[:] = True
            first = np.zeros(len(distinct), dtype=np.int64)
            first[back[::-1]] = np.arange(len(h) - 1, -1, -1)
            stop = np.append(at[1:], len(data))
            raw, first = memoryview(data), first[fresh]
            self._learn(distinct[fresh], [bytes(raw[a:b]) for a, b in zip(at[first].tolist(), stop[first].tolist())])
            place = np.searchsorted(self._hash, distinct)
        size, start = self._len[place][back], self._start[place][back]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = self._ids[np.repeat(start - upto[:-1], size) + np.arange(upto[-1])]
        return ids, upto[np.searchsorted(at, bounds)]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of a run of ids, also where a character is split between tokens."""
        table = self.table
        return b"".join([table[i] for i in ids.tolist()])

    def byte_offsets(self, ids: np.ndarray) -> np.ndarray:
        """Where each token of ONE text begins and, last, where the text ends, in bytes."""
        return np.concatenate([[0], np.cumsum(self.size[ids])])

    def char_offsets(self, ids: np.ndarray) -> np.ndarray:
        """The character in which each token of ONE text begins (a token inside a character
        begins in that character) and, last, the number of characters."""
        raw = np.frombuffer(self.decode(ids), dtype=np.uint8)
        heads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        at = self.byte_offsets(ids)
        inside = np.append((raw & 0xC0) == 0x80, False)[at]
        return heads[at] - inside


def encode_texts(
    docs: DataFrame,
    path: str,
    pattern: str | None = None,
    text_col: str = "text",
    offsets: bool = False,
) -> DataFrame:
    """All rows and columns of ``docs`` plus ``ids`` (binary: little-endian unsigned 32-bit
    numbers) and ``n_tokens`` (long); with ``offsets`` also ``byte_offsets`` and
    ``char_offsets`` (array<long>, one entry more than tokens).

    ``path`` names a rank file (then ``pattern`` splits the text) or a
    tokenizers JSON file.  Special tokens are never added, their strings are
    ordinary text.  NULL is the empty text, which has no ids.  Columns of the
    same names as the added ones are replaced.
    """
    added = [("ids", "binary"), ("n_tokens", "long")]
    if offsets:
        added += [("byte_offsets", ArrayType(LongType())), ("char_offsets", ArrayType(LongType()))]
    docs = docs.drop(*[name for name, _ in added])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for batch in batches:
            ids, begin = coder.encode(batch.column(at))
            spans = list(zip(begin[:-1].tolist(), begin[1:].tolist()))
            columns = [
                pa.array([ids[a:b].astype("<u4").tobytes() for a, b in spans], pa.binary()),
                pa.array(np.diff(begin), pa.int64()),
            ]
            if offsets:
                for of in (coder.byte_offsets, coder.char_offsets):
                    columns.append(pa.array([of(ids[a:b]) for a, b in spans], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *columns], names=[*batch.schema.names, *[name for name, _ in added]]
            )

    schema = StructType(list(docs.schema.fields))
    for name, kind in added:
        schema = schema.add(name, kind)
    return map_arrow(docs, run, schema)


def decode_ids(frame: DataFrame, path: str, pattern: str | None = None, ids_col: str = "ids") -> DataFrame:
    """All rows and columns plus ``decoded`` (binary): the bytes of the ids; NULL ids give NULL."""
    frame = frame.drop("decoded")
    at = frame.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for batch in batches:
            decoded = [
                None if x is None else coder.decode(np.frombuffer(x, dtype="<u4")) for x in batch.column(at).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.binary())], names=[*batch.schema.names, "decoded"]
            )

    return map_arrow(frame, run, StructType(list(frame.schema.fields)).add("decoded", "binary"))
