"""Vectorised scanning of Arrow text columns: words, their hashes, shingles.

Everything works on the bytes of a whole batch at once.  A word's 64-bit
hash is a polynomial over mixed byte values, read off a prefix sum, so the
cost is a few numpy passes over the bytes however many words there are.
Segments of bounded size keep temporary arrays small; a text of any length
is scanned whole, segment by segment.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 20
U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)  # odd, hence invertible modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n, kept for the life of the worker (two tables)."""
    if not _POW or len(_POW[0]) < n:
        inverse = pow(int(_BASE), -1, 1 << 64)
        _POW[:] = [_powers(int(_BASE), n), _powers(inverse, n)]
    return _POW[0], _POW[1]


def byte_values(lower: bool) -> np.ndarray:
    """A random-looking value per byte; with ``lower``, A-Z count as a-z."""
    values = mix(np.arange(1, 257, dtype=U64))
    if lower:
        values[65:91] = values[97:123]
    return values


#: [\x20\x09-\x0D] parts words; every other byte belongs to one.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: Letters, digits and every byte of a non-ASCII character belong to words.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

LOWERED = byte_values(lower=True)


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, a line feed after each text, and the texts' starts.

    NULL counts as the empty text.  ``starts`` has one more entry: the end.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    glued = pc.binary_join_element_wise(texts, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
    offsets = np.frombuffer(glued.buffers()[1], dtype=np.int64)[glued.offset : glued.offset + len(glued) + 1]
    if not len(glued) or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(glued) + 1, dtype=np.int64)
    data = np.frombuffer(glued.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _segments(data: np.ndarray, member: np.ndarray):
    """Cut the bytes into pieces of about SEGMENT bytes that never split a word."""
    at, n = 0, len(data)
    while at < n:
        end = min(at + SEGMENT, n)
        while end < n and member[data[end - 1]]:
            ahead = np.flatnonzero(~member[data[end : end + SEGMENT]])
            end = end + int(ahead[0]) + 1 if len(ahead) else min(end + SEGMENT, n)
        yield at, end
        at = end


def words(data: np.ndarray, member: np.ndarray = SPACED, values: np.ndarray = LOWERED):
    """(start, end, hash) of every maximal run of member bytes."""
    starts, ends, hashes = [], [], []
    for at, end in _segments(data, member):
        part = data[at:end]
        inside = member[part]
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        power, inverse = _power_tables(max(SEGMENT, len(part)) + 1)
        total = np.zeros(len(part) + 1, dtype=U64)
        np.cumsum(values[part] * power[: len(part)], out=total[1:])
        h = (total[e] - total[s]) * inverse[s]
        hashes.append(mix(h + (e - s).astype(U64) * U64(0xD6E8FEB86659FD93)))
        starts.append(s + at)
        ends.append(e + at)
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


def text_words(texts: pa.Array, member: np.ndarray = SPACED, values: np.ndarray = LOWERED):
    """Word hashes of all texts in order, and where each text's words begin (one entry more)."""
    data, starts = joined(texts)
    s, _, h = words(data, member, values)
    return h, np.searchsorted(s, starts)


def shingle_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive words of ONE text.

    A text with fewer words is one shingle, seeded by its length; one
    without words has none.
    """
    n = len(h)
    if n == 0:
        return np.zeros(0, U64)
    span = min(width, n)
    out = np.full(n - span + 1, U64(span * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF), dtype=U64)
    for k in range(span):
        out = mix(out * U64(0xFF51AFD7ED558CCD) + h[k : n - span + 1 + k])
    return out
