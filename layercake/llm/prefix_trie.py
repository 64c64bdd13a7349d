"""Conversation prefix trie: double-array tries per prefix shard, shared upper nodes merged globally.

1. Equal conversations are collapsed first: a group of copies is one
   sequence with its number of members, its smallest member and a digest
   of all members.  Members are packed in bounded blocks of ids, and the
   digest reads the blocks in order, so no group is ever held whole.
2. The distinct sequences are range-partitioned and sorted by their turns'
   hashes, so a shard is a range of neighbouring prefixes, and a prefix that many
   conversations share is spread over many shards.
3. A shard gives its turns dense ids and packs its trie into BASE and
   CHECK arrays: the child of slot s by turn c is slot BASE[s] + c if
   CHECK there is s.  All sequences walk the arrays at once, one step a
   depth; counts go up along CHECK.
4. A node lies in several shards only if it is a prefix of a shard's first
   or last sequence.  These upper nodes' sums are added up by a key; for
   each pair of neighbouring shards the prefixes that their border shares
   are counted once too often, which correction rows take back.  One
   grouping gives the global values.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layercake.llm.common import list_parts, staged

WIDTH = 16  # bytes of a turn's hash
MEMBER_BLOCK = 4096  # member ids packed into one row
SHARD_TURNS = 1 << 17  # turns in one double-array trie
SEARCH = 4096  # slots looked at together
_NO_MEMBERS = hashlib.sha256(b"").hexdigest()


def sequences(turns: DataFrame, conv: str, order: str, role: str, text: str) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as hash and UTF-8 length of the text.

    A NULL order comes first, NULL role and text count as empty, and turns
    with equal order are ordered by their hash.  Rows without a
    conversation take no part.  A conversation is one row here, 24 bytes a
    turn, as a document is one text.
    """
    said, words = F.coalesce(F.col(f"`{role}`"), F.lit("")), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    framed = F.concat(F.octet_length(said).cast("string"), F.lit(":"), said, words)
    turn = F.struct(
        F.col(f"`{order}`").alias("at"),
        F.substring(F.sha2(framed.cast("binary"), 256), 1, 2 * WIDTH).alias("hash"),
        F.octet_length(words).cast("long").alias("size"),
    )
    return (
        turns.select(F.col(f"`{conv}`").alias("conv_id"), turn.alias("t"))
        .where("conv_id IS NOT NULL")
        .groupBy("conv_id")
        .agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["hash"], t["size"])).alias("turns"))
    )


class DoubleArray:
    """BASE and CHECK of a trie over codes from 1; slot 0 is the root."""

    def __init__(self, room: int):
        self.base = np.zeros(room, dtype=np.int64)
        self.check = np.full(room, -1, dtype=np.int64)
        self.check[0] = 0
        self.low = 1  # no free slot below
        self.tried: dict[int, int] = {}  # fan-out -> where one of its size last fitted

    def _reach(self, end: int) -> None:
        if end > len(self.check):
            more = max(end, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def _fit(self, codes: np.ndarray) -> int:
        """A base at which every code's slot is free."""
        offsets = codes - codes.min()
        span, size = int(offsets.max()), min(len(codes), 64)
        at = max(self.low, self.tried.get(size, 0))
        while True:
            self._reach(at + SEARCH + span)
            free = np.flatnonzero(self.check[at : at + SEARCH] < 0) + at
            for offset in offsets:
                if not len(free):
                    break
                free = free[self.check[free + offset] < 0]
            if len(free):
                self.tried[size] = at
                return int(free[0] - codes.min())
            at += SEARCH

    def _free(self, count: int) -> np.ndarray:
        """The first free slots."""
        found, at, have = [], self.low, 0
        while have < count:
            self._reach(at + max(SEARCH, count))
            free = np.flatnonzero(self.check[at : at + max(SEARCH, count)] < 0)[: count - have] + at
            found.append(free)
            have += len(free)
            at += max(SEARCH, count)
        slots = np.concatenate(found)
        self.low = int(slots[-1]) + 1
        return slots

    def add_level(self, parents: np.ndarray, codes: np.ndarray) -> None:
        """The children of some slots; those of one parent stand together."""
        starts = np.flatnonzero(np.diff(parents, prepend=-1))
        counts = np.diff(starts, append=len(parents))
        for i in np.flatnonzero(counts > 1)[np.argsort(-counts[counts > 1], kind="stable")]:
            own = codes[starts[i] : starts[i] + counts[i]]
            base = self._fit(own)
            self.base[parents[starts[i]]] = base
            self.check[base + own] = parents[starts[i]]
        single = starts[counts == 1]
        if len(single):  # a lone child fits any free slot
            slots = self._free(len(single))
            self.base[parents[single]] = slots - codes[single]
            self.check[slots] = parents[single]

    def step(self, slots: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The children of slots by codes; -1 where there is none."""
        to = self.base[slots] + codes
        inside = (to > 0) & (to < len(self.check))
        return np.where(inside & (self.check[np.where(inside, to, 0)] == slots), to, -1)


def dense_codes(hashes: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Codes from 1 for distinct hashes, numbered by depth, then place, so that siblings' codes lie close."""
    order = np.argsort(depth, kind="stable")
    _, first, inverse = np.unique(hashes[order], return_index=True, return_inverse=True)
    number = np.empty(len(first), dtype=np.int64)
    number[np.argsort(first, kind="stable")] = np.arange(1, len(first) + 1)
    codes = np.empty(len(hashes), dtype=np.int64)
    codes[order] = number[inverse]
    return codes


def build(codes: np.ndarray, starts: np.ndarray) -> DoubleArray:
    """The trie of sorted sequences: codes[starts[i] : starts[i + 1]] each."""
    trie = DoubleArray(2 * len(codes) + SEARCH)
    at = np.zeros(len(starts) - 1, dtype=np.int64)
    lengths = np.diff(starts)
    going = np.flatnonzero(lengths > 0)
    for d in range(int(lengths.max(initial=0))):
        going = going[lengths[going] > d]
        parents, own = at[going], codes[starts[going] + d]
        new = np.ones(len(going), dtype=bool)
        new[1:] = (parents[1:] != parents[:-1]) | (own[1:] != own[:-1])
        trie.add_level(parents[new], own[new])
        at[going] = trie.step(parents, own)
    return trie


def _path_keys(path: bytes) -> list[bytes]:
    """A key for each prefix of a path, the empty one first."""
    keys = [bytes(WIDTH)]
    for i in range(0, len(path), WIDTH):
        keys.append(hashlib.blake2b(keys[-1] + path[i : i + WIDTH], digest_size=WIDTH).digest())
    return keys


_FINAL, _UNDER, _SHARED, _EDGE = 0, 1, 2, 3  # kinds of a shard's rows
_LONGS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
_PARTS = (
    "kind int, key binary, parent_key binary, " + ", ".join(f"{c} long" for c in _LONGS)
    + ", ends string, part int, first_keys array<binary>, last_keys array<binary>, last_cover array<long>"
)
_PARTS_ARROW = pa.schema(
    [("kind", pa.int32()), ("key", pa.binary()), ("parent_key", pa.binary()), *[(c, pa.int64()) for c in _LONGS],
     ("ends", pa.string()), ("part", pa.int32()), ("first_keys", pa.list_(pa.binary())),
     ("last_keys", pa.list_(pa.binary())), ("last_cover", pa.list_(pa.int64()))]
)


def _rows(columns: dict, count: int, part: int) -> pa.RecordBatch:
    given = columns | {"part": [part] * count}
    arrays = [pa.array(given[f.name], f.type) if f.name in given else pa.nulls(count, f.type) for f in _PARTS_ARROW]
    return pa.RecordBatch.from_arrays(arrays, schema=_PARTS_ARROW)


def _border(last: tuple[list[bytes], list[int]], following: list[bytes]) -> dict:
    """Corrections for the prefixes that a shard's last sequence shares with the next one's first."""
    keys, sizes = last
    common = sum(a == b for a, b in zip(keys, following))
    cover = np.cumsum(np.array([0, *sizes[: common - 1]], dtype=np.int64)[::-1])[::-1]
    ended = common == len(keys)
    return {
        "kind": [_SHARED] * common,
        "key": keys[:common],
        "n_convs": [0] * common,
        "n_children": [-1] * (common - 1) + [0],
        "n_leaves": [-1 if ended else 0] * common,
        "saved_tokens": cover.tolist(),
    }


class _Shard:
    """The nodes of one shard of distinct, sorted sequences."""

    def __init__(self, paths: list[bytes], sizes: np.ndarray, n: np.ndarray, conv: np.ndarray, ends: list[str]):
        starts = np.concatenate([[0], np.cumsum([len(p) // WIDTH for p in paths])])
        lengths = np.diff(starts)
        depth = np.arange(starts[-1]) - np.repeat(starts[:-1], lengths)
        codes = dense_codes(np.frombuffer(b"".join(paths), dtype=f"S{WIDTH}"), depth)
        trie = build(codes, starts)
        room = len(trie.check)
        self.n = np.zeros(room, np.int64)
        self.conv = np.full(room, np.iinfo(np.int64).max)
        self.children, self.leaves, self.saved = (np.zeros(room, np.int64) for _ in range(3))
        size, self.end = np.zeros(room, np.int64), np.full(room, -1)
        levels = []
        at, going = np.zeros(len(paths), np.int64), np.arange(len(paths))
        for d in range(int(lengths.max(initial=0)) + 1):
            slots, own = np.unique(at[going], return_inverse=True)
            levels.append(slots)
            np.add.at(self.n, at[going], n[going])
            np.minimum.at(self.conv, at[going], conv[going])
            if d:
                size[at[going]] = sizes[starts[going] + d - 1]
                np.add.at(self.children, trie.check[slots], 1)
            done = lengths[going] == d
            self.end[at[going[done]]] = going[done]
            going = going[~done]
            at[going] = trie.step(at[going], codes[starts[going] + d])
        for d in range(len(levels) - 1, -1, -1):
            slots = levels[d]
            self.leaves[slots] += self.children[slots] == 0
            self.saved[slots] += (self.n[slots] - 1) * size[slots]
            if d:
                np.add.at(self.leaves, trie.check[slots], self.leaves[slots])
                np.add.at(self.saved, trie.check[slots], self.saved[slots])
        self.trie, self.levels, self.ends = trie, levels, ends
        self.first = (_path_keys(paths[0]), sizes[: starts[1]].tolist())
        self.last = (_path_keys(paths[-1]), sizes[starts[-2] :].tolist())
        self.shared: dict[int, tuple[bytes, bytes | None]] = {}
        for i, (keys, _) in ((0, self.first), (len(paths) - 1, self.last)):
            slot = np.zeros(1, np.int64)
            self.shared[0] = (keys[0], None)
            for d, code in enumerate(codes[starts[i] : starts[i + 1]]):
                slot = trie.step(slot, np.array([code]))
                self.shared[int(slot[0])] = (keys[d + 1], keys[d])

    def _columns(self, slots: np.ndarray, depth: np.ndarray) -> dict:
        ended = self.end[slots]
        return {
            "conv_id": self.conv[slots], "depth": depth, "n_convs": self.n[slots], "n_children": self.children[slots],
            "n_leaves": self.leaves[slots], "saved_tokens": self.saved[slots],
            "ends": [self.ends[e] if e >= 0 else None for e in ended],
        }

    def rows(self, part: int) -> Iterator[pa.RecordBatch]:
        slots = np.concatenate(self.levels)
        depth = np.repeat(np.arange(len(self.levels)), [len(x) for x in self.levels])
        shared = np.isin(slots, np.array(list(self.shared)))
        up = self.trie.check[slots]
        under = ~shared & np.isin(up, np.array(list(self.shared)))
        for kind, chosen in ((_FINAL, ~shared & ~under), (_UNDER, under), (_SHARED, shared)):
            own, above = slots[chosen], up[chosen]
            if not len(own):
                continue
            columns = self._columns(own, depth[chosen]) | {"kind": [kind] * len(own)}
            if kind == _FINAL:
                columns["parent_conv_id"] = self.conv[above]
            elif kind == _UNDER:
                columns["parent_key"] = [self.shared[int(s)][0] for s in above]
            else:
                columns["key"], columns["parent_key"] = zip(*[self.shared[int(s)] for s in own])
            yield _rows(columns, len(own), part)


def _shard_rows(batches: Iterator[pa.RecordBatch], shard_turns: int) -> Iterator[pa.RecordBatch]:
    """All nodes of one partition's sorted sequences, shard by shard, and the partition's first and last path."""
    first = last = None
    part, held, turns = 0, [], 0

    def flush():
        nonlocal first, last, held, turns
        table = pa.Table.from_batches(held).combine_chunks()
        shard = _Shard(
            table["path"].to_pylist(), list_parts(table["sizes"])[0], table["n"].to_numpy(), table["conv"].to_numpy(),
            table["ends"].to_pylist(),
        )
        held, turns = [], 0
        yield from shard.rows(part)
        if last is not None:
            border = _border(last, shard.first[0])
            yield _rows(border, len(border["key"]), part)
        first, last = first or shard.first, shard.last

    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch["part"][0].as_py()
        held.append(batch)
        turns += len(list_parts(batch["sizes"])[0])
        if turns >= shard_turns:
            yield from flush()
    if held:
        yield from flush()
    if first is not None:
        cover = np.cumsum([0, *last[1]]).tolist()
        yield _rows({"kind": [_EDGE], "first_keys": [first[0]], "last_keys": [last[0]], "last_cover": [cover]}, 1, part)


_COLLAPSED = "path binary, sizes array<long>, n long, conv long, ends string"
_COLLAPSED_ARROW = pa.schema(
    [("path", pa.binary()), ("sizes", pa.list_(pa.int64())), ("n", pa.int64()), ("conv", pa.int64()), ("ends", pa.string())]
)


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per sequence from its sorted blocks of members; the digest runs over the blocks."""
    key = None
    for batch in batches:
        done: list[dict] = []
        for row in batch.to_pylist():
            if row["key"] != key:
                if key is not None:
                    done.append(now | {"ends": digest.hexdigest()})
                key, digest = row["key"], hashlib.sha256(row["members"].encode())
                now = {"path": row["path"], "sizes": row["sizes"], "n": row["n"], "conv": row["conv"]}
            else:
                digest.update(b"," + row["members"].encode())
                now["n"] += row["n"]
        if done:
            yield pa.RecordBatch.from_pylist(done, _COLLAPSED_ARROW)
    if key is not None:
        yield pa.RecordBatch.from_pylist([now | {"ends": digest.hexdigest()}], _COLLAPSED_ARROW)


def collapsed(convs: DataFrame) -> DataFrame:
    """One row per distinct sequence of (conv_id, turns): its path of hashes, sizes, members and their digest."""
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["hash"]), ""))
    paths = convs.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes"))
    key = F.unhex(F.substring(F.sha2("path", 256), 1, 2 * WIDTH))
    blocks = (
        paths.groupBy(key.alias("key"), F.shiftright("conv_id", MEMBER_BLOCK.bit_length() - 1).alias("block"))
        .agg(*[F.first(c).alias(c) for c in ("path", "sizes")], F.sort_array(F.collect_list("conv_id")).alias("m"))
        .select(
            "key", "block", "path", "sizes", F.size("m").cast("long").alias("n"), F.col("m")[0].alias("conv"),
            F.array_join("m", ",").alias("members"),
        )
    )
    return blocks.repartition("key").sortWithinPartitions("key", "block").mapInArrow(_collapse, _COLLAPSED)


def prefix_nodes(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of (conv_id, turns), as :func:`sequences` gives them.

    conv_id: smallest member; depth; parent_conv_id; n_convs; n_children;
    n_leaves; saved_tokens: over the subtree, members beyond the first
    times the UTF-8 bytes of the node's text; ends: SHA-256 hex of the
    comma-joined ids of members that end there (of nothing if none).
    A shard is cut after a batch that brings it to ``shard_turns`` turns.
    conv_id must be unique; conversations without turns are members of the
    root; no conversations give no nodes.
    """
    distinct = staged(collapsed(convs), "trie-sequences")
    ranged = distinct.repartitionByRange("path").sortWithinPartitions("path").withColumn("part", F.spark_partition_id())
    parts = staged(ranged.mapInArrow(partial(_shard_rows, shard_turns=shard_turns), _PARTS), "trie-parts")

    # Borders between partitions: one row a partition.
    edge = parts.where(F.col("kind") == _EDGE).withColumn("next", F.lead("first_keys").over(Window.orderBy("part")))
    edge = edge.where("next IS NOT NULL").withColumn("common", F.size(F.array_intersect("last_keys", "next")))
    shared = F.transform(
        F.slice("last_keys", F.lit(1), F.col("common")),
        lambda key, d: F.struct(
            key.alias("key"),
            F.when(d < F.col("common") - 1, -1).otherwise(0).alias("n_children"),
            F.when(F.size("last_keys") == F.col("common"), -1).otherwise(0).alias("n_leaves"),
            (
                F.element_at("last_cover", F.col("common")) - F.when(d > 0, F.element_at("last_cover", d)).otherwise(0)
            ).alias("saved_tokens"),
        ),
    )
    borders = edge.select(F.inline(shared)).withColumn("n_convs", F.lit(0))
    sums = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    upper = staged(
        parts.where(F.col("kind") == _SHARED)
        .select("key", "parent_key", "conv_id", "depth", "ends", *sums)
        .unionByName(borders, allowMissingColumns=True)
        .groupBy("key")
        .agg(
            *[F.max(c).alias(c) for c in ("parent_key", "depth", "ends")], F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in sums],
        ),
        "trie-upper",
    )
    columns = ["conv_id", "depth", "parent_conv_id", *sums, F.coalesce("ends", F.lit(_NO_MEMBERS)).alias("ends")]
    below = parts.where(F.col("kind") == _UNDER).select("parent_key", "conv_id", "depth", "ends", *sums)
    parents = upper.select(F.col("key").alias("pk"), F.col("conv_id").alias("parent_conv_id"))
    joined = below.unionByName(upper.drop("key")).join(parents, F.col("parent_key") == F.col("pk"), "left")
    return parts.where(F.col("kind") == _FINAL).select(*columns).unionByName(joined.select(*columns))
