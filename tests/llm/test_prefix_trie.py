"""The prefix trie against plain dictionaries, over shards of every size, with copies, ties and odd rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from layercake.llm import prefix_trie, queries

TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def _plain(convs):
    """Rows (COLUMNS..., ends) of {conv_id: [(role, text), ...]}."""
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(convs):
        turns = tuple(convs[c])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, own in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(own) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted(
        (
            min(own), len(node), min(members[node[:-1]]) if node else -1, len(own), children[node], leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
        )
        for node, own in members.items()
    )


def _got(nodes):
    return sorted((*[-1 if r[c] is None else r[c] for c in COLUMNS], r["ends"]) for r in nodes.collect())


def _frame(spark, convs):
    rows = [(c, t, *turn) for c, turns in convs.items() for t, turn in enumerate(turns)]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, TURNS)


def _sequences(spark, convs):
    return prefix_trie.sequences(_frame(spark, convs), "conv_id", "turn", "role", "text")


@pytest.mark.parametrize("shard_turns", [1, 20, 1 << 17])
@pytest.mark.parametrize("texts, batch", [(2, "1"), (4, "3"), (50, "1000")])
def test_nodes_equal_plain_dictionaries(spark, shard_turns, texts, batch):
    """Long shared prefixes, sequences that are prefixes of others, groups of copies; shards cut anywhere."""
    rng = random.Random(texts)
    words = [("user", "é" * rng.randint(0, 5) + str(i)) for i in range(texts)]
    convs = {c: [rng.choice(words) for _ in range(rng.randint(1, 7))] for c in range(-20, 150)}
    stem = [words[0], words[1]] * 6
    convs |= {1000 + c: stem[: rng.randint(5, 12)] + [rng.choice(words) for _ in range(rng.randint(0, 3))] for c in range(150)}
    convs |= {10_000 * c: stem for c in range(1, 60)}  # copies over many blocks of members
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert _got(prefix_trie.prefix_nodes(_sequences(spark, convs), shard_turns)) == _plain(convs)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_double_array_walks_only_its_own_sequences():
    """BASE and CHECK accept exactly the prefixes that were packed, with many children and lone ones."""
    rng = np.random.default_rng(5)
    seqs = sorted({tuple(rng.integers(1, 400, size=rng.integers(0, 6)) // rng.integers(1, 30) + 1) for _ in range(3000)})
    starts = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    trie = prefix_trie.build(np.concatenate([np.array(s, dtype=np.int64) for s in seqs]), starts)
    prefixes = {s[:d] for s in seqs for d in range(len(s) + 1)}
    slots = {(): 0}
    for p in sorted(prefixes, key=len)[1:]:
        slots[p] = int(trie.step(np.array([slots[p[:-1]]]), np.array([p[-1]]))[0])
    assert -1 not in slots.values() and len(set(slots.values())) == len(prefixes)
    for p in list(slots)[::7]:
        codes = np.arange(0, 500)
        to = trie.step(np.full(len(codes), slots[p]), codes)
        assert {int(c) for c in codes[to >= 0]} == {q[-1] for q in prefixes if len(q) == len(p) + 1 and q[:-1] == p}


def test_odd_rows(spark):
    """NULLs, empty and very long texts, repeated rows, equal turns, no conversation, extra columns."""
    rows = [
        (1, None, "user", "first"), (1, 0, None, None), (1, 1, "", ""), (2, 0, "user", "first"), (2, 5, None, ""),
        (3, 0, "user", "x" * 300_000), (3, 0, "user", "x" * 300_000), (None, 0, "user", "lost"), (4, 7, "a", "b"),
        (5, 7, "ab", ""), (6, 1, "t", "1"), (6, 1, "t", "2"), (7, 1, "t", "2"), (7, 1, "t", "1"),
    ]
    frame = spark.createDataFrame([(*r, "e", 1) for r in rows], TURNS + ", turns string, hash int")
    nodes = prefix_trie.prefix_nodes(prefix_trie.sequences(frame, "conv_id", "turn", "role", "text"))
    convs = {
        1: [("user", "first"), ("", ""), ("", "")], 2: [("user", "first"), ("", "")], 3: [("user", "x" * 300_000)] * 2,
        4: [("a", "b")], 5: [("ab", "")],
    }
    for order in ("12", "21"):  # equal turns have one order
        want = _plain(convs | {6: [("t", t) for t in order], 7: [("t", t) for t in order]})
        if _got(nodes) == want:
            break
    else:
        raise AssertionError(_got(nodes))


def test_no_rows_and_no_turns(spark):
    frame = spark.createDataFrame([], TURNS)
    assert prefix_trie.prefix_nodes(prefix_trie.sequences(frame, "conv_id", "turn", "role", "text")).collect() == []
    empty = spark.createDataFrame([(4, []), (-2, [])], "conv_id long, turns array<struct<hash:string,size:long>>")
    assert _got(prefix_trie.prefix_nodes(empty)) == _plain({4: [], -2: []})


def test_query_rebuilds_conversations(spark, tmp_path):
    """Shared first turns, absent and short bases, turnless results."""
    rng = random.Random(9)
    convs = {c: [("user" if t % 2 == 0 else "assistant", f"{c} {t}") for t in range(rng.randint(1, 9))] for c in range(0, 90) if c % 7 != 3}
    path = str(tmp_path)
    _frame(spark, convs).write.parquet(path + "/conversations.parquet")
    rebuilt = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    got = queries.QUERIES["op11_prefix_trie"](spark, path).withColumnRenamed("ends_sha256", "ends")
    assert _got(got) == _plain(rebuilt)
