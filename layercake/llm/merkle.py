"""Merkle manifest of a dataset by a nested-struct rollup.

Rows become leaves (:func:`leaf_digest`), ordered inside their group, and a
leaf's rank in base 16 is its path: one digit a level.  A *block* is the
256 leaves that share all but the last two digits.  Inside a block the
digit columns are grouped away one after the other; each step nests the
child structs, in digit order, under their parent's digest.  A block is one
row, so its size is bounded whatever the group's.  Blocks are the
leaves of the next pass, until each group is one node, its subroot; the
subroots, ordered by group, go through the same passes up to the root.

On the way down a block meets the proof of its own node (a union grouped by
block, no join), prolongs it through its nested structs with ``transform``
and emits one row a child with ``explode``.

Ranks come from a range partitioning: rows are sorted in ranges, and a
group's rows before a range are counted from one row per range and group.
So a group that holds a third of all rows is spread over many ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layercake.llm.common import prepare, staged

FANOUT = 16  # fixed by the tree's definition
DEPTH = 2  # levels nested in one block: at most FANOUT ** DEPTH leaves in a row
BITS = 4  # of a digit
HEX = 64  # characters of a digest

_PATH = "array<struct<left:string,right:string>>"


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 hex of the fields, each `-` if NULL, else its UTF-8 length, a colon and its text."""
    texts = [f.cast("string") for f in fields]
    encoded = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*encoded).cast("binary"), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf's digest and its proof lead to."""
    return F.aggregate(
        proof, leaf, lambda h, step: F.sha2(F.concat(step["left"], h, step["right"]).cast("binary"), 256)
    )


def proof_digest(proof: Column) -> Column:
    """SHA-256 hex of all sibling digests of a proof, level by level."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def ranked(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """Columns ``rank`` (from 0) and ``size`` within ``grp``; NULLs first, ties in any order among equal rows."""
    # The place in the written files parts rows that are equal in everything else, so that a range can end
    # between them; a file scan yields the same places when a task is repeated.
    keys = [F.col(c).asc_nulls_first() for c in ["grp", *order]] + [F.col("place").asc()]
    leaves = staged(leaves, "merkle-leaves").withColumn("place", F.monotonically_increasing_id())
    placed = staged(
        leaves.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()),
        "merkle-ranges",
    ).withColumn("part", F.shiftright("at", 33))
    spans = placed.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    group = Window.partitionBy("grp")  # at most one row per range
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        F.col("grp").alias("g"), F.col("part").alias("p"), F.sum("n").over(group).alias("size"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
    )
    same = F.col("grp").eqNullSafe(F.col("g")) & (F.col("part") == F.col("p"))
    return (
        placed.join(spans, same).withColumn("rank", F.col("at") + F.col("shift")).drop("g", "p", "part", "at", "shift", "place")
    )


def _levels(size: str) -> Column:
    """How often runs of 16 must be hashed until one node is left."""
    steps = F.lit(0)
    for level in range(15):  # 16 ** 15 nodes
        steps += (F.col(size) > F.lit(FANOUT**level)).cast("int")
    return steps


def _rollup(nodes: DataFrame, carry: Sequence[str]) -> DataFrame:
    """One row per block: (grp, block, size, node), its children nested by digit.

    A digit is grouped away as long as the group has more than one node at its level; beyond, a node passes through.
    """
    up = (
        nodes.withColumn("block", F.shiftright("rank", BITS * DEPTH))
        .withColumn("levels", _levels("size"))
        .repartition("grp", "block")  # groupings by more columns need no further exchange
        .withColumn("node", F.struct("digest", *carry))
    )
    for level in range(DEPTH):
        digits = [F.shiftright("rank", BITS * k).alias(f"d{k}") for k in range(level + 1, DEPTH)]
        child = F.struct(F.shiftright("rank", BITS * level).alias("digit"), "node")
        up = (
            up.groupBy("grp", "block", "size", "levels", *digits)
            .agg(F.sort_array(F.collect_list(child)).alias("kids"), F.min("rank").alias("rank"))
            .withColumn("kids", F.transform("kids", lambda k: k["node"]))
            .withColumn("joined", F.array_join(F.transform("kids", lambda k: k["digest"]), ""))
            .withColumn("hashed", F.col("levels") > level)
            .withColumn(
                "node",
                F.struct(
                    F.when(F.col("hashed"), F.sha2(F.col("joined").cast("binary"), 256))
                    .otherwise(F.col("joined")).alias("digest"),
                    F.when(F.col("hashed"), F.col("joined")).alias("joined"),
                    "kids",
                ),
            )
            .select("grp", "block", "size", "levels", *[f"d{k}" for k in range(level + 1, DEPTH)], "rank", "node")
        )
    return up.select("grp", "block", "size", "node")


def _descend(node: Column, path: Column, depth: int) -> Column:
    """Array of (leaf, path) below a nested node, each path from the leaf upwards."""

    def child(kid: Column, i: Column) -> Column:
        step = F.struct(
            F.substring(node["joined"], F.lit(1), i * HEX).alias("left"),
            F.substring(node["joined"], (i + 1) * HEX + 1, F.lit(FANOUT * HEX)).alias("right"),
        )
        longer = F.when(node["joined"].isNotNull(), F.concat(F.array(step), path)).otherwise(path)
        return F.array(F.struct(kid.alias("leaf"), longer.alias("path"))) if depth == 1 else _descend(kid, longer, depth - 1)

    return F.flatten(F.transform(node["kids"], child))


def _prove(nodes: DataFrame, carry: Sequence[str], above=None) -> DataFrame:
    """(grp, top, root, digest, carry..., path) of each node of a ranked table.

    ``top`` is its group's last node, ``path`` the siblings up to there or,
    with ``above`` (a function of the groups' tops that gives their own
    paths and the root), up to the root.
    """
    blocks = staged(_rollup(nodes, carry), "merkle-blocks")
    block = FANOUT**DEPTH
    none = F.lit(None).cast("string")
    if blocks.where(F.col("size") > block).isEmpty():  # one block a group
        own = F.col("node.digest")
        if above is None:
            paths = blocks.select("grp", "block", own.alias("top"), own.alias("root"), F.array().cast(_PATH).alias("path"))
        else:
            paths = above(blocks.select("grp", own.alias("digest"))).withColumn("block", F.lit(0).cast("long"))
    else:  # the blocks are the next pass's nodes
        higher = blocks.select(
            "grp", F.col("block").alias("rank"), F.expr(f"(size + {block - 1}) div {block}").alias("size"),
            F.col("node.digest").alias("digest"),
        )
        paths = _prove(higher, ["rank"], above).withColumnRenamed("rank", "block")
    met = (
        blocks.select("grp", "block", "node", none.alias("top"), none.alias("root"), F.lit(None).cast(_PATH).alias("path"))
        .unionByName(
            paths.select("grp", "block", F.lit(None).cast(blocks.schema["node"].dataType).alias("node"), "top", "root", "path")
        )
        .groupBy("grp", "block")
        .agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("node", "top", "root", "path")])
    )
    # Everything goes through the exploded struct: filters on columns beside it make the optimizer prune them wrongly.
    whole = F.transform(
        _descend(F.col("node"), F.col("path"), DEPTH), lambda e: F.struct("grp", "top", "root", e["leaf"].alias("leaf"), e["path"].alias("path"))
    )
    names = {c: f"e.{c}" for c in ("grp", "top", "root")} | {c: f"e.leaf.{c}" for c in ["digest", *carry]} | {"path": "e.path"}
    return met.select(F.explode(whole).alias("e")).select(*[F.col(place).alias(c) for c, place in names.items()])


def _over_groups(tops: DataFrame) -> DataFrame:
    """Paths from the groups' subroots up to the root: the groups, in order, are the nodes of one tree."""
    nodes = ranked(tops.select(F.lit(0).alias("grp"), F.col("grp").alias("name"), "digest"), ["name"])
    return _prove(nodes, ["name"]).select(F.col("name").alias("grp"), F.col("digest").alias("top"), "root", "path")


def proofs(leaves: DataFrame, group: str, order: Sequence[str], digest: str = "leaf") -> DataFrame:
    """Each row with ``subroot``, ``root`` and ``proof``: left and right siblings from the leaf up to the root.

    ``leaves`` holds one digest a row; all its columns are kept (so it
    should hold no texts), and none may be called subroot, root or proof.
    Groups are ordered NULL first, then bytewise; leaves by ``order``,
    NULLs first, then by digest.  Equal rows are leaves of their own, with
    equal digests and neighbouring places.  An empty table gives an empty
    result.
    """
    taken = {"subroot", "root", "proof"} & set(leaves.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} would be replaced")
    prepare(leaves.sparkSession)
    held = [c for c in leaves.columns if c != digest]
    keyed = leaves.select(
        F.col(f"`{group}`").alias("grp"), F.col(f"`{digest}`").alias("digest"),
        F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(held)]).alias("row"),
        *[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)],
    )
    places = ranked(keyed, [*[f"o{i}" for i in range(len(order))], "digest"])
    below = _prove(places.select("grp", "rank", "size", "digest", "row"), ["row"], _over_groups)
    back = {c: F.col(f"row.c{i}").alias(c) for i, c in enumerate(held)} | {digest: F.col("digest").alias(digest)}
    return below.select(
        *[back[c] for c in leaves.columns], F.col("top").alias("subroot"), "root", F.col("path").alias("proof")
    )
