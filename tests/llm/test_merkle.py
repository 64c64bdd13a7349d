"""The Merkle manifest against a plain tree, with odd rows and groups of more than one block."""

from __future__ import annotations

import hashlib
import itertools
import zlib

import pytest
from pyspark.sql import functions as F

from layercake.llm import merkle, queries

DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row):
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def _tree(leaves):
    """The root, and each leaf's (left, right) siblings from below."""
    level, paths, place = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for i, p in enumerate(place):
            a = p - p % 16
            paths[i].append(("".join(level[a:p]), "".join(level[p + 1 : a + 16])))
            place[i] = p // 16
        level = [_h(*level[a : a + 16]) for a in range(0, len(level), 16)]
    return level[0], paths


def _plain(rows):
    """Per row (doc_id, leaf, subroot, root, proof): sources NULL first, then bytewise; documents NULL first."""
    key = lambda r: (r[1] is not None, (r[1] or "").encode())
    out, tops = [], []
    for _, group in itertools.groupby(sorted(rows, key=key), key=key):
        group = sorted(group, key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        top, paths = _tree([_leaf(r) for r in group])
        tops.append(top)
        out += [(r, top, p, len(tops) - 1) for r, p in zip(group, paths)]
    root, upper = _tree(tops)
    return root, [(r[0], _leaf(r), top, p + upper[g]) for r, top, p, g in out]


def _leaves(frame):
    return frame.select("doc_id", "source", merkle.leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]).alias("leaf"))


@pytest.mark.parametrize("sizes", [[1], [2, 16], [17, 1, 300], [5000, 3, 256, 257, 16]])
def test_proofs_equal_a_plain_tree(spark, sizes):
    rows = [(g * 10_000 + i, f"s{g}", "en", i, f"text {i}") for g, n in enumerate(sizes) for i in range(n)]
    got = merkle.proofs(_leaves(spark.createDataFrame(rows, DOCS)), "source", ["doc_id"]).collect()
    root, want = _plain(rows)
    assert {r["root"] for r in got} == {root}
    assert sorted((r["doc_id"], r["leaf"], r["subroot"], [tuple(s) for s in r["proof"]]) for r in got) == sorted(want)


def test_many_sources(spark):
    rows = [(i, f"{i:04d}é" if i % 3 else f"{i:04d}z", None, None, None) for i in range(700)]
    got = merkle.proofs(_leaves(spark.createDataFrame(rows, DOCS)), "source", ["doc_id"]).collect()
    root, want = _plain(rows)
    assert sorted((r["doc_id"], r["root"], [tuple(s) for s in r["proof"]]) for r in got) == sorted((i, root, p) for i, _, _, p in want)


def test_odd_rows(spark):
    """NULLs anywhere, empty and long texts, repeated rows and ids are leaves of their own."""
    rows = [
        (None, None, None, None, None), (None, "a", "en", 1, ""), (1, None, "en", 0, "x"), (1, "a", None, 2, "É" * 200_000),
        (1, "a", "en", 3, "tie"), (1, "a", "en", 3, "tie"), (2, "", "en", 4, "A"), (2, "a", "en", 4, "- 1:"), (-5, "Z", "en", 4, "A"),
    ]
    root, want = _plain(rows)
    got = merkle.proofs(_leaves(spark.createDataFrame(rows, DOCS)), "source", ["doc_id"]).collect()
    key = lambda r: (str(r[0]), *r[1:])
    assert sorted(((r["doc_id"], r["leaf"], r["subroot"], [tuple(s) for s in r["proof"]]) for r in got), key=key) == sorted(want, key=key)
    assert {r["root"] for r in got} == {root}


def test_folding_finds_a_changed_leaf(spark):
    rows = [(i, "s", "en", 1, "Text") for i in range(40)]
    proven = merkle.proofs(_leaves(spark.createDataFrame(rows, DOCS)), "source", ["doc_id"])
    other = F.sha2(F.lit("other").cast("binary"), 256)
    told = F.when(F.col("doc_id") == 7, other).otherwise(F.col("leaf"))
    bad = proven.where(merkle.fold(told, F.col("proof")) != F.col("root")).select("doc_id").collect()
    assert [r["doc_id"] for r in bad] == [7]


def test_empty_table_extra_and_clashing_columns(spark):
    empty = merkle.proofs(_leaves(spark.createDataFrame([], DOCS)), "source", ["doc_id"])
    assert empty.count() == 0 and empty.columns == ["doc_id", "source", "leaf", "subroot", "root", "proof"]
    rows = spark.createDataFrame([(1, "s", "x", 5)], "doc_id long, source string, `row.rank` string, grp long")
    frame = rows.withColumn("leaf", F.sha2(F.lit("a").cast("binary"), 256)).withColumnRenamed("leaf", "digest")
    got = merkle.proofs(frame, "source", ["doc_id"], digest="digest").collect()[0]
    assert (got["row.rank"], got["grp"], got["subroot"], got["proof"]) == ("x", 5, _h("a"), [])
    with pytest.raises(ValueError):
        merkle.proofs(frame.withColumn("root", F.lit(1)), "source", ["doc_id"], digest="digest")


def test_query_verifies_all_but_tampered(spark, tmp_path):
    rows = [(i, "s", "en", 1, "Text" if i % 2 else "text") for i in range(60)]
    frame = spark.createDataFrame(rows, DOCS).withColumn("leaf", F.lit("clash")).withColumn("x.y", F.lit(1))
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["verified"] for r in queries.QUERIES["op13_merkle_manifest"](spark, str(tmp_path)).collect()}
    assert got == {i: not (i % 2 and zlib.crc32(str(i).encode()) % 5 == 0) for i in range(60)}
