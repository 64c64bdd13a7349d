"""Line batches in descending order, odd columns of the line dedup, and tokenizers of any kind."""

from __future__ import annotations

import json
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from layercake.llm import bpe, line_dedup

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _lines(rows, min_chars, min_docs):
    """(n_lines, n_dropped, text) of each (doc_id, text), from the definition."""
    key = lambda line: "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    gone = {k: max(ids) for k, ids in holders.items() if len(ids) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or gone.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_lines_equal_the_definition_whatever_the_batches(spark, batches):
    """Repeated rows and ids, NULL ids, ids that are equal or far apart, frequent lines first and last."""
    rng = random.Random(8)
    pool = [f"line {i} " + "x" * rng.randint(0, 12) for i in range(25)]
    rows = [(rng.choice([i, 5, -(10**12), None, i * 10**9]), "\n".join(rng.choices(pool, k=rng.randint(1, 8)))) for i in range(80)]
    rows += [(3, None), (4, ""), (4, "  LINE 1 xxxx \nline 1 xxxx")] + rows[:5]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    got = line_dedup.drop_repeated_lines(docs, min_chars=8, min_docs=4, batches=batches)
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got.collect()), key=repr) == _lines(rows, 8, 4)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_runs_")]


def test_a_lines_keeper_is_the_first_that_the_runs_do_not_hold(spark):
    store = line_dedup.LineRuns(spark, fanout=2, buckets=3)
    batches = [spark.createDataFrame(b, "hash binary, doc_id long") for b in ([(b"a", 9), (b"a", 8), (b"b", 7)], [(b"a", 6), (b"c", 5)], [(b"c", 2), (b"b", 1)])]
    kept = line_dedup.keepers(batches[0].limit(0).union(batches[0]), store, batches)
    assert {(bytes(r["hash"]), r["keeper"]) for r in kept.collect()} == {(b"a", 9), (b"b", 7), (b"c", 5)}
    store.close()


def test_lines_pass_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a\nb", "en", "s", 3)], DOCS)
    wide = docs.select("*", F.lit("v").alias("a.b"), F.lit("w").alias("_kept"), F.lit(7).alias("n_lines"))
    got = line_dedup.drop_repeated_lines(wide).first()
    assert (got["a.b"], got["_kept"], got["n_lines"], got["text"]) == ("v", "w", 2, "a\nb")
    assert line_dedup.drop_repeated_lines(wide.limit(0)).collect() == []


TEXTS = ["", "one two  three\n\n it's 42nd—été 日本語  x", "  lead", "a" * 50, "don't you'll 3.14!!\t\r\n end ", "word " * 400]


@pytest.mark.parametrize("pattern", [r"[\s\S]{1,4}", r"\S+\s*", r"\p{L}+|\P{L}+", public_tokenizers.PATTERN])
def test_any_pattern_gives_the_librarys_ids(pattern):
    """Chunks are cut only where a pattern is proven to allow it."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coder = bpe.encoder(path, pattern)
    assert coder.chunks == (pattern == public_tokenizers.PATTERN)
    plain = bpe.from_ranks(path, pattern)[0]
    ids, begin = coder.encode(pa.array(TEXTS))
    want = [plain.encode(t, add_special_tokens=False).ids for t in TEXTS]
    assert [ids[a:b].tolist() for a, b in zip(begin[:-1], begin[1:])] == want


@pytest.mark.parametrize("change", ["none", "prefix space", "no regex", "digits", "normalizer"])
def test_any_byte_level_file_gives_the_librarys_ids(tmp_path, change):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        whole = json.load(file)
    if change == "prefix space":
        whole["pre_tokenizer"]["add_prefix_space"] = True
    if change == "no regex":
        whole["pre_tokenizer"]["use_regex"] = False
    if change == "digits":
        whole["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "Digits", "individual_digits": True}, whole["pre_tokenizer"]]}
    if change == "normalizer":
        whole["normalizer"] = {"type": "Lowercase"}
    path = str(tmp_path / "t.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(whole, file)
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    coder = bpe.encoder(path)
    assert coder.chunks == (change == "none")
    ids, begin = coder.encode(pa.array(TEXTS))
    assert [ids[a:b].tolist() for a, b in zip(begin[:-1], begin[1:])] == [plain.encode(t, add_special_tokens=False).ids for t in TEXTS]


def test_encoding_passes_repeated_rows_and_dotted_columns(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = spark.createDataFrame([(1, "hi there", "v")] * 3 + [(None, None, None)], "doc_id long, text string, x string").withColumnRenamed("x", "a.b")
    got = bpe.decode_ids(bpe.encode_texts(docs, path, public_tokenizers.PATTERN), path, public_tokenizers.PATTERN).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"], bytes(r["decoded"]), r["a.b"] or "") for r in got) == [(0, 0, b"", "")] + [(1, 2, b"hi there", "v")] * 3
    assert np.frombuffer(got[0]["ids"], "<u4").size == 2
