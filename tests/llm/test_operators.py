"""The training-data operators against brute force, on small tables with NULLs, ties, repeats and clashing columns."""

from __future__ import annotations

import hashlib
import itertools
import os
import re
import tempfile
import tracemalloc
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from layercake.llm import ann, bpe, line_dedup, near_dedup, packing, quality, queries, stages, toxicity, url_filter, vector_dedup, warc
from tests.conftest import SF_CHECK, SF_SMALL

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{i}" for i in range(400)]


def _docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in zip(ids, texts)], DOCS)


def _crc_not(folds, held, i):
    return zlib.crc32(str(i).encode()) % folds != held


# 1 near-duplicates


def _shingles(text):
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def _components(n, linked):
    label = list(range(n))
    for _ in range(n):
        for a, b in linked:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_near_duplicates_match_brute_force(spark):
    rng = np.random.default_rng(1)
    texts = [None, "", " \t\n ", "one two", "ONE  two", "É É", "é é", "x" * 100_000]
    for _ in range(12):
        base = list(rng.choice(WORDS, size=int(rng.integers(20, 150))))
        texts.append(" ".join(base))
        for edits in (0, 1, 2, 5, 9):
            copy = base.copy()
            for at in rng.choice(len(base), size=edits, replace=False):
                copy[at] = "new"
            texts.append(" ".join(copy))
    got = {r["doc_id"]: r for r in near_dedup.near_duplicates(_docs(spark, texts)).collect()}
    sets = [_shingles(t) for t in texts]
    linked = [
        (a, b) for a, b in itertools.combinations(range(len(texts)), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    want = _components(len(texts), linked)
    assert [got[i]["component_id"] for i in range(len(texts))] == want
    assert [got[i]["n_shingles"] for i in range(len(texts))] == [len(s) for s in sets]
    assert all(got[i]["kept"] == (want[i] == i) for i in got)


def test_large_group_of_near_copies_is_cut_into_blocks(spark):
    rng = np.random.default_rng(2)
    base = list(rng.choice(WORDS, size=200))
    texts = []
    for i in range(2 * near_dedup.BLOCK_IDS + 20):
        copy = base.copy()
        copy[int(rng.integers(200))] = f"own{i}"
        texts.append(" ".join(copy))
    got = near_dedup.near_duplicates(_docs(spark, texts)).collect()
    assert {r["component_id"] for r in got} == {0} and len(got) == len(texts)


def test_overlaps_agree_whichever_way_they_are_counted():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 300, size=200)).astype(np.uint64) for _ in range(60)]
    left, right = np.arange(30), np.arange(30, 60)
    x, y = (z.ravel() for z in np.meshgrid(left, right, indexing="ij"))
    got = near_dedup._overlaps(sets, left, right, x, y)
    assert got.tolist() == [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(x, y)]
    assert near_dedup._overlaps(sets, left, right, x[:2], y[:2]).tolist() == got[:2].tolist()


def test_near_duplicates_of_odd_rows(spark):
    long = " ".join(WORDS[:50])
    rows = _docs(spark, [long, long, None, long, "a b c"], ids=[7, 7, None, None, 3]).withColumn("component_id", F.lit("x")).withColumn("sig", F.lit(1))
    got = sorted((r["doc_id"] or -1, r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(rows).collect() if r["n_shingles"])
    assert got == [(-1, 7, False), (3, 3, True), (7, 7, True), (7, 7, True)]
    assert near_dedup.near_duplicates(rows.limit(0)).count() == 0


# 2 lines


def test_lines_match_brute_force_and_pass_other_columns(spark):
    line = "This Line is shared by MANY documents of the corpus"
    texts = [f"own {i}\n  {line if i % 2 else line.upper()}\t\nshort\n" for i in range(6)] + [None, "", line + "\n" + line, "x\n" * 2000]
    docs = _docs(spark, texts).withColumn("pos", F.lit(5)).withColumn("hash", F.lit("h"))
    got = {r["doc_id"]: r for r in line_dedup.drop_repeated_lines(docs, batches=3).collect()}
    assert got[8]["text"] == line + "\n" + line and got[8]["n_dropped"] == 0  # the largest holder keeps all
    for i in range(6):
        assert (got[i]["text"], got[i]["n_lines"], got[i]["n_dropped"]) == (f"own {i}\nshort\n", 4, 1)
    assert (got[6]["text"], got[6]["n_lines"]) == ("", 1) and got[7]["text"] == ""
    assert got[9]["text"] == "x\n" * 2000 and got[0]["pos"] == 5 and got[0]["hash"] == "h"
    assert line_dedup.drop_repeated_lines(docs.limit(0)).count() == 0


def test_line_runs_compact_and_anti_join(spark):
    store = line_dedup.LineRuns(spark, fanout=2, buckets=4)
    schema = "hash binary, n_docs long"
    for batch in ([(b"a", 2), (b"b", 1)], [(b"a", 1)], [(b"c", 1)], [(b"a", 4)], [(b"c", 2)]):
        store.add(spark.createDataFrame(batch, schema))
    assert {(bytes(r["hash"]), r["n_docs"]) for r in store.totals().collect()} == {(b"a", 7), (b"b", 1), (b"c", 3)}
    assert sum(map(len, store.levels)) < 5
    new = store.unseen(spark.createDataFrame([(b"a", 9), (b"z", 9)], "hash binary, doc_id long")).collect()
    assert [bytes(r["hash"]) for r in new] == [b"z"]
    plan = store.totals()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    store.close()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_runs_")]


# 3 and 6 vectors


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_nearest_neighbours_reach_recall(spark):
    rows = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet")
    table = rows.toPandas().sort_values("vec_id")
    e, ids = np.stack(table["embedding"]).astype(np.float64), table["vec_id"].to_numpy()
    got = ann.nearest(rows, rows.where("vec_id % 20 = 0")).toPandas()
    hits = []
    for q, g in got.groupby("query_id"):
        score = e @ e[np.searchsorted(ids, q)]
        order = [i for i in ids[np.lexsort((ids, -score))] if i != q][:20]
        assert g.sort_values("rank")["rank"].tolist() == list(range(1, 21))
        hits.append(len(set(order) & set(g["vec_id"])) / 20)
    assert len(hits) == (ids % 20 == 0).sum() and np.mean(hits) >= 0.9


@pytest.mark.parametrize("kind", ["mixed norms", "one outlier", "384 dimensions"])
def test_nearest_neighbours_reach_recall_on_other_tables(spark, kind):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3000, 384 if kind == "384 dimensions" else 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    if kind == "mixed norms":
        x *= rng.lognormal(sigma=1.0, size=len(x))[:, None]
    if kind == "one outlier":
        x[1] *= 10
    x = x.astype(np.float32).astype(np.float64)
    rows = _vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)])
    got = ann.nearest(rows, rows.where("vec_id % 20 = 0")).toPandas()
    hits = []
    for q, g in got.groupby("query_id"):
        score = x @ x[q]
        order = [i for i in np.lexsort((np.arange(len(x)), -score)) if i != q][:20]
        hits.append(len(set(order) & set(g["vec_id"])) / 20)
    assert len(hits) == 150 and np.mean(hits) >= 0.98 and min(hits) >= 0.5


def test_nearest_neighbours_meet_in_bounded_blocks(spark, monkeypatch):
    rng = np.random.default_rng(13)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[500:900] = x[500]  # many rows of one code
    rows = _vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)])
    want = [tuple(r) for r in ann.nearest(rows, rows, k=5, radius=ann.BITS).orderBy("query_id", "rank").collect()]
    seen = tempfile.mkdtemp(prefix="layercake-test-")
    runs = ann.runs

    def watched(batches, keys):
        for group in runs(batches, keys):
            asks = int(np.sum(group["is_query"].to_numpy()))
            open(f"{seen}/{asks}_{group.num_rows - asks}_{uuid.uuid4().hex}", "w").close()
            yield group

    for name, value in (("TASK_ROWS", 200), ("TASK_QUERIES", 100), ("TILE", 64), ("runs", watched)):
        monkeypatch.setattr(ann, name, value, raising=False)
    for radius in (31, ann.BITS):
        got = [tuple(r) for r in ann.nearest(rows, rows, k=5, radius=radius).orderBy("query_id", "rank").collect()]
        assert [r[:3] for r in got] == [r[:3] for r in want] or radius < ann.BITS
        assert len(got) == 7500
    sizes = [tuple(map(int, name.split("_")[:2])) for name in os.listdir(seen)]
    assert sizes and max(a for a, _ in sizes) <= 160 and max(b for _, b in sizes) <= 300


def test_centre_distances_stay_small_whatever_the_number_of_cells():
    centres = np.random.default_rng(14).normal(size=(700, 32))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([0, 1]), pa.array([1, 1]), pa.array(centres[:2].tolist())], names=["vec_id", "weight", "vec"]
    )
    tracemalloc.start()
    out = list(vector_dedup._assign(32, centres, 0.9)(iter([batch])))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert out[0].num_rows >= 2 and peak < 10 << 20  # all pairs of centres times 32 numbers are 125 MB


def test_nearest_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(100, None, 0), (101, [0.0] * 3, 0), (102, [1.0, nan, 0.0], 0), (103, [1.0, None, 0.0], 0), (104, [inf, 0.0, 0.0], 0), (105, [1.0], 0), (None, [1.0, 0.0, 0.0], 0)]
    good = [(0, [1.0, 0.0, 0.0], 0), (3, [2.0, 0.0, 0.0], 0), (2, [2.0, 0.0, 0.0], 0), (2, [2.0, 0.0, 0.0], 0), (1, [0.0, 1.0, 0.0], 0)]
    rows = _vectors(spark, bad + good).withColumn("code", F.lit("clash"))
    got = [tuple(r) for r in ann.nearest(rows, rows.where("vec_id % 20 = 0"), k=20).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 2, 2.0), (0, 2, 3, 2.0), (0, 3, 1, 0.0)]
    assert ann.nearest(rows.limit(0), rows.limit(0)).count() == 0


def test_vector_groups_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "CELL_ROWS", 40)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(120, 8))
    x = np.concatenate([x, x[:40] + 0.15 * rng.normal(size=(40, 8)), 3 * x[:5], x[:5]]).astype(np.float32).astype(np.float64)
    rows = _vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(900, None, 0), (901, [0.0] * 8, 0), (902, [float("nan")] * 8, 0)])
    got = {r["vec_id"]: r for r in vector_dedup.near_duplicates(rows).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    linked = u @ u.T >= 0.9
    np.fill_diagonal(linked, False)
    label = _components(len(x), list(zip(*np.nonzero(linked))))
    for i in range(len(x)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (linked[i].sum(), label[i], label[i] == i)
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (900, 901, 902))
    assert vector_dedup.near_duplicates(rows.limit(0)).count() == 0


# 4 urls


def test_url_rules_and_propagation(spark):
    def page(i, url, *hosts):
        return (i, url, "".join(f'<a class=x href="//{h}/p">' for h in hosts))

    rows = [
        page(0, "https://Good.Example.NET/en/1?x"), page(1, "http://bad.net/x"), page(2, "http://linker.com/", "bad.net", "bad.net"),
        page(3, "http://liked.com#f", "liked.com"), page(4, "http://good.example.net/en/", "liked.com"), page(5, "no host"), (6, None, None),
        page(7, "http://a.example.com/de/x"), page(8, "http://notexample.com/de/x"), page(9, "http://x.org/fr/"), page(10, "http://evilnet/"),
    ]
    pages = spark.createDataFrame(rows + rows[6:7], "page_id long, url string, html string").withColumn("rank", F.lit(1))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(pages, queries.URL_RULES).collect()}
    assert got[0] == ("good.example.net", "/en/1", "example.net/en/", "allow")
    assert got[1] == ("bad.net", "/x", "net/", "block")
    assert got[2] == ("linker.com", "/", None, "block")  # links to a blocked host
    assert got[3] == ("liked.com", "", None, "allow")
    assert got[5] == got[6] == ("", "", None, "allow")
    assert got[7][2:] == ("example.com/de/", "block") and got[8][2] is None
    assert got[9][2:] == ("org/fr/", "allow") and got[10][2] is None
    assert url_filter.judge(pages.limit(0), queries.URL_RULES).count() == 0


def test_copies_of_a_link_graph_get_the_same_verdicts(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "TOLERANCE", 1e-3)

    def verdicts(copies):
        links = [
            (f"{host}{i}.com", f"{to}{i}.{'net' if to == 'bad' else 'com'}")
            for i in range(copies) for host, to in (("a", "bad"), ("b", "a"), ("c", "b"), ("d", "c"))
        ]
        rows = [(f"http://{host}/", f'<a href="http://{to}/">') for host, to in links] + [(f"http://bad{i}.net/", "") for i in range(copies)]
        pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
        return {(r["host"][0], r["verdict"]) for r in url_filter.judge(pages, queries.URL_RULES).collect()}

    one = verdicts(1)
    assert {v for _, v in one} == {"block"} and verdicts(1500) == one


# 5 and 9 classifiers


def _held_out_accuracy(spark, rows, column, folds, held):
    labels = {r["doc_id"]: r[column] for r in spark.read.parquet(f"{SF_CHECK}/labels.parquet").collect()}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] != _crc_not(folds, held, r["doc_id"]) for r in rows)
    test = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    return np.mean([r["predicted"] == labels[r["doc_id"]] for r in test])


def test_toxicity_on_held_out_documents(spark):
    rows = queries.op5_toxicity(spark, SF_CHECK).collect()
    assert _held_out_accuracy(spark, rows, "toxic", 4, 2) >= 0.85


def test_quality_on_held_out_documents(spark):
    rows = queries.op9_quality(spark, SF_CHECK).collect()
    assert _held_out_accuracy(spark, rows, "quality", 5, 0) >= 0.95


@pytest.mark.parametrize("module,column", [(toxicity, "toxic"), (quality, "quality")])
def test_classifiers_on_odd_tables(spark, module, column):
    docs = _docs(spark, [None, "", "a", "word " * 300_000, "same", "same"], ids=[0, 1, 2, 3, 4, 4]).withColumn("n", F.lit("clash"))
    for label in ([], [(2, 1), (4, 0), (None, 1), (99, 7)]):
        labels = spark.createDataFrame(label, f"doc_id long, {column} int")
        model = module.train(docs, labels)
        rows = module.score(docs, model).collect()
        assert len(rows) == 6 and all(0 <= r[-1] <= 1 for r in rows) and rows[0]["n"] == "clash"
        assert module.score(docs.limit(0), model).count() == 0


def _random_toxicity(spark):
    rng = np.random.default_rng(9)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    texts = ["".join(rng.choice(letters, size=4000)) for _ in range(60)]
    docs = _docs(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    return docs, labels, texts


def test_every_ngram_keeps_its_ratio_and_unseen_ones_back_off(spark, monkeypatch):
    docs, labels, texts = _random_toxicity(spark)
    tables = {}
    ratios = toxicity.ratios
    monkeypatch.setattr(toxicity, "ratios", lambda counts: tables.update(ratios(counts)) or tables)
    model = toxicity.train(docs, labels)
    exact = {name: {r["code"]: r["ratio"] for r in frame.collect()} for name, frame in tables.items()}
    new = "".join(np.random.default_rng(10).choice(list("abcdefghijklmnopqrstuvwxyz"), size=20_000))
    for text in (new, texts[0], texts[1]):
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        want = [
            exact["gram"][g] if g in exact["gram"] else exact["context"].get(g >> 8, 0.0) + exact["low"].get(g & 0xFFFFFFFF, 0.0)
            for g in toxicity.grams(data).tolist()
        ]
        assert np.allclose(model._ratios(data), want, atol=1e-5)


def test_toxicity_scores_alike_by_broadcast_and_by_join(spark, monkeypatch):
    docs, labels, _ = _random_toxicity(spark)
    odd = _docs(spark, ["", "x", "a", "word " * 300_000], ids=[None, 7, 7, 900]).unionByName(docs).withColumn("block", F.lit("clash"))
    want = sorted(tuple(r) for r in toxicity.score(odd.na.fill({"doc_id": -1}), toxicity.train(docs, labels)).collect())
    monkeypatch.setattr(toxicity, "TABLE_KINDS", 0)
    monkeypatch.setattr(toxicity, "BLOCK_BYTES", 1 << 16)
    model = toxicity.train(docs, labels)
    got = sorted(tuple(r) for r in toxicity.score(odd.na.fill({"doc_id": -1}), model).collect())
    assert model.stored is not None and [r[:2] for r in got] == [r[:2] for r in want]
    assert np.allclose([r[-1] for r in got], [r[-1] for r in want], atol=1e-6)
    assert toxicity.score(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("toxic", [1, 2, 5])
def test_few_toxic_labels_still_tell_texts_apart(spark, toxic):
    # Ids whose xxhash64 is no multiple of 8: none of the toxic documents is in a slice by that hash.
    free = [r["id"] for r in spark.range(400).where("pmod(xxhash64(id), 8) <> 0 AND crc32(CAST(CAST(id AS STRING) AS BINARY)) % 4 <> 2").collect()]
    bad, seen = free[:toxic], set(free[:toxic])
    rng = np.random.default_rng(12)
    texts = [" ".join(rng.choice(WORDS, size=40)) + (" vile hateful slur" if i in seen else "") for i in range(400)]
    docs = _docs(spark, texts + [" ".join(rng.choice(WORDS, size=40)) + " vile hateful slur"])
    model = toxicity.train(docs, spark.createDataFrame([(i, int(i in seen)) for i in range(400)], "doc_id long, toxic int"))
    score = {r["doc_id"]: r["toxicity"] for r in toxicity.score(docs, model).collect()}
    ordinary = [score[i] for i in range(400) if i not in seen]
    assert min(score[i] for i in [*bad, 400]) > max(ordinary)
    assert score[400] >= 0.3 and np.mean(np.array(ordinary) >= 0.3) <= 0.05


def test_long_texts_measure_alike_in_pieces():
    import pyarrow as pa

    rng = np.random.default_rng(6)
    model = toxicity.Model(
        rng.normal(size=1 << 22).astype(np.float32), np.zeros(1 << 20, np.float32), np.zeros(1 << 20, np.float32),
        np.zeros(16, np.float32), np.zeros(4), 0.5,
    )
    text = " ".join(rng.choice(WORDS, size=600_000))
    peak, mean, _, n = model.measures(pa.array(["x", text, "short text here"]))
    v = model._ratios(np.frombuffer(text.encode() + b"\n", dtype=np.uint8))
    upto = np.concatenate([[0], np.cumsum(v)])
    assert n[1] == len(v) and abs(mean[1] - v.mean()) < 1e-9
    assert abs(peak[1] - (upto[12:] - upto[:-12]).max() / 12) < 1e-9


# 7 and 8 tokens

ODD = ["", " ", "  a  b ", "a  b \n\nc", "x　 y", "it's we'll I'D !'s", "\x1c\x1d a", "é  é\u0085 \u0085x", "a" * 5000, " \n \n  x",
       "\U0001f600\U0001f600 \U0001f469‍\U0001f469", "<|endoftext|> x", "1 22  333a", "​ a   b", "nul\0nul x\0", None]


def test_encoding_matches_the_libraries(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    docs = _docs(spark, ODD).withColumn("decoded", F.lit("clash"))
    rows = bpe.decode_ids(bpe.encode_texts(docs, path, public_tokenizers.PATTERN, offsets=True), path, public_tokenizers.PATTERN).collect()
    for r in rows:
        text = ODD[r["doc_id"]] or ""
        ids = np.frombuffer(r["ids"], dtype="<u4").tolist()
        assert ids == own.encode_ordinary(text) and r["n_tokens"] == len(ids)
        assert bytes(r["decoded"]) == text.encode()
        assert r["byte_offsets"][-1] == len(text.encode()) and r["char_offsets"][-1] == len(text)
    assert bpe.encode_texts(docs.limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_query_of_whole_texts(spark):
    own = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")),
    )
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in queries.op7_bpe_roundtrip(spark, SF_SMALL).collect():
        ids = np.array(own.encode_ordinary(texts[r["doc_id"]]), dtype="<u4")
        assert r["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_packing_keeps_every_token_once(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    rng = np.random.default_rng(8)
    texts = ODD + [" ".join(rng.choice(WORDS, size=int(n))) for n in rng.integers(1, 3000, size=60)]
    rows = packing.pack_documents(_docs(spark, texts), path).toPandas()
    for i, g in rows.groupby("doc_id"):
        ids = np.array(tokenizer.encode(texts[i] or "", add_special_tokens=False).ids + [0], dtype="<u4")
        g = g.sort_values("piece")
        assert g["length"].sum() == len(ids) and (len(g) == 1 or (g["length"].iloc[1:] == 2048).all())
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in g.itertuples())
    for _, g in rows.sort_values("offset").groupby("sequence_id"):
        assert g["offset"].tolist() == [0, *g["length"].cumsum()[:-1]] and g["length"].sum() <= 2048
    assert rows["sequence_id"].nunique() <= 1.15 * rows["length"].sum() / 2048 + 2
    assert packing.pack_documents(_docs(spark, texts).limit(0), path).count() == 0


def test_best_fit_takes_the_fullest_and_closes_the_fullest():
    bins = packing.BestFit(10, open_bins=2)
    assert [bins.place(n) for n in (6, 7, 3, 4, 8, 9, 2)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0), (3, 0), (2, 8)]
    assert packing.piece_lengths(25, 10) == [5, 10, 10] and packing.piece_lengths(20, 10) == [10, 10]
    with pytest.raises(ValueError):
        bins.place(11)


# 10 WARC


def test_warc_files_hold_linked_records(spark, tmp_dir):
    pages = spark.createDataFrame(
        [(1, "http://a/", '<html lang="DE"><title> T &amp; U</title><script>x<y</script><p>A<br>B&nbsp; C</p><a href=x>'), (2, None, None)],
        "page_id long, url string, html string",
    )
    source = warc.responses(pages.withColumn("block", F.lit("clash")))
    records = warc.derivatives(source)
    ids = {r["source_id"]: r["record_id"] for r in source.collect()}
    rows = {(r["source_id"], r["record_type"]): r for r in records.collect()}
    assert rows[1, "conversion"]["block"] == "T & U\nA\nB C" and rows[2, "conversion"]["block"] == ""
    assert all(r["refers_to"] == ids[k[0]] for k, r in rows.items())
    assert rows[1, "metadata"]["concurrent_to"] == rows[1, "conversion"]["record_id"]
    assert "language: de\r\nlinks: 1\r\n" in rows[1, "metadata"]["block"] and "Content-Type: text/html" in rows[1, "metadata"]["block"]
    warc.write_warc(records, f"{tmp_dir}/out", compression="none")
    raw = b"".join(bytes(r["content"]) for r in spark.read.format("binaryFile").load(f"{tmp_dir}/out").where("path LIKE '%part-%'").collect())
    found = 0
    while raw:
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        n = int(fields["Content-Length"])
        assert fields["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(rest[:n]).hexdigest()
        assert rest[n : n + 4] == b"\r\n\r\n"
        raw, found = rest[n + 4 :], found + 1
    assert found == 4
    assert warc.derivatives(source.limit(0)).count() == 0


# the pipeline's own steps


def test_stages_return_documents(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
    extra = _docs(spark, ["a b c d e f", "a b c d e f", None, None], ids=[1, 1, None, 2])
    assert sorted((r["doc_id"] or -1) for r in stages.without_near_duplicates(spark, extra, SF_SMALL).collect()) == [-1, 1, 2]
