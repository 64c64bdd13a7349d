"""The class-conditional models against a plain version, and recall in a language with few toxic documents."""

from __future__ import annotations

import re
from collections import Counter
from math import log

import numpy as np
import pyarrow as pa
import pytest

from layercake.llm import toxicity

DOCS = "doc_id long, text string"


def _plain_words(texts, labels):
    """ratio of each word, from the definition: discounted document counts over the shared ones."""
    held = [set(re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.lower())) for t in texts]
    count = [Counter(w for s, label in zip(held, labels) if label == c for w in s) for c in (0, 1)]
    every = set(count[0]) | set(count[1])
    total = [sum(c.values()) for c in count]
    out = {}
    for w in every:
        shared = (count[0][w] + count[1][w] + 0.5) / (sum(total) + 0.5 * len(every) + 1)
        p = [(max(c[w] - 0.75, 0) + 0.75 * len(c) * shared) / n for c, n in zip(count, total)]
        out[w] = log(p[1] / p[0])
    return out


def test_word_ratios_equal_the_definition(spark):
    rng = np.random.default_rng(31)
    vocabulary = [f"w{i}" for i in range(60)] + ["été", "Ärger", "don"]
    texts = [" ".join(rng.choice(vocabulary, size=rng.integers(1, 12))) + "." for _ in range(80)]
    labels = (rng.random(80) < 0.3).astype(int)
    counted = spark.createDataFrame(list(zip(texts, labels.tolist())), "text string, toxic long").mapInArrow(
        toxicity._count_words, "word long, ordinary long, toxic long"
    )
    counts = counted.groupBy("word").sum("ordinary", "toxic").toDF("word", "ordinary", "toxic")
    got = {r["code"]: r["ratio"] for r in toxicity.word_ratios(counts).collect()}
    want = _plain_words([t.replace("Ä", "ä") if False else t for t in texts], labels)
    assert len(got) == len({w.lower() if w.isascii() else w for t in texts for w in re.findall(r"[\w]+", t)})
    ascii_words = {w: r for w, r in want.items() if w.isascii()}
    for word, ratio in ascii_words.items():
        _, code = toxicity._text_words(*toxicity.joined(pa.array([word])))
        assert got[int(code[0])] == pytest.approx(ratio, rel=1e-12)


def test_telling_words_of_a_text(spark):
    """The mean of the three largest positive ratios of distinct words, whatever the text's length."""
    words = ["alpha", "beta", "gamma", "delta", "omega"]
    codes = np.array([int(toxicity._text_words(*toxicity.joined(pa.array([w])))[1][0]) for w in words], dtype=np.uint64)
    tables = {n: (np.zeros(0, np.uint64), np.zeros(0)) for n in toxicity.TABLES}
    tables["word"] = (codes, np.array([1.0, 2.0, 4.0, 8.0, -3.0]))
    model = toxicity._model(tables, np.zeros(4), 0.5)
    long = "unknown " * 200_000 + "DELTA"
    texts = pa.array([None, "", "alpha alpha Alpha", "omega", "alpha, beta; gamma. delta", long, "omega beta"])
    told = model.measures(texts)[2]
    assert told.tolist() == pytest.approx([0, 0, 1 / 3, 0, 14 / 3, 8 / 3, 2 / 3])


def test_a_language_with_few_toxic_documents_is_not_overlooked(spark):
    """Nine in ten toxic documents are of one language; the expressions of the other are found all the same."""
    rng = np.random.default_rng(32)
    tongues = [["".join(rng.choice(list(letters), size=rng.integers(4, 9))) for _ in range(400)] for letters in ("abcdefgh", "mnopqrst")]
    slurs = [["fadehgab", "hagefdeb"], ["strompon", "qopmstrn"]]
    rows, labels, kinds = [], [], []
    for i in range(1200):
        tongue = i % 2
        toxic = rng.random() < (0.4 if tongue == 0 else 0.08)
        text = list(rng.choice(tongues[tongue], size=60))
        for _ in range(3 if toxic else 0):
            text[rng.integers(60)] = rng.choice(slurs[tongue])
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
        kinds.append((tongue, toxic))
    docs = spark.createDataFrame(rows, DOCS)
    model = toxicity.train(docs, spark.createDataFrame(labels[:900], "doc_id long, toxic int"))
    score = {r["doc_id"]: r["toxicity"] for r in toxicity.score(docs, model).collect()}
    for tongue in (0, 1):
        bad = [score[i] >= 0.3 for i in range(900, 1200) if kinds[i] == (tongue, True)]
        good = [score[i] >= 0.3 for i in range(900, 1200) if kinds[i] == (tongue, False)]
        assert np.mean(bad) >= 0.8 and np.mean(good) <= 0.06, (tongue, np.mean(bad), np.mean(good))
