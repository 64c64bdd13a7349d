"""Toxicity by class-conditional Kneser-Ney models over bytes.

Two interpolated Kneser-Ney models, one counted on toxic and one on ordinary
documents, predict each byte of the normalised text (ASCII letters lowered,
other characters kept, every other ASCII byte a space) from the five before
it.  A model backs off to the continuation counts of its own class over four
bytes, and from there both back off to the SAME counts, those of all training
documents, so that an expression rare in either class costs both alike.

Compared are length-normalised log-likelihoods: toxic minus ordinary, by
byte, over the whole document and over its most toxic window of twelve
bytes, which keeps a short expression visible in a text of any length.

In a language with few toxic documents the two byte models differ by the
language more than by the expression.  So a third pair of models predicts
words, each by the number of documents of the class that hold it (one
count a document, discounted), backing off to the shared counts of all: a rare
word costs both alike, and one that several toxic and no ordinary documents
hold stands out, whatever its language.  Their measure is the mean
log-ratio of the document's three most telling words.

A logistic curve over the three numbers, fitted on training documents kept
out of the counts, gives the score.

Counts are gathered and smoothed in Spark over every training document; they
grow with it.  Every n-gram keeps its own ratio, and an unseen one backs off.
Up to ``TABLE_KINDS`` n-grams the ratios are broadcast, in hash tables sized
for them whose slots name their n-gram.  With more they stay a stored table:
documents are dealt into blocks, the distinct n-grams of a block are joined
with it, and a block is scored with the ratios that it needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layercake.llm.common import held_out, prepare, staged, with_column
from layercake.llm.textscan import ALNUM, LOWERED, SEGMENT, U64, joined, mix, words

ORDER = 6  # bytes of an n-gram
WINDOW = 12  # n-grams of a window
DISCOUNT = 0.75
TABLES = ("gram", "context", "low", "word")
TELLING = 3  # words whose ratios are averaged
WORD_BITS = U64((1 << 48) - 1)  # of a word's hash
TABLE_KINDS = 1 << 21  # n-grams that are broadcast, at most
BLOCK_BYTES = 4 << 20  # text of a block that is scored by a join
EMPTY = U64(0xFFFFFFFFFFFFFFFF)  # no n-gram: those are 48 bits at most
TUNING = 8  # one training document of a class in so many fits the curve instead of the counts
TUNING_ROWS = 20_000  # of each class, at most so many

_NORMAL = np.where(ALNUM, np.arange(256), 0x20).astype(U64)
_NORMAL[65:91] = np.arange(97, 123)


def grams(data: np.ndarray) -> np.ndarray:
    """The ORDER bytes from each position on, normalised, as one number."""
    bytes_ = _NORMAL[data]
    n = max(0, len(data) - ORDER + 1)
    out = np.zeros(n, dtype=U64)
    for k in range(ORDER):
        out = (out << U64(8)) | bytes_[k : n + k]
    return out


def slot(codes: np.ndarray, size: int) -> np.ndarray:
    return (mix(codes + U64(0x9E3779B97F4A7C15)) & U64(size - 1)).astype(np.int64)


def slotted(codes: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code, ratio) of each slot of a hash table at most two thirds full; a code lies in the first free slot from its own on."""
    size = 1 << max(4, int(1.5 * len(codes)).bit_length())
    keys, values = np.full(size, EMPTY), np.full(size, np.nan, dtype=np.float32)
    left, at = np.arange(len(codes)), slot(codes, size)
    while len(left):
        free = keys[at] == EMPTY
        keys[at[free]] = codes[left[free]]  # of several codes one stays
        won = keys[at] == codes[left]
        values[at[won]] = ratio[left[won]]
        left, at = left[~won], (at[~won] + 1) & (size - 1)
    return keys, values


def _groups(starts: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Runs of texts of ``size`` bytes together at most; a longer text is alone."""
    i, n = 0, len(starts) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + size, side="right")) - 1)
        yield i, j
        i = j


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, toxic) to (gram, ordinary, toxic), summed over two megabytes of text."""
    for batch in batches:
        data, starts = joined(batch.column(0))
        label = batch.column(1).to_numpy(zero_copy_only=False) == 1
        for i, j in _groups(starts, 2 * SEGMENT):
            for at in range(int(starts[i]), int(starts[j]), 2 * SEGMENT):
                end = min(at + 2 * SEGMENT + ORDER - 1, int(starts[j]))
                codes = grams(data[at:end])
                place = np.arange(at, at + len(codes))
                owner = np.searchsorted(starts, place, side="right") - 1
                inside = place + ORDER <= starts[owner + 1]  # no n-gram reaches into the next text
                codes, toxic = codes[inside], label[owner[inside]]
                kinds, back = np.unique(codes, return_inverse=True)
                n = np.bincount(back, minlength=len(kinds))
                bad = np.bincount(back[toxic], minlength=len(kinds))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kinds.view(np.int64)), pa.array((n - bad).astype(np.int64)), pa.array(bad.astype(np.int64))],
                    names=["gram", "ordinary", "toxic"],
                )


def _text_words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, word) of each distinct word of each text."""
    at, _, code = words(data, ALNUM, LOWERED)
    owner, code = np.searchsorted(starts, at, side="right") - 1, code & WORD_BITS
    order = np.lexsort((code, owner))
    owner, code = owner[order], code[order]
    new = np.ones(len(code), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (code[1:] != code[:-1])
    return owner[new], code[new]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, toxic) to (word, ordinary, toxic): the documents that hold it, summed over a batch."""
    for batch in batches:
        owner, code = _text_words(*joined(batch.column(0)))
        toxic = (batch.column(1).to_numpy(zero_copy_only=False) == 1)[owner]
        kinds, back = np.unique(code, return_inverse=True)
        n, bad = np.bincount(back, minlength=len(kinds)), np.bincount(back[toxic], minlength=len(kinds))
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds.view(np.int64)), pa.array((n - bad).astype(np.int64)), pa.array(bad.astype(np.int64))],
            names=["word", "ordinary", "toxic"],
        )


def word_ratios(counts: DataFrame) -> DataFrame:
    """(code, ratio) from (word, ordinary, toxic): discounted document counts, backing off to those of both classes."""
    classes = ("ordinary", "toxic")
    total = counts.agg(
        *[F.sum(c).alias(f"n_{c}") for c in classes], *[F.count(F.when(F.col(c) > 0, 1)).alias(f"k_{c}") for c in classes],
        F.count("*").alias("kinds"),
    ).first()  # one row
    shared = (F.col("ordinary") + F.col("toxic") + 0.5) / F.lit((total["n_ordinary"] or 0) + (total["n_toxic"] or 0) + 0.5 * total["kinds"] + 1)
    p = {c: _discounted(F.col(c), F.lit(total[f"n_{c}"] or 0), F.lit(total[f"k_{c}"]), shared) for c in classes}
    return counts.select(F.col("word").alias("code"), F.log(p["toxic"] / p["ordinary"]).alias("ratio"))


def _discounted(count: Column, total: Column, kinds: Column, below: Column) -> Column:
    """Absolute discounting into the distribution below; an unseen context leaves all to it."""
    return F.when(total > 0, (F.greatest(count - DISCOUNT, F.lit(0.0)) + DISCOUNT * kinds * below) / total).otherwise(below)


def ratios(counts: DataFrame) -> dict[str, DataFrame]:
    """Log-ratios toxic to ordinary from (gram, ordinary, toxic), each as (code, ratio).

    ``gram``: of each n-gram that occurs; ``context``: what an unseen byte
    after five seen ones adds to ``low``, the ratio of the last four bytes.
    """
    classes = ("ordinary", "toxic")
    counts = counts.select(
        "gram", *classes, F.shiftright("gram", 8).alias("context"), F.col("gram").bitwiseAND(0xFFFFFFFF).alias("low")
    )
    context = counts.groupBy("context").agg(
        *[F.sum(c).alias(f"n_{c}") for c in classes],
        *[F.count(F.when(F.col(c) > 0, 1)).alias(f"k_{c}") for c in classes],
    )
    context = staged(context, "kn-context")
    # Kneser-Ney: below, a byte counts by the number of distinct n-grams it ends.
    low = staged(
        counts.groupBy("low").agg(*[F.count(F.when(F.col(c) > 0, 1)).alias(c) for c in classes], F.count("*").alias("pooled")),
        "kn-ends",
    ).withColumn("tail", F.shiftright("low", 8))
    tail = staged(
        low.groupBy("tail").agg(
            *[F.sum(c).alias(f"n_{c}") for c in classes],
            *[F.count(F.when(F.col(c) > 0, 1)).alias(f"k_{c}") for c in classes],
            F.sum("pooled").alias("n_pooled"),
        ),
        "kn-tails",
    )
    shared = (F.col("pooled") + 0.5) / (F.col("n_pooled") + 128)
    low = staged(
        low.join(tail, "tail").select(
            "low",
            *[_discounted(F.col(c), F.col(f"n_{c}"), F.col(f"k_{c}"), shared).alias(f"p_{c}") for c in classes],
        ),
        "kn-low",
    )
    gram = (
        counts.join(context, "context").join(low, "low")
        .select(
            "gram",
            *[_discounted(F.col(c), F.col(f"n_{c}"), F.col(f"k_{c}"), F.col(f"p_{c}")).alias(f"q_{c}") for c in classes],
        )
    )
    left = {c: F.when(F.col(f"n_{c}") > 0, DISCOUNT * F.col(f"k_{c}") / F.col(f"n_{c}")).otherwise(1.0) for c in classes}
    return {
        "gram": gram.select(F.col("gram").alias("code"), F.log(F.col("q_toxic") / F.col("q_ordinary")).alias("ratio")),
        "context": context.select(
            F.col("context").alias("code"),
            F.log(left["toxic"] / left["ordinary"]).alias("ratio"),
        ),
        "low": low.select(
            F.col("low").alias("code"), F.log(F.col("p_toxic") / F.col("p_ordinary")).alias("ratio")
        ),
    }


@dataclass
class Model:
    gram: np.ndarray
    context: np.ndarray
    low: np.ndarray
    word: np.ndarray
    curve: np.ndarray  # intercept, weights of the window's, the document's and its telling words' mean log-ratio
    base: float  # share of toxic training documents
    keys: dict[str, np.ndarray] | None = None  # the code of each slot; without them a slot serves whatever falls in it
    stored: DataFrame | None = None  # (key, ratio) instead of slots, if there are too many to broadcast

    def _find(self, table: str, codes: np.ndarray) -> np.ndarray:
        """Ratios of codes, NaN for a code that the table does not hold."""
        values = getattr(self, table)
        at = slot(codes, len(values))
        if self.keys is None:
            return values[at].astype(np.float64)
        keys, out, left = self.keys[table], np.full(len(codes), np.nan), np.arange(len(codes))
        while len(left):
            there = keys[at]
            hit = there == codes[left]
            out[left[hit]] = values[at[hit]]
            on = ~hit & (there != EMPTY)
            left, at = left[on], (at[on] + 1) & (len(keys) - 1)
        return out

    def _ratios(self, data: np.ndarray) -> np.ndarray:
        codes = grams(data)
        out = self._find("gram", codes)
        new = np.flatnonzero(np.isnan(out))
        codes = codes[new]
        out[new] = np.nan_to_num(self._find("context", codes >> U64(8))) + np.nan_to_num(
            self._find("low", codes & U64(0xFFFFFFFF))
        )
        return out

    def _telling(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Mean ratio of the TELLING most toxic words of each text; what it lacks of them counts as zero."""
        owner, code = _text_words(data, starts)
        ratio = np.nan_to_num(self._find("word", code))
        some = ratio > 0
        owner, ratio = owner[some], ratio[some]
        order = np.lexsort((-ratio, owner))
        owner, ratio = owner[order], ratio[order]
        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])[: len(owner)])
        rank = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
        best = rank < TELLING
        return np.bincount(owner[best], weights=ratio[best], minlength=len(starts) - 1)[: len(starts) - 1] / TELLING

    def measures(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(most toxic window's and whole text's mean log-ratio per byte, telling words' one, number of n-grams) of each text."""
        data, starts = joined(texts)
        n = np.maximum(np.diff(starts) - ORDER + 1, 0)
        total, peak = np.zeros(len(n)), np.full(len(n), -np.inf)
        for i, j in _groups(starts, SEGMENT):
            for at in range(int(starts[i]), int(starts[j]), SEGMENT):
                # Positions at .. last belong to this step; windows that begin there reach a little further.
                last = min(at + SEGMENT, int(starts[j]))
                values = self._ratios(data[at : min(last + WINDOW + ORDER - 2, int(starts[j]))])
                upto = np.concatenate([[0.0], np.cumsum(values)])
                a = np.maximum(starts[i:j], at) - at
                b = np.minimum(starts[i:j] + n[i:j], last) - at
                some = np.flatnonzero(b > a)
                total[i + some] += upto[b[some]] - upto[a[some]]
                ends = np.minimum(starts[i:j] + n[i:j] - WINDOW + 1, last) - at  # windows inside one text
                long = np.flatnonzero(ends > a)
                if len(long):
                    windows = upto[WINDOW:] - upto[:-WINDOW]
                    cuts = np.stack([a[long], ends[long]], axis=1).ravel()
                    best = np.maximum.reduceat(np.append(windows, -np.inf), cuts)[::2]
                    peak[i + long] = np.maximum(peak[i + long], best)
        peak = np.where(np.isfinite(peak), peak, total)  # a text shorter than a window
        return peak / WINDOW, total / np.maximum(n, 1), self._telling(data, starts), n

    def scores(self, texts: pa.Array) -> np.ndarray:
        *measured, n = self.measures(texts)
        z = self.curve[0] + sum(w * x for w, x in zip(self.curve[1:], measured))
        return np.where(n > 0, 1 / (1 + np.exp(-np.clip(z, -500, 500))), self.base)


def _model(tables: dict[str, tuple[np.ndarray, np.ndarray]], curve: np.ndarray, base: float) -> Model:
    """A model from (codes, ratios) of each table."""
    slots = {name: slotted(*tables[name]) for name in TABLES}
    return Model(**{name: values for name, (_, values) in slots.items()}, curve=curve, base=base, keys={name: keys for name, (keys, _) in slots.items()})


def _key(code: Column | np.ndarray, table: str):
    """A code with its table's number in the top byte."""
    number = TABLES.index(table) << 56
    return code + (U64(number) if isinstance(code, np.ndarray) else F.lit(number))


def _kinds(block: pa.Table) -> pa.Table:
    """(block, text) of one block to (block, key): all that its n-grams may look up, once."""
    data, starts = joined(block.column(1).combine_chunks())
    found = {name: [np.zeros(0, U64)] for name in TABLES}
    found["word"].append(np.unique(_text_words(data, starts)[1]))
    for at in range(0, int(starts[-1]), SEGMENT):
        codes = np.unique(grams(data[at : min(at + SEGMENT + ORDER - 1, int(starts[-1]))]))
        for name, part in zip(TABLES, (codes, codes >> U64(8), codes & U64(0xFFFFFFFF))):
            found[name].append(np.unique(part))
    keys = np.concatenate([_key(np.unique(np.concatenate(found[name])), name) for name in TABLES])
    return pa.table({"block": pa.array(np.full(len(keys), block.column(0)[0].as_py(), np.int64)), "key": pa.array(keys.view(np.int64))})


def _applied(docs: DataFrame, model: Model, text_col: str, call, added: list[tuple[str, str]]) -> DataFrame:
    """``docs`` and the columns ``added`` (name, type) that ``call(model, texts)`` returns."""
    names, schema = [name for name, _ in added], docs.schema
    for name, kind in added:
        schema = with_column(schema, name, kind)
    columns, at = docs.columns, docs.columns.index(text_col)
    if model.stored is None:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                new = call(shared.value, batch.column(at))
                yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, new)], names=[*columns, *names])

        return docs.mapInArrow(run, schema)
    curve, base = model.curve, model.base
    size = docs.agg(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)) + 64)).first()[0] or 0
    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(size // BLOCK_BYTES + 1))
    # Written, so that a row is in the same block both times.
    placed = staged(docs.select(block.alias("_block"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)]), "kn-blocks")
    looked = placed.select(F.col("_block").alias("block"), f"_c{at}").groupBy("block").applyInArrow(_kinds, "block long, key long")
    ratios_of = looked.join(model.stored.hint("merge"), "key").select("block", "key", "ratio")

    def score_block(rows: pa.Table, known: pa.Table) -> pa.Table:
        key, ratio = known["key"].to_numpy().view(U64), known["ratio"].to_numpy()
        number = key >> U64(56)
        own = {name: number == U64(i) for i, name in enumerate(TABLES)}
        some = _model({name: (key[m] & U64((1 << 56) - 1), ratio[m]) for name, m in own.items()}, curve, base)
        new = call(some, rows.column(at + 1).combine_chunks())
        return pa.table([*rows.columns[1:], *map(pa.array, new)], names=[*columns, *names])

    return placed.groupBy("_block").cogroup(ratios_of.groupBy("block")).applyInArrow(score_block, schema)


def fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression with a slight ridge, by Newton's method."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    a = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    b = np.zeros(a.shape[1])
    ridge = np.diag([1e-6] + [0.05] * (a.shape[1] - 1))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        step = np.linalg.solve((a.T * (p * (1 - p) + 1e-9)) @ a + ridge, a.T @ (p - y) + ridge @ b)
        b -= step
        if np.abs(step).max() < 1e-8:
            break
    w = b[1:] / scale
    return np.array([b[0] - (w * mean).sum(), *w])


def train(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Count both classes on the labelled rows outside fold ``held`` and fit the curve.

    Only labels 0 and 1 with a doc_id count; of several labels of a document
    the larger holds.  Each class gives one document in TUNING, and at least
    one of two, to the curve; its intercept is then set for the true shares.
    With a single document of a class, which the counts need, the curve is
    the plain log-ratio of the worst window on top of the shares.  Without
    labels of both classes every score is the share of toxic rows (a half
    without any).
    """
    spark = prepare(docs.sparkSession)
    marks = (
        labels.where(F.col("toxic").isin(0, 1) & ~held_out("doc_id", folds, held))
        .groupBy(F.col("doc_id").cast("long").alias("_doc")).agg(F.max("toxic").alias("toxic"))
    )
    # Labels grow with the documents: joined by a shuffle at every size.
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text")).join(
        marks.hint("merge"), F.col("_id") == F.col("_doc")
    )
    # Of documents that are there and long enough to measure, so that each class has its share.
    there = docs.where(F.octet_length(text_col) >= ORDER - 1).select(F.col(id_col).cast("long").alias("_there")).distinct()
    known = staged(marks.join(there.hint("merge"), F.col("_doc") == F.col("_there"), "left_semi"), "kn-known")
    shares = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
    n = [shares.get(label, 0) for label in (0, 1)]
    held_back = [0 if k < 2 else min(-(-k // TUNING), TUNING_ROWS) for k in n]
    order = F.xxhash64("_doc", F.lit("toxicity"))
    picked = [known.where(F.col("toxic") == label).orderBy(order, "_doc").limit(held_back[label]) for label in (0, 1)]
    # At most 2 * TUNING_ROWS ids: broadcast.
    picked = F.broadcast(staged(picked[0].unionByName(picked[1]).select(F.col("_doc").alias("_picked")), "kn-picked"))
    is_picked = F.col("_id") == F.col("_picked")
    counts = staged(
        rows.join(picked, is_picked, "left_anti").select("text", "toxic")
        .mapInArrow(_count, "gram long, ordinary long, toxic long")
        .groupBy("gram").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")),
        "kn-counts",
    )
    said = staged(
        rows.join(picked, is_picked, "left_anti").select("text", "toxic")
        .mapInArrow(_count_words, "word long, ordinary long, toxic long")
        .groupBy("word").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")),
        "kn-words",
    )
    tables = ratios(counts) | {"word": word_ratios(said)}
    if counts.count() + said.count() <= TABLE_KINDS:
        # At most TABLE_KINDS rows each.
        kept = {name: frame.select("code", F.col("ratio").cast("float").alias("ratio")).toArrow() for name, frame in tables.items()}
        model = _model({name: (t["code"].to_numpy().view(U64), t["ratio"].to_numpy()) for name, t in kept.items()}, np.zeros(4), 0.5)
    else:
        keyed = [frame.select(_key(F.col("code"), name).alias("key"), F.col("ratio").cast("float").alias("ratio")) for name, frame in tables.items()]
        none = np.full(1, np.nan, np.float32)
        model = Model(none, none, none, none, np.zeros(4), 0.5, stored=staged(reduce(DataFrame.unionByName, keyed), "kn-ratios"))
    tuned = rows.join(picked, is_picked, "left_semi").select("_id", "text", F.col("toxic").cast("int").alias("label"))
    points = _applied(tuned, model, "text", Model.measures, [("peak", "double"), ("mean", "double"), ("told", "double"), ("n", "long")])
    # One row a document, of rows that share an id one that can be measured.
    points = (
        points.where("n > 0").groupBy("_id").agg(F.min(F.struct("peak", "mean", "told", "label")).alias("p")).select("_id", "p.*").toArrow()
    ).sort_by("_id")
    y = points["label"].to_numpy()
    model.base = (n[1] + 1) / (n[0] + n[1] + 2)
    prior = float(np.log(model.base / (1 - model.base)))
    if 0 < y.sum() < len(y):
        model.curve = fit_curve(np.column_stack([points[c].to_numpy() for c in ("peak", "mean", "told")]), y.astype(float))
        model.curve[0] += np.log(n[1] / n[0]) - np.log(y.sum() / (len(y) - y.sum()))
    else:
        model.curve = np.array([prior, float(WINDOW) if min(n) else 0.0, 0.0, 0.0])
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "toxicity") -> DataFrame:
    """All rows and columns of ``docs`` plus ``score_col`` (double, 0 to 1).

    A text of fewer than five bytes (NULL and empty too) scores the share of
    toxic training documents.  A column of the same name is replaced.
    """
    return _applied(docs.drop(score_col), model, text_col, lambda m, texts: [m.scores(texts)], [(score_col, "double")])
