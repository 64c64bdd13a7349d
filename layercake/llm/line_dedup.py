"""Line dedup over levelled sorted runs of line hashes, in DataFrame functions only.

``LineRuns`` keeps, for every line hash, in how many documents it was seen.
A batch is merge-anti-joined with the runs, which tells its new lines, and
adds one sorted run of its own; once a level holds ``fanout`` runs they are merged into one run of the next
level, so a hash is rewritten once a level: O(log batches) times.  Runs are
bucketed and sorted by hash with one fixed bucket count, so merging runs and
joining a batch with them reads the runs without a shuffle.

``drop_repeated_lines`` is the batch job on top of it.  Documents come in
batches of descending ids, so the batch in which the runs do not yet hold a
line also holds the largest document with it: that document is the line's
keeper.  When all batches are in, the merged runs tell which lines are
frequent, and each of those goes, except in its keeper.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake.llm.common import prepare, staged
from layercake.session import scratch_path

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; the quick built-in serves texts that are all ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def line_key(line: Column) -> Column:
    """A line without blanks at its ends, A-Z lowered."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def lines_of(text: Column) -> Column:
    """The lines of a text; NULL and the empty text have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class LineRuns:
    """Levelled sorted runs of (hash, n_docs)."""

    def __init__(self, spark: SparkSession, fanout: int = 4, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"line_runs_{uuid.uuid4().hex[:12]}"
        self.levels: list[list[str]] = []
        self._written = 0

    def _write(self, frame: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        run = f"{self.name}_{self._written}"
        self._written += 1
        (
            frame.repartition(self.buckets, "hash")
            .sortWithinPartitions("hash")
            .write.bucketBy(self.buckets, "hash")
            .sortBy("hash")
            .option("path", scratch_path(self.spark, run))
            .saveAsTable(run)
        )
        self.levels[level].append(run)

    def _merged(self, runs: list[str]) -> DataFrame:
        frame = self.spark.table(runs[0])
        for run in runs[1:]:
            other = self.spark.table(run).select("hash", F.col("n_docs").alias("n2"))
            # A merge of two sorted runs: same buckets on both sides, no shuffle.
            frame = frame.hint("merge").join(other, "hash", "full").select(
                "hash",
                (F.coalesce("n_docs", F.lit(0)) + F.coalesce("n2", F.lit(0))).alias("n_docs"),
            )
        return frame

    def totals(self) -> DataFrame:
        """(hash, n_docs) over everything added."""
        runs = [run for level in self.levels for run in level]
        if not runs:
            return self.spark.createDataFrame([], "hash binary, n_docs long")
        return self._merged(runs)

    def unseen(self, lines: DataFrame) -> DataFrame:
        """The rows of ``lines`` (with a column ``hash``) that no run holds: a merge-anti-join with each run."""
        for run in [run for level in self.levels for run in level]:
            lines = lines.hint("merge").join(self.spark.table(run).select("hash"), "hash", "left_anti")
        return lines

    def add(self, lines: DataFrame) -> None:
        """Add a batch of (hash, n_docs), one row a hash.  A document belongs to one batch, in which it counts once per hash."""
        self._write(lines.select("hash", "n_docs"), 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._write(self._merged(full), level + 1)
            for run in full:
                self.spark.sql(f"DROP TABLE {run}")
            level += 1

    def close(self) -> None:
        """Take the runs out of the session's catalogue; their files stay in the scratch folder."""
        for run in [run for level in self.levels for run in level]:
            self.spark.sql(f"DROP TABLE {run}")
        self.levels = []


def keepers(hashed: DataFrame, store: LineRuns, batches: list[DataFrame]) -> DataFrame:
    """(hash, keeper) of every line of the batches, which come in descending order of doc_id: the
    batch's largest document with a line that the runs do not hold yet."""
    found = []
    for batch in batches:
        lines = staged(
            batch.select("hash", "doc_id").distinct()
            .groupBy("hash").agg(F.count("doc_id").alias("n_docs"), F.max("doc_id").alias("keeper")),
            "line-batch",
        )
        found.append(staged(store.unseen(lines).select("hash", "keeper"), "line-keepers"))
        store.add(lines)
    return reduce(DataFrame.unionByName, found)


def drop_repeated_lines(
    docs: DataFrame,
    min_chars: int = 40,
    min_docs: int = 5,
    batches: int = 4,
    fanout: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All rows and columns of ``docs`` with ``text`` cut, plus n_lines and n_dropped (long).

    A line whose key (blanks stripped at both ends, A-Z lowered) has at least
    ``min_chars`` code points and occurs in at least ``min_docs`` documents
    is dropped from every document but the one with the largest id; there all
    its copies stay.  Rows that share an id are one document; a row with a
    NULL id counts as no document and keeps all lines.  A NULL or empty text
    is one empty line and comes back as the empty text.  Extra columns pass through, whatever
    their names, except those named n_lines and n_dropped, which are replaced.
    """
    spark = prepare(docs.sparkSession)
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    keyed = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("row"),
        F.posexplode(F.transform(lines_of(F.col(text_col)), line_key)).alias("pos", "key"),
    ).where((F.length("key") >= min_chars) & F.col("doc_id").isNotNull())
    # One row to the driver: ids that cut the documents into batches of about equal numbers.
    cuts = docs.agg(F.percentile_approx(F.col(id_col).cast("long"), [i / batches for i in range(batches - 1, 0, -1)], 1000).alias("c")).first()["c"]
    cuts = sorted(set(cuts or []), reverse=True)
    number = reduce(lambda a, b: a + b, [(F.col("doc_id") <= c).cast("int") for c in cuts], F.lit(0))
    hashed = staged(keyed.select(number.alias("batch"), "doc_id", "row", "pos", F.unhex(F.md5("key")).alias("hash")), "line-hashes", "batch")
    store = LineRuns(spark, fanout)
    kept_by = keepers(hashed, store, [hashed.where(F.col("batch") == i) for i in range(len(cuts) + 1)])
    often = store.totals().where(F.col("n_docs") >= min_docs)
    frequent = staged(often.join(kept_by.withColumnRenamed("hash", "h"), F.col("hash") == F.col("h")).select("hash", "keeper"), "frequent")
    store.close()
    # The long lines that stay: an anti-join with the frequent ones; positions are distinct per text.
    stay = (
        hashed.hint("merge")
        .join(frequent.withColumnRenamed("hash", "h"), (F.col("hash") == F.col("h")) & (F.col("doc_id") != F.col("keeper")), "left_anti")
        .groupBy("doc_id", "row")
        .agg(F.collect_set("pos").alias("stay"))
    )
    places = F.sequence(F.lit(0), F.size("_lines") - 1)
    short = F.filter(places, lambda i: F.length(F.btrim(F.get("_lines", i), F.lit(BLANKS))) < min_chars)
    kept = F.when(F.col("_id").isNull(), places).otherwise(
        F.array_sort(F.array_union(short, F.coalesce("stay", F.array().cast("array<int>"))))
    )
    whole = docs.select(
        *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(columns)],
        F.col(id_col).cast("long").alias("_id"),
        F.col(text_col).alias("_text"),
        F.xxhash64(F.col(text_col)).alias("_row"),
    )
    cut = F.array_join(F.transform("_kept", lambda i: F.get("_lines", i)), "\n")
    joined = whole.join(stay, (F.col("_id") == F.col("doc_id")) & (F.col("_row") == F.col("row")), "left")
    return joined.withColumn("_lines", lines_of(F.col("_text"))).withColumn("_kept", kept).select(
        *[cut.alias(c) if c == text_col else F.col(f"_c{i}").alias(c) for i, c in enumerate(columns)],
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("_kept")).cast("long").alias("n_dropped"),
    )
