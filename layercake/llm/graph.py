"""Connected components of a distributed edge list, by smallest-label propagation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.llm.common import staged


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each node of an undirected edge list with the smallest node it reaches.

    One round takes the smallest label among a node and its neighbours, then
    the label of that label (pointer jumping), so the rounds grow with the
    logarithm of a chain's length.  Labels are written after each round; the
    driver only sees the number of labels that changed.  Messages are
    aggregated before the shuffle, and the joins read plain shuffles, which
    adaptive execution splits where a hub has many edges.
    """
    links = staged(
        edges.select(F.col(a).alias("src"), F.col(b).alias("dst"))
        .where("src <> dst")
        .unionByName(edges.select(F.col(b).alias("src"), F.col(a).alias("dst")).where("src <> dst"))
        .distinct(),
        "links",
    )
    labels = staged(
        links.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("m"))
        .select("node", F.least("node", "m").alias("label")),
        "labels",
    )
    while True:
        heard = links.join(labels, F.col("src") == F.col("node")).select(
            F.col("dst").alias("node"), "label", F.lit(None).cast(labels.schema["label"].dataType).alias("own")
        )
        low = staged(
            heard.unionByName(labels.withColumn("own", F.col("label")))
            .groupBy("node")
            .agg(F.min("label").alias("label"), F.max("own").alias("own")),
            "low",
        )
        if low.where("label <> own").isEmpty():
            return labels.select("node", F.col("label").alias("component"))
        up = low.select(F.col("node").alias("label"), F.col("label").alias("top"))
        labels = staged(low.join(up, "label").select("node", F.col("top").alias("label")), "labels")
