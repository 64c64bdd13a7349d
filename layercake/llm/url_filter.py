"""URL filters: rules by host and path, and trust and distrust spread over host links.

Urls that a rule fits take the longest rule's verdict.  All others take
their host's: trust flows from the trusted hosts along links (personalised
PageRank), distrust from the blocked hosts against them (a host that links
to a blocked one is suspect).  Both run in one iteration over an edge table
with a column for the direction; a host is blocked when its distrust exceeds
its trust times ``threshold``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layercake.llm.common import prepare, staged
from layercake.llm.line_dedup import lower_ascii

DAMPING = 0.85
TOLERANCE = 1e-6  # share of its own rank that a host may still move by in the last round
LEAST = 1e-300  # smaller moves are rounding
#: Hosts of absolute and scheme-relative links.
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""

Rules = list[tuple[str, str]]  # (verdict, host and path prefix)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; both empty for NULL or a url without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise("")
    return lower_ascii(F.regexp_extract(rest, "^([^/?#]*)", 1)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_columns(host: Column, path: Column, rules: Rules) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, else NULLs."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):
        name, _, prefix = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + prefix)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): how many links lead from one host to another; ``pages`` has host and html."""
    return (
        pages.where("host <> ''")
        .select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("dst"))
        .select("src", lower_ascii(F.col("dst")).alias("dst"))
        .where("src <> dst")
        .groupBy("src", "dst").agg(F.count("*").alias("weight"))
    )


def spread(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(host, trust, distrust) from (src, dst, weight) and (kind, host, seed).

    Kind ``trust`` starts at its seeds and follows links; ``distrust`` follows
    them backwards.  Each kind's seeds share a mass of one.  Rounds end when
    none reached a new host or moved a rank by more than TOLERANCE of itself,
    whatever the number of hosts that share the mass.
    """
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    )
    out = both.groupBy("kind", "src").agg(F.sum("weight").alias("total"))
    flows = staged(
        both.join(staged(out, "out-links"), ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("total")).alias("share")), "flows"
    )
    mass = seeds.groupBy("kind").agg(F.sum("seed").alias("mass"))  # two rows
    start = staged(
        seeds.join(F.broadcast(mass), "kind").where("seed > 0").select("kind", "host", (F.col("seed") / F.col("mass")).alias("seed")), "seeds"
    )
    rank = start.select("kind", "host", F.col("seed").alias("rank"))
    unknown = F.lit(None).cast("double").alias("old")
    while True:
        moved = flows.join(rank, (flows["kind"] == rank["kind"]) & (flows["src"] == rank["host"])).select(
            flows["kind"], F.col("dst").alias("host"), (DAMPING * F.col("share") * F.col("rank")).alias("gain"), unknown
        )
        base = start.select("kind", "host", ((1 - DAMPING) * F.col("seed")).alias("gain"), unknown)
        was = rank.select("kind", "host", F.lit(0.0).alias("gain"), F.col("rank").alias("old"))
        new = staged(
            moved.unionByName(base).unionByName(was)
            .groupBy("kind", "host").agg(F.sum("gain").alias("rank"), F.sum("old").alias("old")),
            "ranks",
        )
        rank = new.select("kind", "host", "rank")
        moves = F.col("old").isNull() | (F.abs(F.col("rank") - F.col("old")) > TOLERANCE * F.col("rank") + LEAST)
        if new.where(moves).isEmpty():
            break
    return rank.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("rank")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("rank")).otherwise(0.0)).alias("distrust"),
    )


def judge(
    pages: DataFrame, rules: Rules, threshold: float = 1.0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, trust, distrust.

    ``verdict`` is the longest fitting rule's, else the host's: ``block`` if
    its distrust exceeds ``threshold`` times its trust, else ``allow`` (also
    for a url without a host).  A host is a trusted seed if most of its pages
    are allowed by rule, a blocked seed if most are blocked by rule, with its
    number of such pages as weight.  A NULL url or one without ``://`` has an
    empty host and path, NULL html has no links, repeated rows are judged
    alike and count as often as they occur.  Other columns are ignored; an
    empty table gives no rows.
    """
    prepare(pages.sparkSession)
    host, path = host_and_path(F.col("url"))
    named = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).select(
        "page_id", host.alias("host"), path.alias("path"), "html"
    )
    rule, says = rule_columns(F.col("host"), F.col("path"), rules)
    ruled = named.select("page_id", "host", "path", rule.alias("rule"), says.alias("says"))
    seeds = (
        ruled.where("host <> ''").groupBy("host")
        .agg(F.count("*").alias("n"), *[F.count(F.when(F.col("says") == v, 1)).alias(v) for v in ("allow", "block")])
        .select(
            "host",
            F.explode(
                F.array(
                    F.struct(F.lit("trust").alias("kind"), F.when(2 * F.col("allow") > F.col("n"), F.col("allow")).otherwise(0).cast("double").alias("seed")),
                    F.struct(F.lit("distrust").alias("kind"), F.when(2 * F.col("block") > F.col("n"), F.col("block")).otherwise(0).cast("double").alias("seed")),
                )
            ).alias("s"),
        )
        .select("s.kind", "host", "s.seed")
    )
    edges = staged(host_edges(named), "host-edges")
    ranks = staged(spread(edges, staged(seeds, "host-seeds")).withColumnRenamed("host", "h"), "host-ranks")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    return ruled.join(ranks, F.col("host") == F.col("h"), "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("says", F.when(distrust > threshold * trust, "block").otherwise("allow")).alias("verdict"),
        trust.alias("trust"),
        distrust.alias("distrust"),
    )
