"""WARC derivatives: metadata and plain-text conversion records from responses.

Each response gives two records that refer to it and to each other.  Record
ids are derived from the response and the kind, so a rerun writes the same
ones.  Everything is column expressions; ``write_warc`` writes the records
with Spark's text sink, whose line separator is the blank lines that end a
WARC record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE = "2024-01-01T00:00:00Z"
#: HTML elements that end a line of text.
BLOCKS = "address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figure|footer|form|h1|h2|h3|h4|h5|h6|header|hr|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul"
#: Character references that are decoded, ampersand last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def record_id(*parts: Column) -> Column:
    """A stable ``<urn:uuid:...>`` from the MD5 of the parts."""
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def digest(content: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(content.cast("binary"), 256))


def plain_text(html: Column) -> Column:
    """Text of an HTML page: no comments, scripts or tags; a line per block; single spaces."""
    text = html
    for pattern, by in (
        (r"(?s)<!--.*?-->", ""),
        (r"(?is)<script\b.*?</script[^>]*>", ""),
        (r"(?is)<style\b.*?</style[^>]*>", ""),
        (rf"(?i)</?(?:{BLOCKS})\b[^>]*>", "\n"),
        (r"<[^>]*>", ""),
    ):
        text = F.regexp_replace(text, pattern, by)
    for name, char in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(char))
    text = F.regexp_replace(F.regexp_replace(text, r"[ \t\r\f\x0B]+", " "), r" ?\n[ \n]*", "\n")
    return F.btrim(text, F.lit(" \n"))


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = DATE) -> DataFrame:
    """Pages as responses: source_id, record_id, target_uri, date, http_headers, payload, payload_digest."""
    payload = F.coalesce(F.col("payload"), F.lit(""))
    return (
        pages.select(F.col(id_col).alias("source_id"), F.col(url_col).alias("target_uri"), F.col(html_col).alias("payload"))
        .select("source_id", "target_uri", payload.alias("payload"))
        .withColumn("payload_digest", digest(F.col("payload")))
        .select(
            "source_id",
            record_id(F.lit("response"), F.col("source_id"), F.col("target_uri"), F.col("payload_digest")).alias("record_id"),
            "target_uri",
            F.lit(date).alias("date"),
            F.concat(
                F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                F.octet_length("payload").cast("string"),
                F.lit("\r\n"),
            ).alias("http_headers"),
            "payload",
            "payload_digest",
        )
    )


def derivatives(source: DataFrame) -> DataFrame:
    """Two rows per response: source_id, record_type, record_id, refers_to, concurrent_to, target_uri,
    date, content_type, http_headers, payload_digest, block, block_digest, content_length.

    ``conversion``: the payload's plain text.  ``metadata``: title, language,
    number of links, the source's headers and digest, and the conversion's
    id.  Both refer to the response, name each other as concurrent and keep
    its target, date, headers and payload digest.  A NULL payload counts as
    empty and gives an empty conversion; a NULL target stays NULL.  Repeated
    responses give repeated records with equal ids; a NULL source_id stays
    NULL.  Other columns are ignored, an empty table gives no rows.
    """
    kinds = ("metadata", "conversion")
    parsed = source.withColumn("payload", F.coalesce("payload", F.lit(""))).select(
        "source_id",
        F.col("record_id").alias("refers_to"),
        "target_uri",
        "date",
        "http_headers",
        "payload_digest",
        plain_text(F.col("payload")).alias("text"),
        F.btrim(F.regexp_replace(F.regexp_extract("payload", r"(?is)<title[^>]*>(.*?)</title", 1), r"[ \t\r\n\f\x0B]+", " ")).alias("title"),
        F.lower(F.regexp_extract("payload", r"""(?i)<html[^>]*\blang\s*=\s*["']?([a-zA-Z-]+)""", 1)).alias("language"),
        F.size(F.regexp_extract_all("payload", F.lit(r"""(?i)<a\s[^>]*?(href)\s*="""), F.lit(1))).alias("links"),
        *[record_id(F.lit(kind), F.col("record_id")).alias(kind) for kind in kinds],
    )
    end = F.lit("\r\n")
    fields = F.concat(
        F.lit("title: "), F.col("title"), end, F.lit("language: "), F.col("language"), end,
        F.lit("links: "), F.col("links").cast("string"), end,
        F.lit("source-payload-digest: "), F.col("payload_digest"), end,
        F.lit("conversion-record-id: "), F.col("conversion"), end,
        F.concat(F.lit("source-headers:"), F.lit("\r\n "), F.replace(F.btrim(F.col("http_headers"), F.lit("\r\n")), F.lit("\r\n"), F.lit("\r\n "))), end,
    )

    def record(kind: str, other: str, content_type: str, block: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("record_type"),
            F.col(kind).alias("record_id"),
            F.col(other).alias("concurrent_to"),
            F.lit(content_type).alias("content_type"),
            block.alias("block"),
        )

    both = F.array(
        record("metadata", "conversion", "application/warc-fields", fields),
        record("conversion", "metadata", "text/plain; charset=utf-8", F.col("text")),
    )
    return (
        parsed.select("source_id", "refers_to", "target_uri", "date", "http_headers", "payload_digest", F.explode(both).alias("r"))
        .select("source_id", "refers_to", "target_uri", "date", "http_headers", "payload_digest", "r.*")
        .withColumns({"block_digest": digest(F.col("block")), "content_length": F.octet_length("block").cast("long")})
    )


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write ``derivatives`` as WARC 1.1 files, one a task."""

    def header(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(name + ": "), value, F.lit("\r\n"))).otherwise("")

    text = F.concat(
        F.lit("WARC/1.1\r\n"),
        header("WARC-Type", F.col("record_type")),
        header("WARC-Record-ID", F.col("record_id")),
        header("WARC-Refers-To", F.col("refers_to")),
        header("WARC-Concurrent-To", F.col("concurrent_to")),
        header("WARC-Target-URI", F.regexp_replace("target_uri", r"[\r\n]", "")),
        header("WARC-Date", F.col("date")),
        header("WARC-Block-Digest", F.col("block_digest")),
        header("Content-Type", F.col("content_type")),
        header("Content-Length", F.col("content_length").cast("string")),
        F.lit("\r\n"),
        F.col("block"),
    )
    records.select(text.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", compression).text(path)
