"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake.llm import ann, bpe, line_dedup, merkle, near_dedup, packing, pii, prefix_trie, quality, toxicity, url_filter, vector_dedup, warc
from layercake.llm.common import held_out, prepare, staged
from layercake.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return wrap


#: Documents as words: A-Z lowered, split at [\x20\x09-\x0D]+; shingles of five words on whole texts.
_OP1_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ \t\n\v\f\r]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM docs
), shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM sets
  UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x
), comp AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c AS component_id, doc_id = c AS kept
FROM sets JOIN comp ON x = doc_id
"""


@query("op1_near_dedup", _OP1_SQL)
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(prepare(spark), sf_dir, "documents"), percent=85)


_OP2_SQL = r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
  SELECT doc_id, unnest(range(1, len(ls) + 1)) AS pos, unnest(ls) AS line FROM split
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), frequent AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT keyed.*, coalesce(last <> doc_id, false) AS gone FROM keyed LEFT JOIN frequent USING (k)
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op2_line_dedup", _OP2_SQL)
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


@query("op7_bpe_roundtrip")
def op7_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    ranks = tokenizer_path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode_texts(docs, ranks, public_tokenizers.PATTERN).drop("text")
    return bpe.decode_ids(encoded, ranks, public_tokenizers.PATTERN).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query("op8_best_fit_packing")
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), folds=4, held=2)
    return toxicity.score(docs, model, score_col="score").select(
        "doc_id",
        held_out("doc_id", 4, 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"), folds=5, held=0)
    return quality.score(docs, model, score_col="score").select(
        "doc_id",
        held_out("doc_id", 5, 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


@query("op3_nearest_neighbours")
def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ann.nearest(rows, rows.where("vec_id % 20 = 0"), k=20)


_OP6_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), ok AS (
  SELECT vec_id, e FROM v WHERE e IS NOT NULL AND list_aggregate(list_transform(e, lambda x: abs(x)), 'sum') > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b
  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x
), comp AS (SELECT x, min(y) AS c FROM reach GROUP BY x),
links AS (SELECT x, count(*) AS n FROM pairs GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, c AS component_id, vec_id = c AS kept
FROM embeddings JOIN comp ON comp.x = vec_id LEFT JOIN links ON links.x = vec_id
"""


@query("op6_vector_dedup", _OP6_SQL)
def op6_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.9)


#: The rules of the url query, fixed by its contract.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


@query("op4_url_filter")
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


_OP10_SQL = r"""
WITH source AS (
  SELECT page_id, url, coalesce(html, '') AS payload, 'sha256:' || sha256(coalesce(html, '')) AS payload_digest FROM pages
), ids AS (
  SELECT *, md5('response|' || coalesce(CAST(page_id AS VARCHAR), '') || '|' || coalesce(url, '') || '|' || payload_digest) AS h
  FROM source
), named AS (
  SELECT *, '<urn:uuid:' || h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] || '>' AS refers_to
  FROM ids
), kinds AS (
  SELECT named.*, k AS record_type, md5(k || '|' || refers_to) AS g, md5('conversion|' || refers_to) AS c
  FROM named, (VALUES ('metadata'), ('conversion')) AS t(k)
), stripped AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(payload,
    '<!--.*?-->', '', 'gs'), '(?is)<script\b.*?</script[^>]*>', '', 'g'), '(?is)<style\b.*?</style[^>]*>', '', 'g'),
    '(?i)</?(?:BLOCKS)\b[^>]*>', chr(10), 'g'), '<[^>]*>', '', 'g') AS raw
  FROM kinds
), decoded AS (
  SELECT *, replace(replace(replace(replace(replace(replace(raw, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
    '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&') AS chars
  FROM stripped
), texts AS (
  SELECT *, trim(regexp_replace(regexp_replace(chars, '[ \t\r\f\x0B]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), ' ' || chr(10)) AS text,
    trim(regexp_replace(regexp_extract(payload, '(?is)<title[^>]*>(.*?)</title', 1), '[ \t\r\n\f\x0B]+', ' ', 'g')) AS title,
    lower(regexp_extract(payload, '(?i)<html[^>]*\blang\s*=\s*["'']?([a-zA-Z-]+)', 1)) AS language,
    len(regexp_extract_all(payload, '(?i)<a\s[^>]*?(href)\s*=', 1)) AS links
  FROM decoded
), blocks AS (
  SELECT *, CASE WHEN record_type = 'conversion' THEN text ELSE
    'title: ' || title || chr(13) || chr(10) || 'language: ' || language || chr(13) || chr(10)
    || 'links: ' || links || chr(13) || chr(10) || 'source-payload-digest: ' || payload_digest || chr(13) || chr(10)
    || 'conversion-record-id: <urn:uuid:' || c[1:8] || '-' || c[9:12] || '-' || c[13:16] || '-' || c[17:20] || '-' || c[21:32] || '>'
    || chr(13) || chr(10) || 'source-headers:' || chr(13) || chr(10) || ' HTTP/1.1 200 OK' || chr(13) || chr(10)
    || ' Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || ' Content-Length: ' || strlen(payload) || chr(13) || chr(10)
    END AS block
  FROM texts
)
SELECT page_id, record_type,
  '<urn:uuid:' || g[1:8] || '-' || g[9:12] || '-' || g[13:16] || '-' || g[17:20] || '-' || g[21:32] || '>' AS record_id,
  refers_to, url AS target_uri, payload_digest, 'sha256:' || sha256(block) AS block_digest,
  CAST(strlen(block) AS BIGINT) AS content_length
FROM blocks
""".replace("BLOCKS", warc.BLOCKS)


@query("op10_warc_derivatives", _OP10_SQL)
def op10_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(prepare(spark), sf_dir, "pages")
    return warc.derivatives(warc.responses(pages)).select(
        F.col("source_id").alias("page_id"),
        "record_type", "record_id", "refers_to", "target_uri", "payload_digest", "block_digest", "content_length",
    )


#: crc32 of an integer's decimal text; DuckDB has none, so its bytes are fed bit by bit.
_CRC32 = """(4294967295 - list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(
    string_split(CAST({} AS VARCHAR), ''), lambda ch: [CAST(ord(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, v: CASE WHEN v >= 0 THEN xor(c, v) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))"""


def _tree_sql(levels: int) -> str:
    """CTEs n0, n1, ...: the nodes of each level, with their siblings, of trees over nodes (grp, pos, digest)."""
    out = []
    for k in range(levels + 1):
        up = f"""(
    SELECT grp, pos // f AS pos, CASE WHEN any_value(f) > 1 THEN sha256(string_agg(digest, '' ORDER BY pos))
      ELSE any_value(digest) END AS digest FROM n{k - 1} GROUP BY grp, pos // f)""" if k else "nodes"
        out.append(f"""n{k} AS (
  SELECT *, CASE WHEN f > 1 THEN coalesce(string_agg(digest, '') OVER (PARTITION BY grp, pos // f ORDER BY pos
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END AS l,
    CASE WHEN f > 1 THEN coalesce(string_agg(digest, '') OVER (PARTITION BY grp, pos // f ORDER BY pos
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END AS r
  FROM (SELECT grp, pos, digest, CASE WHEN count(*) OVER (PARTITION BY grp) > 1 THEN 16 ELSE 1 END AS f FROM {up})
)""")
    return ",\n".join(out)


def _op13_sql(levels: int = 6) -> str:
    """The manifest of up to 16 ** levels rows a source, and as many sources."""
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)"]
    fixed = " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields)
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def text(t):
        return f"coalesce(strlen({t}) || ':' || {t}, '-')"

    inner = _tree_sql(levels).replace("nodes", "leaves")
    outer = _tree_sql(levels)
    for k in range(levels + 1):
        outer = outer.replace(f"n{k} AS", f"s{k} AS").replace(f"FROM n{k} ", f"FROM s{k} ")
    joins, sibs = [], []
    for tree, grp, start in (("n", "d.source", "d.pos"), ("s", "0", "o.pos")):
        pos = start
        for k in range(levels):
            name = f"{tree}_{k}"
            joins.append(f"JOIN {tree}{k} AS {name} ON {name}.grp IS NOT DISTINCT FROM {grp} AND {name}.pos = {pos}")
            pos = f"{tree}_{k}.pos // {tree}_{k}.f"
            sibs += [f"{tree}_{k}.l", f"{tree}_{k}.r"]
        joins.append(f"JOIN {tree}{levels} AS {tree}_{levels} ON {tree}_{levels}.grp IS NOT DISTINCT FROM {grp}")
        if tree == "n":
            joins.append("JOIN over_sources o ON o.source IS NOT DISTINCT FROM d.source")
    steps = [(t, k) for t in "ns" for k in range(levels)]
    chain, last = [], "met"
    for i, (t, k) in enumerate(steps):
        step = f"CASE WHEN {t}{k}_f > 1 THEN sha256({t}{k}_l || told || {t}{k}_r) ELSE told END"
        chain.append(f"f{i} AS (SELECT * REPLACE ({step} AS told) FROM {last})")
        last = f"f{i}"
    kept = ", ".join(f"{t}_{k}.{c} AS {t}{k}_{c}" for t, k in steps for c in "lrf")
    return f"""
WITH hashed AS (
  SELECT doc_id, source, sha256({fixed} || {text('text')}) AS leaf, CASE WHEN {_CRC32.format('doc_id')} % 5 = 0
    THEN sha256({fixed} || {text(lower)}) ELSE sha256({fixed} || {text('text')}) END AS told FROM documents
), docs AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM hashed
), leaves AS (SELECT source AS grp, pos, leaf AS digest FROM docs),
{inner}, over_sources AS (
  SELECT grp AS source, digest, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS pos FROM n{levels}
), nodes AS (SELECT 0 AS grp, pos, digest FROM over_sources),
{outer}, met AS (
  SELECT d.doc_id, d.leaf, d.told, n_{levels}.digest AS subroot, s_{levels}.digest AS root,
    sha256({" || ".join(sibs)}) AS proof_sha256, {kept}
  FROM docs d {" ".join(joins)}
), {", ".join(chain)}
SELECT doc_id, leaf, subroot, root, proof_sha256, told AS folded_root, told = root AS verified FROM {last}
"""


@query("op13_merkle_manifest", _op13_sql())
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    leaves = docs.select(
        "doc_id", "source", merkle.leaf_digest(*head, F.col("text")).alias("leaf"),
        F.when(tampered, merkle.leaf_digest(*head, lower)).alias("told"),
    )
    proven = merkle.proofs(leaves, group="source", order=["doc_id"])
    return proven.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        merkle.fold(F.coalesce("told", "leaf"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query("op12_pii")
def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and base_sha256 are of the spans found in the source itself; spans lists all."""
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(docs, keep_text=False)

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(spans, kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id",
        *[count(base, kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


_OP11_SQL = f"""
WITH own AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), shares AS (SELECT *, {_CRC32.format('conv_id')} % 9 AS h FROM own),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.ts[1:c.h], []), c.ts[c.h + 1:]) AS ts
  FROM shares c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5
), members AS (
  SELECT conv_id, ts[1:d] AS key, d, d = len(ts) AS ended FROM (SELECT *, unnest(range(0, len(ts) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT key, d, min(conv_id) AS conv_id, count(*) AS n,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends_sha256
  FROM members GROUP BY key, d
), families AS (SELECT key[1:d - 1] AS key, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
counted AS (
  SELECT n.*, coalesce(f.n_children, 0) AS n_children, CASE WHEN d = 0 THEN 0 ELSE (n - 1) * strlen(n.key[d].t) END AS saved
  FROM nodes n LEFT JOIN families f ON f.key = n.key
), subtrees AS (
  SELECT key[1:a] AS key, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM counted) GROUP BY 1
)
SELECT c.conv_id, c.d AS depth, p.conv_id AS parent_conv_id, c.n AS n_convs, c.n_children,
  CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN subtrees s ON s.key = c.key LEFT JOIN nodes p ON c.d > 0 AND p.d = c.d - 1 AND p.key = c.key[1:c.d - 1]
"""


@query("op11_prefix_trie", _OP11_SQL)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation c begins with the first h turns of conversation c - c % 5; its own follow after as many."""
    own = staged(prefix_trie.sequences(table(prepare(spark), sf_dir, "conversations"), "conv_id", "turn", "role", "text"), "convs")
    heads = own.where("conv_id % 5 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 8).alias("head"))
    shares = own.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int"))
    turns = F.expr("concat(slice(coalesce(head, slice(turns, 1, 0)), 1, h), slice(turns, h + 1, size(turns)))")
    rebuilt = shares.join(heads, F.col("conv_id") - F.col("conv_id") % 5 == F.col("base"), "left")
    nodes = prefix_trie.prefix_nodes(rebuilt.select("conv_id", turns.alias("turns")))
    return nodes.withColumnRenamed("ends", "ends_sha256")
