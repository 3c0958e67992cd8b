"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cabrank.llm import (
    bpe, conversation_trie, exact_dedup, licenses, mixing, page_text, quality, ranked_search, secrets, simhash, token_counts, topk,
    url_filter,
)
from cabrank.llm.common import table

URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
RANKS = "byte_bpe_50k.tiktoken"
VOCABULARY = "byte_bpe_50k.json"


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.decisions(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).withColumn("dice", F.round("dice", 9))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extracted(table(spark, sf_dir, "pages"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(table(spark, sf_dir, "conversations"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filters, op2_exact_dedup, op3_byte_bpe, op4_exact_topk, op5_license_scans,
        op6_token_counts, op7_source_mixing, op8_simhash, op9_secret_scans, op10_quality,
        op11_main_text, op12_conversation_trie, op13_ranked_search,
    )
}

_RULE_ROWS = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
_TEMPLATE_ROWS = ", ".join("({}, {})".format(*("'" + x.replace("'", "''") + "'" for x in row)) for row in licenses.TEMPLATES)

ORACLE = {
    "op1_url_filters": rf"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES {_RULE_ROWS}),
parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
),
fitting AS (
  SELECT host, path, max(struct_pack(long := length(rule_host || rule_path), rule := rule_host || rule_path, verdict := verdict)) AS best
  FROM (SELECT DISTINCT host, path FROM parts)
  JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM parts LEFT JOIN fitting USING (host, path)
""",
    "op2_exact_dedup": """
SELECT doc_id, first_value(doc_id) OVER same AS keep_id, count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
  row_number() OVER same = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST)
""",
    "op4_exact_topk": """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 10
""",
    "op5_license_scans": rf"""
WITH templates(license, template) AS (VALUES {_TEMPLATE_ROWS}),
cut AS (
  SELECT doc_id, unnest(list_distinct(list_concat([t], string_split(t, chr(10)),
    flatten(list_transform(string_split(t, chr(10)),
      lambda line: string_split(regexp_replace(line, '([.!?])[ \t]+', '\1' || chr(10), 'g'), chr(10))))))) AS unit
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
),
listed AS (
  SELECT doc_id, unit, list_filter(string_split_regex(lower(unit), '[^a-z0-9]+'), lambda w: w <> '') AS w FROM cut
),
own AS (
  SELECT doc_id, list_distinct(list_transform(range(2, len(w) + 1), lambda i: w[i - 1] || ' ' || w[i])) AS pairs FROM listed
),
known AS (
  SELECT license, list_distinct(list_transform(range(2, len(w) + 1), lambda i: w[i - 1] || ' ' || w[i])) AS parts
  FROM (SELECT license, list_filter(string_split_regex(lower(template), '[^a-z0-9]+'), lambda w: w <> '') AS w FROM templates)
),
compared AS (
  SELECT doc_id, license, 2 * len(list_intersect(pairs, parts)) / CAST(len(pairs) + len(parts) AS DOUBLE) AS dice
  FROM own JOIN known ON len(pairs) > 0
)
SELECT doc_id, license, round(max(dice), 9) AS dice, count(*) AS n_units FROM compared WHERE dice >= 0.8 GROUP BY doc_id, license
""",
    "op9_secret_scans": r"""
WITH kinds(place, kind, pattern, grp, least) AS (VALUES
  (0, 'assign', '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
  (1, 'access', 'AKIA[A-Z0-9]+', 0, 20), (2, 'hex', '[0-9a-f]+', 0, 24)),
matched AS (
  SELECT row_id, place, kind, least, generate_subscripts(found, 1) AS i, unnest(found) AS hit, unnest(counted) AS counted,
    unnest(gaps[:len(found)]) AS gap
  FROM (
    SELECT row_id, place, kind, least, regexp_extract_all(t, pattern, 0) AS found, regexp_extract_all(t, pattern, grp) AS counted,
      string_split_regex(t, pattern) AS gaps
    FROM (SELECT row_number() OVER () AS row_id, coalesce(text, '') AS t FROM documents), kinds
  )
),
placed AS (
  SELECT row_id, place, kind, length(counted) >= least AS valid, length(hit) AS long,
    sum(length(gap) + length(hit)) OVER (PARTITION BY row_id, place ORDER BY i) AS stop
  FROM matched
),
joined AS (
  SELECT row_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || CAST(stop - long AS VARCHAR) || ':' || CAST(stop AS VARCHAR), ',' ORDER BY stop - long, place) AS spans
  FROM placed WHERE valid GROUP BY row_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM (SELECT row_number() OVER () AS row_id, doc_id FROM documents) LEFT JOIN joined USING (row_id)
""",
    # The article of these pages by patterns: it holds headings and paragraphs, b, br and a few references.
    "op11_main_text": r"""
WITH cut AS (
  SELECT row_number() OVER () AS row_id, page_id, url,
    string_split_regex(replace(replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '<b>', ''), '<br>', ' '), '</?(p|h1)>') AS parts
  FROM pages
),
plain AS (
  SELECT row_id, page_id, url, list_filter(list_transform(parts, lambda part: trim(regexp_replace(
    replace(replace(replace(replace(part, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '[ \t\n\x0b\f\r]+', ' ', 'g'))), lambda part: part <> '') AS parts
  FROM cut
)
SELECT page_id, url, coalesce(array_to_string(parts, chr(10) || chr(10)), '') AS text,
  CAST(length(coalesce(array_to_string(parts, chr(10) || chr(10)), '')) AS BIGINT) AS n_chars
FROM plain
""",
    "op12_conversation_trie": r"""
WITH own AS (
  SELECT conv_id, list(struct_pack(role := coalesce(role, ''), said := coalesce(text, '')) ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
hashed AS (
  SELECT conv_id, turns, conv_id - conv_id % 20 AS head, xor(list_reduce(list_prepend(4294967295, range(8 * length(CAST(conv_id AS VARCHAR)))),
    lambda crc, k: CASE
      WHEN (CASE WHEN k % 8 = 0 THEN xor(crc, CAST(ascii(substr(CAST(conv_id AS VARCHAR), CAST(k // 8 + 1 AS INT), 1)) AS BIGINT)) ELSE crc END) % 2 = 1
      THEN xor((CASE WHEN k % 8 = 0 THEN xor(crc, CAST(ascii(substr(CAST(conv_id AS VARCHAR), CAST(k // 8 + 1 AS INT), 1)) AS BIGINT)) ELSE crc END) // 2, 3988292384)
      ELSE (CASE WHEN k % 8 = 0 THEN xor(crc, CAST(ascii(substr(CAST(conv_id AS VARCHAR), CAST(k // 8 + 1 AS INT), 1)) AS BIGINT)) ELSE crc END) // 2 END),
    4294967295) % 4 AS h
  FROM own
),
members AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns, [])[:a.h], a.turns[a.h + 1:]) AS path FROM hashed a LEFT JOIN own b ON a.head = b.conv_id
),
placed AS (SELECT conv_id, path[:d] AS node, d, len(path) AS deep FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM members)),
nodes AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (deep = d), '')) AS ends_sha256,
    (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(node[-1].said, '[^\x20\x09-\x0D]+')) END AS spent
  FROM placed GROUP BY node, d
),
children AS (SELECT node[:d - 1] AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
above AS (
  SELECT n.node[:up] AS node, sum(spent) AS saved_tokens, count(*) FILTER (c.node IS NULL) AS n_leaves
  FROM (SELECT *, unnest(range(d + 1)) AS up FROM nodes) n LEFT JOIN children c ON n.node = c.node GROUP BY ALL
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, a.n_leaves,
  CAST(a.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN above a ON a.node = n.node LEFT JOIN children c ON c.node = n.node LEFT JOIN nodes p ON n.d > 0 AND p.node = n.node[:n.d - 1]
""",
    "op13_ranked_search": r"""
WITH terms AS (
  SELECT row_id, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS row_id, doc_id, text FROM documents)
),
held AS (SELECT row_id, doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
sizes AS (SELECT row_id, CAST(sum(tf) AS BIGINT) AS size FROM held GROUP BY row_id),
total AS (SELECT count(*) AS docs, CAST(sum(size) AS BIGINT) AS words FROM sizes),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM held, total GROUP BY term, docs),
asked AS (
  SELECT DISTINCT item_row, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS item_row, item_id, text FROM benchmark)
),
scored AS (
  SELECT item_row, item_id, row_id, doc_id,
    CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * size * docs) // words)))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (row_id), total GROUP BY ALL
),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_row ORDER BY score DESC, doc_id NULLS LAST, row_id) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM ranked WHERE rank <= 10
""",
}
