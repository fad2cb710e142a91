"""The registered queries of this subpackage and, where SQL can say it, their results in SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm import exact_dedup, language_id, lexical, line_dedup, packing, quality, sentencepiece_match, simhash, substrings, token_output, topk, url_filters, whitening
from tradeloom.llm.common import id_bucket, table

#: Vocabulary files of public tokenizers.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
PIECE_MODEL, BYTE_RANKS = f"{TOKENIZERS}/piece_bpe_32k.model", f"{TOKENIZERS}/byte_bpe_50k.tiktoken"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def language_network(docs: DataFrame) -> language_id.Network:
    """Fitted outside the held-out quarter."""
    return language_id.fit(docs, id_bucket("doc_id", 4) != 2)


@query
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"))


#: The pages of these tables have no canonical or refresh links, so the form of a URL names its component.
ORACLES["op1_url_filters"] = r"""
WITH rules(action, rule_host, start) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
rest AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
forms AS (SELECT *, regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\.', '') || regexp_replace(path, '(/index)?(\.html)?/*$', '') || '?' ||
  array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'),
    lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))), '&') AS form FROM parts),
ruled AS (SELECT url, max_by(action, length(rule_host || start)) AS action, max_by(rule_host || start, length(rule_host || start)) AS rule
  FROM (SELECT DISTINCT url, host, path FROM parts) JOIN rules ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, start) GROUP BY url),
decided AS (SELECT form, bool_or(action = 'allow') AS allowed FROM forms JOIN ruled USING (url) WHERE host <> '' GROUP BY form)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN allowed THEN 'allow' WHEN NOT allowed THEN 'block' END, 'allow') AS verdict
FROM forms LEFT JOIN ruled USING (url) LEFT JOIN decided USING (form)
"""


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_network(docs))
    return found.select("doc_id", F.coalesce(id_bucket("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLES["op3_exact_topk"] = """
WITH sound AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM sound q JOIN sound c ON q.r <> c.r WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.items(table(spark, sf_dir, "documents")))


@query
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document as a digest, and whether they decode to its text."""
    pieces = sentencepiece_match.load(PIECE_MODEL)
    tokens = sentencepiece_match.decode(sentencepiece_match.encode(table(spark, sf_dir, "documents"), pieces), pieces)
    return tokens.select(
        "doc_id",
        (F.coalesce(F.octet_length("ids"), F.lit(0)) / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("same_text"),
    )


@query
def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every packed row that was written: a digest of its ids, its segments and their documents."""
    packed = token_output.write(token_output.pack(table(spark, sf_dir, "documents"), token_output.ranks(BYTE_RANKS)))
    ids = F.sha2("input_ids", 256).alias("ids_sha256")
    return packed.select("shard", "bin", ids, F.size("doc_ids").alias("segments"), F.element_at("cu_seqlens", -1).alias("tokens"), "cu_seqlens", "position_resets", "doc_ids", "pieces")


@query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", F.coalesce(id_bucket("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.resolve(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


ORACLES["op8_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.grouped(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "pages"))


def _lines_sql() -> str:
    text = "coalesce(html, '')"
    for pattern, by in line_dedup.MARKUP:
        text = f"regexp_replace({text}, '{pattern}', '{by}', 'g')"
    for entity, by in line_dedup.ENTITIES:
        quoted = by.replace("'", "''")
        text = f"replace({text}, '{entity}', '{quoted}')"
    return rf"list_filter(list_transform(string_split(regexp_replace(regexp_replace({text}, '[ \t\r\f]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> '')"


ORACLES["op10_line_dedup"] = f"""
WITH own AS (SELECT row_number() OVER () AS r, page_id, translate(regexp_extract(CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END, '^[^/?#]*'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, {_lines_sql()} AS own FROM pages),
sites AS (SELECT host, count(*) AS pages FROM own GROUP BY host),
counts AS (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(own)) AS line FROM own) GROUP BY host, line),
common AS (SELECT host, list(line) AS drops FROM counts JOIN sites USING (host) WHERE n > 1 AND n > {line_dedup.RATIO} * pages GROUP BY host),
stay AS (SELECT page_id, host, own, list_filter(own, lambda x: NOT list_contains(coalesce(drops, []), x)) AS stay FROM own LEFT JOIN common USING (host))
SELECT page_id, host, CAST(len(own) AS INTEGER) AS lines, CAST(len(own) - len(stay) AS INTEGER) AS dropped, array_to_string(stay, chr(10)) AS text FROM stay
"""


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op11_lexical_search"] = r"""
WITH words AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
size AS (SELECT count(*) AS n, CAST(coalesce(sum(len(words)), 0) AS BIGINT) AS l FROM words WHERE len(words) > 0),
counts AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM words) GROUP BY r, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counts, size GROUP BY term, n),
asked AS (SELECT i, item_id, term, count(*) AS often FROM (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY i, item_id, term),
ms AS (SELECT r, doc_id, 100 - 25 + ((25 * len(words) * n) // l) AS m FROM words, size WHERE len(words) > 0),
scored AS (SELECT i, item_id, r, doc_id, CAST(sum(often * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN ms USING (r) GROUP BY i, item_id, r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""


@query
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removed(table(spark, sf_dir, "documents"))
