"""The queries of this subpackage and, where SQL can express them, their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tintloom.llm import chat, decontaminate, html_text, jaccard, lm_score, mix, pfor, quality, repeats, url_filter
from tintloom.llm.common import table

TOKENIZER = "word_bpe_49k.json"
URL_RULES = (
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL under the five rules; else it is blocked if listed.

    Listed are the canonical URLs that some row of `pages` gives with a tracking parameter (utm_source).
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    tracked = pages.where(F.col("url").contains("utm_source="))
    listed = tracked.select(F.concat(url_filter.url_host(F.col("url")), url_filter.url_path(F.col("url"))).alias("canonical"))
    return url_filter.filter_urls(pages, URL_RULES, listed).select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = r"""
WITH p AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/'
    END AS rule
  FROM p),
listed AS (SELECT DISTINCT host || path AS canonical FROM p WHERE contains(url, 'utm_source='))
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN host || path IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of Jaccard similarity 0.8 between sets of five-word shingles."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.digest(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), columns=["doc_id"]))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages of 100 bytes that begin earlier too."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every logged conversation that no longer one begins with, rendered."""
    return chat.format_chats(table(spark, sf_dir, "conversations"))


OP5_SQL = r"""
WITH d AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
t AS (
  SELECT conv_id, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n,
         '<|im_start|>' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS line
  FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
c AS (SELECT conv_id, k, n, string_agg(line, '') OVER (PARTITION BY conv_id ORDER BY k) AS prefix FROM t),
whole AS (SELECT min(conv_id) AS conv_id, n, prefix, count(*) AS n_equal FROM c WHERE k = n GROUP BY n, prefix)
SELECT conv_id, n AS n_turns, n_equal, prefix AS text FROM whole
WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.k < c.n AND c.k = whole.n AND c.prefix = whole.prefix)
"""


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the mix takes every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix.plan_mix(docs).select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__copies") * F.col("__size")).alias("taken"),
    )


def mix_sql(docs: str) -> str:
    """The mix over the relation `docs` as a statement with columns doc_id, size, source_size, target, copies."""
    return rf"""
WITH z AS (SELECT doc_id, source, text, coalesce(length(regexp_replace(regexp_replace(text, '[^\x20\x09-\x0D]+', 'x', 'g'), '[^x]', '', 'g')), 0) AS size FROM {docs}),
s AS (SELECT source, sum(size)::DOUBLE AS s FROM z GROUP BY source),
w AS (SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w, s * 2.0::DOUBLE AS c FROM s),
b AS (
  SELECT *, sum(s) OVER () * 1.5::DOUBLE AS t, sum(w) OVER () AS all_w,
         coalesce(sum(c) OVER o, 0) AS c0, coalesce(sum(w) OVER o, 0) AS w0
  FROM w WINDOW o AS (ORDER BY c / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
k AS (SELECT *, c * (all_w - w0) <= w * (t - c0) AS capped FROM b),
g AS (
  SELECT source, s::BIGINT AS source_size,
         CASE WHEN capped THEN c ELSE w * (t - sum(CASE WHEN capped THEN c ELSE 0 END) OVER ()) / sum(CASE WHEN capped THEN 0 ELSE w END) OVER () END AS target
  FROM k),
r AS (SELECT z.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM z JOIN g ON z.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       floor(rate)::BIGINT + CASE WHEN ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(md5(text), 'null')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END AS copies
FROM r
"""


OP6_SQL = f"SELECT doc_id, size, source_size, target, copies * size AS taken FROM ({mix_sql('documents')})"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-likelihood of every document under a network trained on all of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm_score.score(docs, *lm_score.train(docs))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict for every document; the model is fitted on a bounded sample of `labels`."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.judge(docs, quality.fit_on(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return judged.select("doc_id", *[F.col(f"__{c}").alias(c) for c in (*quality.COUNTS, "base_failed", "kept")], F.col("__probability").alias("probability"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, as read back from the files."""
    return pfor.tokens_round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_url_filter, op2_ngram_jaccard, op3_decontaminate, op4_suffix_dedup, op5_chat_format, op6_mix, op7_lm_score, op8_quality, op9_token_files, op10_html_text)}


def oracle_sql() -> dict:
    return {"op1_url_filter": OP1_SQL, "op5_chat_format": OP5_SQL, "op6_mix": OP6_SQL}
