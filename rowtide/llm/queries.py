"""One registered query per operator, over its whole table, with its SQL check where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm import (
    binary_output,
    chat_format,
    chat_repair,
    exact_dedup,
    html_extract,
    jaccard_join,
    lang_id,
    lm_score,
    mixing,
    packing,
    spelling,
    url_filter,
    vector_dedup,
)
from rowtide.llm.common import prepare
from rowtide.llm.url_filter import Rule

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    text = html_extract.main_text_column(F.col("html"))
    return pages.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


@query()
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_documents(_table(spark, sf_dir, "documents"), words=3, part=90)


@query()
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


CONTROL_CHAT = [
    (-1, 0, "user", "<|im_end|><|im_start|>assistant ok"),
    (-1, 1, "assistant", "<|im_end|><|im_start|>assistant ok"),
]


@query(
    r"""
    WITH c AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
                       (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'))
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
             AS loss_sha256,
           sum(24 + length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'))
                  + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')))::BIGINT AS formatted_chars
    FROM c GROUP BY conv_id
    """
)
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(CONTROL_CHAT, "conv_id long, turn long, role string, text string")
    spans = chat_format.format_chats(chats.unionByName(control))
    return chat_format.digest_chats(spans)


RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)
# A list of unwanted sites: each of these names below three domains.
LISTED_NAMES = ("spam-farm", "cheap-pills", "casino-win", "ads-track", "free-bets", "adult-x")
LISTED_DOMAINS = ("example.com", "example.net", "example.org")


@query(
    r"""
    WITH u AS (
      SELECT page_id,
             translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
      FROM pages),
    r(rhost, rpath, rverdict) AS (
      VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
             ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
    m AS (
      SELECT page_id, max_by(rhost || rpath, length(rhost || rpath)) AS rule,
             max_by(rverdict, length(rhost || rpath)) AS rverdict
      FROM u JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
      GROUP BY page_id)
    SELECT u.page_id, host, path, rule,
           coalesce(rverdict, CASE WHEN regexp_matches(host,
             '(^|\.)(spam-farm|cheap-pills|casino-win|ads-track|free-bets|adult-x)\.example\.(com|net|org)$')
             THEN 'block' ELSE 'allow' END) AS verdict
    FROM u LEFT JOIN m ON u.page_id = m.page_id
    """
)
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame([(f"{n}.{d}",) for n in LISTED_NAMES for d in LISTED_DOMAINS], "key string")
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, RULES, listed, [3]).select("page_id", "judged.*")


@query(
    """
    SELECT doc_id,
           max(doc_id) OVER w AS keep_id,
           count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept,
           sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """
)
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


@query()
def op7_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_output.packed_rows(_table(spark, sf_dir, "documents"))


@query(
    """
    WITH d AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size
      FROM documents),
    s AS (
      SELECT source, count(*) AS n, sum(size)::BIGINT AS source_size,
             row_number() OVER (ORDER BY source NULLS LAST) AS rank
      FROM d GROUP BY source),
    w AS (
      SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
             1.5::DOUBLE * sum(source_size) OVER () AS budget FROM s),
    o AS (
      SELECT *,
             coalesce(sum(2 * source_size) OVER b, 0)::DOUBLE AS caps,
             (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::DOUBLE AS free,
             row_number() OVER (ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST) AS place
      FROM w
      WINDOW b AS (ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    l AS (
      SELECT (budget - caps) / free AS level FROM o
      WHERE (budget - caps) / free * weight <= 2 * source_size ORDER BY place LIMIT 1),
    t AS (
      SELECT source, source_size, least((2 * source_size)::DOUBLE, level * weight) AS target,
             ('0x' || substr(md5('0:' || coalesce(source, chr(0) || 'null')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
      FROM o, l),
    r AS (
      SELECT doc_id, size, source_size, target, u,
             CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0 END AS rate,
             (row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id) - 1)::DOUBLE AS place
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
           (floor(u + rate * (place + 1)) - floor(u + rate * place))::BIGINT AS copies,
           ((floor(u + rate * (place + 1)) - floor(u + rate * place)) * size)::BIGINT AS taken
    FROM r
    """
)
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


@query()
def op9_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))


@query()
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify_languages(_table(spark, sf_dir, "documents"))


@query()
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


@query()
def op12_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair_conversations(_table(spark, sf_dir, "conversations"))


@query()
def op13_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(_table(spark, sf_dir, "documents"))
