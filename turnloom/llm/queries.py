"""Registered queries of the subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.llm.common import Work, table
from turnloom.llm.decontaminate import find_benchmark_items
from turnloom.llm.filter_audit import audit_filters
from turnloom.llm.hard_negatives import mine
from turnloom.llm.html_blocks import extract_main_text
from turnloom.llm.license_scan import scan_licenses
from turnloom.llm.lsh_forest import near_duplicates
from turnloom.llm.ngram_join import link_documents
from turnloom.llm.packing import pack_documents, tokenizer_path
from turnloom.llm.sharding import shard_documents
from turnloom.llm.suffix_dedup import remove_repeats
from turnloom.llm.toxicity import held_out, score_documents
from turnloom.llm.url_filter import judge_urls
from turnloom.llm.vptree import nearest

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(
        table(spark, sf_dir, "documents"), "doc_id", "text", tokenizer_path(), Work(spark)
    )
    return packed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents"), "doc_id", "text", Work(spark))
    removed = F.aggregate(
        "removed", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"]
    )
    return cut.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), 8, Work(spark))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_documents(documents, table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", "predicted"
    )


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    asks = F.col("vec_id") % 50 == 0
    return nearest(vectors, "vec_id", "embedding", asks, Work(spark), k=5)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return find_benchmark_items(documents, benchmark, Work(spark))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return judge_urls(pages, rules, Work(spark)).drop("url")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return link_documents(documents, "doc_id", "text", Work(spark), n=3, part=90, whole=100)


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    anchors = F.col("vec_id") % 100 == 0
    return mine(vectors, "vec_id", "embedding", moved, anchors, Work(spark))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return audit_filters(documents, labels, Work(spark))


def op13_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return near_duplicates(documents, "doc_id", "text", Work(spark), n=4, part=80, whole=100)


QUERIES: dict[str, Query] = {
    "op1_licenses": op1_licenses,
    "op2_packing": op2_packing,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_sharding": op4_sharding,
    "op5_toxicity": op5_toxicity,
    "op6_nearest": op6_nearest,
    "op7_decontamination": op7_decontamination,
    "op8_url_filter": op8_url_filter,
    "op9_ngram_join": op9_ngram_join,
    "op10_main_text": op10_main_text,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_filter_audit": op12_filter_audit,
    "op13_minhash_forest": op13_minhash_forest,
}

_RULE_VALUES = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)

ORACLES: dict[str, str] = {
    "op8_url_filter": rf"""
WITH rules(rule_host, rule_path, action) AS (VALUES {_RULE_VALUES}),
parts AS (
    SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
    FROM pages
),
fits AS (
    SELECT page_id, host, path, rule_host || rule_path AS rule, action
    FROM parts LEFT JOIN rules
        ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path,
    arg_max(rule, length(rule)) AS rule,
    coalesce(arg_max(action, length(rule)), 'allow') AS verdict
FROM fits GROUP BY page_id, host, path
""",
    "op11_hard_negatives": """
WITH sound AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike,
        CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM sound a, sound b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER)
        AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
""",
    "op12_filter_audit": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
        doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS copied
    FROM documents
),
flags AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
    FROM labels GROUP BY doc_id
),
masks AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
        CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text)
            THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN copied THEN 'E' ELSE '' END AS fails
    FROM words LEFT JOIN flags USING (doc_id)
),
alike AS (SELECT part, good, toxic, fails, count(*) AS n FROM masks GROUP BY ALL),
orders AS (
    SELECT '' AS filter_order
    UNION ALL
    SELECT filter_order || f FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS l(f)
    WHERE NOT contains(filter_order, f)
),
steps AS (
    SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS f,
        filter_order[1:step - 1] AS before
    FROM orders, range(1, 6) AS r(step) WHERE length(filter_order) = 5
),
outcomes AS (
    SELECT part, filter_order, step, f, n, good, toxic, fails,
        contains(fails, f) AS now, length(translate(fails, before, '')) < length(fails) AS gone
    FROM alike, steps
),
counts AS (
    SELECT part, filter_order, step, f,
        CAST(coalesce(sum(n) FILTER (WHERE NOT now AND NOT gone), 0) AS BIGINT) AS kept,
        CAST(coalesce(sum(n) FILTER (WHERE now AND NOT gone), 0) AS BIGINT) AS removed,
        CAST(coalesce(sum(n) FILTER (WHERE now AND gone), 0) AS BIGINT) AS redundant,
        CAST(coalesce(sum(n) FILTER (WHERE fails = f), 0) AS BIGINT) AS unique_fails,
        CAST(coalesce(sum(n) FILTER (WHERE now AND NOT gone AND good), 0) AS BIGINT) AS good_lost,
        CAST(coalesce(sum(n) FILTER (WHERE now AND NOT gone AND toxic), 0) AS BIGINT) AS toxic_lost
    FROM outcomes GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counts
""",
}
