"""The named queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm import (
    alignment,
    decontaminate,
    extract,
    jaccard,
    lexical,
    packing,
    pii,
    quality,
    sharding,
    syncmers,
    tokens,
    url_filter,
    vectors,
)
from railyard.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]

# fixed values
BAD_SITES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
SHARD_BYTES = 64 << 10  # so small that every given table splits
WORD_MODEL = "word_bpe_49k.json"
BYTE_MODEL = "byte_bpe_50k.json"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(documents, pii.session_key(spark))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged; the list holds the canonical URLs of known bad sites."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    host, path = url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))
    bad = host.rlike(rf"^((www|m|blog)\.)?({'|'.join(BAD_SITES)})\.")
    listed = pages.filter(bad).select(url_filter.canonical(host, path).alias("canonical"))
    return url_filter.filter_urls(pages, listed).drop("url")


def op3_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints_with_edits(read(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(documents, read(spark, sf_dir, "labels"))
    scored = quality.score(documents, model, with_text=False)
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.GOOD).cast("int").alias("predicted"),
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path(WORD_MODEL))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").alias("size"))
    return sharding.shard(documents, F.col("doc_id"), F.col("size"), SHARD_BYTES).drop("size")


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(read(spark, sf_dir, "pages"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.count_tokens(documents, tokenizer_path(tokens.MODEL))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read(spark, sf_dir, "documents"), n=3, percent=90, spare=2.5)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    overlaps = decontaminate.find_overlaps(documents, read(spark, sf_dir, "benchmark"))
    return decontaminate.with_hits(overlaps).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        "contaminated",
        "longest",
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical.search(documents, read(spark, sf_dir, "benchmark"))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.align(documents, tokenizer_path(BYTE_MODEL), tokenizer_path(tokens.MODEL))


QUERIES: dict[str, Query] = {
    "op1_pii": op1_pii,
    "op2_url_filter": op2_url_filter,
    "op3_syncmers": op3_syncmers,
    "op4_quality": op4_quality,
    "op5_packing": op5_packing,
    "op6_sharding": op6_sharding,
    "op7_main_text": op7_main_text,
    "op8_token_counts": op8_token_counts,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_decontamination": op10_decontamination,
    "op11_lexical_search": op11_lexical_search,
    "op12_nearest_neighbours": op12_nearest_neighbours,
    "op13_alignment": op13_alignment,
}

ORACLE_SQL = {
    "op2_url_filter": f"""
        WITH parsed AS (
            SELECT page_id,
                   CASE WHEN contains(url, '://') THEN translate(
                       regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
                   CASE WHEN contains(url, '://')
                        THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
            FROM pages),
        keyed AS (
            SELECT *, regexp_replace(host, '^(www\\.|m\\.)', '')
                      || regexp_replace(path, '(\\.html|/)$', '') AS canonical FROM parsed),
        listing AS (
            SELECT DISTINCT canonical FROM keyed
            WHERE regexp_matches(host, '^((www|m|blog)\\.)?({'|'.join(BAD_SITES)})\\.')),
        ruled AS (
            SELECT *, CASE
                WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/')
                    THEN 'example.net/en/'
                WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/')
                    THEN 'example.com/de/'
                WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/'
                END AS rule
            FROM keyed)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
                    WHEN rule IS NOT NULL THEN 'block'
                    WHEN canonical IN (SELECT canonical FROM listing) THEN 'block'
                    ELSE 'allow' END AS verdict,
               rule IS NULL AND canonical IN (SELECT canonical FROM listing) AS listed
        FROM ruled""",
    "op6_sharding": f"""
        WITH sized AS (
            SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes, md5(CAST(doc_id AS VARCHAR)) AS h
            FROM documents),
        bits AS (
            SELECT *, right(repeat('0', 16) || bin(
                (strpos('0123456789abcdef', h[1]) - 1) * 4096 + (strpos('0123456789abcdef', h[2]) - 1) * 256
                + (strpos('0123456789abcdef', h[3]) - 1) * 16 + strpos('0123456789abcdef', h[4]) - 1), 16) AS b
            FROM sized),
        sums AS (
            SELECT substr(b, 1, d) AS prefix, d, sum(n_bytes) AS total
            FROM bits, range(0, 17) AS depths(d) WHERE n_bytes <= {SHARD_BYTES} GROUP BY ALL),
        leaf AS (
            SELECT doc_id, n_bytes, prefix, d, total,
                   row_number() OVER (PARTITION BY doc_id, b ORDER BY d) AS place
            FROM (SELECT *, unnest(range(0, 17)) AS d FROM bits)
            JOIN sums USING (d) WHERE prefix = substr(b, 1, d) AND total <= {SHARD_BYTES} AND n_bytes <= {SHARD_BYTES})
        SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, prefix AS shard, CAST(d AS INTEGER) AS depth,
               CAST(total AS BIGINT) AS shard_bytes
        FROM leaf WHERE place = 1
        UNION ALL
        SELECT doc_id, n_bytes, array_to_string(list_transform(range(1, 33), lambda i:
                   right('000' || bin(strpos('0123456789abcdef', h[i]) - 1), 4)), ''), 128, n_bytes
        FROM bits WHERE n_bytes > {SHARD_BYTES}""",
    "op11_lexical_search": r"""
        WITH words AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) AS term
            FROM documents),
        asked AS (
            SELECT item_id, term, count(*) AS q
            FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) AS term
                  FROM benchmark)
            GROUP BY ALL),
        sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
        total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS n_words FROM sizes),
        postings AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
        weights AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM postings, total GROUP BY term),
        scored AS (
            SELECT item_id, doc_id, CAST(sum(q * w * ((1000000000 * tf)
                       // (1000 * tf + 12 * (75 + (25 * n * docs) // n_words)))) AS BIGINT) AS score
            FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), total
            GROUP BY ALL HAVING score > 0),
        ranked AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
                   doc_id, score
            FROM scored)
        SELECT * FROM ranked WHERE rank <= 20""",
}
