"""URL filter: allow and block rules, then a list of URLs behind a blocked Bloom filter.

The list's canonical URLs are hashed into blocks of 256 bits, four words of 64 bits with one
bit set in each. The number of blocks follows the list but never exceeds ``MOST_BLOCKS``, so
the broadcast filter is at most 20 MB; on a longer list more URLs pass it, no result changes.
Only possible hits meet the list itself, in a hash join that removes the false positives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import ascii_lower

# fixed values
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
         ("allow", "org/fr/"))
MOST_BLOCKS = 1 << 19
URLS_PER_BLOCK = 16
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without www. or m., and path without its .html and its last slash."""
    return F.concat(
        F.regexp_replace(host, r"^(www\.|m\.)", ""), F.regexp_replace(path, r"(\.html|/)$", "")
    )


def with_rule(pages: DataFrame, rules=RULES) -> DataFrame:
    """Adds rule and its verdict: the longest that fits host (or a subdomain) and path."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at = text.index("/")
        host, path = text[:at], text[at:]
        fits = (
            (F.col("host") == host) | F.col("host").endswith(f".{host}")
        ) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return pages.withColumn("rule", rule).withColumn("verdict", verdict)


def _bits(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block, and one bit for each of its four words."""
    spread = F.xxhash64(key, F.lit(1))
    block = F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")
    one = F.lit(1).cast("bigint")
    return block, [
        F.call_function("shiftleft", one, F.shiftright(spread, 6 * i).bitwiseAND(63).cast("int"))
        for i in range(4)
    ]


def bloom_filter(urls: DataFrame, blocks: int) -> DataFrame:
    """block, w0..w3 of the filter over ``urls.canonical``."""
    block, bits = _bits(F.col("canonical"), blocks)
    cells = urls.select(block.alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(bits)])
    return cells.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)])


def filter_urls(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """host, path, rule, verdict, listed added to ``pages``, one row per row.

    ``listed`` has one column, canonical; repeated and null entries count once and not at
    all. A null url, or one without ``://``, has an empty host and path, meets no rule and is
    allowed. Columns of ``pages`` with a result's name are replaced.
    """
    listed = listed.filter(F.col("canonical").isNotNull()).select("canonical").distinct()
    size = listed.agg(F.approx_count_distinct("canonical")).first()[0]
    blocks = max(1, min(MOST_BLOCKS, -(-size // URLS_PER_BLOCK)))
    drop = ("host", "path", "rule", "verdict", "listed")
    keep = [c for c in pages.columns if c not in drop]
    # two steps, so that a clashing column is gone before the new one is read
    parsed = pages.select(*keep).withColumns(
        {"host": host_of(F.col("url")), "path": path_of(F.col("url"))}
    )
    judged = with_rule(parsed, rules)
    open_ = judged.filter(F.col("rule").isNull()).withColumn(
        "_key", canonical(F.col("host"), F.col("path"))
    )
    block, bits = _bits(F.col("_key"), blocks)
    bloom = F.broadcast(
        bloom_filter(listed, blocks).select(
            F.col("block").alias("_block"), *[F.col(f"w{i}").alias(f"_w{i}") for i in range(4)]
        )
    )
    probed = open_.withColumn("_block", block).join(bloom, "_block", "left")
    inside = F.lit(True)
    for i, bit in enumerate(bits):
        inside = inside & (F.col(f"_w{i}").bitwiseAND(bit) != 0)
    probed = probed.withColumn("_possible", F.coalesce(inside, F.lit(False)))
    exact = listed.select(F.col("canonical").alias("_key"), F.lit(True).alias("_hit"))
    hits = probed.filter("_possible").join(exact, "_key", "left")
    result = [*keep, "host", "path", "rule", "verdict", "listed"]
    no = F.lit(False)
    blocked = F.col("listed")
    return (
        judged.filter(F.col("rule").isNotNull()).withColumn("listed", no).select(result)
        .unionByName(
            probed.filter(~F.col("_possible")).withColumn("listed", no)
            .withColumn("verdict", F.lit("allow")).select(result)
        )
        .unionByName(
            hits.withColumn("listed", F.coalesce("_hit", no))
            .withColumn("verdict", F.when(blocked, "block").otherwise("allow")).select(result)
        )
    )
