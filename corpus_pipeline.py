"""A training corpus from ``documents``, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all
but the last return the columns of ``documents``. ``run`` writes each stage's rows to the
shared folder and reads them again, so a lost executor never costs more than one stage.
No stage fails on null texts, repeated rows, empty tables or extra columns; what becomes of
them is said in the operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm import decontaminate, jaccard, packing, pii, quality
from railyard.llm.common import read
from railyard.llm.queries import WORD_MODEL, tokenizer_path
from railyard.plans.checkpoints import cut


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _apart(docs: DataFrame) -> DataFrame:
    """Columns that ``documents`` has not got under names that no operator uses."""
    return docs.toDF(*[c if c in COLUMNS else f"_own_{c}" for c in docs.columns])


def _back(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(_apart(docs).columns).toDF(*docs.columns)


def _recount(changed) -> dict:
    """n_chars anew where a text was changed."""
    n = F.length("text").cast("bigint")
    return {"n_chars": F.when(changed, n).otherwise(F.col("n_chars"))}


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, accepts."""
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    scored = quality.score(_apart(docs), model)
    return _back(scored.filter(F.col("score") >= quality.GOOD), docs)


def _row_key() -> Column:
    """Equal for rows equal in doc_id and text (by 64-bit hash); ordered by doc_id, null last."""
    n = F.coalesce(F.col("doc_id"), F.lit(0)).cast("bigint").bitwiseXOR(F.lit(-(1 << 63)))
    parts = [F.lpad(F.hex(x), 16, "0") for x in (n, F.xxhash64("text"))]
    return F.concat(F.when(F.col("doc_id").isNull(), "1").otherwise("0"), *parts)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8) the row of the least doc_id, and of
    the rows with that id one.

    Rows equal in doc_id and text count once. Rows without a doc_id come after all others.
    """
    keyed = docs.select(_row_key().alias("doc_id"), "text")
    found = jaccard.near_duplicates(keyed, n=5, percent=80)
    kept = found.filter("doc_id = component_id").select(F.col("doc_id").alias("_key")).distinct()
    first = _apart(docs).withColumn("_key", _row_key()).join(kept, "_key", "left_semi")
    return _back(first.dropDuplicates(["_key"]), docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; from the others the words that a test item has are cut."""
    benchmark = read(spark, sf_dir, "benchmark")
    overlaps = decontaminate.find_overlaps(_apart(docs), benchmark, cut_out=True)
    clean = decontaminate.with_hits(overlaps).filter(~F.col("contaminated"))
    return _back(clean.withColumns(_recount(F.size("spans") > 0)), docs)


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms."""
    changed = pii.pseudonymise(_apart(docs), pii.session_key(spark))
    return _back(changed.withColumns(_recount(F.size("pii") > 0)), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts' tokens as pieces of sequences."""
    return packing.pack(docs, tokenizer_path(WORD_MODEL))


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("pii", without_pii),
    ("packing", packed),
]

# No SQL: none of the stages can be expressed in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
