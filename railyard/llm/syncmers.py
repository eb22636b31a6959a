"""Document fingerprints: closed syncmers over words, in DataFrame functions only.

A text is its runs of non-white characters, a run longer than ``LONGEST`` being several. Of
each ``K`` consecutive words, the inner runs of ``S`` words are hashed; the K words are chosen
if their least inner hash lies at either edge. Whether they are chosen depends on nothing
outside them, so equal passages give equal anchors wherever they stand.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import text_of
from railyard.llm.ordering import with_neighbours

K, S, LONGEST = 5, 2, 64


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def anchors(text: Column, positions: bool = True) -> Column:
    """The chosen anchors in text order: struct(position, 64-bit hash), or their hashes alone.

    A text with fewer than K words, or in which none is chosen, has one anchor over all its
    words; a text without words, and null, has none.
    """
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"\S{{1,{LONGEST}}}"), F.lit(0))

    def chosen(h: Column) -> Column:
        inner = F.transform(
            F.slice(h, 1, F.greatest(F.size(h) - (S - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, S)]),
        )

        def pick(m: Column) -> Column:
            edge = K - S

            def anchor(x: Column, i: Column) -> Column:
                middle = [F.get(m, i + j) for j in range(1, edge)]
                least = F.least(*middle) if len(middle) > 1 else middle[0]
                name = F.xxhash64(*[F.get(h, i + j) for j in range(K)])
                value = F.struct(i.alias("position"), name.alias("hash")) if positions else name
                return F.when(F.least(x, F.get(m, i + edge)) <= least, value)

            starts = F.slice(m, 1, F.greatest(F.size(m) - edge, F.lit(0)))
            return F.array_compact(F.transform(starts, anchor))

        found = _let(inner, pick)
        whole = F.xxhash64(h)
        if positions:
            whole = F.struct(F.lit(0).alias("position"), whole.alias("hash"))
        only = F.when(F.size(h) > 0, F.array(whole)).otherwise(F.array().cast(
            "array<struct<position:int,hash:bigint>>" if positions else "array<bigint>"
        ))
        return _let(found, lambda f: F.when(F.size(f) > 0, f).otherwise(only))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), chosen)


def fingerprint(text: Column) -> Column:
    """The distinct anchor hashes, in text order."""
    return F.array_distinct(anchors(text, positions=False))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two fingerprints; of two empty ones, 1."""
    both, all_ = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(all_ == 0, F.lit(1.0)).otherwise(both.cast("double") / all_)


def fingerprints_with_edits(documents: DataFrame) -> DataFrame:
    """Fingerprints of each text and of an edited text, and how alike they are.

    The edited text ends in the start of the next document, descending doc_id. Rows with the
    same doc_id are ordered by text, a null doc_id comes last, a single row follows itself.
    Other columns are not read.
    """
    rows = documents.select("doc_id", text_of().alias("text")).withColumn(
        "print", fingerprint(F.col("text"))
    )
    rows = with_neighbours(rows, "doc_id", ["text", "print"], ["text"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - half),
        F.substring(F.col("next_text"), F.lit(1), half),
    )
    rows = rows.select("doc_id", n.cast("bigint").alias("n_chars"), edited.alias("edited"), "print", "next_print")
    rows = rows.withColumn("edited_print", fingerprint(F.col("edited")))

    def line(c: str) -> Column:
        return F.array_join(F.col(c).cast("array<string>"), " ")

    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        line("print").alias("fingerprint"),
        line("edited_print").alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
