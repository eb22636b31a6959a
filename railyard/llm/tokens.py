"""Token counts: map-side look-up in two tiers, without a shuffle of pre-tokens.

A sentence-piece model never joins symbols across the start of a word, so the length of a
text is the sum of the lengths of its pre-tokens. Tier one is a table of the corpus's
frequent pre-tokens, of at most ``TABLE`` entries of at most ``LONGEST`` characters, which
is broadcast. Tier two is a dictionary in each Python worker; a pre-token that neither
holds is encoded once and remembered. The table decides speed only, never a result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from railyard.llm.common import in_worker, lean, small_batches, text_of, thin_out

MODEL = "piece_bpe_32k.model"
TABLE, PER_TASK, LONGEST = 65_536, 4_096, 64
HELD, KEPT = 1_000_000, 256  # entries of a worker's dictionary, and the characters of their keys
BREAK = "\x01"  # stands for a line break inside a pre-token


def pre_tokens(text: str) -> list[str] | None:
    """Words between single spaces, a line break starting a new one.

    None for a text whose spaces or control characters have a meaning that this split does
    not keep; such a text is encoded as a whole.
    """
    if "  " in text or " \n" in text or BREAK in text or "▁" in text:
        return None
    if not text or text[0] in " \n" or text[-1] == " ":
        return None
    return text.replace("\n", " " + BREAK).split(" ")


class Lengths(dict):
    """Token numbers by pre-token, encoded when first asked for."""

    def __init__(self, processor, known):
        super().__init__(known)
        self.encode = processor.encode

    def __missing__(self, word: str) -> int:
        # the encoder puts a space before what it gets; before a line break there is none
        n = len(self.encode("\n" + word[1:])) - 1 if word[0] == BREAK else len(self.encode(word))
        if len(word) <= KEPT:
            thin_out(self, HELD)
            self[word] = n
        return n


def frequent_pre_tokens(documents: DataFrame) -> list[str]:
    """The pre-tokens that are frequent in the corpus, ``TABLE`` at most.

    Each task counts all its texts and gives its ``PER_TASK`` most frequent pre-tokens;
    only these summaries are summed up. A task's counter is thinned out when it has grown
    large, taking the least kept count off the others, so memory is bounded.
    """

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(pre_tokens(text) or ())
                if len(seen) > 50 * PER_TASK:
                    top = seen.most_common(10 * PER_TASK)
                    floor = top[-1][1] - 1
                    seen = Counter({w: n - floor for w, n in top})
        top = [(w, n) for w, n in seen.most_common(PER_TASK) if w and len(w) <= LONGEST]
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
            ["word", "n"],
        )

    rows = (
        documents.select(text_of().alias("text"))
        .mapInArrow(summary, "word string, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "word")
        .limit(TABLE)
        .select("word")
        .collect()
    )
    return [r.word for r in rows]


def count_tokens(documents: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """All columns of ``documents`` but its text, with n_bytes, n_tokens and over_limit.

    A null or empty text has no bytes and no tokens. Rows are neither joined nor merged, so
    repeated rows stay as they are; columns named like a result are replaced.
    """
    import sentencepiece

    spark = documents.sparkSession
    processor = sentencepiece.SentencePieceProcessor(model_file=model_path)
    words = frequent_pre_tokens(small_batches(documents))
    bare = Lengths(processor, {})
    table = spark.sparkContext.broadcast({w: bare[w] for w in words})
    keep = [c for c in documents.columns if c not in ("text", "n_bytes", "n_tokens", "over_limit")]
    source = documents.select(*keep, text_of().alias("text"))
    schema = source.drop("text").schema.add("n_bytes", LongType()).add("n_tokens", LongType())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        held = in_worker(
            f"lengths {model_path}",
            lambda: Lengths(
                sentencepiece.SentencePieceProcessor(model_file=model_path), table.value
            ),
        )
        for batch in batches:
            size, tokens = [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                words = pre_tokens(text)
                size.append(len(text.encode()))
                if words is None:
                    tokens.append(len(held.encode(text)))
                else:
                    tokens.append(sum(map(held.__getitem__, words)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(size, pa.int64()), pa.array(tokens, pa.int64())],
                [*batch.schema.names[:-1], "n_bytes", "n_tokens"],
            )

    counted = source.mapInArrow(lean(count), schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
