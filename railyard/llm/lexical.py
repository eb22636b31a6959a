"""Ranked lexical search by NRA: sorted reads with lower and upper score intervals.

The documents are cut into segments of bounded size. In a segment each term's postings are
sorted by impact. A search reads its terms' postings from the top, block after block, and no
others: what was read of a document is its lower score, and what is still to be read at most of
its other terms makes its upper score. It goes on until no unread document and no document
outside the first ``k`` can reach the k-th lower score, ties included, and the scores of the
first ``k`` are complete. A task keeps the best of its segments, and the k-th score so far ends
the reads of later segments earlier; the best of all tasks are merged by two ranking steps.

Statistics (documents, terms, document frequencies) are exact and corpus-wide. Items are taken
in blocks with at most ``BLOCK_WORDS`` terms; per block the driver and each worker hold their
vocabulary, and the documents are read once.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from railyard.llm.common import and_fields, small_batches, text_of
from railyard.llm.decontaminate import words_of
from railyard.plans.checkpoints import cut

BLOCK_WORDS, BLOCK_ITEMS = 100_000, 2_000
SEGMENT_ROWS, SEGMENT_POSTINGS = 16_384, 2_000_000
FIRST_BLOCK = 128  # postings of each term that the first step reads; doubled at each step
GROUPS = 64  # first ranking step
UNIT = 1_000_000_000

Item = tuple[object, dict[bytes, int]]


def _blocks(items: DataFrame) -> Iterator[list[Item]]:
    """(id, terms with their number) of each item, in blocks of bounded size."""
    block, size = [], 0
    for row in items.select("item_id", text_of().cast("binary").alias("text")).toLocalIterator():
        terms = Counter(words_of(bytes(row.text)))
        if block and (size + len(terms) > BLOCK_WORDS or len(block) == BLOCK_ITEMS):
            yield block
            block, size = [], 0
        block.append((row.item_id, dict(terms)))
        size += len(terms)
    if block:
        yield block


def count_terms(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tf) of each row: its number of words, and the words of ``vocabulary``
    that it holds, by their number there, with how often."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)
    source = small_batches(documents).select("doc_id", text_of().cast("binary").alias("text"))
    schema = and_fields(source.select("doc_id").schema, "n bigint, terms array<int>, tf array<int>")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            sizes, lengths, terms, times = [], [], [], []
            for text in batch.column(1):
                words = words_of(text.as_py())
                ids = np.fromiter((i for i in map(number, words) if i is not None), np.int32)
                some, n = np.unique(ids, return_counts=True)
                sizes.append(len(words))
                lengths.append(len(some))
                terms.append(some)
                times.append(n)
            cuts = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
            lists = [
                pa.ListArray.from_arrays(cuts, pa.array(np.concatenate([cuts[:0], *x]).astype(np.int32)))
                for x in (terms, times)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "tf"]
            )

    return source.mapInArrow(count, schema)


class Segment:
    """Impact-sorted postings of some documents."""

    def __init__(self, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tf: np.ndarray, weights, total):
        rows = np.repeat(np.arange(len(n)), sizes)
        documents, words = total
        m = 75 + (25 * n * documents) // max(words, 1)
        tf = tf.astype(np.int64)
        impact = weights[terms] * ((UNIT * tf) // (1000 * tf + 12 * m[rows]))
        order = np.lexsort((rows, -impact, terms))
        self.n_rows, self.rows, self.impact = len(n), rows[order], impact[order]
        self.bounds = np.searchsorted(terms[order], np.arange(len(weights) + 1))

    def search(self, terms: list[tuple[int, int]], k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """The first ``k`` rows, by score and then by row, of all with a score of ``least`` or
        more and above 0, with their complete scores. ``terms`` are (term, times in the item)."""
        lists = [(self.bounds[t], self.bounds[t + 1], q) for t, q in terms if self.bounds[t] < self.bounds[t + 1]]
        lower = np.zeros(self.n_rows, np.int64)
        at = [start for start, _, _ in lists]
        ahead = [q * int(self.impact[start]) for start, _, q in lists]
        depth, need, rest = FIRST_BLOCK, max(least, 1), sum(ahead)
        while True:
            for i, (_, end, q) in enumerate(lists):
                stop = min(at[i] + depth, end)
                lower[self.rows[at[i] : stop]] += q * self.impact[at[i] : stop]
                at[i], ahead[i] = stop, q * int(self.impact[stop]) if stop < end else 0
            rest = sum(ahead)
            if self.n_rows >= k:
                need = max(need, int(np.partition(lower, self.n_rows - k)[self.n_rows - k]))
            upper = lower + rest
            for i, (start, _, _) in enumerate(lists):
                if ahead[i]:  # nothing is to come from a list that the row was read in
                    upper[self.rows[start : at[i]]] -= ahead[i]
            met = np.flatnonzero((lower > 0) & (upper >= need))
            # neither an unread row nor one outside the first can come in, and scores are complete
            if not rest or (rest < need and (upper[met] == lower[met]).all()):
                first = met[np.lexsort((met, -lower[met]))][:k]
                return first, lower[first]
            depth *= 2


class Best:
    """The first ``k`` documents of each item over the segments that a task has searched."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.score = [np.zeros(0, np.int64) for _ in range(n_items)]
        self.ids: list[list] = [[] for _ in range(n_items)]

    def least(self, item: int) -> int:
        return int(self.score[item][-1]) if len(self.score[item]) == self.k else 0

    def add(self, item: int, score: np.ndarray, ids: list) -> None:
        if not len(score):
            return
        score, ids = np.concatenate((self.score[item], score)), self.ids[item] + ids
        order = sorted(range(len(ids)), key=lambda i: (-score[i], ids[i] is None, ids[i] or 0))[: self.k]
        self.score[item], self.ids[item] = score[order], [ids[i] for i in order]


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search_block(documents: DataFrame, block: list[Item], kind_of_item: str, k: int) -> DataFrame:
    spark = documents.sparkSession
    vocabulary: dict[bytes, int] = {}
    for _, terms in block:
        for t in terms:
            vocabulary.setdefault(t, len(vocabulary))
    counted = cut(count_terms(documents, vocabulary))
    total = counted.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("words")).first()
    n, words = total.documents, total.words or 0
    df = np.zeros(len(vocabulary), np.int64)
    for row in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[row.term] = row["count"]
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    asked = [[(vocabulary[t], q) for t, q in terms.items()] for _, terms in block]
    shared = spark.sparkContext.broadcast((weights, asked))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, asked = shared.value
        best = Best(len(asked), k)
        for part in _segments(batches):
            order = part.sort_by([("doc_id", "ascending")])
            ids = order.column(0).to_pylist()
            lists = order.column("terms").combine_chunks(), order.column("tf").combine_chunks()
            segment = Segment(
                order.column("n").to_numpy(),
                lists[0].value_lengths().to_numpy(zero_copy_only=False),
                *(x.flatten().to_numpy(zero_copy_only=False) for x in lists),
                weights,
                (n, words),
            )
            for item, terms in enumerate(asked):
                rows, score = segment.search(terms, k, best.least(item))
                best.add(item, score, [ids[r] for r in rows.tolist()])
        yield pa.RecordBatch.from_pydict(
            {
                "item": pa.array(np.repeat(np.arange(len(asked)), list(map(len, best.ids))), pa.int32()),
                "doc_id": pa.array([i for ids in best.ids for i in ids], id_type),
                "score": pa.array(np.concatenate(best.score), pa.int64()),
            }
        )

    kind = counted.schema["doc_id"].dataType
    id_type = to_arrow_type(kind)
    found = counted.mapInArrow(search, f"item int, doc_id {kind.simpleString()}, score bigint")
    salted = found.withColumn("group", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
    ranked = _ranked(_ranked(salted, ["item", "group"], k), ["item"], k)
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], f"item int, item_id {kind_of_item}")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of at most ``SEGMENT_ROWS`` rows and about ``SEGMENT_POSTINGS`` postings."""
    held, rows, postings = [], 0, 0
    for whole in batches:
        for start in range(0, whole.num_rows, 1024):
            batch = whole.slice(start, 1024)
            size = len(batch.column(2).flatten())
            if held and (rows + batch.num_rows > SEGMENT_ROWS or postings + size > SEGMENT_POSTINGS):
                yield pa.Table.from_batches(held)
                held, rows, postings = [], 0, 0
            held.append(batch)
            rows, postings = rows + batch.num_rows, postings + size
    if held:
        yield pa.Table.from_batches(held)


def search(documents: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` highest-scoring documents of each item.

    A null text has no terms. Each row of ``items`` is searched for by itself, and each row of
    ``documents`` is a document, repeated ones included; rows without a doc_id come last among
    equal scores. Items without terms, and scores of 0, give no rows. Other columns are left out.
    """
    kind = items.schema["item_id"].dataType.simpleString()
    parts = [_search_block(documents, block, kind, k) for block in _blocks(items)]
    if not parts:
        doc = documents.schema["doc_id"].dataType.simpleString()
        schema = f"item_id {kind}, rank int, doc_id {doc}, score bigint"
        return documents.sparkSession.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
