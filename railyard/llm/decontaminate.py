"""Benchmark decontamination with a generalised suffix automaton.

The automaton accepts every run of words of every test item. A document's words stream
through it; at each word it gives the length of the longest run ending there that is also in
some item. Where that reaches the window (or a whole item that is shorter), the last words are
hit. Words that no item has reset the automaton, so stretches between them that are too short
for any window are passed over.

Items are taken in blocks of at most ``BLOCK_WORDS`` words, each block one broadcast automaton
and one pass over the documents, so neither the driver nor a worker holds more than one block.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import lean, small_batches, text_of
from railyard.plans.checkpoints import cut

WINDOW = 13
BLOCK_WORDS = 100_000
# ASCII letters in lower case; digits and all beyond ASCII as they are; white space else
LETTERS = bytes(
    c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32
    for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


class Automaton:
    """Suffix automaton of several word sequences; states are numbers, 0 is the start."""

    def __init__(self, items: Iterable[tuple[object, list[bytes]]], window: int):
        self.window, self.vocabulary = window, {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        held = []
        for name, words in items:
            if words:
                ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
                held.append((name, ids))
                last = 0
                for w in ids:
                    last = self._extend(last, w)
        self.shortest = min((min(window, len(ids)) for _, ids in held), default=window)
        self._mark(held)

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:  # this run is known from an earlier item
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._split(last, w, q)
        new = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, w, q)
        return new

    def _split(self, p: int, w: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = copy
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = copy
            p = link[p]
        return copy

    def _mark(self, held) -> None:
        """Items by the state of a window; short items by the states they end in."""
        self.items: dict[int, set] = {}
        short: dict[int, list] = {}
        for name, ids in held:
            state = 0
            for i, w in enumerate(ids):
                state = self.next[state][w]
                if i + 1 >= self.window:
                    self.items.setdefault(self._window_state(state), set()).add(name)
            if len(ids) < self.window:
                short.setdefault(state, []).append((len(ids), name))
        self.at_window = [
            self._window_state(s) if self.length[s] >= self.window else -1
            for s in range(len(self.next))
        ]
        self.short: list[tuple] = [()] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            own = tuple(short.get(s, ()))
            self.short[s] = self.short[self.link[s]] + own if own else self.short[self.link[s]]

    def _window_state(self, state: int) -> int:
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set, int]:
        """Merged spans [first word, past the last], items found, longest run."""
        n = len(words)
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, n)
        stops = np.flatnonzero(ids < 0)
        starts = np.concatenate(([0], stops + 1))
        ends = np.concatenate((stops, [n]))
        wide = np.flatnonzero(ends - starts >= self.shortest)
        spans: list[list[int]] = []
        found: set = set()
        longest = 0
        nxt, link, length, window = self.next, self.link, self.length, self.window
        for a, b in zip(starts[wide].tolist(), ends[wide].tolist()):
            state = size = 0
            for i, w in enumerate(ids[a:b].tolist(), a + 1):
                while state and w not in nxt[state]:
                    state = link[state]
                    size = length[state]
                if w not in nxt[state]:
                    continue
                state = nxt[state][w]
                size += 1
                longest = max(longest, size)
                back = 0
                if size >= window:
                    back = window
                    found |= self.items[self.at_window[state]]
                for m, name in self.short[state]:
                    if m <= size:
                        back = max(back, m)
                        found.add(name)
                if back:
                    while spans and spans[-1][1] >= i - back:
                        back = max(back, i - spans.pop()[0])
                    spans.append([i - back, i])
        found.discard(None)  # items without an id
        return spans, found, longest


def merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[object, list[bytes]]]]:
    block, size = [], 0
    rows = benchmark.select("item_id", text_of().cast("binary").alias("text"))
    for row in rows.toLocalIterator():
        words = words_of(bytes(row.text))
        if block and size + len(words) > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((None if row.item_id is None else str(row.item_id), words))
        size += len(words)
    yield block


def find_overlaps(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, cut_out: bool = False
) -> DataFrame:
    """``documents`` with n_words, spans (hit words as [start, end)), items and longest run.

    A null text has no words; items without words are not looked for; items without an id count
    for spans and longest but are not named; items with the same id count as one. Without items
    nothing is hit. With ``cut_out`` the texts come back without their hit words, each span from
    its first to its last word. Columns of ``documents`` named like a result are replaced.
    """
    spark = documents.sparkSession
    drop = ("text", "n_words", "spans", "items", "longest")
    keep = [c for c in documents.columns if c not in drop]
    out = small_batches(documents).select(
        *keep,
        "text",
        F.lit(0).cast("bigint").alias("n_words"),
        F.expr("cast(array() as array<array<int>>)").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"),
        F.lit(0).alias("longest"),
    )
    spans_type = pa.list_(pa.list_(pa.int32()))

    def scan_with(shared, remove: bool):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = shared.value
            for batch in batches:
                raw = batch.column(len(keep)).cast(pa.binary()).to_pylist()
                _, spans, items, longest = (c.to_pylist() for c in batch.columns[-4:])
                count = []
                for i, t in enumerate(raw):
                    words = words_of(t or b"")
                    count.append(len(words))
                    s, found, size = automaton.scan(words)
                    if s:
                        spans[i] = merged(spans[i] + s) if spans[i] else s
                        items[i] = sorted(found.union(items[i]))
                    longest[i] = max(longest[i], size)
                    if remove and spans[i]:
                        raw[i] = without_spans(t, spans[i])
                text = pa.array(raw, pa.binary()).cast(pa.string()) if remove else batch.column(len(keep))
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:-5],
                        text,
                        pa.array(count, pa.int64()),
                        pa.array(spans, spans_type),
                        pa.array(items, pa.list_(pa.string())),
                        pa.array(longest, pa.int32()),
                    ],
                    batch.schema.names,
                )

        return lean(scan)

    blocks = list_ahead(_blocks(benchmark))
    for i, (block, last) in enumerate(blocks):
        source = cut(out) if i else out
        shared = spark.sparkContext.broadcast(Automaton(block, window))
        out = source.mapInArrow(scan_with(shared, cut_out and last), source.schema)
    return out


def list_ahead(items: Iterator) -> Iterator[tuple]:
    """Each item with whether it is the last; one is read ahead."""
    items = iter(items)
    held = next(items)
    for item in items:
        yield held, False
        held = item
    yield held, True


def with_hits(overlaps: DataFrame, share: int = 20) -> DataFrame:
    """n_hit, and contaminated: some words are hit and they are one in ``share`` at least."""
    hit = F.aggregate(
        "spans", F.lit(0).cast("bigint"), lambda total, s: total + F.get(s, F.lit(1)) - F.get(s, F.lit(0))
    )
    return overlaps.withColumn("n_hit", hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    )


def without_spans(raw: bytes, spans: list[list[int]]) -> bytes:
    """A text without the words of its spans, each cut from its first to its last word."""
    at = [m.span() for m in re.finditer(rb"\S+", raw.translate(LETTERS))]
    parts, last = [], 0
    for a, b in spans:
        parts.append(raw[last : at[a][0]])
        last = at[b - 1][1]
    return b"".join([*parts, raw[last:]])
