"""Best-fit packing of token pieces by a configuration linear program.

1. Tasks tokenise whole texts and cut documents longer than a sequence; each piece gets its
   place among the pieces of its length in its task.
2. The histogram of lengths, at most ``capacity`` rows whatever the corpus, goes to the
   driver. There a covering program over configurations (sets of lengths that fit one
   sequence) is solved by multiplicative weights; each round prices all configurations at
   once by a knapsack dynamic program. Whole multiples of the configurations are kept, and
   best fit, working on counts, places what rounding leaves over.
3. The plan says which places of each length a configuration takes. It is a table of at most
   a few configurations per length and per round, so it is broadcast, and each piece looks up
   its sequence and its offset.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railyard.llm.common import in_worker, lean, small_batches, text_of, thin_out
from railyard.plans.checkpoints import cut

END = 1  # the id that closes each document
HELD, LONGEST = 500_000, 64  # entries of a worker's dictionary, and the bytes of their keys
PLACES = 1 << 40  # more than the pieces of one length


# ---------------------------------------------------------------- tokens and pieces
class Words(dict):
    """Ids as little-endian bytes, by words between white space, in ASCII lower case.

    The tokenizer lower-cases, drops white space and never joins letters with a full stop or
    a comma, so such a word's ids do not depend on the words around it.
    """

    def __init__(self, tokenizer):
        super().__init__({b"": b""})
        self.tokenizer, self.tokenize = tokenizer, tokenizer.model.tokenize

    def encode(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        if word[-1:] in (b".", b",") and word[:-1].isalpha():
            ids = self[word[:-1]] + self[word[-1:]]
        elif word.isalpha():  # ASCII letters only: one pre-token, in the model's own alphabet
            ids = np.array([t.id for t in self.tokenize(word.decode())], "<u4").tobytes()
        else:
            ids = self.encode(word.decode())
        if len(word) <= LONGEST:
            thin_out(self, HELD)
            self[word] = ids
        return ids

    def of_text(self, text: bytes) -> bytes:
        if b"<|" in text:  # special tokens are spelt in lower case only
            return self.encode(text.decode())
        return b"".join(map(self.__getitem__, text.lower().replace(b"\n", b" ").split(b" ")))


def pieces(documents: DataFrame, tokenizer_path: str, capacity: int) -> DataFrame:
    """One row per piece, with its task and its place among that task's equal lengths."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        import tokenizers
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        words = in_worker(
            f"ids {tokenizer_path}",
            lambda: Words(tokenizers.Tokenizer.from_file(tokenizer_path)),
        )
        last, full = np.array([END], "<u4").tobytes(), 4 * capacity
        seen: Counter[int] = Counter()
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = words.of_text(text) + last
                for i, at in enumerate(range(0, len(ids), full)):
                    part = ids[at : at + full]
                    n = len(part) // 4
                    out.append((doc_id, i, at // 4, n, zlib.crc32(part), task, seen[n]))
                    seen[n] += 1
            columns = list(zip(*out)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], schema=arrow
            )

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "place"]
    id_type = documents.schema["doc_id"].dataType.simpleString()
    arrow_id = {"int": pa.int32(), "string": pa.string()}.get(id_type, pa.int64())
    types = [arrow_id, pa.int32(), *[pa.int64()] * 5]
    arrow = pa.schema(list(zip(names, types)))
    kinds = [id_type, "int", *["bigint"] * 5]
    source = small_batches(documents).select("doc_id", text_of().cast("binary").alias("text"))
    return source.mapInArrow(lean(make), ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


# ---------------------------------------------------------------- the linear program
def best_configuration(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> dict[int, int]:
    """The most valuable multiset of lengths within the capacity, by dynamic programming."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if k := fits[room]:
            value = prices[:k] + best[room - lengths[:k]]
            i = int(value.argmax())
            if value[i] > best[room]:
                best[room], choice[room] = value[i], i
    found: Counter[int] = Counter()
    room = capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            found[int(lengths[choice[room]])] += 1
            room -= int(lengths[choice[room]])
    return dict(found)


def fractional(
    counts: dict[int, int], capacity: int, rounds: int
) -> list[tuple[dict[int, int], float]]:
    """Configurations and how often each is used, by multiplicative weights.

    A length's price starts at its share of a sequence. A round takes the configuration of
    the highest total price as often as its scarcest length allows, and lowers the price of
    each length by the share of its pieces that this covers.
    """
    lengths = np.array(sorted(counts))
    if not len(lengths):
        return []
    demand = np.array([counts[n] for n in lengths.tolist()], float)
    share = lengths / capacity
    prices = share * (1 + 1e-3 * share)  # among equals, the longer ones first
    covered, uses = np.zeros(len(lengths)), []
    for _ in range(rounds):
        found = best_configuration(lengths, prices, capacity)
        at = np.searchsorted(lengths, list(found))
        taken = np.array(list(found.values()), float)
        times = float((demand[at] / taken).min())
        uses.append((found, times))
        covered[at] += taken * times
        prices[at] *= np.exp(-taken * times / demand[at])
        if (covered >= demand).all():
            break
    return uses


def rounded(
    uses: list[tuple[dict[int, int], float]], counts: dict[int, int], capacity: int
) -> tuple[list[tuple[dict[int, int], int]], dict[int, int]]:
    """Whole numbers of uses within the counts, fullest configurations first; the rest."""
    left, plan = dict(counts), []

    def fill(use):
        return sum(n * k for n, k in use[0].items())

    for found, times in sorted(uses, key=lambda u: (-fill(u), -u[1])):
        if fill((found, times)) < 0.999 * capacity:
            continue
        whole = min(math.floor(times), *(left[n] // k for n, k in found.items()))
        if whole:
            plan.append((found, whole))
            for n, k in found.items():
                left[n] -= k * whole
    return plan, {n: k for n, k in left.items() if k}


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best fit, longest first. Equal sequences are one entry with a multiplicity, so the
    work follows the number of different lengths, not of pieces."""
    by_room: dict[int, list[tuple[dict[int, int], int]]] = defaultdict(list)
    rooms = np.zeros(capacity + 1, bool)

    def put(found, times, room):
        if times:
            by_room[room].append((found, times))
            rooms[room] = True

    for n in sorted(counts, reverse=True):
        k = counts[n]
        while k:
            tight = np.flatnonzero(rooms[n:])
            room = n + int(tight[0]) if len(tight) else capacity
            found, times = by_room[room].pop() if len(tight) else ({}, k)
            rooms[room] = bool(by_room[room])
            each = min(room // n, k)
            use = min(times, k // each)
            put(found, times - use if len(tight) else 0, room)
            put({**found, n: each}, use, room - each * n)
            k -= use * each
    return [x for entries in by_room.values() for x in entries]


def plan_sequences(counts: dict[int, int], capacity: int, rounds: int) -> dict[str, np.ndarray]:
    """For each length and range of places: first sequence, pieces in each, first offset."""
    plan, rest = rounded(fractional(counts, capacity, rounds), counts, capacity)
    taken: Counter[int] = Counter()
    sequence, rows = 0, []
    for found, times in plan + best_fit(rest, capacity):
        offset = 0
        for n in sorted(found, reverse=True):
            rows.append((n * PLACES + taken[n], sequence, found[n], offset))
            taken[n] += found[n] * times
            offset += found[n] * n
        sequence += times
    assert taken == Counter(counts)
    rows.sort()
    names = ("key", "sequence", "each", "offset")
    return {k: np.array([r[i] for r in rows], np.int64) for i, k in enumerate(names)}


# ---------------------------------------------------------------- the operator
def pack(
    documents: DataFrame, tokenizer_path: str, capacity: int = 4096, rounds: int = 160
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    A null or empty text is the closing id alone. Rows with the same doc_id, or of the same
    text, are packed each for itself. No rows give no sequences. Other columns are not read.
    """
    held = cut(pieces(documents, tokenizer_path, capacity))
    spark = held.sparkSession
    by_task = held.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task")
    starts = by_task.withColumn(
        "before", F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, -1))
    ).select("length", "task", F.coalesce("before", F.lit(0)).alias("before"))
    histogram = held.groupBy("length").count().collect()  # one row per length up to capacity
    plan = spark.sparkContext.broadcast(
        plan_sequences({r["length"]: r["count"] for r in histogram}, capacity, rounds)
    )
    placed = held.join(starts, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("before") + F.col("place")).alias("place"),
    )
    kinds = placed.schema.fields[:5]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            key = length * PLACES + batch.column("place").to_numpy()
            i = np.searchsorted(p["key"], key, side="right") - 1
            step = key - p["key"][i]
            sequence = p["sequence"][i] + step // p["each"][i]
            offset = p["offset"][i] + step % p["each"][i] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                [*batch.schema.names[:5], "sequence_id", "offset"],
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kinds)
    return placed.mapInArrow(assign, schema + ", sequence_id bigint, offset bigint")
