"""Alignment of two tokenizers by galloping intersection of their token ends.

Each tokenizer gives the byte offsets at which its tokens end. The shorter list of ends drives
an exponential and then a binary search into the longer; the common offsets cut both token
sequences into groups, and the differences of successive ranks are the ranges of tokens that
overlap in a group. A pair of tokens that end together is a link.

The texts of a batch are laid end to end, so one intersection serves all of them; the driving
list is cut into lanes that gallop side by side.

Corpus counts of links are exact. A first pass writes each row's numbers and links; the counts
of the ``TABLE`` most frequent pairs are broadcast as sorted arrays, all other pairs are joined.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import and_fields, in_worker, small_batches, text_of
from railyard.plans.checkpoints import cut

TABLE = 1 << 18  # pairs whose counts are broadcast, 17 bytes each
BATCH_BYTES = 4 << 20  # of texts that are aligned at once
LANE = 256  # ends that one lane of the search takes
SPACE = "▁"
# fixed value: how a byte-level tokenizer cuts a text
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranks i, j with a[i] == b[j]; both arrays rise strictly.

    The shorter one is cut into lanes. Each lane goes on from the last place in the longer one:
    the step doubles until the end is passed, and a binary search ends within that last step.
    """
    if len(a) > len(b):
        j, i = common_ends(b, a)
        return i, j
    n, most = len(a), np.iinfo(np.int64).max
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    grid = np.full(-(-n // LANE) * LANE, a[-1], np.int64)
    grid[:n] = a
    grid = grid.reshape(-1, LANE)
    longer = np.append(b, most)
    places = np.empty(grid.shape, np.int64)
    at = np.searchsorted(b, grid[:, 0])
    for k in range(LANE):
        end = grid[:, k]
        low, high, step = at.copy(), at.copy(), 1
        while (short := longer[high] < end).any():
            low[short] = high[short] + 1
            high[short] = np.minimum(high[short] + step, len(b))
            step *= 2
        while (low < high).any():
            mid = (low + high) // 2
            less = longer[mid] < end
            low, high = np.where(less, mid + 1, low), np.where(less, high, mid)
        places[:, k] = at = low
    places = places.ravel()[:n]
    i = np.flatnonzero(longer[places] == a)
    return i, places[i]


def entry_bytes(token: str) -> bytes | None:
    """Bytes of a byte-level entry: printable Latin-1 stands for itself, 256 and on for the others."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [c for c in range(256) if c not in plain]
    codes = [c if (c := ord(x)) in plain else others[c - 256] if 256 <= c < 256 + len(others) else -1 for x in token]
    return None if -1 in codes else bytes(codes)


class ByteLevel:
    """A byte-level tokenizer of the tokenizers library. Where its file says no more than merges
    in the order of ids, the same merges run in tiktoken, which is four times as fast."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        file = json.loads(self.library.to_str())
        special = {t["id"] for t in file["added_tokens"]}
        entries = {i: t for t, i in file["model"]["vocab"].items() if i not in special}
        known = {i: entry_bytes(t) for i, t in entries.items()}
        self.bytes = [known.get(i) or b"" for i in range(max(known) + 1)]
        merged = [file["model"]["vocab"].get(a + b) for a, b in map(self._pair, file["model"]["merges"])]
        how = file["pre_tokenizer"] or {}
        plain = how.get("type") == "ByteLevel" and not how.get("add_prefix_space") and how.get("use_regex", True)
        self.fast = None
        if plain and not file["normalizer"] and None not in merged and merged == sorted(merged):
            import tiktoken

            ranks = {b: i for i, b in known.items()}
            self.fast = tiktoken.Encoding("a", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def _pair(merge) -> list[str]:
        return merge.split(" ") if isinstance(merge, str) else merge

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.fast:
            return [self.fast.encode_ordinary(t) for t in texts]
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """A sentence-piece tokenizer, which puts a space before what it gets."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._piece(self.library.id_to_piece(i)) for i in range(self.library.get_piece_size())]

    @staticmethod
    def _piece(piece: str) -> bytes:
        byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace(SPACE, " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


class Aligner:
    """Two tokenizers and the texts by which their ids are named in groups."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.size_a = np.fromiter(map(len, self.a.bytes), np.int64)
        self.size_b = np.fromiter(map(len, self.b.bytes), np.int64)
        self.first_b = 2 * len(self.a.bytes)  # in names: A's ids, then B's, each inside and at the end of its part
        self.names = [f"{i}{end}".encode() for i in range(len(self.a.bytes)) for end in ",|"]
        self.names += [f"{i}{end}".encode() for i in range(len(self.b.bytes)) for end in ",;"]

    def of_texts(self, texts: list[str]) -> Groups:
        """The texts' groups; a text that a tokenizer does not give back has no tokens."""
        got = [i for i, t in enumerate(texts) if t]
        spaced = [" " + texts[i] for i in got]
        ids_a, ids_b = self.a.encode(spaced), self.b.encode([texts[i] for i in got])
        whole, a, b = [], [], []
        for i, text, x, y in zip(got, spaced, ids_a, ids_b):
            raw = text.encode()
            if b"".join(map(self.a.bytes.__getitem__, x)) == raw == b"".join(map(self.b.bytes.__getitem__, y)):
                whole.append(i)
                a.append(x)
                b.append(y)
        return Groups(self, len(texts), np.array(whole, np.int64), a, b)


class Groups:
    """The groups of several texts, laid end to end."""

    def __init__(self, aligner: Aligner, n_texts: int, whole: np.ndarray, a: list, b: list):
        self.aligner, self.whole = aligner, whole
        self.n_a, self.n_b, self.n_groups = (np.zeros(n_texts, np.int64) for _ in range(3))
        self.n_a[whole], self.n_b[whole] = list(map(len, a)), list(map(len, b))
        self.a, self.b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (a, b))
        ends_a, ends_b = np.cumsum(aligner.size_a[self.a]), np.cumsum(aligner.size_b[self.b])
        filled_a, filled_b = aligner.size_a[self.a] > 0, aligner.size_b[self.b] > 0
        if filled_a.all() and filled_b.all():
            self.i, self.j = common_ends(ends_a, ends_b)
        else:  # an entry without bytes belongs to the token before it
            at_a, at_b = np.flatnonzero(filled_a), np.flatnonzero(filled_b)
            i, j = common_ends(ends_a[at_a], ends_b[at_b])
            self.i, self.j = np.append(at_a, len(self.a))[i + 1] - 1, np.append(at_b, len(self.b))[j + 1] - 1
        self.text = np.repeat(np.arange(n_texts), self.n_a)[self.i]
        self.n_groups += np.bincount(self.text, minlength=n_texts)

    def ranges(self) -> np.ndarray:
        """A row a group: its first and past its last token of A, the same of B; ranks over all texts."""
        start = [np.concatenate(([0], x[:-1] + 1)) if len(x) else x for x in (self.i, self.j)]
        return np.stack([start[0], self.i + 1, start[1], self.j + 1], axis=1)

    def written(self) -> list[bytes]:
        """Each text's groups as ``a1,a2|b1;a3|b2,b3``."""
        first_a, past_a, first_b, past_b = self.ranges().T
        order = np.empty(len(self.a) + len(self.b), np.int64)
        last_a, last_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        last_a[self.i] = last_b[self.j] = 1
        order[np.arange(len(self.a)) + np.repeat(first_b, past_a - first_a)] = 2 * self.a + last_a
        order[np.arange(len(self.b)) + np.repeat(past_a, past_b - first_b)] = self.aligner.first_b + 2 * self.b + last_b
        names, out, at = self.aligner.names, [], 0
        for n in (self.n_a + self.n_b).tolist():
            out.append(b"".join(map(names.__getitem__, order[at : at + n].tolist()))[:-1])
            at += n
        return out

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, pair (A's id x 2^32 + B's) and number of links, sorted, once for each text and pair."""
        pair = self.a[self.i] << 32 | self.b[self.j]
        order = np.lexsort((pair, self.text))
        text, pair = self.text[order], pair[order]
        new = np.ones(len(pair), bool)
        new[1:] = (text[1:] != text[:-1]) | (pair[1:] != pair[:-1])
        at = np.flatnonzero(new)
        return text[at], pair[at], np.diff(np.append(at, len(pair)))


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``batch``, whose last column is text, in slices of some ``BATCH_BYTES`` of text."""
    ends = np.cumsum(pa.compute.binary_length(batch.column(batch.num_columns - 1)).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        past = max(at + 1, int(np.searchsorted(ends, done + BATCH_BYTES, "right")))
        yield batch.slice(at, past - at)
        at = past


def groups_of(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """All columns of ``documents`` but its text, with n_a, n_b, n_groups, n_links, groups_sha256,
    pairs (A's id x 2^32 + B's) and times, how often each of them is linked.

    A text that is null or empty, or that a tokenizer does not give back byte by byte, has no
    tokens. Repeated rows stay as they are; columns named like a result are replaced.
    """
    numbers = ("n_a", "n_b", "n_groups", "n_links")
    new = (*numbers, "groups_sha256", "pairs", "times")
    keep = [c for c in documents.columns if c not in ("text", *new)]
    source = small_batches(documents).select(*keep, text_of().alias("text"))
    fields = [f"{c} bigint" for c in numbers] + ["groups_sha256 string", "pairs array<bigint>", "times array<bigint>"]
    out = and_fields(source.drop("text").schema, ", ".join(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        aligner = in_worker(f"aligner {path_a} {path_b}", lambda: Aligner(path_a, path_b))
        for whole in batches:
            for batch in _portions(whole):
                found = aligner.of_texts(batch.column(batch.num_columns - 1).to_pylist())
                shas = [hashlib.sha256(t).hexdigest() if t else "" for t in found.written()]
                text, pair, times = found.links()
                cuts = pa.array(np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:-1],
                        *map(pa.array, (found.n_a, found.n_b, found.n_groups, found.n_groups)),
                        pa.array(shas, pa.string()),
                        *(pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (pair, times)),
                    ],
                    [*batch.schema.names[:-1], *new],
                )

    return source.mapInArrow(run, out)


def _counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): how many links hold each pair, and whether none of its B id has more."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            times = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            some, at = np.unique(pairs, return_inverse=True)
            n = np.bincount(at, times, len(some)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(n)], ["pair", "n"])

    partial = aligned.select("pairs", "times").mapInArrow(sums, "pair bigint, n bigint")
    counts = cut(partial.groupBy("pair").agg(F.sum("n").alias("n")))
    b = F.col("pair").bitwiseAND((1 << 32) - 1)
    top = counts.groupBy(b.alias("b")).agg(F.max("n").alias("top"))
    return cut(counts.withColumn("b", b).join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best")))


def align(documents: DataFrame, path_a: str, path_b: str, table: int = TABLE) -> DataFrame:
    """``groups_of`` without the links, with n_best, the row's links whose count is the highest of
    their B id in the corpus, and count_sum, the counts of all its links together."""
    spark = documents.sparkSession
    names = [f"c{i}" for i in range(len(documents.columns))]
    at = documents.columns.index("text")
    plain = documents.toDF(*names[:at], "text", *names[at + 1 :])
    aligned = cut(groups_of(plain, path_a, path_b).withColumn("_row", F.monotonically_increasing_id()))
    counts = _counts(aligned)
    known = counts.orderBy(F.desc("n"), "pair").limit(table).toPandas().sort_values("pair")
    shared = spark.sparkContext.broadcast(
        (known["pair"].to_numpy(np.int64), known["n"].to_numpy(np.int64), known["best"].to_numpy(bool))
    )

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = shared.value
        for batch in batches:
            row, lists, times = batch.columns
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            times = times.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            place = np.minimum(np.searchsorted(pairs, flat), max(len(pairs) - 1, 0))
            hit = pairs[place] == flat if len(pairs) else np.zeros(len(flat), bool)
            total, good = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            np.add.at(total, owner[hit], times[hit] * n[place[hit]])
            np.add.at(good, owner[hit], times[hit] * best[place[hit]])
            miss = ~hit
            cuts = np.concatenate(([0], np.cumsum(np.bincount(owner[miss], minlength=len(sizes))))).astype(np.int32)
            left = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(x[miss])) for x in (flat, times)]
            yield pa.RecordBatch.from_arrays(
                [row, pa.array(total), pa.array(good), *left], ["_row", "total", "good", "pairs", "times"]
            )

    partly = cut(
        aligned.select("_row", "pairs", "times").mapInArrow(
            look_up, "_row bigint, total bigint, good bigint, pairs array<bigint>, times array<bigint>"
        )
    )
    rare = partly.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("z")).select(
        "_row", F.col("z.pairs").alias("pair"), F.col("z.times").alias("times")
    )
    joined = rare.join(counts, "pair").select(
        "_row",
        (F.col("times") * F.col("n")).alias("total"),
        (F.col("times") * F.col("best").cast("int")).alias("good"),
    )
    both = partly.select("_row", "total", "good").unionByName(joined)
    sums = both.groupBy("_row").agg(F.sum("good").alias("n_best"), F.sum("total").alias("count_sum"))
    own = {f"c{i}": c for i, c in enumerate(documents.columns)}
    added = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    back = [F.col(c).alias(old) for c, old in own.items() if old != "text" and old not in added]
    return aligned.drop("pairs", "times").join(sums, "_row").select(*back, *added)
