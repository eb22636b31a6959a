"""N-gram Jaccard join with token-combination prefixes.

Documents are sets of hashed word shingles (their tokens); equal sets are one node. Two sets
of similarity p have at most (1 - p) of the larger one's tokens apart, so in any common order
of the tokens their prefixes must share signatures once a prefix holds more tokens than may
be apart. The order here is by frequency class:

* tokens of no other node need no index at all, they only count;
* rare tokens, by their frequency, are indexed one by one;
* frequent tokens, which a count sketch over the corpus names, and those beyond the counted
  share of the hash range are indexed as pairs within groups of tokens. A pair-indexed group
  counts for one token less than it holds, so the prefix is extended by one token a group.
  The number of groups depends on a set's size band; sets near a band's lower end are indexed
  in the band below as well.

Most documents have enough tokens of their own and are not indexed. Nodes that share a
signature are gathered around one of them, the leader, instead of being paired: a group is
verified as a whole by products of 0/1 matrices. A group of more than ``BLOCK`` nodes is cut
into blocks by the distance to its leader; blocks farther apart than two linked sets can be,
by the triangle inequality, do not meet. Groups give spanning links only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railyard.llm.common import in_worker, lean, small_batches, text_of
from railyard.llm.components import stars
from railyard.llm.shingles import Shingler, mix, node_of
from railyard.plans.checkpoints import cut

CELLS, SLICES = 1 << 20, 16  # of the count sketch: 4 MB a task, 128 KB as broadcast bits
FREQUENT_SHARE, FREQUENT_LEAST = 500, 64  # frequent: in more than one of 500 documents
BLOCK = 1024
STEPS = 20  # distance steps of a group
FILTER_BITS = 1 << 23


class Scheme:
    """The numbers that follow from shingle length and similarity in hundredths. ``spare``
    says how much of the hash range is counted, as a multiple of a prefix's share of it."""

    def __init__(self, n: int, percent: int, spare: float = 1.5):
        self.n, self.percent = n, percent
        self.least = -(-percent // (100 - percent))  # smaller sets link with equal ones only
        self.counted = np.uint64(min(spare * (100 - percent) / 100, 0.9) * 2**64)
        self.reach = -(-STEPS * (100 - percent) // 100)

    def need(self, size: int) -> int:
        """Tokens of a prefix: one more than may be missing in a similar set."""
        return (100 - self.percent) * size // 100 + 1

    def bands(self, size: int) -> list[int]:
        band = size.bit_length() - 1
        return [band, band - 1] if size * self.percent <= 100 << band else [band]

    def groups(self, band: int) -> int:
        return max(1, (1 << band) * (100 - self.percent) // 300)


def _shingler(n: int) -> Shingler:
    """The worker's own, which takes the place of any other operator's cache."""
    return in_worker(f"shingler {n}", lambda: Shingler(n))


def _seen_before(seen: dict, node: int) -> bool:
    """Whether this task met the node lately; equal texts often stand together."""
    if node in seen:
        return True
    seen[node] = True
    if len(seen) > 200_000:
        for key in list(islice(seen, 100_000)):
            del seen[key]
    return False


# ---------------------------------------------------------------- nodes and the sketch
def _nodes(documents: DataFrame, scheme: Scheme) -> DataFrame:
    """(doc_id, n_shingles, node, th) of every row, and each task's part of the sketch."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shingler, counts = _shingler(scheme.n), np.zeros(CELLS, np.uint32)
        for batch in batches:
            sizes, nodes = [], []
            for s in shingler.sets(batch.column(2).to_pylist()):
                sizes.append(len(s))
                nodes.append(node_of(s) if len(s) else None)
                np.add.at(counts, (s % np.uint64(CELLS)).astype(np.int64), 1)
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), batch.column(1),
                 pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())],
                names,
            )
        task, width = TaskContext.get().partitionId(), CELLS // SLICES
        parts = [zlib.compress(counts[i * width : (i + 1) * width].tobytes(), 1) for i in range(SLICES)]
        none = pa.nulls(SLICES, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(SLICES, id_type), none, none, none, pa.array([task] * SLICES, pa.int32()),
             pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())],
            names,
        )

    names = ["doc_id", "n_shingles", "node", "th", "task", "slice", "counts"]
    kind = documents.schema["doc_id"].dataType.simpleString()
    id_type = {"int": pa.int32(), "string": pa.string()}.get(kind, pa.int64())
    schema = f"doc_id {kind}, n_shingles bigint, node bigint, th bigint, task int, slice int, counts binary"
    return documents.select("doc_id", F.xxhash64(text_of()).alias("th"), text_of().cast("binary").alias("text")).mapInArrow(lean(scan), schema)


def _frequent(sketches: DataFrame, limit: int) -> np.ndarray:
    """Bits of the sketch's cells that count more than ``limit``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, sums = CELLS // SLICES, {}
        for batch in batches:
            for i, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = sums.setdefault(i, np.zeros(width, np.uint64))
                own += np.frombuffer(zlib.decompress(part), np.uint32)
        out = [(i, zlib.compress(np.minimum(s, 2**32 - 1).astype(np.uint32).tobytes(), 1)) for i, s in sums.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in out], pa.int32()), pa.array([p for _, p in out], pa.binary())],
            ["slice", "counts"],
        )

    schema = "slice int, counts binary"
    # first by task, then by slice, so that no task sums up all others
    some = sketches.repartition("task").select("slice", "counts").mapInArrow(add, schema)
    all_ = some.repartition(SLICES, "slice").mapInArrow(add, schema)
    bits = np.zeros(CELLS, bool)
    for row in all_.toLocalIterator():
        i = row["slice"] * (CELLS // SLICES)
        counts = np.frombuffer(zlib.decompress(bytes(row["counts"])), np.uint32)
        bits[i : i + len(counts)] = counts > limit
    return bits


# ---------------------------------------------------------------- who must be indexed
def _counted_tokens(documents: DataFrame, scheme: Scheme, shared) -> DataFrame:
    """(token, node, slack) of the rare tokens in the counted share of the hash range; slack
    is how many of a node's may be repeated before it must be indexed. A node that must be in
    any case has a row of its own, with a token that no other has."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, shingler, seen = shared.value, _shingler(scheme.n), {}
        for batch in batches:
            tokens, nodes, slacks = [], [], []
            for s in shingler.sets(batch.column(0).to_pylist()):
                if len(s) < scheme.least or _seen_before(seen, node := node_of(s)):
                    continue
                low = s[: np.searchsorted(s, scheme.counted)]
                low = low[~frequent[(low % np.uint64(CELLS)).astype(np.int64)]]
                slack = len(low) - scheme.need(len(s))
                if slack < 0:
                    low = np.append(low, np.array([node], np.int64).view(np.uint64))
                tokens.append(low.view(np.int64))
                nodes.append(np.full(len(low), node))
                slacks.append(np.full(len(low), slack, np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (tokens, nodes, slacks)],
                    ["token", "node", "slack"],
                )

    return documents.select(text_of().cast("binary").alias("text")).mapInArrow(
        scan, "token bigint, node bigint, slack int"
    )


def _to_index(counted: DataFrame) -> DataFrame:
    """(node, repeated): the nodes with too few tokens of their own, and their counted tokens
    that other nodes have too, the least frequent first."""
    by = Window.partitionBy("token")
    met = counted.withColumns(
        {"lo": F.min("node").over(by), "hi": F.max("node").over(by), "c": F.count("*").over(by)}
    ).filter("lo < hi or slack < 0")
    again = F.when(F.col("lo") < F.col("hi"), F.struct(F.col("c"), F.col("token")))
    return (
        met.groupBy("node").agg(F.first("slack").alias("slack"), F.collect_set(again).alias("repeated"))
        .filter("slack < 0 or size(repeated) > slack")
        .select("node", F.transform(F.array_sort("repeated"), lambda x: x["token"]).alias("repeated"))
    )


def _sets(documents: DataFrame, rows: DataFrame, index: DataFrame, scheme: Scheme) -> DataFrame:
    """(node, size, tokens, repeated) of the nodes to index.

    One text of each is read again. A bit filter of fixed size over the texts' hashes keeps
    the other texts out of the Python workers; the join on the node is exact.
    """
    th = F.xxhash64(text_of())

    def cell(c):
        return F.shiftright(c, 7).bitwiseAND(FILTER_BITS // 64 - 1)

    def bit(c):
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), c.bitwiseAND(63).cast("int"))

    wanted = rows.join(index, "node", "left_semi").groupBy("node").agg(F.min("th").alias("th"))
    bits = wanted.groupBy(cell(F.col("th")).alias("cell")).agg(F.bit_or(bit(F.col("th"))).alias("bits"))
    found = (
        documents.select(text_of().cast("binary").alias("text"), th.alias("th"))
        .withColumn("cell", cell(F.col("th"))).join(F.broadcast(bits), "cell")
        .filter(F.col("bits").bitwiseAND(bit(F.col("th"))) != 0).select("text")
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = _shingler(scheme.n), {}
        for batch in batches:
            out = []
            for s in shingler.sets(batch.column(0).to_pylist()):
                if len(s) >= scheme.least and not _seen_before(seen, node := node_of(s)):
                    out.append((node, len(s), s.tobytes()))
            columns = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.binary())],
                ["node", "size", "tokens"],
            )

    sets = found.mapInArrow(lean(scan), "node bigint, size int, tokens binary")
    return sets.join(index, "node").dropDuplicates(["node"])


# ---------------------------------------------------------------- signatures and groups
def signatures(tokens: np.ndarray, repeated: list, scheme: Scheme, frequent: np.ndarray):
    """The signatures of a set, and how many of its counted tokens no other node has.

    ``tokens`` are sorted; ``repeated`` are counted ones, the least frequent first.
    """
    need = scheme.need(len(tokens))
    counted = np.searchsorted(tokens, scheme.counted)
    low = tokens[:counted]
    often = frequent[(low % np.uint64(CELLS)).astype(np.int64)]
    single = np.array(repeated, np.int64).view(np.uint64)
    own = int((~often).sum()) - len(single)
    out = [mix(single[: max(0, need - own)])]
    need -= own + len(single)
    if need > 0:
        rest = np.concatenate((low[often], tokens[counted:]))
        for band in scheme.bands(len(tokens)):
            groups = scheme.groups(band)
            group = (mix(rest) % np.uint64(groups)).astype(np.int64)
            # a token counts if its group has come up before
            first = np.zeros(len(rest), bool)
            first[np.unique(group, return_index=True)[1]] = True
            enough = np.searchsorted(np.cumsum(~first), need) + 1
            taken, of = rest[:enough], group[:enough]
            order = np.argsort(of, kind="stable")
            taken, of = taken[order], of[order]
            for part in np.split(taken, np.flatnonzero(np.diff(of)) + 1):
                i, j = np.triu_indices(len(part), 1)
                out.append(mix(mix(part[i]) + np.uint64(3) * part[j] + np.uint64(band + 1)))
    return np.unique(np.concatenate(out)), own


def _postings(sets: DataFrame, scheme: Scheme, shared) -> DataFrame:
    """(sig, node, own)"""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        for batch in batches:
            sigs, nodes, owns = [], [], []
            rows = batch.to_pydict()
            for node, raw, repeated in zip(rows["node"], rows["tokens"], rows["repeated"]):
                found, own = signatures(np.frombuffer(raw, np.uint64), repeated, scheme, frequent)
                sigs.append(found.view(np.int64))
                nodes.append(np.full(len(found), node))
                owns.append(np.full(len(found), own, np.int32))
            if sigs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (sigs, nodes, owns)], ["sig", "node", "own"]
                )

    return sets.select("node", "tokens", "repeated").mapInArrow(lean(scan), "sig bigint, node bigint, own int")


def _members(postings: DataFrame) -> DataFrame:
    """(leader, node): the nodes of each signature with the one of them that has the fewest
    tokens of its own. Copies of one text so gather around the same leader."""
    lead = F.min(F.struct("own", "node"))["node"]
    buckets = postings.groupBy("sig").agg(
        lead.alias("leader"), F.min("node").alias("lo"), F.max("node").alias("hi")
    ).filter("lo < hi").select("sig", "leader")
    return postings.join(buckets, "sig").select("leader", "node").distinct()


def _blocks(members: DataFrame, sets: DataFrame, scheme: Scheme) -> DataFrame:
    """(leader, pair, node): what is verified together."""
    size = members.groupBy("leader").count().withColumn("large", F.col("count") > BLOCK)
    of = cut(members.join(size.select("leader", "large"), "leader"))
    small = of.filter(~F.col("large")).select("leader", F.lit("").alias("pair"), "node")
    tokens = sets.select("node", "tokens")
    heads = tokens.select(F.col("node").alias("leader"), F.col("tokens").alias("head"))
    large = of.filter("large").select("leader", "node").join(tokens, "node").join(heads, "leader")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            steps = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                all_ = len(a) + len(b) - both
                steps.append(STEPS * (all_ - both) // all_)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(steps, pa.int32())], ["leader", "node", "step"]
            )

    placed = cut(large.select("leader", "node", "tokens", "head").mapInArrow(lean(measure), "leader bigint, node bigint, step int"))
    parts = placed.groupBy("leader", "step").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    own = placed.join(parts, ["leader", "step"]).withColumn(
        "part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    )
    other = parts.select("leader", F.col("step").alias("to"), F.col("parts").alias("to_parts"))
    near = F.sequence(F.col("step") - scheme.reach, F.col("step") + scheme.reach)
    met = own.withColumn("to", F.explode(near)).join(other, ["leader", "to"])
    met = met.withColumn("to_part", F.explode(F.sequence(F.lit(0), F.col("to_parts") - 1)))
    name = [F.format_string("%d.%d", a, b) for a, b in (("step", "part"), ("to", "to_part"))]
    pairs = met.select("leader", F.concat_ws("-", F.array_sort(F.array(*name))).alias("pair"), "node")
    return small.unionByName(pairs)


def linked(sizes: np.ndarray, tokens: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set, the least place in its connected part of the group."""
    m = len(sizes)
    if m == 2:
        both = np.array([[0, len(np.intersect1d(*tokens, assume_unique=True))]] * 2)
        both[1] = both[1][::-1]
    else:
        flat = np.concatenate(tokens)
        owner = np.repeat(np.arange(m), sizes)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        new = np.concatenate(([True], flat[1:] != flat[:-1]))
        name = np.cumsum(new) - 1
        times = np.bincount(name)
        keep = times[name] > 1
        name, owner = (np.cumsum(times > 1) - 1)[name[keep]], owner[keep]
        both = np.zeros((m, m), np.float32)
        wide = 4096
        edges = np.searchsorted(name, np.arange(0, (name[-1] if len(name) else -1) + 1 + wide, wide))
        for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            part = np.zeros((m, wide), np.float32)
            part[owner[a:b], name[a:b] - i * wide] = 1
            both += part @ part.T
    union = sizes[:, None] + sizes[None, :] - both
    link = 100 * both.astype(np.float64) >= percent * union
    np.fill_diagonal(link, True)
    label = np.arange(m)
    while True:
        new = np.where(link, label[None, :], m).min(axis=1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links(blocks: DataFrame, sets: DataFrame, scheme: Scheme) -> DataFrame:
    """(a, b): links that span the connected part of each block."""
    work = blocks.join(sets.select("node", "size", "tokens"), "node").select(
        "leader", "pair", "node", "size", "tokens"
    )
    dealt = work.repartition("leader", "pair").sortWithinPartitions("leader", "pair")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(group):
            if len(group) < 2:
                return []
            nodes = [g[0] for g in group]
            label = linked(np.array([g[1] for g in group]), [g[2] for g in group], scheme.percent)
            return [(nodes[i], nodes[j]) for i, j in enumerate(label.tolist()) if i != j]

        def batch_of(found):
            return pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"]
            )

        at, group, found = None, [], []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for leader, pair, node, size, raw in zip(*columns):
                if (leader, pair) != at:
                    found += links(group)
                    at, group = (leader, pair), []
                group.append((node, size, np.frombuffer(raw, np.uint64)))
            if found:
                yield batch_of(found)
                found = []
        yield batch_of(found + links(group))

    return dealt.mapInArrow(lean(verify), "a bigint, b bigint")


# ---------------------------------------------------------------- the operator
def near_duplicates(
    documents: DataFrame, n: int = 5, percent: int = 80, spare: float = 1.5
) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    Two rows are linked if the Jaccard similarity of their shingle sets is at least
    ``percent`` hundredths. component_id is the least doc_id reachable by links, itself
    included. A null or empty text, or one without words, has no shingles, is linked with
    nothing and is its own component. ``spare`` decides cost only: the more of it, the more
    tokens are counted and the fewer documents indexed, which pays for short shingles. Rows with a null doc_id keep a null component_id unless
    a linked row has an id. Shingles are compared by 64-bit hashes. Other columns are not read.
    """
    spark = small_batches(documents).sparkSession
    scheme = Scheme(n, percent, spare)
    scanned = cut(_nodes(documents, scheme))
    rows = scanned.filter("slice is null").select("doc_id", "n_shingles", "node", "th")
    limit = max(FREQUENT_LEAST, rows.count() // FREQUENT_SHARE)
    frequent = _frequent(scanned.filter("slice is not null").select("task", "slice", "counts"), limit)
    shared = spark.sparkContext.broadcast(frequent)

    index = cut(_to_index(_counted_tokens(documents, scheme, shared)))
    sets = cut(_sets(documents, rows, index, scheme))
    members = cut(_members(cut(_postings(sets, scheme, shared))))
    star = stars(_links(_blocks(members, sets, scheme), sets, scheme))

    nodes = rows.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    ends = star.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        star.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
    named = nodes.join(ends, "node")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    joined = named.join(least, "root").select("node", "component_id")
    alone = nodes.join(ends, "node", "left_anti").select("node", F.col("least").alias("component_id"))
    found = rows.filter("node is not null").join(joined.unionByName(alone), "node")
    result = ["doc_id", "n_shingles", "component_id"]
    empty = rows.filter("node is null").withColumn("component_id", F.col("doc_id"))
    return found.select(result).unionByName(empty.select(result))
