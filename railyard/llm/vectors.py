"""Approximate nearest neighbours by multi-index hashing.

Codes are learned: a bounded sample gives a mean, principal directions and, by iterative
quantisation, a rotation under which signs lose least; ``BITS`` signs are a vector's code. A
code is split into ``PARTS`` substrings, each indexed. Two codes within a Hamming radius R
agree in some substring up to R // PARTS bits (pigeonhole), so a query probes, in each index,
the substrings that near to its own, and finds every code within R. Those are ranked by the
distances of the vectors themselves.

R is chosen per query: the sample gives an upper bound of the distance to the k-th neighbour
and, for vectors at that distance, the share ``CAUGHT`` of Hamming distances. Queries that find
fewer than k vectors are asked again with the whole code as radius, which reaches all.

An index is dealt by the first bits of its substring to cells, and a cell with many vectors is
split further by hash, so no group is unbounded; a query goes only to cells that its probes
can reach. A cell's vectors are held by one task while its queries stream past.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from railyard.llm.common import and_fields
from railyard.plans.checkpoints import cut

BITS, PARTS = 64, 4
WIDTH = BITS // PARTS
SAMPLE, SAMPLE_BYTES = 8_192, 32 << 20  # what codes and radii are fitted on
ROUNDS = 30  # of the rotation
CAUGHT = 0.97
CELL_ROWS = 8_192  # vectors of a cell, and queries that one copy of it serves: eight times as many
MOST_DEPTH = 10  # bits that deal to cells
PAIRS = 1 << 20  # candidate pairs that are ranked at once


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) of the rows whose vector has a length above 0, finite components and one not 0."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = v.isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.exists(v, lambda x: x != 0)
    return rows.select(F.col(key).alias("id"), v.alias("v")).filter(F.coalesce(good, F.lit(False)))


class Coder:
    """Codes and radii, fitted on a sample of vectors."""

    def __init__(self, sample: np.ndarray, k: int):
        dim = sample.shape[1]
        self.mean = sample.mean(axis=0)
        centred = sample - self.mean
        random = np.random.default_rng(1)
        turned = []
        for start in range(0, BITS, dim):  # more bits than dimensions: several rotations
            width = min(dim, BITS - start)
            _, _, axes = np.linalg.svd(centred[:2048], full_matrices=True)
            main = centred @ axes[:width].T
            turn = np.linalg.qr(random.standard_normal((width, width)))[0]
            for _ in range(ROUNDS):
                u, _, w = np.linalg.svd(np.where(main @ turn >= 0, 1.0, -1.0).T @ main)
                turn = (u @ w).T
            turned.append(axes[:width].T @ turn)
        self.planes = np.concatenate(turned, axis=1)
        self.sample, self.k = sample, k
        self._calibrate()

    def codes(self, v: np.ndarray) -> np.ndarray:
        signs = (v - self.mean) @ self.planes >= 0
        return np.packbits(signs, axis=1, bitorder="little").view(np.uint64).ravel()

    def kth(self, v: np.ndarray) -> np.ndarray:
        """Upper bounds of the distances to the k-th neighbour: those to sample vectors, one
        more than k of them, as a query may be in the sample itself."""
        if len(self.sample) <= self.k:
            return np.full(len(v), np.inf)
        squares = (v**2).sum(axis=1)[:, None] + (self.sample**2).sum(axis=1)[None] - 2 * v @ self.sample.T
        return np.sqrt(np.maximum(np.partition(squares, self.k, axis=1)[:, self.k], 0))

    def _calibrate(self) -> None:
        """For steps of distance, the Hamming distance that a ``CAUGHT`` share of pairs keeps."""
        some = self.sample[:: max(1, len(self.sample) // 512)]
        squares = (some**2).sum(axis=1)[:, None] + (self.sample**2).sum(axis=1)[None] - 2 * some @ self.sample.T
        near = np.argpartition(squares, min(2 * self.k, squares.shape[1] - 1), axis=1)[:, : 2 * self.k + 1]
        apart = np.sqrt(np.maximum(np.take_along_axis(squares, near, axis=1), 0)).ravel()
        codes, own = self.codes(self.sample), self.codes(some)
        bits = np.bitwise_count(own[:, None] ^ codes[near]).ravel()
        order = np.argsort(apart, kind="stable")
        groups = np.array_split(order, max(1, min(32, len(order) // 256)))
        self.steps = np.array([apart[g].max() for g in groups])
        radius = np.array([np.quantile(bits[g], CAUGHT, method="higher") for g in groups])
        self.radius = np.maximum.accumulate(radius)

    def radii(self, v: np.ndarray) -> np.ndarray:
        """Per query; beyond the longest distance met, the whole code."""
        place = np.searchsorted(self.steps, self.kth(v))
        return np.append(self.radius, BITS)[place].astype(np.int32)


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))


def _coded(rows: DataFrame, shared, with_radius: bool) -> DataFrame:
    """``rows`` with their code and, on request, their radius."""
    new = ["code", "radius"] if with_radius else ["code"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                v = _matrix(batch.column("v"))
                added = [pa.array(coder.codes(v).view(np.int64))]
                if with_radius:
                    added.append(pa.array(coder.radii(v)))
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, *new])

    return rows.mapInArrow(run, and_fields(rows.schema, "code bigint" + ", radius int" * with_radius))


def _substring(part: int) -> Column:
    return F.shiftrightunsigned("code", part * WIDTH).bitwiseAND((1 << WIDTH) - 1).cast("int")


def _reach(radius: Column, part: Column) -> Column:
    """Bits in which a probe of this substring may differ: with R = q * PARTS + a, the first
    a + 1 substrings take q and the others q - 1 (-1: none)."""
    q = F.floor(radius / PARTS).cast("int")
    return F.when(part <= radius - q * PARTS, q).otherwise(q - 1)


def _by_part(rows: DataFrame, depth: int) -> DataFrame:
    """A row for each substring with the cell, the part's number and its first bits."""
    parts = F.array(*[F.struct(F.lit(p).alias("part"), _substring(p).alias("sub")) for p in range(PARTS)])
    one = rows.withColumn("_p", F.explode(parts)).select("*", "_p.part", "_p.sub").drop("_p")
    return one.withColumn("cell", F.col("part") * (1 << depth) + F.shiftright("sub", WIDTH - depth))


def _probe_cells(queries: DataFrame, depth: int, splits: dict[int, tuple[int, int]]) -> DataFrame:
    """A row for each query and cell, split of a cell and copy of it that it has to see."""
    spark = queries.sparkSession
    one = _by_part(queries, depth).withColumn("reach", _reach(F.col("radius"), F.col("part")))
    first = F.col("cell") - F.col("part") * (1 << depth)
    cells = F.transform(F.sequence(F.lit(0), F.lit((1 << depth) - 1)), lambda c: c.cast("int"))
    met = F.filter(cells, lambda c: F.bit_count(c.bitwiseXOR(first)) <= F.col("reach"))
    rows = one.withColumn("first", F.explode(met)).withColumn("cell", F.col("part") * (1 << depth) + F.col("first"))
    table = spark.createDataFrame([(c, s, n) for c, (s, n) in splits.items()], "cell int, splits int, copies int")
    named = rows.join(F.broadcast(table), "cell")
    copy = F.pmod(F.xxhash64("id"), F.col("copies")).cast("int")
    split = F.explode(F.sequence(F.lit(0), F.col("splits") - 1))
    return named.withColumn("copy", copy).withColumn("split", split).select(
        "cell", "split", "copy", "id", "v", "code", "radius"
    )


class Cell:
    """The vectors of one split of a cell, by the values of their substring."""

    def __init__(self, part: int, ids: list, v: np.ndarray, codes: np.ndarray):
        sub = (codes >> np.uint64(part * WIDTH)) & np.uint64((1 << WIDTH) - 1)
        order = np.argsort(sub, kind="stable")
        self.part, self.ids, self.v, self.codes = part, [ids[i] for i in order], v[order], codes[order]
        self.values, self.start, self.n = np.unique(sub[order], return_index=True, return_counts=True)

    def near(self, codes: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, row) within the radius that no earlier substring has found."""
        sub = (codes >> np.uint64(self.part * WIDTH)) & np.uint64((1 << WIDTH) - 1)
        q = radius // PARTS
        reach = [np.where(p <= radius - q * PARTS, q, q - 1) for p in range(PARTS)]
        hit = np.bitwise_count(sub[:, None] ^ self.values[None]) <= reach[self.part][:, None]
        query, value = np.nonzero(hit)
        n = self.n[value]
        query = np.repeat(query, n)
        row = np.repeat(self.start[value] - np.cumsum(n) + n, n) + np.arange(len(query))
        apart = codes[query] ^ self.codes[row]
        keep = np.bitwise_count(apart) <= radius[query]
        for p in range(self.part):
            bits = (apart >> np.uint64(p * WIDTH)) & np.uint64((1 << WIDTH) - 1)
            keep &= np.bitwise_count(bits) > reach[p][query]
        return query[keep], row[keep]

    def best(self, ids: list, v: np.ndarray, codes: np.ndarray, radius: np.ndarray, k: int):
        """(query id, vector id, distance), the nearest ``k`` of this cell for each query."""
        query, row = self.near(codes, radius)
        apart = np.empty(len(query))
        step = max(1, 4 * PAIRS // self.v.shape[1])
        for a in range(0, len(query), step):
            at = slice(a, a + step)
            apart[at] = np.sqrt(((v[query[at]] - self.v[row[at]]) ** 2).sum(axis=1))
        ends = np.searchsorted(query, np.arange(len(ids) + 1))
        for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
            if b - a > k + 1:  # one may be the query; ties with the last stay
                near = a + np.flatnonzero(apart[a:b] <= np.partition(apart[a:b], k)[k])
            else:
                near = np.arange(a, b)
            found = [(float(apart[j]), x) for j in near for x in self.ids[row[j]] if x != ids[i]]
            found.sort(key=lambda f: (f[0], f[1]))
            for distance, x in found[:k]:
                yield ids[i], x, distance


def _ask(index: DataFrame, queries: DataFrame, depth: int, k: int, kind: str) -> DataFrame:
    """(query_id, vec_id, score): the nearest of each cell that a query sees."""
    spark = index.sparkSession
    rows = _by_part(index, depth)
    held = {r.cell: r["count"] for r in rows.groupBy("cell").count().collect()}  # PARTS x 2^depth at most
    asked = queries.count()
    copies = max(1, -(-asked // (8 * CELL_ROWS)))
    splits = {c: (-(-n // CELL_ROWS), copies) for c, n in held.items()}
    table = spark.createDataFrame([(c, s, n) for c, (s, n) in splits.items()], "cell int, splits int, copies int")
    members = (
        rows.join(F.broadcast(table), "cell")
        .withColumn("split", F.pmod(F.xxhash64("v"), F.col("splits")).cast("int"))
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
        .select("cell", "split", "copy", F.lit(0).alias("asks"), F.lit(None).cast(kind).alias("id"), "ids", "v", "code", F.lit(0).alias("radius"))
    )
    asking = _probe_cells(queries, depth, splits).select(
        "cell", "split", "copy", F.lit(1).alias("asks"), "id", F.lit(None).cast(f"array<{kind}>").alias("ids"), "v", "code", "radius"
    )
    key = ["cell", "split", "copy"]
    met = members.unionByName(asking).repartition(*key).sortWithinPartitions(*key, "asks")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cell, parts = None, None, []
        for whole in batches:
            keys = np.stack([whole.column(c).to_numpy() for c in range(4)], axis=1)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                batch, key = whole.slice(a, b - a), tuple(keys[a, :3].tolist())
                if key != now:
                    now, cell, parts = key, None, []
                if not keys[a, 3]:
                    parts.append(batch)
                    continue
                if cell is None:
                    if not parts:
                        continue
                    table = pa.Table.from_batches(parts)
                    v = np.concatenate([_matrix(p.column("v")) for p in parts])
                    codes = table.column("code").to_numpy().view(np.uint64)
                    cell = Cell(key[0] >> depth, table.column("ids").to_pylist(), v, codes)
                    parts = []
                step = max(1, PAIRS // len(cell.codes))
                for start in range(0, batch.num_rows, step):
                    some = batch.slice(start, step)
                    found = list(
                        cell.best(
                            some.column("id").to_pylist(),
                            _matrix(some.column("v")),
                            some.column("code").to_numpy().view(np.uint64),
                            some.column("radius").to_numpy(),
                            k,
                        )
                    )
                    if found:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*found), types)], ["query_id", "vec_id", "score"]
                        )

    id_type = to_arrow_type(index.schema["ids"].dataType.elementType)
    types = (id_type, id_type, pa.float64())
    return met.mapInArrow(search, f"query_id {kind}, vec_id {kind}, score double")


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(rows: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): for the rows that ``queries`` selects, the nearest others.

    Nearness is the Euclidean distance in double precision, ties go to the smaller id. Rows
    without an id, vectors that are null, empty or zero, with a null or non-finite component, or
    of another length than the commonest (of equally common ones the longest) take no part. Of
    repeated ids each vector is a candidate, and an id asks with its least one. Equal vectors
    are indexed once with their least k + 1 ids, which is all that a query can need of them.
    """
    spark = rows.sparkSession
    kind = rows.schema[key].dataType.simpleString()
    out = f"query_id {kind}, rank int, vec_id {kind}, score double"
    marked = rows.withColumn("_asks", F.coalesce(queries, F.lit(False)))
    good = usable(marked, key, vector).filter("id is not null")
    length = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if length is None:
        return spark.createDataFrame([], out)
    good = good.filter(F.size("v") == length.n)
    size = max(64, min(SAMPLE, SAMPLE_BYTES // (8 * length.n)))
    # least hashes; the share that is passed over first keeps what tasks send to the driver bounded
    place = F.shiftrightunsigned(F.xxhash64("id", "v"), 32)
    share = min(1.0, 2 * size / length["count"])
    drawn = good.filter(place <= int(share * 2**32)).orderBy(place, "id").limit(size).select("v").collect()
    shared = spark.sparkContext.broadcast(Coder(np.array([r.v for r in drawn], np.float64), k))
    asking = marked.filter("_asks")
    own = usable(asking, key, vector).filter((F.size("v") == length.n) & F.col("id").isNotNull())
    own = own.groupBy("id").agg(F.min("v").alias("v"))
    same = Window.partitionBy("v").orderBy("id")
    few = good.withColumn("_n", F.row_number().over(same)).filter(F.col("_n") <= k + 1)
    index = cut(_coded(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), shared, False))
    asked = cut(_coded(own, shared, True))
    n = index.count()
    depth = min(MOST_DEPTH, max(0, int(np.ceil(np.log2(max(n, 1) / CELL_ROWS)))))
    found = cut(_first(_ask(index, asked, depth, k, kind), k))
    full = found.groupBy("query_id").count().filter(F.col("count") >= k).select(F.col("query_id").alias("id"))
    short = asked.join(full, "id", "left_anti").filter(F.col("radius") < BITS).withColumn("radius", F.lit(BITS))
    again = _ask(index, cut(short), depth, k, kind)
    late = short.select(F.col("id").alias("query_id"))
    kept = found.drop("rank").join(late, "query_id", "left_anti")
    return _first(kept.unionByName(again), k).select("query_id", "rank", "vec_id", "score")
