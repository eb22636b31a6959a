"""Shards by extendible hashing: a directory indexed by bits of a hash prefix.

All rows start in one bucket. A bucket beyond the byte limit splits on its next bit, others
stay, so each row ends at the least depth at which its bucket fits. Rows are summed up to one
cell per ``LEVEL_BITS`` bits, which Spark combines before the shuffle; a level's buckets are
sums of cells, at most 17 for each. Only rows of buckets that are still too large go to the
next level. The directory of a level has at most one row per cell that holds rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railyard.plans.checkpoints import cut

LEVEL_BITS = 16
HASH_BITS = 128
DIGEST, PATH, BITS = "__digest", "__path", "__bits"  # columns of the work in progress


def prefix_bits(digest: Column, start: int, count: int) -> Column:
    """``count`` bits (a multiple of four) of a hexadecimal digest, as a string of 0 and 1."""
    part = F.substring(digest, start // 4 + 1, count // 4)
    return F.lpad(F.conv(part, 16, 2), count, "0")


def _level(cells: DataFrame, limit: int, at: int) -> DataFrame:
    """The directory of one level: cell, depth (null: still too large), bytes of the bucket.

    ``cells`` has the bits so far, ``LEVEL_BITS`` more and bytes.
    """
    # deeper levels start from a bucket known to be too large
    depths = F.sequence(F.lit(1 if at else 0), F.lit(LEVEL_BITS))
    within = cells.withColumn("d", F.explode(depths)).withColumn("prefix", F.expr(f"substring({BITS}, 1, d)"))
    fitting = within.groupBy(PATH, "prefix").agg(F.sum("bytes").alias("total")).filter(F.col("total") <= limit)
    least = F.min(F.when(F.col("total").isNotNull(), F.struct("d", "total"))).alias("least")
    found = within.join(fitting, [PATH, "prefix"], "left").groupBy(PATH, BITS).agg(least)
    depth = (F.col("least.d") + at).alias("depth")
    return found.select(PATH, BITS, depth, F.col("least.total").alias("shard_bytes"))


def _alone(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Rows larger than the limit, each a shard of its own named by all bits of its digest, and
    by a number where several share that."""
    shared = rows.groupBy(DIGEST).agg((F.count("*") > 1).alias(BITS))
    bits = F.concat(*[prefix_bits(F.col(DIGEST), i, LEVEL_BITS) for i in range(0, HASH_BITS, LEVEL_BITS)])
    own = F.when(F.col(BITS), F.concat(F.lit("-"), F.col(PATH))).otherwise("")
    numbered = rows.withColumn(PATH, F.monotonically_increasing_id().cast("string"))
    return numbered.join(shared, DIGEST).select(
        *keep, "n_bytes", F.concat(bits, own).alias("shard"), F.lit(HASH_BITS).alias("depth"),
        F.col("n_bytes").alias("shard_bytes"),
    )


def shard(documents: DataFrame, key: Column, size: Column, limit: int) -> DataFrame:
    """n_bytes, shard, depth and shard_bytes added to ``documents``, one row per row.

    ``key`` is any column as text (null: empty); ``size`` is a row's bytes (null: none). The
    shard is its bits, the empty text if all rows fit one. A row larger than the limit is a
    shard of its own, in which no other row takes part. When no bits are left, as for one key
    with more bytes than the limit, its rows are told apart by a second digest over the whole
    row and, should they be equal in full, over their place in the input. No rows give none.
    Columns named like a result are replaced, all others kept.
    """
    results = ["n_bytes", "shard", "depth", "shard_bytes"]
    keep = [c for c in documents.columns if c not in results]
    digest = F.md5(F.coalesce(key.cast("string"), F.lit(""))).alias(DIGEST)
    every = documents.select(*keep, digest, F.coalesce(size, F.lit(0)).cast("bigint").alias("n_bytes"))
    rows = every.filter(F.col("n_bytes") <= limit).withColumn(PATH, F.lit(""))
    done, at = _alone(every.filter(F.col("n_bytes") > limit), keep), 0
    while True:
        if at and at % HASH_BITS == 0:  # a digest is used up: the next tells equal keys apart
            own = F.monotonically_increasing_id().cast("string") if at > HASH_BITS else F.lit("")
            whole = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keep]
            rows = cut(rows.withColumn(DIGEST, F.md5(F.concat_ws("|", own, *whole))))
        rows = rows.withColumn(BITS, prefix_bits(F.col(DIGEST), at % HASH_BITS, LEVEL_BITS))
        cells = rows.groupBy(PATH, BITS).agg(F.sum("n_bytes").alias("bytes"))
        directory = cut(_level(cut(cells), limit, at))
        found = rows.join(directory, [PATH, BITS])
        fit = found.filter(F.col("depth").isNotNull())
        name = F.concat(PATH, F.expr(f"substring({BITS}, 1, depth - {at})"))
        done = done.unionByName(fit.withColumn("shard", name).select(*keep, *results))
        if directory.filter(F.col("depth").isNull()).isEmpty():
            return done
        rows = found.filter(F.col("depth").isNull()).withColumn(
            PATH, F.concat(PATH, BITS)
        ).select(*keep, DIGEST, "n_bytes", PATH)
        at += LEVEL_BITS
