"""Neighbours in a total order without a global window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PER_RANGE = 32


def _range_of(column: Column, bounds: list) -> Column:
    """How many bounds lie below the value, as a balanced tree of comparisons; null: none."""

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(column > F.lit(bounds[mid]), tree(mid + 1, hi)).otherwise(tree(lo, mid))

    return tree(0, len(bounds))


def with_neighbours(
    rows: DataFrame, key: str, carried: list[str], ties: list[str], before: bool = False
) -> DataFrame:
    """Adds next_<c> for each carried column: its value in the next row by descending key,
    after the last row that of the first; with ``before`` also previous_<c>, null for the
    first row. Null keys come last; equal keys are ordered by ``ties``. A single row follows
    itself.

    Rows are dealt to ranges of the key, one per shuffle partition, and are shuffled once. The
    bounds come from ``PER_RANGE`` keys for each range and decide the balance only. The least
    and the largest key of each range go to the driver; rows with those keys are also sent, as
    guests, to the range next to theirs.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sample = rows.select(key).dropna().orderBy(F.xxhash64(key)).limit(PER_RANGE * parts).collect()
    drawn = sorted(r[0] for r in sample)
    bounds = sorted({drawn[i * len(drawn) // parts] for i in range(1, parts)} if drawn else ())
    ranged = rows.withColumn("_range", _range_of(F.col(key), bounds))
    ends = (
        rows.select(key).withColumn("_range", _range_of(F.col(key), bounds)).groupBy("_range")
        .agg(F.max(key).alias("top"), F.min(key).alias("bottom"),
             F.count_if(F.col(key).isNull()).alias("nulls")).orderBy("_range").collect()
    )
    guests = [(ends[i - 1]["top"], e["_range"], 1) for i, e in enumerate(ends)]
    if before:
        guests += [
            (None if up["nulls"] else up["bottom"], down["_range"], -1)
            for down, up in zip(ends, ends[1:])
        ]
    kind = rows.schema[key].dataType.simpleString()
    table = spark.createDataFrame(guests, f"_end {kind}, _target int, _guest int")
    visiting = (
        rows.join(F.broadcast(table), F.col(key).eqNullSafe(F.col("_end")))
        .withColumn("_range", F.col("_target")).select(*ranged.columns, "_guest")
    )
    order = Window.partitionBy("_range").orderBy("_guest", F.desc_nulls_last(key), *ties)
    both = ranged.withColumn("_guest", F.lit(0)).unionByName(visiting)
    named = {f"next_{c}": F.lead(c).over(order) for c in carried}
    if before:
        named |= {f"previous_{c}": F.lag(c).over(order) for c in carried}
    return both.withColumns(named).filter("_guest = 0").drop("_guest", "_range")
