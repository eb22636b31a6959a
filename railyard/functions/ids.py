"""Dense numbers for new rows, in a given order, without a one-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.checkpoints import cut


def next_id(df: DataFrame, key: str) -> int:
    """One more than the greatest key; 1 when there is none or keys are not numbers."""
    if not isinstance(df.schema[key].dataType, T.IntegralType):
        return 1
    top = df.agg(F.max(key).alias("top")).first()["top"]
    return 1 if top is None else int(top) + 1


def number_rows(df: DataFrame, *order: str, name: str = "_n") -> DataFrame:
    """Adds 1, 2, 3, ... following ``order``, which must identify a row.

    The rows are range-sorted and written together with their partition and their place
    in it, which fixes both. The number is that place plus the sizes of the partitions
    before it. Only those sizes, one row per partition, pass through a single task.
    """
    placed = cut(
        df.orderBy(*order).select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"),
        )
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place") + F.lit(1))
        .drop("_part", "_place", "_offset")
    )
