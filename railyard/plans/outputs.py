"""All results of a job in one write."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .checkpoints import scratch_dir


def write_together(
    outputs: dict[str, DataFrame], path: str | None = None
) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Runs a job once: (its outputs, read back from files, their row counts).

    Every output is one column of structs in one tagged frame, which is written by one Spark job
    in a folder for each output, so steps that outputs share run once, and a lost executor costs
    a task. An output without rows has no folder. The counts are observed by the same write.
    The files are put in ``path``, or in a fresh folder of the session's shared one.
    """
    spark = next(iter(outputs.values())).sparkSession
    path = path or scratch_dir(spark, "outputs")
    rows = [
        df.select(F.lit(name).alias("part"), F.struct("*").alias(name))
        for name, df in outputs.items()
    ]
    tagged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    seen = Observation()
    counts = [F.count_if(F.col("part") == name).alias(name) for name in outputs]
    tagged.observe(seen, *counts).write.partitionBy("part").parquet(path)
    stored = spark.read.schema(tagged.schema).parquet(path)
    frames = {
        name: stored.filter(F.col("part") == name).select(f"{name}.*")
        if seen.get[name]
        else spark.createDataFrame([], df.schema)
        for name, df in outputs.items()
    }
    return frames, dict(seen.get)
