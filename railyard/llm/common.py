"""Small helpers that several operators share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import islice
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BATCH_BYTES = 8 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def small_batches(rows: DataFrame) -> DataFrame:
    """``rows``, with the session's default of 10,000 rows in a batch for Python workers, which
    suits numbers, brought down to 1,000 and to ``BATCH_BYTES``: texts are long, and both sides
    hold a whole batch. Settings of the session's own stay; these two stay for its later plans,
    as a plan is run after this returns."""
    conf = rows.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    most = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(re.sub(r"[^0-9]", "", conf.get(most)) or 0) in (0, 64 << 20, (1 << 31) - 1):  # defaults
        conf.set(most, str(BATCH_BYTES))
    return rows


def and_fields(schema: StructType, ddl: str) -> StructType:
    """``schema`` with further fields after its own."""
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])


def ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def thin_out(held: dict, most: int) -> None:
    """Keeps a dictionary of short keys bounded: beyond ``most`` entries the first quarter stays, which
    holds the frequent keys, as these are met early."""
    if len(held) > most:
        for key in list(islice(held, most // 4, None)):
            del held[key]


def trim() -> None:
    """Gives memory that a worker has freed back to the system, where the C library can."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` for a Python worker that is kept for later tasks: each task ends with ``trim``."""

    def run(batches: Iterator) -> Iterator:
        yield from work(batches)
        trim()

    return run


def in_worker(name: str, make: Callable[[], Any]) -> Any:
    """A value that one Python worker makes once and keeps for its later tasks, until a task
    asks for one of another name: a worker never holds two."""
    import sys
    import types

    box = sys.modules.setdefault("_railyard_worker", types.ModuleType("_railyard_worker"))
    if getattr(box, "name", None) != name:
        box.name = box.value = None
        trim()
        box.value = make()
        box.name = name
    return box.value
