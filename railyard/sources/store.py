"""Parquet store of the thirteen tables with consistent multi-table publication.

Data files are written to fresh paths and never overwritten. A publication is one row set
in the manifest, written last: (version, table, paths). Readers take the newest version of
each table, so they see all tables of a publication or none, and a job that dies before
the manifest leaves the store as it was. One writer at a time is assumed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ids import next_id, number_rows
from ..plans.tables import Tables
from ..schemas import TABLES

# tables whose rows are counted on reading (Parquet footers only) to bound broadcasts
DIMENSIONS = ("Stations", "Routes", "Trains", "SeatClasses", "Coaches", "Schedules")
COUNTED = (*DIMENSIONS, "RefundPolicies")

MANIFEST = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("table", T.StringType()),
        T.StructField("paths", T.ArrayType(T.StringType())),
    ]
)


def _manifest_path(root: str) -> str:
    return f"{root.rstrip('/')}/manifest"


def _current(spark: SparkSession, root: str) -> tuple[int, dict[str, list[str]]]:
    """Newest version and the paths of each table; at most one row per table is fetched."""
    rows = (
        spark.read.schema(MANIFEST)
        .parquet(_manifest_path(root))
        .groupBy("table")
        .agg(F.max_by("paths", "version").alias("paths"), F.max("version").alias("version"))
        .collect()
    )
    return max(r["version"] for r in rows), {r["table"]: list(r["paths"]) for r in rows}


def _fresh(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}/{uuid.uuid4().hex}"


def _write(df: DataFrame, root: str, table: str) -> str:
    path = _fresh(root, table)
    df.write.parquet(path)
    return path


def _publish(spark: SparkSession, root: str, version: int, paths: dict[str, list[str]]) -> None:
    rows = [(version, table, p) for table, p in paths.items()]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(
        _manifest_path(root)
    )


def create_store(root: str, t: Tables) -> None:
    """Writes every table and publishes version 1."""
    spark = next(iter(t.values())).sparkSession
    _publish(spark, root, 1, {name: [_write(df, root, name)] for name, df in t.items()})


def read_store(spark: SparkSession, root: str) -> Tables:
    """The newest tables, read with their declared schemas."""
    _, paths = _current(spark, root)
    frames = {name: spark.read.schema(TABLES[name].struct).parquet(*p) for name, p in paths.items()}
    bounds = {name: frames[name].count() for name in COUNTED if name in frames}
    return Tables(frames, bounds)


def replace_tables(spark: SparkSession, root: str, new: dict[str, DataFrame]) -> int:
    """Publishes new states of some tables together (update and delete). Returns the version."""
    version, _ = _current(spark, root)
    written = {name: [_write(df, root, name)] for name, df in new.items()}
    _publish(spark, root, version + 1, written)
    return version + 1


def append_tables(spark: SparkSession, root: str, rows: dict[str, DataFrame]) -> int:
    """Publishes additional rows of some tables without rewriting what is there."""
    version, paths = _current(spark, root)
    added = {name: [*paths[name], _write(df, root, name)] for name, df in rows.items()}
    _publish(spark, root, version + 1, added)
    return version + 1


def with_ids(t: Tables, table: str, rows: DataFrame, *order: str) -> DataFrame:
    """Gives new rows of a table the next identity values, in the given order (which must
    identify a row). Columns of the table that the rows lack become NULL."""
    spec = TABLES[table]
    start = next_id(t[table], spec.key) - 1
    numbered = number_rows(rows, *order).withColumn(spec.key, F.col("_n") + F.lit(start))
    return numbered.select(
        *[
            (F.col(c.name) if c.name in numbered.columns else F.lit(None)).cast(c.type).alias(c.name)
            for c in spec.cols
        ]
    )


def save_bucketed(t: Tables, database: str, buckets: int) -> None:
    """Saves bookings, tickets and payments as tables bucketed and sorted by BookingID, so
    that joins and counts per booking need no shuffle."""
    for name in ("Bookings", "Tickets", "Payments"):
        (
            t[name]
            .write.bucketBy(buckets, "BookingID")
            .sortBy("BookingID")
            .saveAsTable(f"{database}.{name.lower()}", format="parquet")
        )
