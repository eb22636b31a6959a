"""Stored tables in partitions, of which a change rewrites only those it touches.

A stored table has the columns of its rows and one more, ``part``, computed from them: a block
of keys, a month. Appends add files; updates and deletes read the touched partitions, write
their new rows to the shared folder, and overwrite these partitions by Spark's dynamic
partition overwrite. Partitions that no row is left in are dropped. All other files stay as
they are.

One writer at a time is assumed. The new rows are on disk before anything is overwritten, so a
lost executor costs a task; a driver that dies within the overwrite leaves partitions either
old or new, and the same change can be applied again: updates and deletes are by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.checkpoints import cut, scratch_dir

PART = "part"
# a broadcast list of touched partitions prunes the scan; more of them are joined by shuffle
LISTED = 10_000


def key_block(key: str, rows: int = 1 << 20) -> Column:
    """Blocks of consecutive keys; NULL keys are in a block of their own."""
    return F.coalesce(F.floor(F.col(key) / F.lit(rows)).cast("string"), F.lit("none"))


def month_of(column: str) -> Column:
    return F.coalesce(F.date_format(column, "yyyy-MM"), F.lit("none"))


def day_of(column: str) -> Column:
    return F.coalesce(F.date_format(column, "yyyy-MM-dd"), F.lit("none"))


def create(rows: DataFrame, table: str, part: Column, path: str | None = None) -> None:
    """Stores rows as a new table, in the warehouse or at ``path``. Rows meet by partition
    first, so that a task writes few files; AQE splits partitions of many rows."""
    writer = rows.withColumn(PART, part).hint("rebalance", PART).write.partitionBy(PART)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table, format="parquet")


def read(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).drop(PART)


def _in_order(spark: SparkSession, table: str, rows: DataFrame) -> DataFrame:
    """Columns in the order of the stored table, by which rows are inserted."""
    return rows.hint("rebalance", PART).select(*spark.table(table).columns)


def append(table: str, rows: DataFrame, part: Column) -> None:
    spark = rows.sparkSession
    _in_order(spark, table, rows.withColumn(PART, part)).write.insertInto(table)


def _rewrite(spark: SparkSession, table: str, touched: DataFrame, gone: DataFrame, key: str,
             new: DataFrame | None) -> list[str]:
    """Touched partitions without the rows of ``gone`` keys and with the ``new`` rows."""
    names = sorted(r[0] for r in touched.collect())  # bounded by the catalogue's partitions
    if not names:
        return []
    stored = spark.table(table)
    if len(names) <= LISTED:
        stored = stored.filter(F.col(PART).isin(names))
    else:
        stored = stored.join(touched, PART, "left_semi")
    rows = stored.join(gone, key, "left_anti")
    if new is not None:
        rows = rows.unionByName(new)
    path = scratch_dir(spark, "state")
    rows.write.parquet(path)
    # inserts take the mode of overwriting from their session, so this one gets its own, and
    # the user's other work keeps theirs
    own = spark.newSession()
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    state = own.read.schema(rows.schema).parquet(path)
    left = {r[0] for r in state.select(PART).distinct().collect()}
    _in_order(own, table, state).write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)
    empty = [name for name in names if name not in left]
    if empty:
        _drop(spark, table, empty)
    return names


def _drop(spark: SparkSession, table: str, parts: list[str]) -> None:
    """Drops partitions without rows. One stored at a path keeps its folder, so its files go by
    an overwrite with no rows first."""
    spark.createDataFrame([], read(spark, table).schema).createOrReplaceTempView("_no_rows")
    for name in parts:
        spark.sql(f"INSERT OVERWRITE {table} PARTITION ({PART} = '{name}') SELECT * FROM _no_rows")
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({PART} = '{name}')")
    spark.catalog.dropTempView("_no_rows")


def update(table: str, changed: DataFrame, key: str, part: Column) -> list[str]:
    """Replaces the rows that have the keys of ``changed``, whose keys are unique and not NULL,
    and adds those of unknown keys. A row whose partition changes moves. Returns the partitions
    that were rewritten.

    The partitions of the old rows are found by a scan of the key column alone.
    """
    spark = changed.sparkSession
    new = cut(changed.withColumn(PART, part))
    keys = new.select(key)
    old = spark.table(table).select(key, PART).join(keys, key, "left_semi").select(PART)
    touched = cut(old.unionByName(new.select(PART)).distinct())
    return _rewrite(spark, table, touched, keys, key, new)


def delete(table: str, gone: DataFrame, key: str) -> list[str]:
    """Removes the rows that have the keys of ``gone``. Returns the partitions that changed."""
    spark = gone.sparkSession
    keys = cut(gone.select(key).dropna().distinct())
    old = spark.table(table).select(key, PART).join(keys, key, "left_semi")
    return _rewrite(spark, table, cut(old.select(PART).distinct()), keys, key, None)
