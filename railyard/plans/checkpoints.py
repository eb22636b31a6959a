"""Reliable lineage cuts for the iterative jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# folders of local sessions without the setting
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach, as the session names it.

    Only a session in a single process (``local[...]``) without the setting gets a temporary
    folder; on a cluster a machine-local folder would lose its data with the machine, so that
    is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="run-")
    return _LOCAL[app]


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back.

    The plan runs once, later steps start from files that survive lost executors, and the
    optimizer knows their size.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "step")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
