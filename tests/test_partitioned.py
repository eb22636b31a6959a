"""Stored tables: a change rewrites the partitions it touches and no other file."""

import uuid

import pytest
from helpers import rows
from pyspark.sql import functions as F

from railyard.plans.checkpoints import scratch_dir
from railyard.sources import partitioned as P

SCHEMA = "id bigint, day date, v string"


def files(spark, table):
    """partition -> names of its files."""
    listed = spark.table(table).select(P.PART, F.col("_metadata.file_path").alias("f")).distinct()
    out = {}
    for part, name in rows(listed):
        out.setdefault(part, set()).add(name)
    return out


@pytest.fixture(params=["in the warehouse", "at a path"])
def stored(spark, request):
    import datetime as dt

    path = scratch_dir(spark, "table") if request.param == "at a path" else None
    name = "t" + uuid.uuid4().hex[:10]
    data = [(i, dt.date(2025, 1, 1 + i % 5), f"v{i}") for i in range(40)]
    P.create(spark.createDataFrame([*data, (40, None, "no day")], SCHEMA), name, P.day_of("day"), path)
    return name


def state(spark, table):
    return {r.id: (str(r.day), r.v) for r in P.read(spark, table).collect()}


def test_a_change_of_one_day_rewrites_that_day_only(spark, stored):
    before, was = files(spark, stored), state(spark, stored)
    changed = P.read(spark, stored).filter("id in (5, 10)").withColumn("v", F.lit("new"))
    assert P.update(stored, changed, "id", P.day_of("day")) == ["2025-01-01"]
    after = files(spark, stored)
    assert {p for p in before if before[p] != after[p]} == {"2025-01-01"}
    assert state(spark, stored) == {**was, 5: ("2025-01-01", "new"), 10: ("2025-01-01", "new")}
    # the session's own mode is left alone
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_rows_move_and_arrive(spark, stored):
    import datetime as dt

    before, was = files(spark, stored), state(spark, stored)
    new = [(1, dt.date(2025, 1, 4), "moved"), (99, dt.date(2025, 2, 1), "more"), (2, None, "lost")]
    touched = P.update(stored, spark.createDataFrame(new, SCHEMA), "id", P.day_of("day"))
    assert touched == ["2025-01-02", "2025-01-03", "2025-01-04", "2025-02-01", "none"]
    after = files(spark, stored)
    assert {p for p in after if before.get(p) != after[p]} == set(touched)
    assert state(spark, stored) == {**was, **{i: (str(d), v) for i, d, v in new}}


def test_deletes_drop_partitions_without_rows(spark, stored):
    before, was = files(spark, stored), state(spark, stored)
    gone = spark.createDataFrame([(i,) for i in [*range(0, 40, 5), 3, 77, None, 3]], "id bigint")
    assert P.delete(stored, gone, "id") == ["2025-01-01", "2025-01-04"]
    after = files(spark, stored)
    assert set(before) - set(after) == {"2025-01-01"}
    assert {p for p in after if before[p] != after[p]} == {"2025-01-04"}
    assert state(spark, stored) == {i: x for i, x in was.items() if i % 5 and i != 3 or i == 40}
    # everything goes, and the empty table can be filled again
    P.delete(stored, P.read(spark, stored).select("id"), "id")
    assert P.read(spark, stored).count() == 0
    P.append(stored, spark.createDataFrame([(7, None, "x")], SCHEMA), P.day_of("day"))
    assert state(spark, stored) == {7: ("None", "x")}


def test_appends_add_files(spark, stored):
    before, was = files(spark, stored), state(spark, stored)
    more = P.read(spark, stored).filter("id = 6").withColumn("id", F.lit(60).cast("bigint"))
    P.append(stored, more, P.day_of("day"))
    after = files(spark, stored)
    assert all(before[p] <= after[p] for p in before)
    assert {p for p in before if before[p] != after[p]} == {"2025-01-02"}
    assert state(spark, stored) == {**was, 60: ("2025-01-02", "v6")}


def test_nothing_to_change(spark, stored):
    before = files(spark, stored)
    nothing = spark.createDataFrame([], SCHEMA)
    assert P.update(stored, nothing, "id", P.day_of("day")) == []
    assert P.delete(stored, nothing, "id") == []
    assert files(spark, stored) == before
