"""Who holds a unique value when: keyed changes applied in the order of ``request_id``.

A change of a row takes the values it sets and frees those that the row had. It is refused if
another row holds one of its values at that time, and then neither takes nor frees anything.
Most values are asked for by one row only; such changes are never in question. The others form
components, rows and contested values that hang together, found by joins; each component is
settled in one pass over its changes in order, which stream through a task that keeps the
values held at the time. Components are spread over tasks; the order within one is the rule
itself, so it is not split. That pass sees contested values only, and of a row's changes that ask
for none only the first after one that does: it frees what the row had, the next find nothing to free.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.checkpoints import cut

START = -(1 << 62)  # before every request


def _components(links: DataFrame) -> DataFrame:
    """(key, label): equal labels for keys that hang together by items; links are (key, item).

    Each round takes the least label over a key's items and then that label's own label, so
    the number of rounds follows the logarithm of the longest path.
    """
    labels = cut(links.select("key").distinct().withColumn("label", F.col("key")))
    total = None
    while True:
        by_item = links.join(labels, "key").groupBy("item").agg(F.min("label").alias("label"))
        least = links.join(by_item, "item").groupBy("key").agg(F.min("label").alias("label"))
        above = least.select(F.col("key").alias("label"), F.col("label").alias("next"))
        labels = cut(least.join(above, "label", "left").select("key", F.coalesce("next", "label").alias("label")))
        now = labels.agg(F.sum(F.xxhash64("key", "label").cast("decimal(38,0)"))).first()[0]
        if now == total:
            return labels
        total = now


def _in_question(changes: DataFrame, holders: DataFrame) -> DataFrame:
    """(label, key, request_id, items): the contested values of what can be refused or free one,
    with the holders at the start as changes of ``START``."""
    asked = changes.select("request_id", "key", F.explode("items").alias("item")).dropna()
    held = holders.select(F.lit(START).alias("request_id"), "key", F.explode("items").alias("item")).dropna()
    both = asked.unionByName(held)
    contested = cut(
        both.groupBy("item")
        .agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.max("request_id").alias("last"))
        .filter((F.col("lo") < F.col("hi")) & (F.col("last") > START)).select("item")
    )
    hits = cut(both.join(contested, "item", "left_semi"))
    labels = _components(cut(hits.select("key", "item").distinct()))
    # all changes of these rows; those without a contested value count after one that has some
    met = changes.select("request_id", "key", F.lit(None).cast("string").alias("item")).unionByName(hits)
    in_order = Window.partitionBy("key").orderBy("request_id", F.asc_nulls_first("item"))
    counts = F.coalesce("item", F.lag("item").over(in_order)).isNotNull()
    return (
        met.join(labels, "key").withColumn("_counts", counts).filter("_counts")
        .groupBy("label", "key", "request_id").agg(F.collect_set("item").alias("items"))
    )


def refused_changes(changes: DataFrame, holders: DataFrame) -> DataFrame:
    """(request_id, item, at_start) of the changes that take a value another row holds then.

    ``changes`` are (request_id, key, items), ``holders`` (key, items) of the rows at the start;
    items are texts, one for each unique rule or null, and keys numbers. ``at_start``: the other
    row has held the value from the start. A value that several rows hold at the start is free
    when all but the asking one have given it up.
    """
    # defined here, so that it travels whole and workers need no copy of this package
    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        has: dict = {}  # key: its items
        owners: dict = {}  # item: {key: whether from the start}
        for batch in batches:
            out = []
            for label, key, request, wanted in zip(*(column.to_pylist() for column in batch.columns)):
                if label != now:
                    now, has, owners = label, {}, {}
                rivals = []
                for x in wanted:
                    holders = owners.get(x)
                    if holders and (len(holders) > 1 or key not in holders):
                        rivals.append((x, any(start for k, start in holders.items() if k != key)))
                if request > START and rivals:
                    out.append((request, *min(rivals, key=lambda r: (not r[1], r[0]))))
                    continue
                for x in has.get(key, ()):
                    if x not in wanted and owners[x].pop(key, None) is not None and not owners[x]:
                        del owners[x]
                for x in wanted:
                    owners.setdefault(x, {}).setdefault(key, request == START)
                has[key] = wanted
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([o[0] for o in out], pa.int64()),
                    pa.array([o[1] for o in out], pa.string()),
                    pa.array([o[2] for o in out], pa.bool_()),
                ],
                ["request_id", "item", "at_start"],
            )

    rows = _in_question(changes, holders).select("label", "key", "request_id", "items")
    ordered = rows.repartition("label")
    ordered = ordered.sortWithinPartitions("label", "request_id")
    return ordered.mapInArrow(settle, "request_id bigint, item string, at_start boolean")
