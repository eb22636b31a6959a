"""First come, first served over sets of items: the rule behind seat booking.

A request claims several items and gets all of them or none. Requests are served in the
order of ``request_id``; one loses if an item was given to an earlier request. A refused
request gives nothing away, so whether a claim holds depends on all earlier decisions.

Groups of few claims are folded in order, one array each. Larger ones are settled in rounds of
joins and aggregates over all tasks. A request without an open rival before it wins. One with a single
open rival before it wins exactly if that one loses, so such requests form trees, whose decisions
are found by doubling: each step looks at the decision twice as far up, and a chain of n rivals
takes log2(n) steps. What a round cannot decide has two or more open rivals before it; most of
these lose an item in it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.checkpoints import cut

# stands for two or more rivals; the one number that is no request id
_SEVERAL = -(1 << 63)

# claims of a group that one row may hold as an array
FOLD_ROWS = 1_000


def _rivals(claims: DataFrame) -> DataFrame:
    """(request_id, before) of all open requests: ``before`` is NULL if no open request comes
    first on any of its items, the id of the only one that does, or ``_SEVERAL``.

    It takes the first two requests of each item. Their limit is applied before the shuffle,
    so an item that a third of all requests ask for sends two rows a task.
    """
    item = ["grp", "item"]
    ranked = claims.withColumn(
        "_place", F.row_number().over(Window.partitionBy(*item).orderBy("request_id"))
    ).filter(F.col("_place") <= 2)
    first_two = ranked.groupBy(*item).agg(
        F.min("request_id").alias("first"), F.max("request_id").alias("second")
    )
    rival: Column = (
        F.when(F.col("request_id") == F.col("first"), F.lit(None).cast("bigint"))
        .when(F.col("request_id") == F.col("second"), F.col("first"))
        .otherwise(F.lit(_SEVERAL))
    )
    least, most = F.min("rival"), F.max("rival")
    return (
        claims.join(first_two, item)
        .select("request_id", rival.alias("rival"))
        .groupBy("request_id")
        .agg(F.when(least == most, least).when(least.isNotNull(), F.lit(_SEVERAL)).alias("before"))
    )


def _decided(rivals: DataFrame) -> DataFrame:
    """(request_id, won) of the requests that ``rivals`` settles.

    ``up`` is the request that a decision hangs on, ``flip`` whether it is the opposite of
    that one's. A step replaces both by those of the request above; an ``up`` that is decided,
    or has several rivals and stays open, ends the climb.
    """
    several = F.col("before") == _SEVERAL
    nodes = rivals.select(
        "request_id",
        F.when(~several, F.col("before")).alias("up"),
        F.when(F.col("before").isNull(), True).alias("won"),
        F.col("before").isNotNull().alias("flip"),
    )
    done: list[DataFrame] = []
    while True:
        above = nodes.select(
            F.col("request_id").alias("up"),
            F.col("up").alias("_up"),
            F.col("won").alias("_won"),
            F.col("flip").alias("_flip"),
        )
        ends = F.col("_up").isNull()
        nodes = cut(
            nodes.join(above, "up", "left").select(
                "request_id",
                F.col("_up").alias("up"),
                F.coalesce("won", F.when(ends, F.col("_won") != F.col("flip"))).alias("won"),
                # flips add up on the way; below a request that stays open they do not matter
                (F.col("flip") != F.coalesce(F.col("_flip") & ~ends, F.lit(False))).alias("flip"),
            )
        )
        if nodes.filter(F.col("up").isNotNull()).isEmpty():
            return nodes.filter(F.col("won").isNotNull()).select("request_id", "won")


def _folded(claims: DataFrame) -> DataFrame:
    """Winners of groups with few claims: each group's requests, in order, are one array, which
    is folded over the items given away so far."""
    by_group = claims.repartition("grp").groupBy("grp", "request_id").agg(
        F.collect_list("item").alias("items")
    )
    lists = by_group.groupBy("grp").agg(
        F.array_sort(F.collect_list(F.struct("request_id", "items"))).alias("requests")
    )
    kind = claims.schema["item"].dataType.simpleString()
    start = F.struct(
        F.array().cast(f"array<{kind}>").alias("given"), F.array().cast("array<bigint>").alias("won")
    )

    def serve(done: Column, request: Column) -> Column:
        served = F.struct(
            F.concat(done["given"], request["items"]).alias("given"),
            F.array_append(done["won"], request["request_id"]).alias("won"),
        )
        return F.when(F.arrays_overlap(done["given"], request["items"]), done).otherwise(served)

    won = F.aggregate("requests", start, serve, lambda done: done["won"])
    return lists.select(F.explode(won).alias("request_id"))


def _one_round(claims: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(winners, claims still open) after one round."""
    item = ["grp", "item"]
    decided = _decided(cut(_rivals(claims)))
    won = decided.filter("won").select("request_id")
    # whoever claims an item that was given away is done, and so are all that were decided
    given = claims.join(won, "request_id", "left_semi").select(*item)
    lost = claims.join(given, item, "left_semi").select("request_id")
    gone = lost.unionByName(decided.select("request_id")).distinct()
    return won, cut(claims.join(gone, "request_id", "left_anti"))


def first_come(claims: DataFrame, fold_rows: int = FOLD_ROWS) -> DataFrame:
    """Request ids that get all their items, each once.

    ``claims`` has ``request_id`` (bigint), ``item`` and ``grp``, none of them NULL; items of
    different groups never collide. A claim that is repeated counts once. Groups of at most
    ``fold_rows`` claims are folded in order; larger ones, however large, are settled in rounds
    over all their rows until so few are left. ``fold_rows`` moves cost only.
    """
    claims = cut(claims.select("request_id", "grp", "item").distinct())
    winners: list[DataFrame] = []
    while True:
        sizes = claims.groupBy("grp").agg(F.count(F.lit(1)).alias("rows"))
        large = sizes.filter(F.col("rows") > fold_rows).select("grp")
        if large.isEmpty():
            winners.append(_folded(claims))
            return cut(reduce(DataFrame.unionByName, winners))
        winners.append(_folded(claims.join(large, "grp", "left_anti")))
        won, claims = _one_round(cut(claims.join(large, "grp", "left_semi")))
        winners.append(won)


def first_by_key(claims: DataFrame, keys: int) -> DataFrame:
    """``first_come`` for claims (request_id, item) on unique values, of which a request has
    ``keys`` at most and which are mostly asked for once.

    With one value each the first request of a value gets it. With several, requests whose
    values no other asks for need no round.
    """
    if keys == 1:
        first = claims.groupBy("item").agg(F.min("request_id").alias("request_id"))
        return first.select("request_id")
    met = claims.groupBy("item").agg(
        F.min("request_id").alias("lo"), F.max("request_id").alias("hi")
    )
    contested = met.filter("lo < hi").select("item")
    rivals = claims.join(contested, "item", "left_semi").select("request_id").distinct()
    alone = claims.select("request_id").distinct().join(rivals, "request_id", "left_anti")
    settled = first_come(
        claims.join(rivals, "request_id", "left_semi").withColumn("grp", F.lit(0))
    )
    return cut(alone.unionByName(settled))


def distinct_claims(requests: DataFrame, group: str, items: str) -> DataFrame:
    """Of requests with the very same items only the first can win: either it gets them or
    someone before it holds one of them for good. Keeps that one per group and item set."""
    return (
        requests.groupBy(group, F.array_sort(items).alias(items))
        .agg(F.min("request_id").alias("request_id"))
        .select("request_id", F.col(group).alias("grp"), F.explode(items).alias("item"))
    )
