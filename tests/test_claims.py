"""First come, first served: rounds of joins against a plain replay."""

import random

import pytest
from helpers import AS_OF, BOOKING_REQUEST, FLOW_REQUESTS, apply, fix, rows
from pyspark.sql import functions as F

from railyard import messages as msg
from railyard.functions.ids import number_rows
from railyard.functions.lookups import taken_seats
from railyard.operators import booking_jobs, claims
from railyard.operators.booking_jobs import create_bookings
from railyard.operators.claims import distinct_claims, first_by_key, first_come
from railyard.plans.checkpoints import cut
from railyard.sources.commands import mixed_booking_requests
from railyard.sources.seed import seed_tables
from railyard.sources.star import star_tables


def replay(requests):
    """request_id, group, items -> winners, one request after the other."""
    given, won = set(), set()
    for request, group, items in sorted(requests):
        wanted = {(group, i) for i in items}
        if not wanted & given:
            given |= wanted
            won.add(request)
    return won


def random_requests(seed, n=300, groups=4, items=12):
    rnd = random.Random(seed)
    ids = rnd.sample(range(10_000), n)
    hot = [rnd.choice([0, 0, 0, *range(groups)]) for _ in ids]
    return [(r, g, rnd.sample(range(items), rnd.randint(1, 3))) for r, g in zip(ids, hot)]


def settle(spark, requests, fold_rows):
    df = spark.createDataFrame(requests, "request_id bigint, grp bigint, items array<bigint>")
    return first_come(distinct_claims(df, "grp", "items"), fold_rows)


def dense(seed, n=150):
    """Up to five items out of few, ids below 0 too: many rivals before most requests."""
    rnd = random.Random(seed)
    return [(r - 70, 0, rnd.sample(range(18), rnd.randint(1, 5))) for r in range(n)]


def hot_item(n=400):
    """Everyone wants item 0, and one more besides, in falling and rising order."""
    return [(i, 0, [0, 1 + i % 90] if i % 3 else [1 + (n - i) % 90]) for i in range(n)]


def forest(seed, n=200):
    """Each request shares one item with one earlier request: trees of every depth."""
    rnd = random.Random(seed)
    asked = {i: [10 * i] for i in range(n)}
    for i in range(1, n):
        rival = rnd.randrange(max(0, i - 4), i)
        asked[rival].append(10_000 + i)
        asked[i].append(10_000 + i)
    return [(i, 0, items) for i, items in asked.items()]


@pytest.mark.parametrize(
    "requests",
    [random_requests(1), random_requests(2, 200, 2, 30), dense(3), hot_item(), forest(4)],
    ids=["random", "wide", "dense", "hot", "forest"],
)
@pytest.mark.parametrize("fold_rows", [100_000, 60, 0])
def test_matches_a_replay(spark, requests, fold_rows):
    got = [r[0] for r in rows(settle(spark, requests, fold_rows))]
    assert set(got) == replay(requests) and len(got) == len(set(got))


def test_no_claims_and_repeated_claims(spark):
    empty = spark.createDataFrame([], "request_id bigint, grp bigint, item bigint")
    assert first_come(empty).count() == 0
    twice = spark.createDataFrame(
        [(2, 0, 5), (2, 0, 5), (1, 0, 5), (1, 0, 5), (3, 1, 5)], empty.schema
    )
    assert sorted(rows(first_come(twice))) == [(1,), (3,)]


def test_long_chain_in_a_bounded_number_of_steps(spark, monkeypatch):
    """Every second request of a chain wins; the written steps follow its logarithm."""
    steps = []

    def counted(df):
        steps.append(1)
        return cut(df)

    monkeypatch.setattr(claims, "cut", counted)
    n = 100_000
    links = spark.range(n).select(
        F.col("id").alias("request_id"),
        F.lit(0).alias("grp"),
        F.explode(F.array("id", F.col("id") + 1)).alias("item"),
    )
    got = first_come(links)
    assert got.count() == n // 2 and got.filter("request_id % 2 = 1").isEmpty()
    assert len(steps) <= 24


def test_settlement_needs_no_python(spark):
    nodes = claims._rivals(spark.createDataFrame([(1, 0, 1)], "request_id bigint, grp int, item int"))
    text = nodes._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in text and "Pandas" not in text


@pytest.mark.parametrize("keys", [1, 2])
def test_unique_values_in_rounds(spark, keys):
    """Two values a request, many asked for once, some by chains of requests."""
    rnd = random.Random(keys)
    asked = [(r, 0, [f"a{rnd.randint(0, 60)}", f"b{r % 25}"][:keys]) for r in rnd.sample(range(500), 90)]
    df = spark.createDataFrame(asked, "request_id bigint, grp bigint, items array<string>")
    asks = df.select("request_id", F.explode("items").alias("item"))
    got = [r[0] for r in rows(first_by_key(asks, keys))]
    assert set(got) == replay(asked) and len(got) == len(set(got))
    assert first_by_key(asks.limit(0), keys).count() == 0


def test_numbers_are_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(7)
    got = rows(number_rows(df, "k").orderBy("k"), "k", "_n")
    assert got == [(i, i + 1) for i in range(1000)]
    assert number_rows(df.limit(0), "k").count() == 0


@pytest.fixture(scope="module")
def seed(spark):
    t = seed_tables(spark)
    return t.with_frames(Seats=fix(t["Seats"]), Users=fix(t["Users"]))


def book(spark, t, requests, **options):
    return create_bookings(t, spark.createDataFrame(requests, BOOKING_REQUEST), AS_OF, **options)


def test_every_kind_of_refusal(spark, seed):
    t = apply(seed, book(spark, seed, FLOW_REQUESTS))
    requests = [
        (10, 1, 99, "1", "A", "VNPay"),
        (11, 1, 1, "1,2", "A", "VNPay"),
        (12, 1, 1, "3", "A", "VNPay"),
        (13, 1, 1, "5,5", "A,B", "VNPay"),
        (14, 1, 1, "9999", "A", "VNPay"),
        (15, 99, 1, "6", "A", "VNPay"),
        (16, 1, 1, "7", "A", "Barter"),
        (17, 1, 1, "8,12", "A,B", "VNPay"),  # 12 is taken, so 8 stays free
        (18, 2, 1, "8, 9", "A, B", "Cash"),
        (19, 2, 1, "9,10", "A,B", "Cash"),
        (20, 2, 1, "10", "A", None),
        (21, 2, 6, "8", "A", "Momo"),  # same seat on another trip
        (22, 2, 1, "x", "A", "Momo"),
    ]
    out = book(spark, t, requests, first_code=4)
    refused = {r.request_id: (r.code, r.reason) for r in out["rejects"].collect()}
    assert refused == {
        10: msg.NO_SCHEDULE,
        11: msg.LIST_MISMATCH,
        12: msg.SEAT_TAKEN,
        13: msg.SEAT_TAKEN,
        14: (None, "unknown SeatID"),
        15: (None, "unknown UserID"),
        16: (None, "unknown PaymentMethod"),
        17: msg.SEAT_TAKEN,
        19: msg.SEAT_TAKEN,
        22: (None, "unknown SeatID"),
    }
    got = rows(out["bookings"].orderBy("BookingID"), "BookingID", "BookingCode", "ScheduleID")
    assert got == [
        (4, "BK2025110500004", 1),
        (5, "BK2025110500005", 1),
        (6, "BK2025110500006", 6),
    ]
    assert rows(out["payments"].orderBy("PaymentID"), "PaymentID", "PaymentMethod") == [
        (4, "Cash"),
        (5, None),
        (6, "Momo"),
    ]
    assert dict(rows(out["schedules"], "ScheduleID", "AvailableSeats")) == {1: 340, 6: 349}
    ids = [r[0] for r in rows(out["tickets"].orderBy("TicketID"), "TicketID")]
    assert ids == [8, 9, 10, 11]


def test_train_check_and_late_check_are_options(spark, seed):
    other = [(1, 1, 1, "200", "A", "VNPay")]  # a seat of train 2
    assert book(spark, seed, other)["bookings"].count() == 1
    out = book(spark, seed, other, check_train=True)
    assert rows(out["rejects"], "reason") == [("seat of another train",)]
    late = [(1, 1, 2, "1", "A", "VNPay")]  # left three days ago
    assert book(spark, seed, late)["bookings"].count() == 1
    assert rows(book(spark, seed, late, refuse_late=True)["rejects"], "reason") == [(msg.TOO_LATE,)]


def test_invariants_under_heavy_conflict(spark, seed):
    rnd = random.Random(5)
    requests = []
    for i in range(120):
        seats = rnd.sample(range(1, 15), rnd.randint(1, 3))
        names = ",".join("N" for _ in seats)
        trip = rnd.choice([1, 1, 6])
        requests.append((i, 1, trip, ",".join(map(str, seats)), names, "VNPay"))
    out = book(spark, seed, requests)
    wanted = replay([(r[0], r[2], r[3].split(",")) for r in requests])
    assert out["bookings"].count() == len(wanted)
    refused = {r[0] for r in rows(out["rejects"], "request_id")}
    assert refused == {r[0] for r in requests} - wanted
    t = apply(seed, out)
    pairs = t["Tickets"].join(t["Bookings"], "BookingID").select("ScheduleID", "SeatID")
    assert pairs.count() == pairs.distinct().count()
    free = t["Schedules"].agg(F.sum("AvailableSeats")).first()[0]
    before = seed["Schedules"].agg(F.sum("AvailableSeats")).first()[0]
    assert free + t["Tickets"].count() == before


def test_only_what_looks_like_a_number_is_cast(spark):
    texts = ["1", " 2 ", "+3", "-4", "x7", "-", "", "1.5", "1e3", "99999999999999999999", "\t5\n", "6 7", "٣"]
    asked = spark.createDataFrame([(",".join(texts), "An, Binh"), (None, None)], "seat_ids string, passenger_names string")
    plain = F.transform(F.split("seat_ids", ","), lambda s: F.trim(s).try_cast("bigint"))
    want = [r[0] or [] for r in asked.select(plain).collect()]
    got = booking_jobs._with_lists(asked).collect()
    assert [r.seats for r in got] == want and want[0][:4] == [1, 2, 3, -4] and want[0][4] is None
    # a try_cast that fails throws an exception, which costs more than the whole request
    assert "RLIKE" in booking_jobs._with_lists(asked)._jdf.queryExecution().optimizedPlan().toString()


def test_requests_copy_no_seat_lists(spark):
    sf = "/root/testdata/sf0.001"
    made = mixed_booking_requests(star_tables(spark, sf, "1990-01-01 00:00:00"), spark, sf)
    # Spark copies the row that a lambda stands on, here with all seats of a train
    top = made._jdf.queryExecution().optimizedPlan().toString().split("\n")[0]
    assert "own" in top and "lambda" not in top


def test_taken_seats_of_few_seats(spark):
    t = star_tables(spark, "/root/testdata/sf0.001", "1990-01-01 00:00:00")
    every = set(rows(taken_seats(t)))
    some = spark.range(3, 9).withColumnRenamed("id", "SeatID")
    assert set(rows(taken_seats(t, seats=some))) == {r for r in every if 3 <= r[0] < 9} != set()
