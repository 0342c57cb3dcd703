"""Spacing and TTL dedup against plain sequential implementations."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridtally.operators import spacing
from gridtally.operators.dedup import dedup_batches

START = datetime(2024, 1, 1)


def _greedy(rows, gap_us):
    """rows: (key, microseconds, id); the rule applied one by one."""
    kept, last = set(), {}
    for key, at, row_id in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        if key not in last or at - last[key] >= gap_us:
            last[key] = at
            kept.add(row_id)
    return kept


def _frame(spark, rows):
    data = [(k, "s", START + timedelta(microseconds=us), i) for k, us, i in rows]
    return spark.createDataFrame(data, "client_id string, screen_id string, event_time timestamp, id long").repartition(5)


def _dense(rng, n, span_us):
    return [(rng.choice(["a", "a", "a", "b", None]), rng.randrange(span_us), i) for i in range(n)]


@pytest.mark.parametrize(
    "n, span_us, gap_us, chunk_us",
    [
        (3000, 60_000_000, 16_667, 1_000_000),      # busy, many chunks, few pauses
        (3000, 3_000_000, 100_000, 100_000),        # chunk as long as the gap
        (2000, 5_000_000, 1_000_000, None),         # everything in one chunk
        (500, 3_600_000_000, 1_000_000, 2_000_000), # sparse
        (4000, 10_000, 7, 50),                      # many equal times
    ],
)
def test_matches_the_sequential_rule(spark, n, span_us, gap_us, chunk_us):
    rows = _dense(random.Random(n + gap_us), n, span_us)
    out = spacing.keep_spaced(_frame(spark, rows), ["client_id", "screen_id"], "event_time", gap_us, ["id"], chunk_us)
    assert {r.id for r in out.collect()} == _greedy(rows, gap_us)


def test_chains_that_never_meet(spark):
    """Rows every half gap: odd and even rows form two chains, so each chunk depends on the first."""
    rows = [("a", 500 * i, i) for i in range(4001)]
    out = spacing.keep_spaced(_frame(spark, rows), ["client_id", "screen_id"], "event_time", 1000, ["id"], 2500)
    assert {r.id for r in out.collect()} == set(range(0, 4001, 2))


def test_columns_and_missing_times(spark):
    frame = spark.createDataFrame(
        [("a", "s", START, 1), ("a", "s", None, 2), ("a", "s", START + timedelta(microseconds=10), 3)],
        "client_id string, screen_id string, event_time timestamp, id long",
    )
    out = spacing.thin_events(frame, rate=60, order=("id",))
    assert out.schema == frame.schema and [r.id for r in out.collect()] == [1]


def test_rate_bounds():
    assert [spacing.gap_for_rate(r) for r in (None, 0, 1, 0.2, 240, 1000, 60, 3)] == [
        16667, 16667, 1_000_000, 1_000_000, 4167, 4167, 16667, 333_334
    ]


def _ttl_batches(spark, rows):
    data = [(c, b, START + timedelta(minutes=m), i) for c, b, m, i in rows]
    return spark.createDataFrame(data, "client_id string, batch_id string, received_at timestamp, id long")


def test_dedup_batches_by_hand(spark):
    day = 24 * 60
    rows = [
        ("a", "x", 0, 1), ("a", "x", 5, 2), ("b", "x", 5, 3), ("a", "", 1, 4), ("a", "", 2, 5), ("a", None, 3, 6),
        ("a", None, 3, 7), ("a:b", "c", 0, 8), ("a", "b:c", 0, 9), ("a", "x", day - 1, 10), ("a", "x", day, 11),
        ("a", "x", day + 1, 12), ("a", "x", 2 * day - 1, 13), ("a", "x", 2 * day, 14), ("a", " ", 0, 15), ("a", " ", 1, 16),
    ]
    kept = {r.id for r in dedup_batches(_ttl_batches(spark, rows), tie=("id",)).collect()}
    assert kept == {1, 3, 4, 5, 6, 7, 8, 9, 11, 14, 15}


def test_dedup_batches_random(spark):
    rng = random.Random(7)
    rows = [(rng.choice("ab"), rng.choice(["x", "y", "z"]), rng.randrange(6 * 24 * 60), i) for i in range(600)]
    expected = _greedy([(c + b, m, i) for c, b, m, i in rows], 24 * 60)
    assert {r.id for r in dedup_batches(_ttl_batches(spark, rows), tie=("id",)).collect()} == expected


def test_a_group_longer_than_a_block(spark):
    frame = spark.range(1_200_000).selectExpr(
        "if(id < 1100000, 'a', 'b') AS client_id", "'s' AS screen_id",
        "timestamp_micros(1704067200000000 + id * 10) AS event_time", "id",
    ).repartition(8)
    out = spacing.keep_spaced(frame, ["client_id", "screen_id"], "event_time", 25, ["id"], 60_000_000)
    kept = out.selectExpr("count(*)", "sum(id)", "min(id)", "max(id)").first()
    expected = list(range(0, 1_100_000, 3)) + list(range(1_100_000, 1_200_000, 3))
    assert tuple(kept) == (len(expected), sum(expected), 0, expected[-1])


def test_times_before_1970(spark):
    rows = [("a", us, i) for i, us in enumerate(range(-50, 50, 7))]
    data = [(k, "s", datetime(1970, 1, 1) + timedelta(microseconds=us), i) for k, us, i in rows]
    frame = spark.createDataFrame(data, "client_id string, screen_id string, event_time timestamp, id long")
    out = spacing.keep_spaced(frame, ["client_id", "screen_id"], "event_time", 10, ["id"], 16)
    assert {r.id for r in out.collect()} == _greedy(rows, 10)
