"""Approximate dedup against history with a per-day split-block Bloom filter.

A filter is a table: one row per (day, block) with a 256-bit block in four longs. An id sets one bit
in each of the block's eight 32-bit lanes, so building is one ``bit_or`` aggregate and probing is
one join on (day, block): one row per id in both, all built-in functions. Blocks are picked by hash,
so a day with a third of all events is still spread evenly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.operators.listens import dedup_events

# Planned size of a day, wanted error, days kept; and the published space need of
# split-block filters at that error (bits per id).
DAY_CAPACITY = 10_000_000
ERROR_RATE = 0.001
KEEP_DAYS = 8
BITS_PER_ID = 16.9
BLOCK_BITS = 256

WORDS = ["w0", "w1", "w2", "w3"]
FILTER = "day date, block bigint, w0 bigint, w1 bigint, w2 bigint, w3 bigint, ids bigint"


def block_count(capacity: int = DAY_CAPACITY) -> int:
    return max(1, int(-(-capacity * BITS_PER_ID // BLOCK_BITS)))


def _word(index: int) -> Column:
    # Lanes 2i and 2i+1 live in the low and high half of word i, each addressed by five hash bits.
    low, high = 10 * index, 10 * index + 5
    return F.expr(
        f"shiftleft(1L, cast(shiftright(_bits, {low}) & 31L as int))"
        f" | shiftleft(1L, cast(32L + (shiftright(_bits, {high}) & 31L) as int))"
    )


def _hashed(events: DataFrame, capacity: int) -> DataFrame:
    block = F.pmod(F.xxhash64("event_id", "day"), F.lit(block_count(capacity)).cast("bigint"))
    return (
        events.withColumns({"block": block, "_bits": F.xxhash64("day", "event_id", F.lit("lanes"))})
        .withColumns({word: _word(i) for i, word in enumerate(WORDS)})
        .drop("_bits")
    )


def build_filter(events: DataFrame, capacity: int = DAY_CAPACITY) -> DataFrame:
    """Filter table of the given (day, event_id) rows; ``ids`` is the number of distinct ids."""
    ids = events.select("day", "event_id").distinct()
    union_bits = [F.bit_or(w).alias(w) for w in WORDS]
    return _hashed(ids, capacity).groupBy("day", "block").agg(*union_bits, F.count(F.lit(1)).alias("ids"))


def merge_filters(*filters: DataFrame) -> DataFrame:
    """Union of filters built with the same capacity from disjoint ids."""
    rows = filters[0]
    for other in filters[1:]:
        rows = rows.unionByName(other)
    return rows.groupBy("day", "block").agg(
        *[F.bit_or(w).alias(w) for w in WORDS], F.sum("ids").cast("bigint").alias("ids")
    )


def check_load(filters: DataFrame, capacity: int = DAY_CAPACITY) -> DataFrame:
    """The filter, failing on a day with more ids than planned for (its errors would exceed the
    promised rate). Costs one small aggregate: a day has a fixed number of blocks."""
    loads = filters.groupBy("day").agg(F.sum("ids").alias("_load"))
    full = F.when(
        F.col("_load") > capacity,
        F.raise_error(F.concat(F.lit("Bloom filter over capacity on "), F.col("day").cast("string"))),
    ).otherwise(F.lit(True).cast("string"))
    checked = loads.select("day", full.alias("_ok")).filter(F.col("_ok").isNotNull())
    return filters.join(checked.drop("_ok"), "day", "left_semi")


def bloom_skip(listens: DataFrame, filters: DataFrame, capacity: int = DAY_CAPACITY) -> DataFrame:
    """Events not seen before: exact within the new rows, approximate against the filter.

    A filter hit skips the event, so counts can come out slightly low but never too high.
    """
    fresh = _hashed(dedup_events(listens), capacity)
    known = filters.select("day", "block", *[F.col(w).alias(f"_{w}") for w in WORDS])
    hit = F.lit(True)
    for w in WORDS:
        hit = hit & (F.col(f"_{w}").bitwiseAND(F.col(w)) == F.col(w))
    probed = fresh.join(known, ["day", "block"], "left")
    return probed.filter(~F.coalesce(hit, F.lit(False))).drop("block", *WORDS, *[f"_{w}" for w in WORDS])
