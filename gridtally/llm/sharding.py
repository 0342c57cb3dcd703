"""Sharding by a minimax contiguous partition of ordered, atomic groups.

Rows with equal texts are one group; groups stand in the order of their text's hash. The smallest
capacity that lets a greedy walk fill all groups into the wanted number of shards is found by binary
search, and the walk's cuts at that capacity are the shard ends.

Spark numbers the rows and sums their sizes over the whole order. The search itself sees block
summaries of those running sums: a block's first and last sum bound the walk from below and above, and
only the narrow bands in which the walk may still end are summarized again, more finely, until the
capacity is exact. The driver holds ``shards * BLOCKS`` summary rows at any input size.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtally.session import saved

#: Summary rows of one band and round.
BLOCKS = 1024

Point = tuple[int, int]  # running bytes, running rows
#: (last end in [low, x], first end in (x, high]) of three numbers low, x, high.
Near = Callable[[int, int, int], tuple[Point | None, Point | None]]


class Steps:
    """Block summaries of running sums: (first, last, count) of each block, in order."""

    def __init__(self, blocks: list[tuple[Point, Point, int]]):
        self.blocks = blocks
        self.starts = [first[0] for first, _, _ in blocks]

    def last_up_to(self, x: int) -> tuple[Point, int]:
        """A true group end at or below x, and a bound that the greatest such end does not pass."""
        k = bisect_right(self.starts, x) - 1
        if k < 0:
            return (0, 0), 0
        first, last, count = self.blocks[k]
        if x >= last[0]:
            return last, last[0]
        return first, first[0] if count <= 2 else x


def walk(steps: list[Steps], capacity: int, total: int) -> tuple[list[Point], list[int]]:
    """Shard ends of the greedy walk: true ends from below, and bounds from above."""
    low, high = [(0, 0)], [0]
    for step in steps:
        low.append(step.last_up_to(min(total, low[-1][0] + capacity))[0])
        high.append(step.last_up_to(min(total, high[-1] + capacity))[1])
    return low, high


def _least(good: Callable[[int], bool], below: int, at: int) -> int:
    """The least x in (below, at] with good(x), which holds from some x on, and at ``at``."""
    while at - below > 1:
        middle = (below + at) // 2
        below, at = (below, middle) if good(middle) else (middle, at)
    return at


Summarize = Callable[[list[tuple[int, int]]], list[Steps]]


def _fits(summarize: Summarize, steps: list[Steps], capacity: int, total: int) -> list[Point] | None:
    """The walk's ends at one capacity, or None if it does not reach the end.

    Each round summarizes only the blocks in which the walk's steps fall, until the answer is sure.
    """
    while True:
        low, high = walk(steps, capacity, total)
        if low[-1][0] >= total:
            return low
        if high[-1] < total:
            return None
        steps = summarize(
            [
                (step.last_up_to(min(total, low[s][0] + capacity))[0][0], min(total, high[s] + capacity))
                for s, step in enumerate(steps)
            ]
        )


def smallest_capacity(summarize: Summarize, total: int, shards: int) -> tuple[int, list[Point]]:
    """The least capacity and the walk's ends. ``summarize`` gives the steps of each band [low, high]."""
    steps = [summarize([(0, total)])[0]] * shards
    bad, good = (total - 1) // shards, total
    ends, before = walk(steps, good, total)[0], None
    while True:
        sure = _least(lambda c: walk(steps, c, total)[0][-1][0] >= total, bad, good)
        if sure < good:
            good, ends = sure, walk(steps, sure, total)[0]
        bad = _least(lambda c: walk(steps, c, total)[1][-1] >= total, bad, good) - 1
        if good - bad <= 1:
            return good, ends
        if (bad, good) == before:  # a very large group keeps the bands wide: settle one capacity for sure
            middle = (bad + good) // 2
            found = _fits(summarize, steps, middle, total)
            bad, good, ends = (middle, good, ends) if found is None else (bad, middle, found)
        before = bad, good
        from_ends, to_ends = walk(steps, bad + 1, total)[0], walk(steps, good, total)[1]
        steps = summarize(
            [
                (steps[s].last_up_to(min(total, from_ends[s][0] + bad + 1))[0][0], min(total, to_ends[s] + good))
                for s in range(shards)
            ]
        )


def balanced(near: Near, tail: list[Point], capacity: int, shards: int) -> list[Point]:
    """Shard ends, from (0, 0) on, with no shard above a feasible ``capacity`` and none empty while groups are left.

    ``tail[j]`` is the end that j groups come after, for each j below the number of shards and groups.
    """
    total = tail[0]
    least = [total[0]]  # least end after each number of shards, from the last one back, that lets the rest fit
    for _ in range(shards - 1):
        x = least[-1] - capacity
        least.append(near(x, x - 1, total[0])[1][0] if x > 0 else 0)
    ends = [(0, 0)]
    for left in range(shards - 1, 0, -1):
        at = ends[-1][0]
        if at >= total[0]:
            ends.append(total)
            continue
        low, high = max(least[left], at + 1), at + capacity
        spare = left < len(tail) and tail[left][0] > at
        if spare:  # a group at least for every shard to come
            high = min(high, tail[left][0])
        wanted = at + (total[0] - at) // (left + 1) if spare else low
        wanted = min(max(wanted, low), high)
        below, above = near(low, wanted, high)
        if below and above:
            below = below if wanted - below[0] <= above[0] - wanted else above
        ends.append(below or above)
    return [*ends, total]


def _finder(groups: DataFrame, largest: int) -> Near:
    """Looks up ends in the stored groups; no gap between ends is wider than the largest group."""
    end = F.struct("upto", "row")

    def near(low: int, x: int, high: int) -> tuple[Point | None, Point | None]:
        here = groups.filter(F.col("upto").between(max(low, x - largest), min(high, x + largest)))
        found = here.agg(F.max(F.when(F.col("upto") <= x, end)), F.min(F.when(F.col("upto") > x, end))).first()
        return tuple(tuple(f) if f else None for f in found)

    return near


def _summarizer(groups: DataFrame) -> Summarize:
    """Blocks of group ends, for several bands in one job."""

    def summarize(bands: list[tuple[int, int]]) -> list[Steps]:
        spans = F.array(
            *[F.struct(F.lit(k).alias("band"), F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit((b - a) // BLOCKS + 1).alias("width")) for k, (a, b) in enumerate(bands)]
        )
        end = F.struct("upto", "row")
        blocks = (
            groups.filter((F.col("upto") >= min(a for a, _ in bands)) & (F.col("upto") <= max(b for _, b in bands)))
            .select("upto", "row", F.explode(F.filter(spans, lambda s: F.col("upto").between(s["a"], s["b"]))).alias("s"))
            .groupBy("s.band", F.floor((F.col("upto") - F.col("s.a")) / F.col("s.width")).alias("block"))
            .agg(F.min(end).alias("first"), F.max(end).alias("last"), F.count("*").alias("n"))
            .collect()
        )
        of: list[list[tuple[Point, Point, int]]] = [[] for _ in bands]
        for r in sorted(blocks, key=lambda r: (r["band"], r["block"])):
            of[r["band"]].append((tuple(r["first"]), tuple(r["last"]), r["n"]))
        return [Steps(blocks) for blocks in of]

    return summarize


def numbered(rows: DataFrame, order: list[str], size: str) -> DataFrame:
    """``rows`` in a fixed order with ``row`` (from 1) and ``upto`` (running sum of ``size``).

    Range partitions are numbered within and then offset by what stands before them, so no task sees
    more than its range; equal order keys may be split between ranges.
    """
    placed = saved(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns(
            {"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}
        ),
        "placed",
    )
    parts = placed.groupBy("_part").agg(F.sum(size).alias("_bytes"), F.count("*").alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    parts = saved(
        parts.select(
            "_part",
            F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_bytes"),
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows"),
        ),
        "parts",
    )
    within = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumn("_sum", F.sum(size).over(within))
        .join(parts, "_part")
        .withColumns({"upto": F.col("_sum") + F.col("_bytes"), "row": F.col("_at") + F.col("_rows") + 1})
        .drop("_part", "_at", "_sum", "_bytes", "_rows")
    )


def shard(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its shard, such that the fullest shard is as small as the order allows.

    A null text counts as empty and shares a group with empty texts. Repeated rows each get a slot of
    their own. A very long or very common text fills a shard of its own where it must, and the others share
    the rest evenly; no shard is empty if there are as many different texts. An empty table gives no rows.
    Other columns of ``docs`` are not read.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.sha2(body.cast("binary"), 256).alias("text_key"),
    )
    ordered = saved(numbered(rows, ["text_key", "doc_id"], "size"), "numbered")
    groups = ordered.groupBy("text_key").agg(F.max("upto").alias("upto"), F.max("row").alias("row"), F.sum("size").alias("bytes"))
    # In ranges of ends, so that looking for an end opens the files around it only.
    groups = saved(groups.drop("text_key").repartitionByRange("upto").sortWithinPartitions("upto"), "ends")
    total, largest = groups.agg(F.max("upto"), F.max("bytes")).first()
    ends = [(0, 0)] * (shards + 1)
    if total:
        capacity, _ = smallest_capacity(_summarizer(groups), total, shards)
        tail = [tuple(r) for r in groups.select("upto", "row").orderBy(F.desc("upto")).limit(shards).collect()]
        ends = balanced(_finder(groups, largest), tail, capacity, shards)
    number = F.lit(0)
    start = F.lit(0)
    for upto, row in ends[1:-1]:
        number = number + (F.col("upto") > upto).cast("int")
        start = F.when(F.col("upto") > upto, F.lit(row)).otherwise(start)
    return ordered.select(
        "doc_id", "size", "text_crc32",
        F.lit("bytes").alias("law"),
        number.cast("int").alias("shard"),
        (F.col("row") - 1 - start).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
