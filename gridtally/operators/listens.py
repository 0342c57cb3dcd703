"""Per-user item activity: exact counts, rolling windows, rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtally.operators import params
from gridtally.operators.grid import listen_day

# How many ways the followers of one user are split.
FOLLOWER_SHARES = 256


def dedup_events(listens: DataFrame) -> DataFrame:
    """One row per (day, event_id): the same id on two days stays twice.

    Copies are usually identical; where they differ the earliest wins, so a rerun after a lost
    executor gives the same answer. The minimum is taken map-side first, so any number of copies
    of one event reaches the shuffle as one row per map task.
    """
    days = listens if "day" in listens.columns else listen_day(listens)
    row = F.struct("listened_at", "user_id", "song_id", "provider")
    first = days.groupBy("day", "event_id").agg(F.min(row).alias("row"))
    return first.select("day", "event_id", "row.*")


def daily_song_counts(listens: DataFrame) -> DataFrame:
    """Exact count per (user, day, song). The provider is not part of the key."""
    return (
        dedup_events(listens)
        .groupBy("user_id", "day", "song_id")
        .agg(F.count(F.lit(1)).alias("listen_count"))
    )


def flush_deltas(listens: DataFrame, flush: str) -> DataFrame:
    """Counter increments per flush: what one flush adds to each (user, day, song)."""
    days = listens if "day" in listens.columns else listen_day(listens)
    return days.groupBy(flush, "user_id", "day", "song_id").agg(F.count(F.lit(1)).alias("delta"))


def sum_deltas(deltas: DataFrame) -> DataFrame:
    """Stored counters: the sum of all increments."""
    return deltas.groupBy("user_id", "day", "song_id").agg(
        F.sum("delta").cast("bigint").alias("listen_count")
    )


def merge_days(daily: DataFrame, as_of, days=None) -> DataFrame:
    """Counts per (user, song) over as_of and the ``days`` − 1 days before it, for all users."""
    span, last = params.window_days(days), params.day(as_of, "as_of")
    window = daily.filter(
        F.col("day").between(F.date_sub(F.lit(last), span - 1), F.lit(last))
    )
    return window.groupBy("user_id", "song_id").agg(
        F.sum("listen_count").cast("bigint").alias("listen_count")
    )


def rank_songs(counts: DataFrame, k: int) -> DataFrame:
    """Best ``k`` songs of every user; equal counts are ordered by song_id.

    Counts come in partitioned by (user, song), so a user with very many songs is cut to ``k`` rows
    per partition (WindowGroupLimit) before the shuffle by user.
    """
    order = Window.partitionBy("user_id").orderBy(F.desc("listen_count"), "song_id")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def user_topk(daily: DataFrame, as_of, days=None, k=None) -> DataFrame:
    return rank_songs(merge_days(daily, as_of, days), params.top_k(k))


def topk_payload(topk: DataFrame, users: DataFrame, days=None, k=None) -> DataFrame:
    """One nested row per requested user, with an empty list for users without rows."""
    entry = F.struct("rank", "song_id", "listen_count")
    lists = topk.groupBy("user_id").agg(F.array_sort(F.collect_list(entry)).alias("ranked"))
    results = F.transform(
        F.coalesce("ranked", F.array().cast("array<struct<rank:int,song_id:string,listen_count:bigint>>")),
        lambda e: F.struct(e["song_id"].alias("song_id"), e["listen_count"].alias("listen_count"), e["rank"].alias("rank")),
    )
    return users.select("user_id").distinct().join(lists, "user_id", "left").select(
        "user_id",
        F.lit(params.window_days(days)).alias("days"),
        F.lit(params.top_k(k)).alias("k"),
        results.alias("results"),
        F.lit(False).alias("cached"),
    )


def topk_of_followed(follows: DataFrame, topk: DataFrame, shares: int = FOLLOWER_SHARES) -> DataFrame:
    """Top-K songs of everyone a user follows.

    One followee may have a third of all followers, so followers are split by hash into ``shares``.
    Each followee's ranking is packed into one row (at most k songs) and copied only to the shares
    that have followers, never more copies than result rows need anyway.
    """
    packed = topk.groupBy(F.col("user_id").alias("followee")).agg(
        F.collect_list(F.struct("song_id", "listen_count", "rank")).alias("songs")
    )
    edges = follows.withColumn("share", F.pmod(F.xxhash64("follower"), F.lit(shares)))
    copies = edges.select("followee", "share").distinct().join(packed, "followee")
    return edges.join(copies, ["followee", "share"]).select("follower", "followee", F.inline("songs"))


def exact_item_counts(listens: DataFrame) -> DataFrame:
    """COUNT(DISTINCT event_id) per (user, song) from raw events.

    Spark first reduces to distinct (user, song, event) rows, spread over all three columns, and
    only then counts, so one heavy pair is not counted in one task.
    """
    return listens.groupBy("user_id", "song_id").agg(F.count_distinct("event_id").alias("item_count"))


def raw_song_counts(history: DataFrame, limit: int = 10, user_id: str | None = None) -> DataFrame:
    """Most played songs straight from history: one user's list, or every user's."""
    if user_id is not None:
        counts = history.filter(F.col("user_id") == user_id).groupBy("song_id").agg(
            F.count(F.lit(1)).alias("listen_count")
        )
        return counts.orderBy(F.desc("listen_count"), "song_id").limit(limit)
    counts = history.groupBy("user_id", "song_id").agg(F.count(F.lit(1)).alias("listen_count"))
    return rank_songs(counts, limit)


def preaggregate_events(listens: DataFrame, *scope: str) -> DataFrame:
    """(user, song, count) summaries published instead of single events."""
    return listens.groupBy(*scope, "user_id", "song_id").agg(F.count(F.lit(1)).alias("listen_count"))


def reduction_ratio(summaries: DataFrame) -> DataFrame:
    """Messages before and after pre-aggregation, and the share saved."""
    totals = summaries.agg(
        F.coalesce(F.sum("listen_count"), F.lit(0)).cast("bigint").alias("messages_before"),
        F.count(F.lit(1)).alias("messages_after"),
    )
    saved = F.lit(1.0) - F.col("messages_after") / F.col("messages_before").cast("double")
    return totals.withColumn("reduction", F.when(F.col("messages_before") > 0, saved))


def dedup_stats(listens: DataFrame) -> DataFrame:
    """Events seen, accepted and skipped as duplicates, per day.

    Planned as (day, event_id) partial counts first, so neither a heavy day nor a much-copied event
    lands in one task.
    """
    days = listens if "day" in listens.columns else listen_day(listens)
    per_event = days.groupBy("day", "event_id").agg(F.count(F.lit(1)).alias("copies"))
    return per_event.groupBy("day").agg(
        F.sum("copies").cast("bigint").alias("seen"),
        F.count(F.lit(1)).alias("accepted"),
        F.sum(F.col("copies") - 1).cast("bigint").alias("duplicates"),
    )


def history_rows(listens: DataFrame) -> DataFrame:
    """Listen events in the history layout."""
    return listen_day(listens).select(
        "user_id", "day", F.col("listened_ts").alias("listened_at"), "event_id", "song_id", "provider"
    )


def history_newest_first(history: DataFrame) -> DataFrame:
    """Each user-day's events, newest first.

    A range sort over all four columns, so a very long user-day is spread over several tasks.
    """
    return history.orderBy("day", "user_id", F.desc("listened_at"), "event_id")
