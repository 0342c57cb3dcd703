"""Skew trial: a third of all rows under one key; prints how evenly reduce tasks were loaded.

    python trials/skew.py ROWS SCRATCH_FOLDER [JOB ...]

Made-up rows are written once to the scratch folder, each job runs over all of them, and Spark's
event log tells how many records each task read.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from gridtally.operators import bloom, checks, dedup, grid, keyed, listens, rollups, spacing  # noqa: E402

START, DAYS = 1_704_067_200, 6


def session(logs: str) -> SparkSession:
    conf = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        "spark.eventLog.enabled": "true",
        "spark.eventLog.compress": "false",
        "spark.eventLog.dir": f"file://{logs}",
    }
    builder = SparkSession.builder.master("local[8]").appName("skew-trial")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def make_rows(spark: SparkSession, rows: int, path: str) -> None:
    def pick(seed: int, size: int):
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(size))

    hot = F.col("id") % 3 == 0

    def mostly(value: str, prefix: str, size: int):
        return F.when(hot, F.lit(value)).otherwise(F.concat(F.lit(prefix), pick(size, size)))

    spark.range(0, rows, 1, 64).select(
        F.col("id").alias("n"),
        F.when(hot, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("event_id"),
        mostly("hot", "c", 50).alias("client_id"),
        mostly("hot", "s", 7).alias("screen_id"),
        mostly("hot", "u", 100_000).alias("user_id"),
        F.concat(F.lit("song"), pick(2, 1_000_000)).alias("song_id"),
        F.lit("p").alias("provider"),
        (pick(3, DAYS * 86_400) + START).alias("listened_at"),
        F.timestamp_micros(pick(4, DAYS * 86_400_000_000) + START * 1_000_000).alias("event_time"),
        (pick(5, 1000) / 1000.0).alias("x_norm"),
        (pick(6, 1000) / 1000.0).alias("y_norm"),
        F.lit("mousemove").alias("event_type"),
        F.randn(3).alias("value"),
    ).write.parquet(path)


def jobs(raw):
    plays = raw.select("event_id", "user_id", "song_id", "provider", "listened_at")
    own_ids = raw.withColumn("event_id", F.concat("event_id", F.lit("-"), F.col("n") % 1000)).select(plays.columns)
    moves = raw.select("client_id", "screen_id", "event_time", "n")
    follows = raw.select(F.col("n").cast("string").alias("follower"), F.col("user_id").alias("followee"))
    sent = raw.select("client_id", F.col("event_id").alias("batch_id"), F.col("event_time").alias("received_at"), "n")
    return {
        "heatmap_hourly": lambda: rollups.heatmap_hourly(raw),
        "user_topk": lambda: listens.user_topk(listens.daily_song_counts(own_ids), "2024-01-06"),
        "topk_of_followed": lambda: listens.topk_of_followed(follows, listens.rank_songs(listens.preaggregate_events(raw), 10)),
        "thin_events": lambda: spacing.thin_events(moves, rate=60, order=("n",)),
        "dedup_batches": lambda: dedup.dedup_batches(sent, tie=("n",)),
        "exact_item_counts": lambda: listens.exact_item_counts(plays),
        "dedup_stats": lambda: listens.dedup_stats(plays),
        "exact_percentiles": lambda: checks.exact_percentiles(raw, "client_id", "value"),
        "bloom_skip": lambda: bloom.bloom_skip(own_ids, bloom.build_filter(grid.listen_day(own_ids.filter("song_id < 'song5'")))),
        "latest_row_per_key": lambda: keyed.latest_row_per_key(moves, ["client_id", "screen_id"], ["event_time", "n"]),
    }


def report(logs: str, names: dict[str, float]) -> None:
    described, loads = {}, {}
    newest = max(glob.glob(f"{logs}/*"), key=os.path.getmtime)
    for part in [newest] if os.path.isfile(newest) else sorted(glob.glob(f"{newest}/events*")):
        with open(part) as lines:
            for event in map(json.loads, lines):
                if event["Event"] == "SparkListenerJobStart":
                    label = event["Properties"].get("spark.job.description", "")
                    for stage in event["Stage IDs"]:
                        described.setdefault(stage, label)
                elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                    read = event["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
                    loads.setdefault(event["Stage ID"], []).append(read)
    for name, seconds in names.items():
        worst = 0.0
        for stage, reads in loads.items():
            if described.get(stage) == name and sum(reads) > 100_000:
                worst = max(worst, max(reads) / statistics.mean(n for n in reads if n))
        print(f"{name:20s} {seconds:7.2f} s  fullest reduce task {worst:.2f} × the mean")


def main() -> None:
    rows, folder = int(sys.argv[1]), sys.argv[2]
    logs = os.path.join(folder, f"events-{int(time.time())}")
    os.makedirs(logs)
    spark = session(logs)
    path = os.path.join(folder, f"rows-{rows}")
    if not os.path.exists(path):
        make_rows(spark, rows, path)
    known, taken = jobs(spark.read.parquet(path)), {}
    for name in sys.argv[3:] or known:
        spark.sparkContext.setJobDescription(name)
        start = time.perf_counter()
        known[name]().write.format("noop").mode("overwrite").save()
        taken[name] = time.perf_counter() - start
    spark.stop()
    report(logs, taken)


if __name__ == "__main__":
    main()
