"""Keyed state without a database: newest rows, due work, status folding, link checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Claim sizes, how far ahead a finished crawl is planned, refresh margin.
DUE_LIMIT, STUCK_LIMIT = 100, 50
NEXT_CRAWL_HOURS = 24
REFRESH_MARGIN_SECONDS = 60
JOB_KEY = ["user_id", "provider"]
RELEASED = "RELEASED"


def latest_row_per_key(rows: DataFrame, keys: list[str], newest: list[str]) -> DataFrame:
    """Upsert: the newest row of each key wins whole. ``newest`` must order a key's rows fully.

    Spark keeps one row per key and map task (WindowGroupLimit) before the shuffle, so a key with
    very many versions does not pile up in one task.
    """
    order = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in newest])
    return rows.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def fold_status_events(events: DataFrame) -> DataFrame:
    """A change stream of job statuses to mergeable per-key state.

    ENQUEUED only moves the status. RUNNING clears the error. IDLE without an error is a finished
    crawl: it clears the error and plans the next one a day later. IDLE with an error keeps the
    plan and records the error. RELEASED takes back a claim that could not be queued: the job is
    IDLE again, with the plan and the error it had. Each field carries the (ts, seq) that set it, so folded rows of
    several micro-batches can be folded again with ``merge_status``.
    """
    at = F.struct("ts", "seq")
    finished = (F.col("status") == "IDLE") & F.col("error").isNull()
    sets_error = ~F.col("status").isin("ENQUEUED", RELEASED)
    return events.groupBy(*JOB_KEY).agg(
        F.max(F.struct("ts", "seq", "status")).alias("status_set"),
        F.max(F.when(sets_error, F.struct("ts", "seq", "error"))).alias("error_set"),
        F.max(F.when(finished, at)).alias("done_set"),
        F.min("ts").alias("created_at"),
    )


def merge_status(folded: DataFrame) -> DataFrame:
    """Merge already folded rows (for instance one per micro-batch) key by key."""
    return folded.groupBy(*JOB_KEY).agg(
        F.max("status_set").alias("status_set"),
        F.max("error_set").alias("error_set"),
        F.max("done_set").alias("done_set"),
        F.min("created_at").alias("created_at"),
    )


def schedule_rows(folded: DataFrame) -> DataFrame:
    """Folded state in the schedule layout. A job never finished is due since its creation."""
    next_day = F.col("done_set.ts") + F.make_interval(hours=F.lit(NEXT_CRAWL_HOURS))
    return folded.select(
        *JOB_KEY,
        F.coalesce(next_day, F.col("created_at")).alias("next_crawl_at"),
        F.when(F.col("status_set.status") == RELEASED, "IDLE").otherwise(F.col("status_set.status")).alias("status"),
        F.col("status_set.ts").alias("updated_at"),
        "created_at",
        F.col("error_set.error").alias("last_error"),
    )


def apply_status_events(events: DataFrame) -> DataFrame:
    return schedule_rows(fold_status_events(events))


def due_work(schedule: DataFrame, as_of, limit: int = DUE_LIMIT) -> DataFrame:
    """Idle jobs whose time has come, oldest first, at most ``limit``."""
    now = F.lit(str(as_of)).cast("timestamp")
    due = schedule.filter((F.col("status") == "IDLE") & (F.col("next_crawl_at") <= now))
    return due.orderBy("next_crawl_at", *JOB_KEY).limit(limit)


def stuck_work(schedule: DataFrame, as_of, minutes: int, limit: int = STUCK_LIMIT) -> DataFrame:
    """Jobs left ENQUEUED for longer than ``minutes``, oldest first, at most ``limit``."""
    cutoff = F.lit(str(as_of)).cast("timestamp") - F.make_interval(mins=F.lit(minutes))
    stuck = schedule.filter((F.col("status") == "ENQUEUED") & (F.col("updated_at") < cutoff))
    return stuck.orderBy("updated_at", *JOB_KEY).limit(limit)


def claim_rows(schedule: DataFrame, chosen: DataFrame, at, status: str = "ENQUEUED") -> DataFrame:
    """The chosen jobs with their new status, updated at the time of the claim.

    The limit in ``chosen`` tells the planner its size, which is what it needs to broadcast a claim.
    """
    claimed = schedule.join(chosen.select(*JOB_KEY), JOB_KEY, "left_semi")
    return claimed.withColumns({"status": F.lit(status), "updated_at": F.lit(str(at)).cast("timestamp")})


def claim_events(claimed: DataFrame, seq: int) -> DataFrame:
    """The claim as status events; once they are folded, ``due_work`` no longer offers the jobs.

    ``seq`` orders this claim among events of the same time.
    """
    return claimed.select(
        *JOB_KEY, "status", F.lit(None).cast("string").alias("error"),
        F.col("updated_at").alias("ts"), F.lit(seq).cast("bigint").alias("seq"),
    )


def user_links(links: DataFrame, user_id: str | None = None) -> DataFrame:
    """Links without their tokens, by provider; of one user or of all."""
    rows = links if user_id is None else links.filter(F.col("user_id") == user_id)
    shown = rows.select("user_id", "provider", "provider_user_id", "scope", "updated_at")
    return shown.orderBy("user_id", "provider")


def orphan_links(links: DataFrame, users: DataFrame) -> DataFrame:
    """Links whose user does not exist."""
    return links.join(users.select("user_id"), "user_id", "left_anti")


def duplicate_link_owners(links: DataFrame) -> DataFrame:
    """Provider accounts claimed by more than one user."""
    owners = links.groupBy("provider", "provider_user_id").agg(F.count_distinct("user_id").alias("owners"))
    return owners.filter(F.col("owners") > 1)


def links_to_refresh(links: DataFrame, as_of_seconds: int) -> DataFrame:
    """Links that cannot be used as they are, with the reason."""
    incomplete = F.col("refresh_token").isNull() | F.col("expires_at").isNull()
    expiring = F.col("expires_at") - REFRESH_MARGIN_SECONDS <= F.lit(as_of_seconds).cast("bigint")
    action = F.when(incomplete, "missing_refresh_token").when(expiring, "refresh")
    return links.select("user_id", "provider", "provider_user_id", "expires_at", action.alias("action")).filter(
        F.col("action").isNotNull()
    )
