"""Per-user item activity: counts, windows, rankings, sketches, checks on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridtally.operators import bloom, checks, grid, ingest, keyed, listens, rollups, sketches
from gridtally.session import saved
from workload import views
from workload.registry import query

AS_OF = views.EVENTS_AS_OF


@query("listen_day", f"""WITH {views.LISTENS} SELECT event_id, user_id, song_id, provider, listened_at, day,
  CAST(make_timestamp(listened_at * 1000000) AS TIMESTAMP) AS listened_ts FROM listens""")
def _(spark, d):
    return grid.listen_day(views.listens(spark, d))


def _daily(spark, d):
    return listens.daily_song_counts(views.listens_replayed(spark, d))


query("daily_song_counts", f"WITH {views.DAILY_COUNTS} SELECT user_id, day, song_id, listen_count FROM daily_counts")(_daily)


@query("partial_then_final_counts", f"""WITH {views.LISTENS}
SELECT user_id, day, song_id, count(*) AS listen_count FROM listens GROUP BY ALL""")
def _(spark, d):
    """Increments of hourly flushes, added up."""
    flushed = views.listens(spark, d).withColumn("flush", F.expr("listened_at div 3600"))
    return listens.sum_deltas(listens.flush_deltas(flushed, "flush"))


@query("merge_days", f"WITH {views.MERGED} SELECT user_id, song_id, listen_count FROM merged")
def _(spark, d):
    return listens.merge_days(_daily(spark, d), AS_OF)


def _topk(spark, d):
    return listens.user_topk(_daily(spark, d), AS_OF)


query("user_topk", f"WITH {views.TOPK} SELECT user_id, song_id, listen_count, rank FROM topk")(_topk)


@query("topk_payload", f"""WITH {views.TOPK}, asked AS (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id FROM customer), lists AS (
  SELECT user_id, string_agg('{{"song_id":"' || song_id || '","listen_count":' || listen_count || ',"rank":' || rank || '}}', ',' ORDER BY rank) AS r
  FROM topk GROUP BY user_id)
SELECT user_id, '{{"user_id":"' || user_id || '","days":7,"k":10,"results":[' || coalesce(r, '') || '],"cached":false}}' AS body
FROM asked LEFT JOIN lists USING (user_id)""")
def _(spark, d):
    asked = views.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("user_id"))
    payload = listens.topk_payload(_topk(spark, d), asked)
    return payload.select("user_id", F.to_json(F.struct("user_id", "days", "k", "results", "cached")).alias("body"))


@query("topk_of_followed", f"""WITH {views.TOPK}, {views.FOLLOWS}
SELECT follower, followee, song_id, listen_count, rank FROM follows JOIN topk ON user_id = followee""")
def _(spark, d):
    return listens.topk_of_followed(views.follows(spark, d), _topk(spark, d))


@query("exact_item_counts", f"""WITH {views.LISTENS}
SELECT user_id, song_id, count(DISTINCT event_id) AS item_count FROM replayed GROUP BY ALL""")
def _(spark, d):
    return listens.exact_item_counts(views.listens_replayed(spark, d))


@query("raw_song_counts", f"""WITH {views.LISTENS} SELECT user_id, song_id, listen_count, rank FROM (
  SELECT user_id, song_id, count(*) AS listen_count,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, song_id) AS INTEGER) AS rank
  FROM listens GROUP BY user_id, song_id) WHERE rank <= 10""")
def _(spark, d):
    return listens.raw_song_counts(listens.history_rows(views.listens(spark, d)))


_PRE = f"""{views.LISTENS}, summaries AS (
  SELECT day, user_id, song_id, count(*) AS listen_count FROM listens GROUP BY ALL)"""


def _summaries(spark, d):
    return listens.preaggregate_events(grid.listen_day(views.listens(spark, d)), "day")


query("preaggregate_events", f"WITH {_PRE} SELECT day, user_id, song_id, listen_count FROM summaries")(_summaries)


@query("preaggregate_reduction", f"""WITH {_PRE} SELECT CAST(sum(listen_count) AS BIGINT) AS messages_before, count(*) AS messages_after,
  1.0::DOUBLE - count(*)::DOUBLE / sum(listen_count)::DOUBLE AS reduction FROM summaries""")
def _(spark, d):
    return listens.reduction_ratio(_summaries(spark, d))


@query("dedup_stats", f"""WITH {views.LISTENS} SELECT day, count(*) AS seen, count(DISTINCT event_id) AS accepted,
  count(*) - count(DISTINCT event_id) AS duplicates FROM replayed GROUP BY day""")
def _(spark, d):
    return listens.dedup_stats(views.listens_replayed(spark, d))


@query("history_newest_first", f"""WITH {views.LISTENS} SELECT user_id, day, CAST(make_timestamp(listened_at * 1000000) AS TIMESTAMP) AS listened_at,
  event_id, song_id, provider FROM listens ORDER BY day, user_id, listened_at DESC, event_id""")
def _(spark, d):
    return listens.history_newest_first(listens.history_rows(views.listens(spark, d)))


_BOUND = f"""WITH {views.LISTENS}
SELECT song_id, count(DISTINCT event_id) AS item_count, TRUE AS within_bound FROM replayed GROUP BY song_id"""


@query("approx_item_counts", _BOUND)
@query("approx_item_counts_bound", _BOUND)
def _(spark, d):
    """Merged daily sketches against exact counts: off by at most three standard errors, at any size."""
    rows = views.listens_replayed(spark, d)
    days = grid.listen_day(rows)
    estimate = sketches.approx_item_counts(sketches.daily_sketches(days, ["song_id"]), ["song_id"])
    exact = rows.groupBy("song_id").agg(F.count_distinct("event_id").alias("item_count"))
    off = F.abs(F.col("approx_count") - F.col("item_count")) / F.col("item_count")
    bound = 3 * 1.04 / 2 ** (sketches.LG_BUCKETS / 2)
    return exact.join(estimate, "song_id").select("song_id", "item_count", (off <= bound).alias("within_bound"))


@query("reconcile_counts", f"""WITH {views.LISTENS}, exact AS (
  SELECT user_id, song_id, count(DISTINCT event_id) AS exact_n FROM replayed GROUP BY ALL), loose AS (
  SELECT user_id, song_id, count(*) AS approx_n FROM replayed WHERE provider <> 'youtube' GROUP BY ALL), both_n AS (
  SELECT user_id, song_id, coalesce(exact_n, 0) AS exact_n, coalesce(approx_n, 0) AS approx_n
  FROM exact FULL JOIN loose USING (user_id, song_id))
SELECT *, abs(approx_n - exact_n)::DOUBLE / greatest(exact_n, 1)::DOUBLE AS rel_diff FROM both_n
WHERE abs(approx_n - exact_n)::DOUBLE / greatest(exact_n, 1)::DOUBLE > 0.25::DOUBLE""")
def _(spark, d):
    """A counter that saw replays and missed one provider, against the exact counts."""
    rows = views.listens_replayed(spark, d)
    exact = listens.exact_item_counts(rows).withColumnRenamed("item_count", "n")
    loose = rows.filter("provider <> 'youtube'").groupBy("user_id", "song_id").agg(F.count(F.lit(1)).alias("n"))
    return checks.reconcile_counts(loose, exact, ["user_id", "song_id"], 0.25)


@query("bloom_skip", f"""WITH {views.LISTENS} SELECT day, event_id, user_id, song_id, provider, listened_at
FROM listens WHERE provider = 'spotify'""")
def _(spark, d):
    """Events of two providers are already in the filter; everything arrives again. At ten million
    planned ids per day the filter makes no mistake on this data, so the exact answer is expected."""
    rows = views.listens_replayed(spark, d)
    seen = grid.listen_day(rows.filter("provider <> 'spotify'"))
    filters = saved(bloom.build_filter(seen), "bloom")
    return bloom.bloom_skip(rows, bloom.check_load(filters))


@query("expire_history", f"""WITH {views.LISTENS} SELECT user_id, day, event_id, song_id, provider FROM listens
WHERE make_timestamp(listened_at * 1000000) > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 7 DAY""")
def _(spark, d):
    history = listens.history_rows(views.listens(spark, d))
    kept = rollups.expire_rows(history, "listened_at", "2024-01-30 12:00:00", rollups.RETENTION_DAYS["history"])
    return kept.drop("listened_at")


@query("expire_counters", f"""WITH {views.DAILY_COUNTS} SELECT user_id, day, song_id, listen_count FROM daily_counts
WHERE day >= DATE '2024-01-30' - 8""")
def _(spark, d):
    return rollups.expire_rows(_daily(spark, d), "day", "2024-01-30 00:00:00", rollups.RETENTION_DAYS["counters"])


# --- service-level checks -----------------------------------------------------------------------

_METRICS = f"""{views.BATCH_EVENTS}, per_client AS (
  SELECT 'client-' || (user_id % 5) AS scope, count(*) AS n, count(*) FILTER (event_type = 'error') AS bad,
         quantile_disc(value, 0.99) AS p99 FROM events GROUP BY ALL), metrics AS (
  SELECT scope, 'error_rate_pct' AS metric, 100.0::DOUBLE * bad / n AS value FROM per_client
  UNION ALL SELECT scope, 'p99_latency_ms', p99 FROM per_client
  UNION ALL SELECT client_id, 'dlq_size', CAST(count(reason) AS DOUBLE) FROM batch GROUP BY client_id
  UNION ALL SELECT client_id, 'consumer_lag', CAST(count(*) FILTER (received_at >= event_time + INTERVAL 3 HOUR) AS DOUBLE) FROM raw GROUP BY client_id)"""


@query("severity_report", f"""WITH {_METRICS} SELECT scope, metric, value, CASE
  WHEN value > critical THEN 'critical' WHEN value > warning THEN 'warning' ELSE 'ok' END AS severity
FROM metrics JOIN (VALUES ('consumer_lag', 10000.0, 100000.0), ('error_rate_pct', 1.0, 5.0),
  ('p99_latency_ms', 500.0, 2000.0), ('dlq_size', 100.0, 1000.0)) levels(metric, warning, critical) USING (metric)""")
def _(spark, d):
    """Error rate, p99, rejected batches and late events per client."""
    rows = views.table(spark, d, "events").withColumn("scope", F.concat(F.lit("client-"), (F.col("user_id") % 5).cast("string")))
    errors = rows.groupBy("scope").agg(
        (F.lit(100.0) * F.count_if(F.col("event_type") == "error") / F.count(F.lit(1))).alias("value")
    )
    p99 = checks.exact_percentiles(rows, "scope", "value", (0.99,)).select("scope", F.col("p99").alias("value"))
    rejected = ingest.validate_batch(views.batches(spark, d)).groupBy(F.col("client_id").alias("scope")).agg(
        F.count("reason").cast("double").alias("value")
    )
    behind = F.col("received_at") >= F.col("event_time") + F.expr("INTERVAL 3 HOURS")
    lag = views.raw_events(spark, d).groupBy(F.col("client_id").alias("scope")).agg(F.count_if(behind).cast("double").alias("value"))
    named = {"error_rate_pct": errors, "p99_latency_ms": p99, "dlq_size": rejected, "consumer_lag": lag}
    parts = [m.withColumn("metric", F.lit(name)) for name, m in named.items()]
    metrics = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return checks.severity_report(metrics)


_PERCENTILES = """SELECT event_type, count(value) AS n, quantile_disc(value, 0.5) AS p50,
  quantile_disc(value, 0.95) AS p95, quantile_disc(value, 0.99) AS p99 FROM events GROUP BY event_type"""


@query("latency_percentiles", _PERCENTILES)
def _(spark, d):
    return checks.exact_percentiles(views.table(spark, d, "events"), "event_type", "value")


@query("latency_percentiles_approx", _PERCENTILES)
def _(spark, d):
    """The sketch form; with this accuracy it is exact below a hundred thousand rows per group."""
    return checks.latency_percentiles(views.table(spark, d, "events"), "event_type", "value", accuracy=100_000)


# --- keyed state --------------------------------------------------------------------------------

_SCHEDULE_COLUMNS = "user_id, provider, next_crawl_at, status, updated_at, created_at, last_error"


def _schedule(spark, d):
    return keyed.apply_status_events(views.status_events(spark, d))


query("apply_status_events", f"WITH {views.STATUS} SELECT {_SCHEDULE_COLUMNS} FROM schedule")(_schedule)

_DUE = f"""due AS (SELECT * FROM schedule WHERE status = 'IDLE' AND next_crawl_at <= TIMESTAMP '{views.ORDERS_AS_OF}'
  ORDER BY next_crawl_at, user_id, provider LIMIT 100)"""


@query("due_work", f"WITH {views.STATUS}, {_DUE} SELECT {_SCHEDULE_COLUMNS} FROM due")
def _(spark, d):
    return keyed.due_work(_schedule(spark, d), views.ORDERS_AS_OF)


@query("stuck_work", f"""WITH {views.STATUS} SELECT {_SCHEDULE_COLUMNS} FROM schedule
WHERE status = 'ENQUEUED' AND updated_at < TIMESTAMP '{views.ORDERS_AS_OF}' - INTERVAL 600 MINUTE
ORDER BY updated_at, user_id, provider LIMIT 50""")
def _(spark, d):
    return keyed.stuck_work(_schedule(spark, d), views.ORDERS_AS_OF, minutes=600)


@query("claim_rows", f"""WITH {views.STATUS}, {_DUE} SELECT user_id, provider, next_crawl_at, 'ENQUEUED' AS status,
  TIMESTAMP '{views.ORDERS_AS_OF}' AS updated_at, created_at, last_error FROM schedule WHERE (user_id, provider) IN (SELECT user_id, provider FROM due)""")
def _(spark, d):
    schedule = _schedule(spark, d)
    return keyed.claim_rows(schedule, keyed.due_work(schedule, views.ORDERS_AS_OF), views.ORDERS_AS_OF)


def _links(spark, d):
    return keyed.latest_row_per_key(views.link_versions(spark, d), ["user_id", "provider"], ["updated_at", "seq"])


query("latest_row_per_key", f"WITH {views.LINKS} SELECT * FROM links")(_links)


@query("user_links", f"WITH {views.LINKS} SELECT user_id, provider, provider_user_id, scope, updated_at FROM links ORDER BY 1, 2")
def _(spark, d):
    return keyed.user_links(_links(spark, d))


@query("orphan_links", f"WITH {views.LINKS} SELECT * FROM links WHERE user_id NOT IN (SELECT user_id FROM users)")
def _(spark, d):
    return keyed.orphan_links(_links(spark, d), views.users(spark, d))


@query("duplicate_link_owners", f"""WITH {views.LINKS} SELECT provider, provider_user_id, count(DISTINCT user_id) AS owners
FROM links GROUP BY ALL HAVING count(DISTINCT user_id) > 1""")
def _(spark, d):
    return keyed.duplicate_link_owners(_links(spark, d))


@query("links_to_refresh", f"""WITH {views.LINKS}, judged AS (
  SELECT *, CASE WHEN refresh_token IS NULL OR expires_at IS NULL THEN 'missing_refresh_token'
    WHEN expires_at - 60 <= CAST(epoch(TIMESTAMP '2000-06-01') AS BIGINT) THEN 'refresh' END AS action FROM links)
SELECT user_id, provider, provider_user_id, expires_at, action FROM judged WHERE action IS NOT NULL""")
def _(spark, d):
    return keyed.links_to_refresh(_links(spark, d), 959_817_600)
