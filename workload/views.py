"""Engine inputs derived from the given tables: Spark frames and the same views as DuckDB text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS_AS_OF = "2024-01-30"
ORDERS_AS_OF = "2001-08-01"


# Schemas of the given tables in use, so that no footer is read just to learn them.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The files hold zone-less UTC times; watermarks need instants.
    return timed_events(table(spark, sf_dir, "events"))


def timed_events(rows: DataFrame) -> DataFrame:
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def _k():
    return F.get_json_object("props", "$.k").cast("int")


def raw_from(rows: DataFrame) -> DataFrame:
    screen = F.concat(F.lit("screen-"), (F.col("event_id") % 3).cast("string"))
    number = F.expr("event_id div 100")
    return rows.select(
        "event_id",
        F.concat(F.lit("client-"), (F.col("user_id") % 5).cast("string")).alias("client_id"),
        screen.alias("screen_id"),
        F.concat(screen, F.lit("-"), number.cast("string")).alias("batch_id"),
        F.col("ts").alias("event_time"),
        (_k().cast("double") / 99.0).alias("x_norm"),
        ((F.col("event_id") * 37 % 101).cast("double") / 100.0).alias("y_norm"),
        F.when(F.col("event_type").isin("click", "view"), "mousemove").otherwise(F.col("event_type")).alias("event_type"),
        (F.col("ts") + F.make_interval(hours=(F.col("event_id") % 5).cast("int"))).alias("received_at"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from(events(spark, sf_dir))


RAW = """raw AS (
  SELECT event_id,
         'client-' || (user_id % 5) AS client_id,
         'screen-' || (event_id % 3) AS screen_id,
         'screen-' || (event_id % 3) || '-' || (event_id // 100) AS batch_id,
         ts AS event_time,
         CAST(json_extract_string(props, '$.k') AS INTEGER)::DOUBLE / 99.0::DOUBLE AS x_norm,
         (event_id * 37 % 101)::DOUBLE / 100.0::DOUBLE AS y_norm,
         CASE WHEN event_type IN ('click', 'view') THEN 'mousemove' ELSE event_type END AS event_type,
         ts + to_hours(CAST(event_id % 5 AS INTEGER)) AS received_at
  FROM events)"""

TEXT_TIME = "strftime({}, '%Y-%m-%dT%H:%M:%S.%fZ')"

CELLED = """celled AS (
  SELECT *,
         CAST(least(greatest(floor(x_norm * 100), 0), 99) AS INTEGER) AS cell_x,
         CAST(least(greatest(floor(y_norm * 200), 0), 199) AS INTEGER) AS cell_y
  FROM raw WHERE event_type = 'mousemove')"""


def _tier(name: str, source: str, unit: str, time: str, measure: str) -> str:
    return f"""{name} AS (
  SELECT client_id, screen_id, CAST(date_trunc('{unit}', {time}) AS TIMESTAMP) AS bucket_start,
         cell_x, cell_y, CAST({measure} AS BIGINT) AS count
  FROM {source} GROUP BY ALL)"""


HOURLY = ", ".join([RAW, CELLED, _tier("hourly", "celled", "hour", "event_time", "count(*)")])
DAILY = ", ".join([HOURLY, _tier("daily", "hourly", "day", "bucket_start", "sum(count)")])
WEEKLY = ", ".join([DAILY, _tier("weekly", "daily", "week", "bucket_start", "sum(count)")])


def batch_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events as sent in batches: text times, and every 13th batch out of range."""
    rows = raw_events(spark, sf_dir)
    bad = F.expr("event_id div 100 % 13 = 0")
    return rows.withColumn("y_norm", F.when(bad, F.col("y_norm") + 1.5).otherwise(F.col("y_norm")))


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (client, screen, batch); the batch number bounds a batch to 100 events."""
    text = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias(c)
    event = F.struct(text("event_time"), "x_norm", "y_norm", "event_type", text("received_at"))
    return batch_events(spark, sf_dir).groupBy("client_id", "screen_id", "batch_id").agg(
        F.array_sort(F.collect_list(event)).alias("events"), F.max("received_at").alias("received_at")
    )


def replayed(once: DataFrame) -> DataFrame:
    number = F.element_at(F.split("batch_id", "-"), -1).cast("bigint")
    again = once.filter(number % 2 == 0).withColumn("received_at", F.col("received_at") + F.expr("INTERVAL 1 HOUR"))
    return once.unionByName(again)


BATCH_EVENTS = RAW + """, sent AS (
  SELECT * REPLACE (CASE WHEN (event_id // 100) % 13 = 0 THEN y_norm + 1.5::DOUBLE ELSE y_norm END AS y_norm)
  FROM raw), batch AS (
  SELECT client_id, screen_id, batch_id, max(received_at) AS received_at, count(*) AS n,
         CASE WHEN max(y_norm) > 1 THEN 'invalid_normalized_coords' END AS reason
  FROM sent GROUP BY ALL)"""


def listens_from(rows: DataFrame) -> DataFrame:
    provider = F.element_at(
        F.array(F.lit("spotify"), F.lit("apple"), F.lit("youtube")), (F.col("event_id") % 3 + 1).cast("int")
    )
    return rows.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("song-"), (_k() % 20).cast("string")).alias("song_id"),
        provider.alias("provider"),
        F.unix_seconds("ts").alias("listened_at"),
    )


def listens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listens_from(events(spark, sf_dir))


def with_replays(rows: DataFrame) -> DataFrame:
    """Every tenth event twice; one scan of the input."""
    copies = F.when(F.col("event_id").cast("bigint") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("_copy", F.explode(copies)).drop("_copy")


def listens_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_replays(listens(spark, sf_dir))


LISTENS = """listens AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
         'song-' || (CAST(json_extract_string(props, '$.k') AS INTEGER) % 20) AS song_id,
         CASE event_id % 3 WHEN 0 THEN 'spotify' WHEN 1 THEN 'apple' ELSE 'youtube' END AS provider,
         CAST(floor(epoch(ts)) AS BIGINT) AS listened_at, CAST(ts AS DATE) AS day
  FROM events), replayed AS (
  SELECT * FROM listens UNION ALL SELECT * FROM listens WHERE CAST(event_id AS BIGINT) % 10 = 0)"""

DAILY_COUNTS = LISTENS + """, daily_counts AS (
  SELECT user_id, day, song_id, count(*) AS listen_count
  FROM (SELECT DISTINCT day, event_id, user_id, song_id FROM replayed) GROUP BY ALL)"""

MERGED = DAILY_COUNTS + f""", merged AS (
  SELECT user_id, song_id, CAST(sum(listen_count) AS BIGINT) AS listen_count FROM daily_counts
  WHERE day BETWEEN DATE '{EVENTS_AS_OF}' - 6 AND DATE '{EVENTS_AS_OF}' GROUP BY ALL)"""

TOPK = MERGED + """, topk AS (
  SELECT user_id, song_id, listen_count, rank FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY listen_count DESC, song_id) AS INTEGER) AS rank
    FROM merged) WHERE rank <= 10)"""


def follows(spark: SparkSession, sf_dir: str) -> DataFrame:
    followee = ((F.col("user_id") * 7 + 1) % 150).cast("string")
    return (
        table(spark, sf_dir, "events")
        .select(F.col("user_id").cast("string").alias("follower"), followee.alias("followee"))
        .distinct()
    )


FOLLOWS = """follows AS (
  SELECT DISTINCT CAST(user_id AS VARCHAR) AS follower, CAST((user_id * 7 + 1) % 150 AS VARCHAR) AS followee
  FROM events)"""


def status_from(orders: DataFrame) -> DataFrame:
    released = (F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 7 == 3)
    status = F.when(released, "RELEASED").when(F.col("o_orderstatus") == "F", "IDLE").when(F.col("o_orderstatus") == "O", "ENQUEUED").otherwise("RUNNING")
    return orders.select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderpriority").alias("provider"),
        status.alias("status"),
        F.when((F.col("o_orderstatus") == "F") & ~released & (F.col("o_orderkey") % 11 == 0), "publish error").alias("error"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_orderkey").alias("seq"),
    )


def status_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_from(table(spark, sf_dir, "orders"))


STATUS = """status_events AS (
  SELECT CAST(o_custkey AS VARCHAR) AS user_id, o_orderpriority AS provider,
         CASE WHEN o_orderstatus = 'F' AND o_orderkey % 7 = 3 THEN 'RELEASED' WHEN o_orderstatus = 'F' THEN 'IDLE'
           WHEN o_orderstatus = 'O' THEN 'ENQUEUED' ELSE 'RUNNING' END AS status,
         CASE WHEN o_orderstatus = 'F' AND o_orderkey % 7 <> 3 AND o_orderkey % 11 = 0 THEN 'publish error' END AS error,
         o_orderdate AS ts, o_orderkey AS seq
  FROM orders), latest AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, provider ORDER BY ts DESC, seq DESC) AS n FROM status_events
), errors AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, provider ORDER BY ts DESC, seq DESC) AS n
  FROM status_events WHERE status IN ('IDLE', 'RUNNING')
), done AS (
  SELECT user_id, provider, max(ts) AS ts FROM status_events WHERE status = 'IDLE' AND error IS NULL GROUP BY ALL
), born AS (
  SELECT user_id, provider, min(ts) AS ts FROM status_events GROUP BY ALL
), schedule AS (
  SELECT l.user_id, l.provider, CAST(coalesce(d.ts + INTERVAL 24 HOUR, b.ts) AS TIMESTAMP) AS next_crawl_at,
         replace(l.status, 'RELEASED', 'IDLE') AS status, l.ts AS updated_at, b.ts AS created_at, e.error AS last_error
  FROM latest l JOIN born b USING (user_id, provider)
  LEFT JOIN done d USING (user_id, provider)
  LEFT JOIN (SELECT * FROM errors WHERE n = 1) e USING (user_id, provider)
  WHERE l.n = 1)"""


def link_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link upserts over time, with invented token values."""
    stamp = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    key = F.col("o_orderkey").cast("string")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderpriority").alias("provider"),
        (F.col("o_custkey") % 1000).cast("string").alias("provider_user_id"),
        F.concat(F.lit("access-"), key).alias("access_token"),
        F.when(F.col("o_orderkey") % 9 != 0, F.concat(F.lit("refresh-"), key)).alias("refresh_token"),
        stamp.alias("expires_at"),
        F.lit("history").alias("scope"),
        stamp.alias("updated_at"),
        F.col("o_orderkey").alias("seq"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 10 != 0)
    return kept.select(F.col("c_custkey").cast("string").alias("user_id"))


LINKS = """link_versions AS (
  SELECT CAST(o_custkey AS VARCHAR) AS user_id, o_orderpriority AS provider,
         CAST(o_custkey % 1000 AS VARCHAR) AS provider_user_id, 'access-' || o_orderkey AS access_token,
         CASE WHEN o_orderkey % 9 <> 0 THEN 'refresh-' || o_orderkey END AS refresh_token,
         CAST(epoch(o_orderdate) AS BIGINT) AS expires_at, 'history' AS scope,
         CAST(epoch(o_orderdate) AS BIGINT) AS updated_at, o_orderkey AS seq
  FROM orders), links AS (
  SELECT * EXCLUDE (n) FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, provider ORDER BY updated_at DESC, seq DESC) AS n
    FROM link_versions) WHERE n = 1), users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id FROM customer WHERE c_custkey % 10 <> 0)"""
