"""Pointer heatmaps: admission, grid, tiers, reads on tiers, files and tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridtally import schemas
from gridtally.functions import utc_text
from gridtally.operators import grid, heatmap_queries, ingest, rollups, spacing
from gridtally.operators.dedup import dedup_batches
from gridtally.session import work_path
from gridtally.sources import event_log, raw_files, tables
from workload import views
from workload.registry import query

TIER = "client_id, screen_id, bucket_start, cell_x, cell_y, count"


# --- grid ---------------------------------------------------------------------------------------

@query("normalize_coords", """SELECT event_id,
  CAST(least(greatest((k * 12.5::DOUBLE - 40.0::DOUBLE - 8.0::DOUBLE) / 1000.0::DOUBLE, 0.0), 1.0) AS DOUBLE) AS x_norm,
  CAST(least(greatest((event_id * 37 % 701 - 16.0::DOUBLE) / 640.0::DOUBLE, 0.0), 1.0) AS DOUBLE) AS y_norm
FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER)::DOUBLE AS k FROM events)""")
def _(spark, d):
    k = F.get_json_object("props", "$.k").cast("int").cast("double")
    pixels = views.table(spark, d, "events").select(
        "event_id", (k * 12.5 - 40.0).alias("x_px"), (F.col("event_id") * 37 % 701).alias("y_px")
    )
    return grid.normalize_coords(pixels, 1000, 640, left=8.0, top=16.0).select("event_id", "x_norm", "y_norm")


@query("filter_event_type", f"WITH {views.RAW} SELECT * FROM raw WHERE event_type = 'mousemove'")
def _(spark, d):
    return grid.filter_event_type(views.raw_events(spark, d))


@query("grid_cell", f"""WITH {views.RAW} SELECT event_id,
  CAST(least(greatest(floor(x_norm * 100), 0), 99) AS INTEGER) AS cell_x,
  CAST(least(greatest(floor(y_norm * 200), 0), 199) AS INTEGER) AS cell_y FROM raw""")
def _(spark, d):
    return grid.grid_cell(views.raw_events(spark, d)).select("event_id", "cell_x", "cell_y")


def _bucket_query(unit: str) -> None:
    sql = f"WITH {views.RAW} SELECT event_id, CAST(date_trunc('{unit}', event_time) AS TIMESTAMP) AS bucket_start FROM raw"

    @query(f"assign_{unit}_bucket", sql)
    def _(spark, d):
        return grid.assign_bucket(views.raw_events(spark, d), unit).select("event_id", "bucket_start")


for _unit in ("hour", "day", "week"):
    _bucket_query(_unit)


@query("cells_to_pixels", f"""WITH {views.HOURLY} SELECT {TIER},
  CAST(floor((cell_x + 0.5::DOUBLE) / 100::DOUBLE * 1280::DOUBLE) AS INTEGER) AS x,
  CAST(floor((cell_y + 0.5::DOUBLE) / 200::DOUBLE * 720::DOUBLE) AS INTEGER) AS y FROM hourly""")
def _(spark, d):
    return grid.cells_to_pixels(rollups.heatmap_hourly(views.raw_events(spark, d)), 1280, 720)


@query("intensity_scale", f"""WITH {views.DAILY} SELECT {TIER},
  CAST(greatest(max(count) OVER w, 1) AS BIGINT) AS max_count,
  count::DOUBLE / greatest(max(count) OVER w, 1)::DOUBLE AS intensity
FROM daily WINDOW w AS (PARTITION BY client_id, screen_id, bucket_start)""")
def _(spark, d):
    return grid.intensity_scale(rollups.heatmap_daily(rollups.heatmap_hourly(views.raw_events(spark, d))))


# --- tiers --------------------------------------------------------------------------------------

def _hourly(spark, d):
    return rollups.heatmap_hourly(views.raw_events(spark, d))


def _daily(spark, d):
    return rollups.heatmap_daily(_hourly(spark, d))


def _weekly(spark, d):
    return rollups.heatmap_weekly(_daily(spark, d))


query("heatmap_hourly", f"WITH {views.HOURLY} SELECT {TIER} FROM hourly")(_hourly)
query("heatmap_daily", f"WITH {views.DAILY} SELECT {TIER} FROM daily")(_daily)
query("heatmap_weekly", f"WITH {views.WEEKLY} SELECT {TIER} FROM weekly")(_weekly)


def _twice_loaded(raw, build):
    """A tier with leftover duplicate rows: on-time and late events loaded separately."""
    late = F.col("received_at") >= F.date_trunc("hour", "event_time") + F.expr("INTERVAL 1 HOUR")
    return build(raw.filter(~late)).unionByName(build(raw.filter(late)))


_TIER_BUILDERS = {
    "hourly": rollups.heatmap_hourly,
    "daily": lambda raw: rollups.heatmap_daily(rollups.heatmap_hourly(raw)),
    "weekly": lambda raw: rollups.heatmap_weekly(rollups.heatmap_daily(rollups.heatmap_hourly(raw))),
}
_TIER_SQL = {"hourly": views.HOURLY, "daily": views.DAILY, "weekly": views.WEEKLY}
_TIER_UNIT = {"hourly": "hour", "daily": "day", "weekly": "week"}
_TIER_LIMIT = {"hourly": 24, "daily": 30, "weekly": 12}


def _read_queries(tier: str) -> None:
    cells = f"WITH {_TIER_SQL[tier]} SELECT {TIER} FROM {tier}"

    @query(f"query_heatmap_{tier}", cells)
    def _(spark, d):
        """Cells of every screen and bucket, and of buckets that are empty, from a stored tier that was loaded
        in two inserts."""
        raw = views.raw_events(spark, d)
        stored = work_path(spark, f"{tier}-tier")
        tables.write_tier(_twice_loaded(raw, _TIER_BUILDERS[tier]), stored, tier)
        known = grid.assign_bucket(grid.filter_event_type(raw), _TIER_UNIT[tier]).select("client_id", "screen_id", "bucket_start")
        empty = known.withColumn("bucket_start", F.col("bucket_start") + F.expr("INTERVAL 1000 DAYS"))
        return heatmap_queries.cells_for(tables.read_tier(spark, stored, tier), known.unionByName(empty))

    newest = f"""WITH {_TIER_SQL[tier]} SELECT client_id, screen_id, bucket_start, events FROM (
      SELECT *, row_number() OVER (PARTITION BY client_id, screen_id ORDER BY bucket_start DESC) AS n FROM (
        SELECT client_id, screen_id, bucket_start, CAST(sum(count) AS BIGINT) AS events FROM {tier} GROUP BY ALL))
      WHERE n <= {_TIER_LIMIT[tier]}"""

    @query(f"recent_buckets_{tier}", newest)
    def _(spark, d):
        return heatmap_queries.recent_buckets(_TIER_BUILDERS[tier](views.raw_events(spark, d)), tier)


for _tier in ("hourly", "daily", "weekly"):
    _read_queries(_tier)


@query("heatmap_payload", f"""WITH {views.DAILY} SELECT client_id, screen_id, bucket_start,
  '{{"grid_w":100,"grid_h":200,"client_id":"' || client_id || '","screen_id":"' || screen_id
  || '","bucket_start":"' || strftime(bucket_start, '%Y-%m-%d %H:%M:%S') || '","cells":['
  || string_agg('{{"cell_x":' || cell_x || ',"cell_y":' || cell_y || ',"count":' || count || '}}', ',' ORDER BY cell_x, cell_y)
  || ']}}' AS body
FROM daily GROUP BY client_id, screen_id, bucket_start""")
def _(spark, d):
    payload = heatmap_queries.heatmap_payload(_daily(spark, d))
    return heatmap_queries.as_json(payload).select("client_id", "screen_id", "bucket_start", "body")


@query("rollup_compaction", f"""WITH {views.WEEKLY}, n AS (
  SELECT (SELECT count(*) FROM hourly) AS h, (SELECT count(*) FROM daily) AS d, (SELECT count(*) FROM weekly) AS w)
SELECT 'hourly' AS tier, h AS rows, CAST(NULL AS DOUBLE) AS shrink FROM n
UNION ALL SELECT 'daily', d, h::DOUBLE / d::DOUBLE FROM n
UNION ALL SELECT 'weekly', w, d::DOUBLE / w::DOUBLE FROM n""")
def _(spark, d):
    return rollups.rollup_compaction(_hourly(spark, d))


@query("expire_rows", f"""WITH {views.WEEKLY}
SELECT 'hourly' AS tier, {TIER} FROM hourly WHERE bucket_start > TIMESTAMP '2024-04-15 00:00:00' - INTERVAL 90 DAY
UNION ALL SELECT 'daily', {TIER} FROM daily WHERE bucket_start > TIMESTAMP '2026-01-15 00:00:00' - INTERVAL 730 DAY
UNION ALL SELECT 'weekly', {TIER} FROM weekly WHERE bucket_start > TIMESTAMP '2029-01-13 00:00:00' - INTERVAL 1825 DAY""")
def _(spark, d):
    """Every tier at a time when half of its rows have reached their age limit."""
    moments = {"hourly": "2024-04-15 00:00:00", "daily": "2026-01-15 00:00:00", "weekly": "2029-01-13 00:00:00"}
    parts = [
        rollups.expire_rows(build(views.raw_events(spark, d)), "bucket_start", moments[tier], rollups.RETENTION_DAYS[tier])
        .withColumn("tier", F.lit(tier))
        for tier, build in _TIER_BUILDERS.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_RUN = ("2024-01-15 06:00:00", "2024-01-15 12:00:00")


@query("reprocess_late", f"""WITH {views.WEEKLY}, late AS (
  SELECT DISTINCT date_trunc('hour', event_time) AS h FROM raw
  WHERE event_type = 'mousemove' AND received_at >= TIMESTAMP '{_RUN[0]}' AND received_at < TIMESTAMP '{_RUN[1]}'
    AND received_at >= date_trunc('hour', event_time) + INTERVAL 1 HOUR)
SELECT 'hourly' AS tier, {TIER} FROM hourly WHERE bucket_start IN (SELECT h FROM late)
UNION ALL SELECT 'daily', {TIER} FROM daily WHERE bucket_start IN (SELECT date_trunc('day', h) FROM late)
UNION ALL SELECT 'weekly', {TIER} FROM weekly WHERE bucket_start IN (SELECT date_trunc('week', h) FROM late)""")
def _(spark, d):
    """Repair of a tier that so far only holds the events that were on time."""
    raw = views.raw_events(spark, d)
    low, high = (F.lit(t).cast("timestamp") for t in _RUN)
    in_run = (F.col("received_at") >= low) & (F.col("received_at") < high)
    late = in_run & (F.col("received_at") >= F.date_trunc("hour", "event_time") + F.expr("INTERVAL 1 HOUR"))
    stale = rollups.heatmap_hourly(raw.filter(~late))
    fixed = rollups.reprocess_late(raw, stale, *_RUN)
    tagged = [rows.withColumn("tier", F.lit(tier)) for tier, rows in fixed.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


@query("backfill_range", f"WITH {views.HOURLY} SELECT {TIER} FROM hourly WHERE bucket_start >= TIMESTAMP '2024-01-08' AND bucket_start < TIMESTAMP '2024-01-22'")
def _(spark, d):
    return rollups.backfill_range(views.raw_events(spark, d), "2024-01-08", "2024-01-22")


# --- admission ----------------------------------------------------------------------------------

@query("explode_batches", f"""WITH {views.BATCH_EVENTS} SELECT s.client_id, s.screen_id, s.batch_id,
  {views.TEXT_TIME.format('s.event_time')} AS event_time, s.x_norm, s.y_norm, s.event_type, b.received_at
FROM sent s JOIN batch b USING (client_id, screen_id, batch_id)""")
def _(spark, d):
    return ingest.explode_batches(views.batches(spark, d))


@query("enrich_received_at", f"""WITH {views.RAW} SELECT * REPLACE (TIMESTAMP '2024-02-01 12:00:00' AS received_at) FROM raw""")
def _(spark, d):
    return ingest.enrich_received_at(views.raw_events(spark, d), "2024-02-01 12:00:00")


@query("validate_batch", f"WITH {views.BATCH_EVENTS} SELECT client_id, screen_id, batch_id, n, reason FROM batch")
def _(spark, d):
    checked = ingest.validate_batch(views.batches(spark, d))
    return checked.select("client_id", "screen_id", "batch_id", F.size("events").cast("bigint").alias("n"), "reason")


@query("route_rejects", f"""WITH {views.BATCH_EVENTS}
SELECT CASE WHEN reason IS NULL THEN 'accepted' ELSE 'quarantine' END AS route, client_id, screen_id, batch_id, reason FROM batch""")
def _(spark, d):
    accepted, rejected = ingest.route_rejects(ingest.validate_batch(views.batches(spark, d)))
    names = ["route", "client_id", "screen_id", "batch_id", "reason"]
    good = accepted.withColumns({"route": F.lit("accepted"), "reason": F.lit(None).cast("string")})
    return good.select(names).unionByName(rejected.withColumn("route", F.lit("quarantine")).select(names))


@query("dedup_batches", f"""WITH {views.BATCH_EVENTS} SELECT client_id, screen_id, batch_id, received_at, n FROM batch""")
def _(spark, d):
    once = views.batches(spark, d).select(
        "client_id", "screen_id", "batch_id", "received_at", F.size("events").cast("bigint").alias("n")
    )
    return dedup_batches(views.replayed(once), tie=("screen_id",))


# Records that hold no event; an empty object does, with nothing set.
_NOT_OBJECTS = [("blank", ""), ("blank", "   "), ("null", "null"), ("array", "[]"), ("number", "17"), ("text", '"x"')]
_LOG = f"""{views.LISTENS}, log AS (
  SELECT *, CAST(event_id AS BIGINT) % 17 = 0 AS broken FROM listens)"""


def _log_records(spark, d):
    """Keyed JSON records of which every 17th lost its end."""
    broken = F.get_json_object("value", "$.event_id").cast("bigint") % 17 == 0
    cut = F.expr("substring(value, 1, length(value) - 5)")
    log = event_log.encode_listens(views.listens(spark, d)).withColumn("value", F.when(broken, cut).otherwise(F.col("value")))
    return log.unionByName(spark.createDataFrame([*_NOT_OBJECTS, ("empty", "{}")], schemas.LOG_RECORD))


@query("decode_or_skip", f"""WITH {_LOG} SELECT event_id, user_id, song_id, provider, listened_at FROM log WHERE NOT broken
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL""")
def _(spark, d):
    return ingest.decode_log(_log_records(spark, d), schemas.LISTEN_EVENT)[0]


@query("decode_quarantine", f"""WITH {_LOG} SELECT user_id AS key, left(value, length(value) - 5) AS value FROM (
  SELECT user_id, '{{"event_id":"' || event_id || '","user_id":"' || user_id || '","song_id":"' || song_id
    || '","provider":"' || provider || '","listened_at":' || listened_at || '}}' AS value FROM log WHERE broken)
UNION ALL VALUES {", ".join(f"('{k}', '{v}')" for k, v in _NOT_OBJECTS)}""")
def _(spark, d):
    return ingest.decode_log(_log_records(spark, d), schemas.LISTEN_EVENT)[1]


@query("coerce_cells", f"""WITH {views.HOURLY} SELECT client_id, screen_id, bucket_start, cell_x, cell_y, count
FROM hourly WHERE (cell_x + cell_y) % 7 NOT IN (0, 1)""")
def _(spark, d):
    """Cells that came back as text, some of it not a whole number."""
    marker = (F.col("cell_x") + F.col("cell_y")) % 7
    text = _hourly(spark, d).withColumns(
        {
            "cell_x": F.when(marker == 0, "n/a").otherwise(F.col("cell_x").cast("string")),
            "cell_y": F.concat(F.lit("+"), F.col("cell_y").cast("string")),
            "count": F.when(marker == 1, "1.5").otherwise(F.col("count").cast("string")),
        }
    )
    return ingest.coerce_cells(text)


@query("valid_ids", r"""SELECT c_custkey, c_mktsegment AS client_id, c_name AS screen_id,
  CASE WHEN NOT regexp_full_match(c_mktsegment, '[a-zA-Z0-9_.\-]{1,128}') THEN 'invalid_client_id'
       WHEN NOT regexp_full_match(c_name, '[a-zA-Z0-9_.\-]{1,128}') THEN 'invalid_screen_id' END AS error FROM customer
UNION ALL SELECT page_id, regexp_replace(url, '^.*/', ''), 'page-' || page_id,
  CASE WHEN NOT regexp_full_match(regexp_replace(url, '^.*/', ''), '[a-zA-Z0-9_.\-]{1,128}') THEN 'invalid_client_id' END FROM pages""")
def _(spark, d):
    """Requests with padded ids: market segments, customer names, last parts of page addresses."""
    names = views.table(spark, d, "customer").select(
        "c_custkey", F.concat(F.lit("  "), "c_mktsegment", F.lit("\t")).alias("client_id"), F.col("c_name").alias("screen_id")
    )
    pages = views.table(spark, d, "pages").select(
        F.col("page_id").alias("c_custkey"),
        F.regexp_replace("url", "^.*/", "").alias("client_id"),
        F.concat(F.lit("page-"), F.col("page_id").cast("string"), F.lit(" ")).alias("screen_id"),
    )
    return ingest.valid_ids(names.unionByName(pages))


def _spaced_sql(step: str, time: str = "event_time") -> str:
    return f"""WITH RECURSIVE {views.RAW}, timed AS (
  SELECT client_id, screen_id, event_id, {time} AS event_time FROM raw), walk AS (
  SELECT client_id, screen_id, min(struct_pack(t := event_time, id := event_id)) AS pos FROM timed GROUP BY ALL
  UNION ALL
  SELECT client_id, screen_id, pos FROM (
    SELECT w.client_id, w.screen_id, min(struct_pack(t := r.event_time, id := r.event_id)) AS pos
    FROM walk w JOIN timed r ON r.client_id = w.client_id AND r.screen_id = w.screen_id
      AND r.event_time >= w.pos.t + INTERVAL {step}
    GROUP BY w.client_id, w.screen_id))
SELECT client_id, screen_id, pos.t AS event_time, pos.id AS event_id FROM walk"""


_FAST = "CAST(make_timestamp(epoch_us(event_time) // 3600) AS TIMESTAMP)"


@query("thin_events", _spaced_sql("1 SECOND", _FAST))
def _(spark, d):
    """At most one event per second and screen, with the month played 3600 times as fast, so that
    events come as close together as pointer moves do."""
    fast = F.timestamp_micros(F.expr("unix_micros(event_time) div 3600")).alias("event_time")
    raw = views.raw_events(spark, d).select("client_id", "screen_id", fast, "event_id")
    return spacing.thin_events(raw, rate=1, order=("event_id",))


@query("thin_events_hourly", _spaced_sql("1 HOUR"))
def _(spark, d):
    """The same rule with an hour between kept events, so that most rows are dropped."""
    raw = views.raw_events(spark, d).select("client_id", "screen_id", "event_time", "event_id")
    return spacing.keep_spaced(raw, ["client_id", "screen_id"], "event_time", 3_600_000_000, ["event_id"], 86_400_000_000)


# --- files, logs and tables ---------------------------------------------------------------------

_LANDED = f"""WITH {views.RAW} SELECT client_id, screen_id, batch_id,
  {views.TEXT_TIME.format('event_time')} AS event_time, x_norm, y_norm, event_type,
  {views.TEXT_TIME.format('received_at')} AS received_at,
  CAST(event_time AS DATE) AS dt, CAST(hour(event_time) AS INTEGER) AS hour FROM raw"""


def _raw_text(spark, d):
    raw = views.raw_events(spark, d)
    return raw.withColumns({c: utc_text(F.col(c)) for c in ("event_time", "received_at")}).drop("event_id")


def _landed(spark, d, file_format):
    base = raw_files.raw_base(work_path(spark, "landing"), file_format)
    raw_files.land_batch(_raw_text(spark, d), base, file_format)
    return base


@query("read_raw_json", _LANDED)
def _(spark, d):
    return raw_files.read_raw_json(spark, _landed(spark, d, "json"))


@query("read_raw_parquet", _LANDED)
def _(spark, d):
    return raw_files.read_raw_parquet(spark, _landed(spark, d, "parquet"))


@query("read_bucket_partition", f"""{_LANDED} WHERE event_time >= TIMESTAMP '2024-01-08' AND event_time < TIMESTAMP '2024-01-22'
  OR event_time >= TIMESTAMP '2024-01-25 07:00:00' AND event_time < TIMESTAMP '2024-01-25 08:00:00'""")
def _(spark, d):
    """Two weeks of hour folders, and one hour of a later day, out of the whole landing area."""
    base = _landed(spark, d, "parquet")
    weeks = raw_files.read_bucket_range(spark, base, "2024-01-08", "2024-01-21", "parquet")
    return weeks.unionByName(raw_files.read_bucket_partition(spark, base, "2024-01-25", "07", "parquet"))


@query("replace_bucket", f"""WITH {views.DAILY} SELECT {TIER} FROM daily
WHERE bucket_start < TIMESTAMP '2024-01-25' OR cell_x >= 50""")
def _(spark, d):
    """A daily table loaded with wrong counts and one day too many, then rewritten day by day: the
    last six days keep only the right half of the grid, and the surplus day ends up empty."""
    path = work_path(spark, "daily-table")
    daily = _daily(spark, d)
    surplus = daily.filter("bucket_start = '2024-01-30'").withColumn("bucket_start", F.expr("TIMESTAMP '2024-01-31'"))
    wrong = daily.withColumn("count", F.col("count") + 1).unionByName(surplus)
    tables.write_tier(wrong, path, "daily")
    days = [f"2024-01-{n:02d} 00:00:00" for n in range(1, 32)]
    right = daily.filter("bucket_start < '2024-01-25' OR cell_x >= 50")
    tables.replace_buckets(right, path, "daily", days)
    return tables.read_tier(spark, path, "daily").select(*rollups.KEYS, "count")


@query("encode_log_records", f"""WITH {views.RAW} SELECT client_id || '|' || screen_id AS key,
  '{{"client_id":"' || client_id || '","screen_id":"' || screen_id || '","batch_id":"' || batch_id
  || '","event_time":"' || {views.TEXT_TIME.format('event_time')} || '","x_norm":' || CAST(x_norm AS VARCHAR)
  || ',"y_norm":' || CAST(y_norm AS VARCHAR) || ',"event_type":"' || event_type
  || '","received_at":"' || {views.TEXT_TIME.format('received_at')} || '"}}' AS value FROM raw""")
def _(spark, d):
    return event_log.encode_pointer_events(_raw_text(spark, d))


@query("encode_listen_records", f"""WITH {views.LISTENS} SELECT user_id AS key,
  '{{"event_id":"' || event_id || '","user_id":"' || user_id || '","song_id":"' || song_id
  || '","provider":"' || provider || '","listened_at":' || listened_at || '}}' AS value FROM listens""")
def _(spark, d):
    return event_log.encode_listens(views.listens(spark, d))
