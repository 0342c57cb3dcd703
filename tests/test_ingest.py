import json

import pytest
from pyspark.sql import functions as F

from gridtally import schemas
from gridtally.functions import parse_rfc3339
from gridtally.operators import ingest, params
from gridtally.sources import event_log

GOOD = ("2026-02-02T10:15:00Z", 0.25, 0.20, "mousemove", None)


def _reasons(spark, batches):
    frame = spark.createDataFrame(batches, schemas.EVENT_BATCH)
    return [r.reason for r in ingest.validate_batch(frame).collect()]


def test_every_reason(spark):
    def event(time=GOOD[0], x=0.5, y=0.5, kind="mousemove"):
        return (time, x, y, kind, None)

    cases = [
        (("acme", "home", "b", [GOOD]), None),
        (("", "home", "b", [GOOD]), "missing_client_id"),
        ((None, "home", "b", [GOOD]), "missing_client_id"),
        (("  \t", "home", "b", [GOOD]), "missing_client_id"),
        (("acme", "  ", "b", [GOOD]), "missing_screen_id"),
        (("  ", "  ", "b", []), "missing_client_id"),
        (("acme", "home", "b", []), "empty_events"),
        (("acme", "home", "b", None), "empty_events"),
        (("acme", "home", "b", [GOOD] * 5000), None),
        (("acme", "home", "b", [GOOD] * 5001), "too_many_events"),
        (("acme", "home", "b", [event(kind=" ")]), "missing_event_type"),
        (("acme", "home", "b", [event(x=-0.01)]), "invalid_normalized_coords"),
        (("acme", "home", "b", [event(y=1.01)]), "invalid_normalized_coords"),
        (("acme", "home", "b", [event(x=None, y=None)]), None),
        (("acme", "home", "b", [event(time=None)]), "invalid_event_time"),
        # first bad event decides, and inside it the first rule
        (("acme", "home", "b", [GOOD, event(time="x"), event(kind="")]), "invalid_event_time"),
        (("acme", "home", "b", [GOOD, event(time="x", x=2.0, kind="")]), "missing_event_type"),
        (("acme", "home", "b", [GOOD, event(time="x", x=2.0)]), "invalid_normalized_coords"),
        # padded ids pass and any non-blank type is admitted
        ((" acme ", "home ", "b", [event(kind="scroll")]), None),
    ]
    assert _reasons(spark, [c[0] for c in cases]) == [c[1] for c in cases]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-02-02T10:15:00Z", "2026-02-02 10:15:00"),
        ("2026-02-02T10:15:00.123456789Z", "2026-02-02 10:15:00.123456"),
        ("2026-02-02T10:15:00.5Z", "2026-02-02 10:15:00.5"),
        ("2026-02-02T10:15:00+05:30", "2026-02-02 04:45:00"),
        ("2026-02-02T23:30:00-01:00", "2026-02-03 00:30:00"),
        ("2024-02-29T00:00:00Z", "2024-02-29 00:00:00"),
        ("2023-02-29T00:00:00Z", None),
        ("2026-02-02", None),
        ("2026-02-02T10:15:00", None),
        ("2026-02-02 10:15:00Z", None),
        ("2026-02-02T10:15Z", None),
        ("2026-02-02T25:15:00Z", None),
        ("2026-13-02T10:15:00Z", None),
        ("2026-02-02T10:15:00Z\n", None),
        ("2026-02-02T10:15:00z", None),
        ("", None),
        (None, None),
    ],
)
def test_rfc3339(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "t string").select(parse_rfc3339(F.col("t")).cast("string").alias("t"))
    assert frame.first().t == expected


def test_routes_and_explode(spark):
    bad = ("2026-02-02T10:15:00Z", 3.0, 0.2, "mousemove", None)
    sparse = ("2026-02-02T10:15:01Z", None, 0.5, "click", "client clock")
    frame = spark.createDataFrame(
        [(" acme ", "home", "b1", [GOOD, sparse]), ("acme", "home", "b2", [GOOD, bad])], schemas.EVENT_BATCH
    )
    accepted, rejected = ingest.route_rejects(ingest.validate_batch(frame))
    assert [r.batch_id for r in rejected.collect()] == ["b2"]
    events = ingest.explode_batches(accepted).collect()
    assert [(e.client_id, e.x_norm, e.received_at) for e in events] == [(" acme ", 0.25, None), (" acme ", 0.0, "client clock")]
    stamped = ingest.enrich_received_at(ingest.explode_batches(accepted), "2026-02-02 11:00:00").collect()
    assert {e.received_at for e in stamped} == {"2026-02-02T11:00:00.000000Z"}
    assert schemas.RAW_EVENT.fieldNames() == ingest.explode_batches(accepted).columns


def test_decode_sets_bad_records_aside(spark):
    good = json.dumps({"event_id": "e1", "user_id": "u", "song_id": "s", "provider": "p", "listened_at": 5, "more": 1})
    records = [("u", good), ("u", "{"), ("u", '{"event_id": "e2", "listened_at": "soon"}'), ("u", '{"event_id": "e3"}'), ("u", None)]
    decoded, broken = ingest.decode_log(spark.createDataFrame(records, schemas.LOG_RECORD), schemas.LISTEN_EVENT)
    assert sorted((r.event_id, r.listened_at) for r in decoded.collect()) == [("e1", 5), ("e3", None)]
    assert broken.count() == 3 and broken.columns == ["key", "value"]


def test_encoding_round_trip(spark):
    events = spark.createDataFrame(
        [("c", "s", None, "2026-02-02T10:15:00Z", 0.1, 0.2, "mousemove", "2026-02-02T10:15:01Z")], schemas.RAW_EVENT
    )
    record = event_log.encode_pointer_events(events).first()
    assert record.key == "c|s" and "batch_id" not in json.loads(record.value)
    back, _ = ingest.decode_log(event_log.encode_pointer_events(events), schemas.RAW_EVENT)
    assert back.collect() == events.collect()


def test_coerce_cells(spark):
    text = spark.createDataFrame(
        [("1", "+2", "3"), ("1.0", "2", "3"), ("x", "2", "3"), ("-4", "0005", "9223372036854775807"),
         ("1", "2", "9223372036854775808"), ("4294967296", "2", "3"), ("1", None, "3"), (" 1", "2", "3"), ("1\n", "2", "3")],
        "cell_x string, cell_y string, count string",
    )
    out = sorted(tuple(r) for r in ingest.coerce_cells(text).collect())
    assert out == [(-4, 5, 9223372036854775807), (1, 2, 3)]
    numbers = spark.createDataFrame([(1.9, 2.0, 3.0), (None, 2.0, 3.0)], "cell_x double, cell_y double, count double")
    assert [tuple(r) for r in ingest.coerce_cells(numbers).collect()] == [(1, 2, 3)]


def test_valid_ids(spark):
    requests = spark.createDataFrame(
        [(" acme ", "home_v1"), ("a b", "home"), ("acme", ""), ("a" * 128, "x.y-z"), ("a" * 129, "x"), (None, "x"), ("é", "x")],
        "client_id string, screen_id string",
    )
    rows = ingest.valid_ids(requests).collect()
    assert [r.error for r in rows] == [
        None, "invalid_client_id", "invalid_screen_id", None, "invalid_client_id", "invalid_client_id", "invalid_client_id"
    ]
    assert rows[0].client_id == "acme"


def test_request_parameters():
    assert [params.bucket_limit(v, "hourly") for v in (None, 0, 501, -1, "abc", "1", 500, " 7 ")] == [24, 24, 24, 24, 24, 1, 500, 7]
    assert params.bucket_limit(None, "daily") == 30 and params.bucket_limit("x", "weekly") == 12
    assert params.window_days(" 5") == 7 and params.top_k("9" * 30) == 10 and params.bucket_limit("9" * 30, "daily") == 30
    assert params.window_days("abc") == 7 and params.window_days(30) == 30 and params.top_k("") == 10
    for call, message in [
        (lambda: params.window_days(0), "days must be 1-30"),
        (lambda: params.window_days("31"), "days must be 1-30"),
        (lambda: params.top_k(101), "k must be 1-100"),
        (lambda: params.hour("24"), "invalid_hour"),
        (lambda: params.hour("x"), "invalid_hour"),
        (lambda: params.day("2024-02-30"), "invalid_dt"),
        (lambda: params.day("2024-1-1"), "invalid_dt"),
        (lambda: params.monday("2024-01-02"), "week_start_not_monday"),
        (lambda: params.safe_id("a'b", "client_id"), "invalid_client_id"),
    ]:
        with pytest.raises(ValueError, match=message):
            call()
    assert params.hour("07") == 7 and params.safe_id(" a.b-c_1 ", "screen_id") == "a.b-c_1"
