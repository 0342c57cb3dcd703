from datetime import datetime, timedelta

from gridtally import schemas
from gridtally.operators import keyed

NOW = datetime(2024, 1, 10)


def _events(spark, rows):
    return spark.createDataFrame(
        [("u", "p", s, e, NOW + timedelta(hours=h), i) for i, (h, s, e) in enumerate(rows)], schemas.STATUS_EVENT
    )


def _state(df):
    row = df.first()
    return row.status, row.next_crawl_at, row.last_error


def test_status_folding(spark):
    cycle = [(0, "IDLE", None), (1, "ENQUEUED", None), (2, "RUNNING", None)]
    start = _events(spark, cycle)
    assert _state(keyed.apply_status_events(start)) == ("RUNNING", NOW + timedelta(hours=24), None)
    failed = _events(spark, cycle + [(3, "IDLE", "publish error: x")])
    assert _state(keyed.apply_status_events(failed)) == ("IDLE", NOW + timedelta(hours=24), "publish error: x")
    again = _events(spark, cycle + [(3, "IDLE", "publish error: x"), (4, "ENQUEUED", None)])
    assert _state(keyed.apply_status_events(again))[2] == "publish error: x"
    running = _events(spark, cycle + [(3, "IDLE", "publish error: x"), (4, "ENQUEUED", None), (5, "RUNNING", None)])
    assert _state(keyed.apply_status_events(running))[2] is None
    done = _events(spark, cycle + [(6, "IDLE", None)])
    assert _state(keyed.apply_status_events(done)) == ("IDLE", NOW + timedelta(hours=30), None)
    never = _events(spark, [(0, "ENQUEUED", None), (0, "IDLE", "boom")])
    assert _state(keyed.apply_status_events(never)) == ("IDLE", NOW, "boom")


def test_folding_in_pieces_is_folding_at_once(spark):
    rows = _events(spark, [(h % 7, s, e) for h, (s, e) in enumerate(
        [("IDLE", None), ("ENQUEUED", None), ("RUNNING", None), ("IDLE", "err")] * 6
    )])
    pieces = [keyed.fold_status_events(rows.filter(f"seq % 3 = {n}")) for n in range(3)]
    merged = keyed.merge_status(pieces[0].unionByName(pieces[1]).unionByName(pieces[2]).unionByName(pieces[0]))
    assert keyed.schedule_rows(merged).collect() == keyed.apply_status_events(rows).collect()


def _schedule(spark):
    rows = [
        ("user-001", "spotify", NOW, "IDLE", NOW), ("user-001", "youtube", NOW, "IDLE", NOW),
        ("user-002", "spotify", NOW, "IDLE", NOW), ("user-003", "spotify", NOW + timedelta(days=1), "IDLE", NOW),
        ("user-004", "spotify", NOW, "ENQUEUED", NOW - timedelta(minutes=11)),
        ("user-005", "spotify", NOW, "ENQUEUED", NOW - timedelta(minutes=10)),
    ]
    return spark.createDataFrame(rows, "user_id string, provider string, next_crawl_at timestamp, status string, updated_at timestamp")


def test_due_stuck_and_claims(spark):
    schedule = _schedule(spark)
    due = keyed.due_work(schedule, NOW)
    assert [(r.user_id, r.provider) for r in due.collect()] == [("user-001", "spotify"), ("user-001", "youtube"), ("user-002", "spotify")]
    assert keyed.due_work(schedule, NOW, 2).count() == 2
    later = NOW + timedelta(minutes=30)
    claimed = keyed.claim_rows(schedule, due, later).collect()
    assert {(r.status, r.updated_at) for r in claimed} == {("ENQUEUED", later)} and len(claimed) == 3
    stuck = keyed.stuck_work(schedule, NOW, minutes=10)
    assert [r.user_id for r in stuck.collect()] == ["user-004"]
    assert keyed.claim_rows(schedule, stuck, NOW).first().updated_at == NOW


def test_a_claim_is_seen_by_the_next_round_and_can_be_released(spark):
    begun = _events(spark, [(0, "IDLE", "boom")])
    at = NOW + timedelta(hours=1)
    schedule = keyed.apply_status_events(begun)
    claim = keyed.claim_events(keyed.claim_rows(schedule, keyed.due_work(schedule, at), at), seq=1)
    assert claim.columns == begun.columns or set(claim.columns) == set(begun.columns)
    queued = begun.unionByName(claim)
    after = keyed.apply_status_events(queued)
    assert keyed.due_work(after, at).isEmpty()
    assert keyed.stuck_work(after, at + timedelta(minutes=5), minutes=10).isEmpty()
    released = queued.unionByName(spark.createDataFrame([("u", "p", keyed.RELEASED, None, at, 2)], schemas.STATUS_EVENT))
    assert _state(keyed.apply_status_events(released)) == ("IDLE", NOW, "boom")
    assert keyed.due_work(keyed.apply_status_events(released), at).count() == 1


def test_links(spark):
    links = spark.createDataFrame(
        [
            ("u1", "spotify", "acc1", "t", "r", 1000, "s", 1), ("u2", "spotify", "acc1", "t", "r", 1060, "s", 1),
            ("u2", "apple", "acc1", "t", None, 9999, "s", 1), ("u3", "apple", "acc2", "t", "r", None, "s", 1),
            ("u1", "apple", "acc9", "t", "r", 1061, "s", 1),
        ],
        "user_id string, provider string, provider_user_id string, access_token string, refresh_token string, expires_at long, scope string, updated_at long",
    )
    users = spark.createDataFrame([("u1",), ("u2",)], "user_id string")
    assert [(r.provider, r.owners) for r in keyed.duplicate_link_owners(links).collect()] == [("spotify", 2)]
    assert [r.user_id for r in keyed.orphan_links(links, users).collect()] == ["u3"]
    actions = {(r.user_id, r.provider): r.action for r in keyed.links_to_refresh(links, 1000).collect()}
    assert actions == {
        ("u1", "spotify"): "refresh", ("u2", "spotify"): "refresh",
        ("u2", "apple"): "missing_refresh_token", ("u3", "apple"): "missing_refresh_token",
    }
    shown = keyed.user_links(links, "u1")
    assert [r.provider for r in shown.collect()] == ["apple", "spotify"] and "access_token" not in shown.columns


def test_newest_version_wins_whole(spark):
    rows = spark.createDataFrame(
        [("u", "p", 1, 1, "a"), ("u", "p", 2, 1, None), ("u", "p", 2, 0, "c"), ("v", "p", 1, 1, "d")],
        "user_id string, provider string, updated_at long, seq long, scope string",
    )
    out = {r.user_id: r.scope for r in keyed.latest_row_per_key(rows, ["user_id", "provider"], ["updated_at", "seq"]).collect()}
    assert out == {"u": None, "v": "d"}
