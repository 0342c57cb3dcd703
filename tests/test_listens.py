import math
import random
from collections import Counter, defaultdict
from datetime import date, timedelta

import pytest

from gridtally.operators import bloom, checks, grid, listens, sketches

SCHEMA = "event_id string, user_id string, song_id string, provider string, listened_at long"
DAY = 86400
T0 = 1704067200  # 2024-01-01


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_event_ids_count_once_per_day(spark):
    rows = [
        ("e1", "u", "s1", "spotify", T0), ("e1", "u", "s1", "spotify", T0),
        ("e1", "u", "s1", "spotify", T0 + DAY),
        ("e2", "u", "s1", "apple", T0 + 5), ("e3", "u", "s2", "apple", T0 + 5),
    ]
    counts = {(r.user_id, str(r.day), r.song_id): r.listen_count for r in listens.daily_song_counts(_frame(spark, rows)).collect()}
    assert counts == {("u", "2024-01-01", "s1"): 2, ("u", "2024-01-02", "s1"): 1, ("u", "2024-01-01", "s2"): 1}
    stats = {str(r.day): (r.seen, r.accepted, r.duplicates) for r in listens.dedup_stats(_frame(spark, rows)).collect()}
    assert stats == {"2024-01-01": (4, 3, 1), "2024-01-02": (1, 1, 0)}


def test_differing_copies_are_settled_the_same_way_every_time(spark):
    rows = [("e", "u", f"s{i}", "p", T0 + (i * 7) % 5) for i in range(5)]
    for parts in (1, 3, 5):
        kept = listens.dedup_events(_frame(spark, rows).repartition(parts)).collect()
        assert [(r.song_id, r.listened_at) for r in kept] == [("s0", T0)]


def test_a_crawl_counts_again_under_new_ids(spark):
    crawl = lambda run: [(f"u-p-{run}-{i}", "u", f"song-{i % 100}", "p", T0 + i * 3600) for i in range(10)]
    counts = listens.daily_song_counts(_frame(spark, crawl(1) + crawl(1) + crawl(2)))
    assert {r.listen_count for r in counts.collect()} == {2} and counts.count() == 10


def _daily(spark, rows):
    return spark.createDataFrame(rows, "user_id string, day date, song_id string, listen_count long")


def test_window_edges_and_ties(spark):
    last = date(2024, 1, 30)
    rows = [
        ("u", last, "b", 2), ("u", last - timedelta(days=6), "a", 2), ("u", last - timedelta(days=7), "old", 99),
        ("u", last + timedelta(days=1), "new", 99), ("u", last, "c", 5), ("v", last, "z", 1),
    ]
    ranked = [(r.user_id, r.song_id, r.listen_count, r.rank) for r in listens.user_topk(_daily(spark, rows), last, 7, 2).collect()]
    assert sorted(ranked) == [("u", "a", 2, 2), ("u", "c", 5, 1), ("v", "z", 1, 1)]
    everything = listens.user_topk(_daily(spark, rows), "2024-01-30", "seven", 100).filter("user_id = 'u'")
    assert [(r.song_id, r.rank) for r in everything.orderBy("rank").collect()] == [("c", 1), ("a", 2), ("b", 3)]


def test_smaller_k_is_a_prefix(spark):
    rng = random.Random(3)
    rows = [(f"u{rng.randrange(5)}", date(2024, 1, 30), f"s{i}", rng.randrange(4)) for i in range(200)]
    three, four = (
        {(r.user_id, r.song_id, r.rank) for r in listens.user_topk(_daily(spark, rows), "2024-01-30", 7, k).collect()}
        for k in (3, 4)
    )
    assert three == {r for r in four if r[2] <= 3}


def test_payload_keeps_users_without_rows(spark):
    topk = listens.user_topk(_daily(spark, [("u", date(2024, 1, 30), "s", 3)]), "2024-01-30")
    asked = spark.createDataFrame([("u",), ("nobody",), ("u",)], "user_id string")
    rows = {r.user_id: r for r in listens.topk_payload(topk, asked).collect()}
    assert set(rows) == {"u", "nobody"} and rows["nobody"].results == [] and not rows["u"].cached
    assert [tuple(e) for e in rows["u"].results] == [("s", 3, 1)] and (rows["u"].days, rows["u"].k) == (7, 10)


def test_followed_rankings_whatever_the_shares(spark):
    topk = spark.createDataFrame([("x", "s1", 5, 1), ("x", "s2", 3, 2), ("y", "s1", 1, 1)], "user_id string, song_id string, listen_count long, rank int")
    follows = spark.createDataFrame([(f"f{i}", "x") for i in range(50)] + [("f1", "y"), ("f2", "gone")], "follower string, followee string")
    for shares in (1, 7, 256):
        out = listens.topk_of_followed(follows, topk, shares).collect()
        assert len(out) == 101 and {r.song_id for r in out if r.follower == "f1"} == {"s1", "s2"}


def test_deltas_preaggregation_and_raw_counts(spark):
    rows = [(f"e{i}", "u", f"s{i % 3}", "p", T0 + i) for i in range(10)]
    frame = _frame(spark, rows)
    whole = {(r.song_id, r.listen_count) for r in listens.daily_song_counts(frame).collect()}
    assert {(r.song_id, r.listen_count) for r in listens.sum_deltas(listens.flush_deltas(frame, "listened_at")).collect()} == whole
    ratio = listens.reduction_ratio(listens.preaggregate_events(frame)).first()
    assert (ratio.messages_before, ratio.messages_after, ratio.reduction) == (10, 3, 1 - 3 / 10)
    history = listens.history_rows(frame)
    assert [(r.song_id, r.listen_count) for r in listens.raw_song_counts(history, 2, "u").collect()] == [("s0", 4), ("s1", 3)]
    newest = [r.event_id for r in listens.history_newest_first(history).collect()]
    assert newest == [f"e{i}" for i in reversed(range(10))]


def test_sketches_merge_across_days(spark):
    rows = [(f"e{i}", "u", "s", "p", T0 + (i % 8) * DAY) for i in range(4000)]
    rows += [(f"e{i}", "u", "s", "p", T0 + ((i + 1) % 8) * DAY) for i in range(500)]
    days = grid.listen_day(_frame(spark, rows))
    merged = sketches.approx_item_counts(sketches.daily_sketches(days, ["user_id", "song_id"]), ["user_id", "song_id"])
    assert abs(merged.first().approx_count - 4000) < 4000 * 0.05
    once = sketches.approx_item_counts_once(days, ["song_id"])
    assert abs(once.first().approx_count - 4000) < 4000 * 0.06


def test_bloom_never_overcounts_and_rarely_undercounts(spark):
    old = [(f"old{i}", "u", "s", "p", T0 + i % 3 * DAY) for i in range(3000)]
    new = [(f"new{i}", "u", "s", "p", T0 + i % 3 * DAY) for i in range(3000)]
    filters = bloom.check_load(bloom.build_filter(grid.listen_day(_frame(spark, old)), 1000), 1000)
    kept = [(r.event_id, str(r.day)) for r in bloom.bloom_skip(_frame(spark, old + new + new), filters, 1000).collect()]
    assert len(kept) == len(set(kept)) and not [k for k in kept if k[0].startswith("old")]
    assert 2970 <= len(kept) <= 3000
    # the same id on another day is another event
    moved = [(f"old{i}", "u", "s", "p", T0 + 9 * DAY) for i in range(100)]
    assert bloom.bloom_skip(_frame(spark, moved), filters, 1000).count() == 100


def test_bloom_error_rate_at_capacity(spark):
    ids = spark.range(200_000).selectExpr("'2024-01-01' AS d", "cast(id AS string) AS event_id").selectExpr("cast(d AS date) AS day", "event_id")
    filters = bloom.build_filter(ids.filter("cast(event_id AS long) < 100000"), 100_000)
    probes = ids.filter("cast(event_id AS long) >= 100000").selectExpr(
        "event_id", "'u' AS user_id", "'s' AS song_id", "'p' AS provider", f"{T0}L AS listened_at"
    )
    false_hits = 100_000 - bloom.bloom_skip(probes, filters, 100_000).count()
    assert false_hits <= 100_000 * bloom.ERROR_RATE * 1.5


def test_full_bloom_filter_fails_loudly(spark):
    import pytest

    days = grid.listen_day(_frame(spark, [(f"e{i}", "u", "s", "p", T0) for i in range(20)]))
    with pytest.raises(Exception, match="over capacity"):
        bloom.check_load(bloom.build_filter(days, 10), 10).collect()


def test_merged_filters_equal_one_filter(spark):
    days = grid.listen_day(_frame(spark, [(f"e{i}", "u", "s", "p", T0) for i in range(500)]))
    parts = [bloom.build_filter(days.filter(f"cast(substring(event_id, 2) AS int) % 2 = {n}"), 100) for n in (0, 1)]
    key = lambda df: sorted(tuple(r) for r in df.select("day", "block", *bloom.WORDS, "ids").collect())
    assert key(bloom.merge_filters(*parts)) == key(bloom.build_filter(days, 100))


def test_exact_percentiles(spark):
    rng = random.Random(11)
    data = [("heavy", float(rng.randrange(100_000)) / 8) for _ in range(30_000)]
    data += [("same", 5.0)] * 1000 + [("one", 7.5)] + [("few", float(v)) for v in (1, 2, 3)] + [(None, 1.0), ("few", None)]
    data += [("spike", 1.0)] * 940 + [("spike", float(v)) for v in range(2, 62)]
    frame = spark.createDataFrame(data, "g string, v double").repartition(8)
    groups = defaultdict(list)
    for g, v in data:
        if v is not None:
            groups[g].append(v)
    for accuracy in (100, 10_000):
        out = {r.g: (r.n, r.p50, r.p95, r.p99) for r in checks.exact_percentiles(frame, "g", "v", accuracy=accuracy).collect()}
        for g, values in groups.items():
            values.sort()
            ranks = [values[max(-(-len(values) * p // 100), 1) - 1] for p in (50, 95, 99)]
            assert out[g] == (len(values), *ranks), g


@pytest.mark.parametrize("bins", [2, 64])
def test_exact_percentiles_of_groups_too_large_to_rank(spark, monkeypatch, bins):
    """Brackets are narrowed, over several passes, until few rows are left in each: many values, one, two, nulls."""
    monkeypatch.setattr(checks, "RANKED_ROWS", 40)
    monkeypatch.setattr(checks, "BINS", bins)
    rng = random.Random(bins)
    values = {"a": [rng.lognormvariate(0, 3) for _ in range(3000)], "b": [7.5] * 500, "c": [1.0] * 400 + [1e12] * 300, "d": [-3.0, 0.0, None, 2.0], None: [float(k % 97) for k in range(800)]}
    frame = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs], "g string, v double")
    out = {r.g: (r.n, r.p50, r.p95, r.p99) for r in checks.exact_percentiles(frame, "g", "v", accuracy=100).collect()}
    for g, vs in values.items():
        known = sorted(v for v in vs if v is not None)
        at = lambda p: known[max(math.ceil(p * len(known)), 1) - 1]
        assert out[g] == (len(known), at(0.5), at(0.95), at(0.99))


def test_percentile_sketch_is_close(spark):
    frame = spark.range(10_000).selectExpr("'g' AS g", "cast(id AS double) AS v")
    row = checks.latency_percentiles(frame, "g", "v").first()
    assert abs(row.p50 - 5000) < 5 and abs(row.p95 - 9500) < 5 and abs(row.p99 - 9900) < 5


def test_reconcile(spark):
    exact = spark.createDataFrame([("a", 100), ("b", 100), ("c", 1)], "k string, n long")
    loose = spark.createDataFrame([("a", 99), ("b", 80), ("d", 2)], "k string, n long")
    out = {r.k: (r.exact_n, r.approx_n, r.rel_diff) for r in checks.reconcile_counts(loose, exact, ["k"], 0.01).collect()}
    assert out == {"b": (100, 80, 0.2), "c": (1, 0, 1.0), "d": (0, 2, 2.0)}


def test_severity_thresholds(spark):
    rows = [
        ("s", "consumer_lag", 10_000.0), ("s", "consumer_lag", 10_001.0), ("s", "consumer_lag", 100_001.0),
        ("s", "cache_hit_rate_pct", 80.0), ("s", "cache_hit_rate_pct", 79.0), ("s", "cache_hit_rate_pct", 49.0),
        ("s", "error_rate_pct", 5.0), ("s", "disk_usage_pct", 90.0), ("s", "unknown", 1.0),
    ]
    out = checks.severity_report(spark.createDataFrame(rows, "scope string, metric string, value double"))
    assert Counter(r.severity for r in out.collect()) == {"ok": 2, "warning": 3, "critical": 3}
