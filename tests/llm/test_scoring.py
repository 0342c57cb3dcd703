"""Lexical search, whitening and language-model scores against plain versions."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtally.llm import lexical_search, lm_scoring, whitening

DOCS = "doc_id long, text string, lang string"
CLASHING = ["n", "places", "numbers", "score", "item", "merge", "rank", "doc", "part", "batch", "range", "x", "index", "v", "vector", "y", "task", "nth"]
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(text):
    return (text or "").translate(UPPER)


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls everywhere, empty and very long texts, repeated rows, ties, clashing columns."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcDEé1") for _ in range(rng.randint(1, 4))) for _ in range(150)]
    prose = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", " ", ", ", "\n", "-"]) for _ in range(n))
    same = prose(40)
    rows = [(1, same), (1, same), (2, same), (3, None), (None, same), (None, None), (4, ""), (5, " \n\t, "), (6, "日本語 É é İ ſ"), (7, prose(20000))]
    rows += [(10 + k, prose(rng.randint(1, 80))) for k in range(120)] + [(200 + k, same) for k in range(60)]
    docs = spark.createDataFrame([(i, t, None) for i, t in rows], DOCS)
    return docs.withColumns({c: F.lit(c) for c in CLASHING}), rows, prose, same


def plain_search(rows, items, k):
    docs = [(i, Counter(TERM.findall(lower(t)))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    holding = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in docs:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = 0
            for t in TERM.findall(lower(text)):
                if t in c:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1)))
                    score += weight * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("tree, leaf", [(8192, 32), (16, 2)])
def test_lexical_search(spark, awkward, monkeypatch, tree, leaf):
    docs, rows, prose, same = awkward
    monkeypatch.setattr(lexical_search, "TREE_DOCS", tree)
    monkeypatch.setattr(lexical_search, "LEAF", leaf)
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 3)  # several passes
    items = [(1, same), (2, prose(5)), (3, prose(30)), (4, None), (None, prose(9)), (5, "zzz"), (6, "É é"), (7, prose(2) * 3), (7, "another text")]
    table = spark.createDataFrame(items + items[:2], "item_id long, text string").withColumns({c: F.lit(c) for c in CLASHING})
    got = sorted((tuple(r) for r in lexical_search.search(docs, table, 20).select("item_id", "rank", "doc_id", "score").collect()), key=str)
    assert got == plain_search(rows, items, 20)


def test_lexical_search_of_empty_tables(spark, awkward):
    docs, *_ = awkward
    nothing = spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([(1, "abc")], "item_id long, text string")
    assert lexical_search.search(nothing, items).collect() == []
    assert lexical_search.search(docs, items.limit(0)).collect() == []
    assert lexical_search.search(docs.filter("text is null"), items).collect() == []


def test_balls_bound_every_score_and_prune():
    rng = np.random.default_rng(3)
    tops = [rng.choice(300, 12, replace=False) for _ in range(8)]  # topics
    rows = [np.unique(np.r_[rng.choice(tops[k % 8], 11, replace=False), rng.integers(0, 300, 1)]) for k in range(800)]
    sizes = np.array([len(r) for r in rows])
    places, values = np.concatenate(rows), rng.integers(800_000, 10**6, sizes.sum())
    groups = np.arange(300) % 7
    tree = lexical_search.Tree(sizes, places, values, groups, leaf=10)
    assert sorted(tree.order) == list(range(800))
    matrix = np.zeros((800, 300), np.int64)
    matrix[np.repeat(np.arange(800), sizes), places] = values
    visited = 0
    for item in range(20):
        place = np.sort(rng.choice(tops[item % 8], 6, replace=False))
        query = np.zeros(300, np.int64)
        query[place] = rng.integers(1, 4, 6)
        by_place = np.searchsorted(place, np.arange(301)), np.zeros(6, np.int64), query[place].astype(float)
        norms = np.sqrt(np.bincount(groups[place], query[place].astype(float) ** 2, 7)).reshape(1, 7)
        bounds = tree.bounds(by_place, 1, norms)[:, 0]
        scores = matrix @ query
        for ball, bound in zip(tree.balls, bounds):
            assert scores[tree.order[ball.first : ball.last]].max() <= bound
        found, n = tree.best(query, bounds, np.arange(800), 20)
        visited += n
        assert [(s, -r) for s, r in found] == sorted(((int(s), r) for r, s in enumerate(scores) if s > 0), key=lambda e: (-e[0], e[1]))[:20]
    assert visited < 0.5 * 20 * sum(b.halves is None for b in tree.balls)


def plain_whitened(vectors):
    x = np.floor(256 * np.array(vectors, float))
    fit = np.unique(x, axis=0)
    e, v = np.linalg.eigh(np.cov(fit.T, bias=True))
    e, v = e[::-1], v[:, ::-1]
    n = len(fit)
    return n, ((n * x - fit.sum(0)) ** 2).sum(1), (x - fit.mean(0)) @ v[:, :4] / np.sqrt(e[:4]), e[:4] / e.sum()


def test_whitening(spark, monkeypatch):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(300, 7)) * [3, 2, 1.5, 1, 0.5, 0.2, 0.1]).round(4).tolist()
    vectors += [vectors[0]] * 150  # one vector in a third of all rows
    rows = [(k, v) for k, v in enumerate(vectors)] + [(3, vectors[3]), (None, vectors[5])]
    bad = [(900, None), (901, [1.0] * 6 + [None]), (902, [float("nan")] * 7), (903, [float("inf")] * 7), (904, [1e300] * 7), (905, []), (906, [1.0] * 6)]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumns({c: F.lit(c) for c in CLASHING})
    monkeypatch.setattr(whitening, "BLOCK_ENTRIES", 100)  # many blocks
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 3)  # several blocks abreast
    got = whitening.whiten(table).collect()
    n, deviation, scores, shares = plain_whitened([v for _, v in rows])
    assert len(got) == 4 * len(rows) and {r["n"] for r in got} == {n}
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-9
    by_id = defaultdict(list)
    for r in got:
        by_id[r["vec_id"]].append(r)
    signs = np.sign([next(r["whitened"] for r in by_id[1] if r["component"] == k + 1) * scores[1][k] for k in range(4)])
    for (i, _), d, s in zip(rows, deviation, scores):
        for r in by_id[i]:
            k = r["component"] - 1
            assert r["deviation"] == int(d) and r["explained"] == pytest.approx(shares[k], rel=1e-9)
            assert r["whitened"] == pytest.approx(signs[k] * s[k], abs=1e-9)


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], schema)).collect() == []
    line = [(k, [k / 8, 1.0]) for k in range(5)]  # one component only
    out = whitening.whiten(spark.createDataFrame(line, schema)).collect()
    assert {r["component"] for r in out} == {1} and len(out) == 5 and out[0]["explained"] == pytest.approx(1)
    huge = [(k, [3.0e16 * k, 0.0]) for k in range(3)]
    assert {r["deviation"] for r in whitening.whiten(spark.createDataFrame(huge, "vec_id long, embedding array<double>")).collect()} >= {None}


def plain_model(rows, order, rounds):
    """Token lists, counts of all and of retained training documents, weights by bucket, and scores."""
    tokens = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", lower(t)) if w] + [None]
    grams = lambda ts, n: [tuple((["<"] * n + ts)[k + 1 : k + n + 1]) for k in range(len(ts))]
    check = lambda i: zlib.crc32(str(i).encode())
    part = lambda i: "unseen" if i is None or check(i) % 5 == 1 else "deleted" if check(i) // 5 % 5 == 1 else "retained"
    docs = [(i, part(i), tokens(t)) for i, t in rows]

    def counted(parts):
        found = [Counter() for _ in range(order + 1)]
        for _, p, ts in docs:
            if p in parts:
                for n in range(1, order + 1):
                    found[n].update(grams(ts, n))
                    found[n - 1].update(g[:-1] for g in grams(ts, n) if g[:-1] and set(g[:-1]) == {"<"})  # starts
        found[0] = Counter({(): sum(found[1][g] for g in found[1] if g != ("<",))})
        return found

    def estimates(found, ts, words):
        out = []
        for k in range(len(ts)):
            bucket, p = 0, [1 / (words + 1)]
            for n in range(1, order + 1):
                g = grams(ts, n)[k]
                above = found[n - 1][g[:-1]]
                if n > 1 and above:
                    bucket = 64 * (n - 1) + above.bit_length()
                p.append(found[n][g] / above if above else 0.0)
            out.append((bucket, p))
        return out

    total, retained = counted({"retained", "deleted"}), counted({"retained"})
    words = sum(1 for g in total[1] if g != ("<",))
    events = [e for _, p, ts in docs if p == "deleted" for e in estimates(retained, ts, words)]
    weights = {b: [1 / (order + 1)] * (order + 1) for b, _ in events}
    for _ in range(rounds):
        sums = {b: [1.0] * (order + 1) for b in weights}
        for b, p in events:
            whole = sum(w * q for w, q in zip(weights[b], p))
            for n in range(order + 1):
                sums[b][n] += weights[b][n] * p[n] / whole
        weights = {b: [x / sum(s) for x in s] for b, s in sums.items()}
    return docs, total, words, weights, lambda ts: estimates(total, ts, words)


@pytest.mark.parametrize("order, batch", [(2, 1 << 21), (3, 200)])
def test_lm_scores(awkward, monkeypatch, order, batch):
    docs, rows, *_ = awkward
    rows = [r for r in rows if r[0] != 7] + [(7, "a b " * 400)]  # the plain version is slow
    docs = docs.filter("doc_id is null or doc_id <> 7").unionByName(docs.filter("doc_id = 7").withColumn("text", F.lit("a b " * 400)))
    monkeypatch.setattr(lm_scoring, "BATCH_TOKENS", batch)
    monkeypatch.setattr(lm_scoring, "RANGE_KEYS", 500)
    monkeypatch.setattr(lm_scoring, "ROUNDS", 6)
    monkeypatch.setattr(lm_scoring, "SETTLED", 0)
    plain, total, words, weights, estimates = plain_model(rows, order, 6)
    got = lm_scoring.score_held_out(docs, order).collect()
    assert len(got) == len(rows)
    n_train = total[0][()]
    table = lm_scoring.Model(None, None, None, order)
    table.weights = weights
    table = table.weight_table()
    expected = []
    for i, part, ts in plain:
        base = sum(math.log10((total[1][(t,)] + 0.5) / (n_train + 0.5 * (words + 1))) for t in ts)
        score = sum(math.log10(sum(w * q for w, q in zip(table[b], p))) for b, p in estimates(ts))
        held_out = i is not None and zlib.crc32(str(i).encode()) % 5 == 1
        expected.append((i, held_out, len(ts), sum(total[1][(t,)] > 0 for t in ts), n_train, base, score))
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    for g, e in zip(sorted(map(tuple, got), key=key), sorted(expected, key=key), strict=True):
        assert g[:5] == e[:5] and g[5:] == pytest.approx(e[5:], rel=1e-9, abs=1e-9)


def test_lm_probabilities_sum_to_one_at_most(spark):
    """Over every known word, the end and one unknown word, after a seen context."""
    rng = random.Random(2)
    words = [f"w{k}" for k in range(12)]
    rows = [(k, " ".join(rng.choices(words, range(1, 13), k=30))) for k in range(200)]
    probes = [(1000 + k, f"w11 {w}") for k, w in enumerate([*words, "unknown"])]
    part = F.when(F.col("doc_id") >= 1000, lm_scoring.UNSEEN).when(F.col("doc_id") % 4 == 0, lm_scoring.DELETED).otherwise(lm_scoring.RETAINED)
    docs = spark.createDataFrame(rows + probes + [(2000, "w11")], "doc_id long, text string")
    model = lm_scoring.train(docs, F.when(F.col("doc_id") == 2000, lm_scoring.UNSEEN).otherwise(part), 2)
    assert model.totals.words == 13 and all(sum(w) == pytest.approx(1) for w in model.weights.values())
    scores = {int(r["doc_id"]): r["score"] for r in model.score().collect()}
    assert all(s < 0 for s in scores.values())


def test_lm_scores_of_edge_cases(spark, awkward):
    assert lm_scoring.score_held_out(spark.createDataFrame([], DOCS)).collect() == []
    unseen = spark.createDataFrame([(None, "a b", None), (None, None, None)], DOCS)  # nothing to learn from
    assert sorted(tuple(r) for r in lm_scoring.score_held_out(unseen).collect()) == [(None, False, 1, 0, 0, 0.0, 0.0), (None, False, 3, 0, 0, 0.0, 0.0)]


def test_lm_beats_its_base_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = lm_scoring.score_held_out(docs, 2).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]
