"""Quality rules, line and byte deduplication, near-duplicates, decontamination against brute force."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from gridtally.llm import components, decontamination, line_dedup, oracles, quality_rules, queries, simhash, suffix_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns whose names the operators use themselves.
CLASHING = ["row", "kept", "fp", "root", "o", "d", "body", "cut", "_text", "chunk", "place", "id", "n_words", "base_failed", "_words", "_lines", "_hashes", "_in_stop_words"]


def words(text):
    return WORD.findall(text or "")


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls everywhere, empty and very long texts, repeated rows, ties, clashing columns."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = prose(60)
    base = "\n".join(prose(25) for _ in range(4))
    rows = [
        (1, base), (1, base), (2, base), (3, base + " tail"), (4, None), (None, "the end"), (None, None), (5, ""), (6, " \n\t \n"),
        (7, prose(20) + "\n" + passage + "\n" + prose(9)), (8, passage), (9, "x " * 30000 + "y"), (10, prose(5000)),
        (11, "\n".join([prose(12)] * 3 + [prose(14), prose(30)] * 2)), (12, "Ünï <b> | # $ *"), (None, base), (13, "a"), (14, "a b"),
        (15, passage[:200] + "\n" + passage), (11, prose(70)), (2, passage + "\n\n" + prose(3)),
    ]
    docs = spark.createDataFrame([(i, t, None, None, None if t is None else len(t)) for i, t in rows], SCHEMA)
    docs = docs.withColumns({c: F.lit(c) for c in CLASHING})
    return docs, rows


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_counts(text):
    w = words(text)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    repeated = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeated)


def test_quality_counts(awkward, empty):
    docs, rows = awkward
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    out = quality_rules.judge(docs).select("doc_id", "text", *names, "base_failed", "kept").collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter(rows)
    for r in out:
        counts = plain_counts(r["text"])
        assert tuple(r[n] for n in names) == counts
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    kept = quality_rules.keep(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["kept"] for r in out)
    assert quality_rules.keep(empty).collect() == []


def test_quality_rules_spare_prose_and_reject_junk(spark):
    clean = "It is the case that a house on the hill was sold to the man from the town.\n" + " ".join(f"the w{k}rd of" for k in range(40))
    junk = " ".join(f"w{k}rd###" for k in range(80))
    loud = " ".join(f"WORD{chr(65 + k % 26)}{chr(65 + k // 26)} THE" for k in range(60))
    rows = {r["doc_id"]: r["kept"] for r in quality_rules.judge(spark.createDataFrame([(1, clean), (2, junk), (3, loud)], "doc_id long, text string")).collect()}
    assert rows == {1: True, 2: False, 3: False}


def test_stop_words_bound_only_the_languages_they_are_of(spark):
    say = lambda letters: " ".join(letters[k % 7 :][:5] + letters[k % 5 :][:4] + letters[k % 11] for k in range(80))
    russian, greek, latin = say("абвгдежзиклмно"), say("αβγδεζηθικλμνξ"), say("bcdfghklmnprst")
    arabic = say("ابتثجحخدذرزسشص")
    docs = [(1, russian, "ru"), (2, greek, None), (3, latin, "pl"), (4, latin, "TR-tr"), (5, arabic, "und"), (6, latin, "en"), (7, latin, None), (8, latin, "de-AT"), (9, None, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    broken = {r["doc_id"]: r["broken_rules"] for r in quality_rules.judge(frame).collect()}
    assert {i for i, names in broken.items() if "stop_words" in names} == {6, 7, 8}
    assert {r["doc_id"] for r in quality_rules.keep(frame).collect()} == {1, 2, 3, 4, 5}
    unlabelled = quality_rules.keep(frame.drop("lang"))
    assert {r["doc_id"] for r in unlabelled.collect()} == {1, 2, 5}


def test_quality_sql_states_the_language_rule_too(spark, tmp_path):
    prose = {
        "en": "the cat and the dog sat in the house", "de": "der Hund und die Katze mit dem Ball", "fr": "le chat et la maison dans une rue",
        "es": "el gato y la casa de una mujer", "pl": "kot oraz pies siedzą razem przed domem", "tr": "kedi ile köpek evde birlikte oturuyor",
        "ru": "кошка сидит дома вместе собакой вечером", "el": "γάτα σκύλος μαζί σπίτι βράδυ τραπέζι",
        "zh": "猫 狗 房子 坐着 晚上 一起", "ar": "قطة كلب بيت مساء معا جالس",
    }
    labels = lambda lang: (lang, None, "", "und", " EN-us", "unknown", "pl", "de_DE")
    rows, n = [], 0
    for lang, text in prose.items():
        # A number after every other word, so that no window of words is found twice.
        body = "\n".join(" ".join(f"{w} {100 * k + j}" if j % 2 else w for j, w in enumerate(text.split())) for k in range(1, 13))
        for label in labels(lang):
            rows.append((n := n + 1, body, label))
    rows += [(n + 1, None, None), (n + 2, "", "en"), (n + 3, "a b c " * 30, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
        found = db.execute(oracles.QUALITY_RULES).fetchall()
    mine = queries.op2_quality_rules(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in mine) == sorted(found)
    kept = {r["doc_id"]: r["kept"] for r in mine}
    of = {i: (t, label) for i, t, label in rows}
    russian = [i for i, (t, _) in of.items() if t and "кошка" in t]
    polish = [i for i, (t, label) in of.items() if t and "pies" in t and label == "pl"]
    assert polish and all(kept[i] for i in polish)
    assert {of[i][1] for i in russian if not kept[i]} == {" EN-us", "de_DE"}


def line_oracle(rows, least=50):
    docs = sorted({(suffix_dedup.LAST if i is None else i, t) for i, t in rows if t})
    sequences = {d: [x for x in d[1].split("\n") if words(x)] for d in docs}
    runs = {}
    for d, lines in sequences.items():
        n = [len(words(x)) for x in lines]
        for i in range(len(lines)):
            j = next((j for j in range(i, len(lines)) if sum(n[i : j + 1]) >= least), None)
            if j is not None:
                runs.setdefault(tuple(lines[i : j + 1]), set()).add((d, i))
            k = next((k for k in range(i, -1, -1) if sum(n[k : i + 1]) >= least), None)
            if k is not None:
                runs.setdefault(tuple(lines[k : i + 1]), set()).add((d, k))
    gone = {d: set() for d in docs}
    for run, places in runs.items():
        first = min(places)
        for d, i in places:
            if d != first[0] or i >= first[1] + len(run):
                gone[d] |= set(range(i, i + len(run)))
    out = {}
    for d, lines in sequences.items():
        place, kept, dead = -1, [], False
        for line in d[1].split("\n"):
            if words(line):
                place += 1
                dead = place in gone[d]
            if not dead:
                kept.append(line)
        out[d] = "\n".join(kept)
    return out


@pytest.mark.parametrize("common", [1, 20, 1000])
def test_line_dedup(awkward, empty, monkeypatch, common):
    monkeypatch.setattr(line_dedup, "COMMON", common)
    docs, rows = awkward
    # Documents of equal id stand in the order of their content hash, which the plain version does not know.
    single = docs.filter("doc_id is null or doc_id not in (2, 11)")
    rows = [r for r in rows if r[0] not in (2, 11)]
    nulls = [r for r in rows if r[0] is None]
    expected = line_oracle(rows)
    out = line_dedup.dedup(single).collect()
    assert len(out) == len(rows) and len(nulls) == 3
    removed = 0
    for r in out:
        i, t = r["row"]["doc_id"], r["row"]["text"]
        assert r["row"]["kept"] == "kept"
        if not t:
            assert (r["kept"], r["n_removed"]) == (t, 0)
            continue
        assert r["kept"] == expected[suffix_dedup.LAST if i is None else i, t]
        assert r["n_removed"] == len(t.split("\n")) - (len(r["kept"].split("\n")) if r["n_removed"] < r["n_lines"] else 0)
        removed += r["n_removed"]
    assert removed > 5
    assert line_dedup.summary(empty).collect() == []


def test_line_dedup_keeps_one_copy_of_overlapping_repeats(spark):
    text = "\n".join(["ten words are in this line and it comes back"] * 40)
    row = line_dedup.dedup(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["kept"] == "\n".join(["ten words are in this line and it comes back"] * 5)
    assert row["n_runs"] == 1


def test_long_runs_of_short_lines(spark):
    rng = random.Random(2)
    lines = [f"w{rng.randint(0, 3)}" for _ in range(400)]
    other = lines[100:260]
    rows = [(1, "\n".join(lines)), (2, "\n".join(["new"] + other + ["newer"]))]
    out = {r["row"]["doc_id"]: r["kept"] for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    expected = line_oracle(rows)
    assert out == {d[0]: kept for d, kept in expected.items()}
    assert out[2] == "new\nnewer"


def byte_oracle(rows, length=50):
    ordered = sorted(((suffix_dedup.LAST if i is None else i), (t or "").encode()) for i, t in rows)
    least = {}
    for i, b in ordered:
        for p in range(len(b) - length + 1):
            least.setdefault(b[p : p + length], i)
    out = Counter()
    for i, b in ordered:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if least[b[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out[i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_suffix_dedup(awkward, empty, monkeypatch):
    docs, rows = awkward
    out = suffix_dedup.remove_repeats(docs).collect()
    found = Counter((suffix_dedup.LAST if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out)
    assert found == byte_oracle(rows)
    assert sum(r["n_removed"] for r in out) > 1000
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in out)
    assert suffix_dedup.remove_repeats(empty).collect() == []


def test_suffix_dedup_over_many_small_chunks_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PASS", 700)
    rng = random.Random(9)
    pool = ["".join(rng.choice("ab") for _ in range(rng.randint(20, 400))) for _ in range(12)]
    rows = [(k, "".join(rng.choice(pool) + rng.choice("xyz") for _ in range(rng.randint(1, 6)))) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    monkeypatch.setattr(suffix_dedup, "BUCKET", 2000)
    out = suffix_dedup.remove_repeats(docs, with_bytes=False).collect()
    assert Counter(tuple(r) for r in out) == byte_oracle(rows)


def test_blind_trie_and_window_order():
    rng = random.Random(1)
    for _ in range(300):
        strings = list({bytes(rng.choice(b"ab") for _ in range(12)) for _ in range(rng.randint(1, 40))})
        assert suffix_dedup.blind_trie_order(strings) == sorted(strings)
    data = bytes(rng.choice(b"ab") for _ in range(300)) * 3
    import numpy as np

    starts = np.arange(len(data) - 49)
    order, fresh = suffix_dedup.sorted_windows(data, starts)
    strings = [data[s : s + 50] for s in starts[order]]
    assert strings == sorted(strings)
    assert fresh.tolist() == [k == 0 or strings[k] != strings[k - 1] for k in range(len(strings))]


def plain_fingerprint(text):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(len(w) - 2, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(edges, nodes):
    of = {x: x for x in nodes}

    def find(x):
        while of[x] != x:
            x = of[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        of[b] = a
    return {x: find(x) for x in nodes}


def test_simhash(awkward, empty):
    docs, rows = awkward
    fps = {t: plain_fingerprint(t) for _, t in rows}
    distinct = sorted(set(fps.values()))
    near = [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 2]
    root = plain_components(near, distinct)
    least = {}
    for i, t in rows:
        if i is not None:
            r = root[fps[t]]
            least[r] = min(least.get(r, i), i)
    out = simhash.near_duplicates(docs).collect()
    expected = Counter((i, f"{fps[t]:016x}", least.get(root[fps[t]])) for i, t in rows)
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in out) == expected
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(root.values()))
    assert simhash.near_duplicates(empty).collect() == [] and simhash.keep_one(empty).collect() == []


@pytest.mark.parametrize("crowded", [0, 3, 64])
def test_links_equal_all_pairs_within_two_bits(spark, monkeypatch, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = random.Random(4)
    seeds = [rng.getrandbits(64) for _ in range(30)] + [0, (1 << 64) - 1]
    near = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for s in seeds for _ in range(12)}
    signed = [x - (1 << 64) if x >> 63 else x for x in sorted(near)]
    links = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    found = [tuple(r) for r in links.collect()]
    mask = (1 << 64) - 1
    assert all(((a ^ b) & mask).bit_count() <= 2 for a, b in found)
    pairs = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 2]
    assert plain_components(found, signed) == plain_components(pairs, signed)
    if crowded == 64:  # no cell is split, so every pair is a link of its own
        assert set(found) == set(pairs)


def test_segment_counts_bound_the_bit_distance_from_below(spark):
    rng = random.Random(9)
    pairs = [(a, a ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6)))) for a in (rng.getrandbits(64) for _ in range(300))]
    counts = lambda x: [(x >> k & 15).bit_count() for k in range(0, 64, 4)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    table = spark.createDataFrame([(signed(a), signed(b)) for a, b in pairs], "a long, b long")
    out = table.select("a", "b", simhash._apart(simhash._unary(F.col("a")), simhash._unary(F.col("b"))).alias("d")).collect()
    mask = (1 << 64) - 1
    for r in out:
        a, b = r["a"] & mask, r["b"] & mask
        assert r["d"] == sum(abs(x - y) for x, y in zip(counts(a), counts(b))) <= (a ^ b).bit_count()


def test_one_row_of_every_component_is_kept(spark):
    long = " ".join(f"w{k}" for k in range(80))
    rows = [(1, long), (1, long), (1, "other words"), (2, long), (None, "other words"), (None, "no id here"), (None, "no id here"), (3, None), (4, "")]
    kept = simhash.keep_one(spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, root int"))
    assert kept.columns == ["doc_id", "text", "root"]
    expected = [(None, "no id here"), (1, "other words"), (1, long), (3, None)]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(expected, key=str)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(200, 200), (201, 202), (202, 201)]
    out = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = {x for e in edges for x in e} - {200}
    assert out == plain_components([e for e in edges if e[0] != 200], nodes)


def plain_contained(text, item, k=5):
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    a, b = split(text), split(item)
    k = min(k, len(b))
    grams = {tuple(b[i : i + k]) for i in range(len(b) - k + 1)} if b else set()
    shared = grams & {tuple(a[i : i + k]) for i in range(len(a) - k + 1)}
    return (len(grams), len(shared)) if grams and 5 * len(shared) >= 4 * len(grams) else None


def test_decontamination(spark, awkward, empty, monkeypatch):
    docs, rows = awkward
    passage = rows[10][1].split()
    items = [
        (1, " ".join(passage[10:40])), (2, "X, x! x; x: x. x"), (3, None), (4, ""), (5, "a"), (6, "nowhere to be seen at all in it"),
        (7, " ".join(passage[:25] + ["other"] + passage[25:50])), (None, " ".join(passage[5:30])), (8, " ".join(passage[:15] + ["zz"] + passage[20:30] + ["yy"] + passage[40:50])), (1, "the end"),
    ]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    expected = Counter()
    for i, t in rows:
        for j, x in items:
            if hit := plain_contained(t, x):
                expected[i, j, *hit] += 1
    assert len(expected) > 8
    for block in (decontamination.BLOCK_BYTES, 150):
        monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
        out = decontamination.find(docs, table).collect()
        assert Counter((r["doc_id"], r["item_id"], r["n_shingles"], r["n_shared"]) for r in out) == expected
        clean = decontamination.keep_clean(docs, table)
        assert clean.columns == docs.columns
        assert clean.count() == sum(not any(plain_contained(t, x) for _, x in items) for _, t in rows)
    assert decontamination.find(empty, table).collect() == []
    assert decontamination.find(docs, table.limit(0)).collect() == []
    assert decontamination.keep_clean(docs, table.limit(0)).count() == len(rows)
