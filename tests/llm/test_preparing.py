"""Token counts, languages, packing, surrogates, sharding and the pipeline against plain versions."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F

import __spark_entry__ as registered
import corpus_pipeline
from gridtally.llm import decontamination, language_id, line_dedup, packing, queries, quality_rules, sharding, simhash, surrogates, token_counts

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["row", "size", "shard", "upto", "text_key", "length", "task", "number", "first", "kind", "place", "p", "n", "bucket", "score"]


@pytest.fixture(scope="module")
def awkward(spark):
    rng = random.Random(6)
    prose = lambda n: " ".join("".join(rng.choice("abcdeé ") for _ in range(5)) for _ in range(n))
    same = prose(30)
    rows = [(1, same), (1, same), (2, same), (3, None), (None, "x"), (None, None), (4, ""), (5, " \n\t "), (6, "12 34 -- !"), (7, prose(20000)), (8, "日本語 😀 é" * 40)]
    rows += [(10 + k, prose(rng.randint(1, 60))) for k in range(30)]
    docs = spark.createDataFrame([(i, t, "en", None, None) for i, t in rows], SCHEMA)
    return docs.withColumns({c: F.lit(c) for c in CLASHING}), rows


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def greedy(vocabulary, word):
    rest, count = token_counts.WORD_START + word, 0
    while rest:
        size = next((k for k in range(len(rest), 0, -1) if rest[:k] in vocabulary), 0)
        if not size:
            return 0
        count, rest = count + 1, rest[size:]
    return count


def test_automaton_counts_like_greedy_matching():
    rng = random.Random(3)
    for _ in range(400):
        start = lambda: token_counts.WORD_START if rng.random() < 0.4 else ""
        vocabulary = {start() + "".join(rng.choice("abc") for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(1, 15))} - {""}
        automaton = token_counts.Automaton.of(vocabulary)
        for _ in range(20):
            word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 9)))
            assert automaton.count(word) == greedy(vocabulary, word)


def test_token_counts(awkward, empty, monkeypatch):
    docs, rows = awkward
    pieces = token_counts.sentencepiece_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    known = set(pieces)
    out = token_counts.count_tokens(docs, pieces).collect()
    expected = Counter()
    for i, t in rows:
        each = [greedy(known, w) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        expected[i, len(each), sum(each) + each.count(0), each.count(0)] += 1
    assert Counter(tuple(r) for r in out) == expected
    assert token_counts.count_tokens(empty, pieces).collect() == []
    counts = token_counts._Counts(token_counts.Automaton.of(["▁a", "b"]))
    monkeypatch.setattr(token_counts, "REMEMBERED_WORDS", 2)
    assert [counts[w] for w in (b"a", b"ab", b"abb", b"x", b"a")] == [1, 2, 3, 0, 1]


def test_languages_of_held_out_documents(spark):
    out = registered.queries()["op8_language_id"](spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = out.join(truth, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert len(held) > 150 and sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_scores_equal_a_plain_sum(spark, monkeypatch):
    monkeypatch.setattr(language_id, "PASS", 7)  # texts run over several passes
    rng = random.Random(2)
    model = language_id.Model(["a", "b"], np.log([0.4, 0.6]), np.vstack([np.random.default_rng(0).normal(-9, 0.01, (language_id.BUCKETS, 2)), [[0, 0]]]).astype(np.float32))
    texts = ["".join(rng.choice("abcÉ xyz") for _ in range(rng.randint(0, 40))) + "q" for _ in range(50)]
    out = model.predict([*texts, None, "", "12 !"])

    def plain(text):
        codes, sums = [ord(c) for c in f" {text.lower()} "], model.priors.copy()
        for i in range(len(codes)):
            mixed = 0
            for order in language_id.ORDERS:
                if i + order > len(codes):
                    break
                mixed = ((mixed ^ codes[i + order - 1]) * int(language_id._MULTIPLIERS[order - 1])) & 0xFFFFFFFF
                mixed ^= mixed >> 15
                sums = sums + model.matrix[mixed % language_id.BUCKETS]
        return sums

    for text, lang, score in zip(texts, out["lang_pred"], out["score"]):
        sums = plain(text)
        assert lang == "ab"[int(sums.argmax())]
        assert score == pytest.approx(1 / np.exp(sums - sums.max()).sum(), rel=1e-4)
    assert out["lang_pred"].tolist()[-3:] == ["und"] * 3 and out["score"].tolist()[-3:] == [0.0] * 3


def test_language_edge_cases(spark, awkward, empty):
    docs, rows = awkward
    model = language_id.train(docs)
    assert model.languages == ["en"]
    out = language_id.identify(docs, model).collect()
    letters = lambda t: any(c.isalpha() for c in t or "")
    assert Counter((r["doc_id"], r["lang_pred"]) for r in out) == Counter((i, "en" if letters(t) else "und") for i, t in rows)
    nothing = language_id.train(empty)
    assert nothing.languages == []
    assert {r["lang_pred"] for r in language_id.identify(docs, nothing).collect()} == {"und"}
    assert language_id.identify_held_out(empty).collect() == []


def test_byte_tokenizer_equals_the_library():
    from tokenizers import Tokenizer

    spec = queries.byte_vocabulary()
    plain = Tokenizer.from_str(spec)
    plain.encode_special_tokens = True
    fast = packing.ByteTokenizer(spec)
    for text in ("", "  a\n\n b\t c   ", "<|endoftext|> x", "é" * 3000, "日本語 " * 50, "a" * 20000, " " * 5000, "\r\n \x00   　x", "it's I'LL 'tis 123 4567 !!??"):
        assert fast.ids(text) == plain.encode(text, add_special_tokens=False).ids
    fast.fast = None  # what the fast path refuses goes to the library
    assert fast.ids("it's") == plain.encode("it's", add_special_tokens=False).ids


def test_packed_ids_equal_the_unmodified_library(spark):
    """The file's added tokens are tokens in the text too, as the library reads them by default."""
    from tokenizers import Tokenizer

    spec = queries.byte_vocabulary()
    plain = Tokenizer.from_str(spec)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n", "<|endoftext|", "it's plain 日本語"]
    rows = list(enumerate(texts))
    assert plain.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), spec, 128).collect()
    check_packed(out, rows, 128, lambda t: plain.encode(t, add_special_tokens=False).ids)


def check_packed(out, documents, capacity, ids_of):
    by_document, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        by_document[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    texts = defaultdict(list)
    for i, t in documents:
        texts[i].append(t)
    assert set(by_document) == set(texts)
    for i, bodies in texts.items():
        expected = Counter()
        for t in bodies:
            ids = ids_of(t or "") + [packing.END_OF_TEXT]
            start, end, piece = 0, len(ids) % capacity or capacity, 0
            while start < len(ids):
                expected[piece, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())] += 1
                piece, start, end = piece + 1, end, end + capacity
        assert Counter((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by_document[i]) == expected
    return len(sequences), sum(r["length"] for r in out)


def test_packing(awkward, empty):
    docs, rows = awkward
    spec = queries.byte_vocabulary()
    tokenizer = packing.ByteTokenizer(spec)
    used, tokens = check_packed(packing.pack(docs, spec, 128).collect(), rows, 128, tokenizer.ids)
    assert used <= -(-tokens // 128) + 3
    assert packing.pack(empty, spec).collect() == []


def test_plan_places_every_piece_once_and_fills_bins_well():
    rng = random.Random(8)
    for _ in range(60):
        capacity = rng.choice([16, 50, 97])
        numbers = {rng.randint(1, capacity): rng.randint(1, 30) for _ in range(rng.randint(1, 20))}
        bins, places = defaultdict(list), Counter()
        for f in packing.plan(numbers, capacity):
            for k in range(f.first, f.last + 1):
                places[f.length, k] += 1
                turn = k - f.first
                bins[f.bin + turn // f.each].append((f.offset + turn % f.each * f.length, f.length))
        assert places == Counter((n, k) for n, c in numbers.items() for k in range(c))
        assert sorted(bins) == list(range(len(bins)))
        for content in bins.values():
            at = 0
            for offset, length in sorted(content):
                assert offset == at
                at += length
            assert at <= capacity
        room = []  # first fit, longest first
        for length in sorted((n for n, c in numbers.items() for _ in range(c)), reverse=True):
            k = next((k for k, free in enumerate(room) if free >= length), None)
            if k is None:
                room.append(capacity - length)
            else:
                room[k] -= length
        assert len(bins) <= len(room) * 1.02 + 1


def test_fullest_finds_the_best_filling():
    rng = random.Random(4)
    for _ in range(200):
        left = {rng.randint(1, 12): rng.randint(1, 3) for _ in range(rng.randint(1, 5))}
        capacity = max(left) + rng.randint(0, 15)
        chosen = packing.fullest(left, capacity)
        assert all(chosen[n] <= left[n] for n in chosen) and max(left) in chosen
        sums = {max(left)}
        for n, c in left.items():
            for _ in range(c - (n == max(left))):
                sums |= {s + n for s in sums}
        assert sum(n * c for n, c in chosen.items()) == max(s for s in sums if s <= capacity)


def plain_capacity(sizes, shards):
    fits = lambda c: walk_plain(sizes, c) <= shards
    low, high = max(sizes) - 1, sum(sizes)
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle, high)
    return high


def walk_plain(sizes, capacity):
    used, room = 1, capacity
    for s in sizes:
        if s > room:
            used, room = used + 1, capacity
        room -= s
    return used


def test_smallest_capacity_equals_a_plain_search(monkeypatch):
    monkeypatch.setattr(sharding, "BLOCKS", 4)
    rng = random.Random(7)
    for _ in range(300):
        large = rng.choice([200, 200, 5000])
        sizes = [rng.choice([1, 2, 3, rng.randint(1, 200)]) for _ in range(rng.randint(1, 120))]
        sizes += rng.choices([large], k=rng.randint(0, 3))
        rng.shuffle(sizes)
        shards = rng.randint(1, 9)
        ends = np.cumsum(sizes).tolist()

        def summarize(bands):
            out = []
            for a, b in bands:
                width, blocks = (b - a) // sharding.BLOCKS + 1, defaultdict(list)
                for row, upto in enumerate(ends, 1):
                    if a <= upto <= b:
                        blocks[(upto - a) // width].append((upto, row))
                out.append(sharding.Steps([(v[0], v[-1], len(v)) for _, v in sorted(blocks.items())]))
            return out

        capacity, cuts = sharding.smallest_capacity(summarize, ends[-1], shards)
        assert capacity == plain_capacity(sizes, shards)
        assert cuts[-1][0] == ends[-1]
        assert all(b[0] - a[0] <= capacity for a, b in zip(cuts, cuts[1:]))

        def near(low, x, high):
            points = [(upto, row) for row, upto in enumerate(ends, 1)]
            below, above = [p for p in points if low <= p[0] <= x], [p for p in points if x < p[0] <= high]
            return (below[-1] if below else None), (above[0] if above else None)

        tail = [(ends[-1 - j], len(ends) - j) for j in range(min(shards, len(ends)))]
        cuts = sharding.balanced(near, tail, capacity, shards)
        loads = [b[0] - a[0] for a, b in zip(cuts, cuts[1:])]
        assert len(loads) == shards and sum(loads) == ends[-1] and max(loads) == capacity
        assert sum(x > 0 for x in loads) == min(shards, len(sizes))
        assert all(upto == (ends[row - 1] if row else 0) for upto, row in cuts)


def test_shards_behind_a_very_common_text_are_filled(spark):
    rows = spark.range(1500).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "common text").otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"),
    )
    load = Counter()
    for r in sharding.shard(rows, 8).collect():
        load[r["shard"]] += r["size"]
    hot = 500 * 12
    rest = sorted(load.values())[:-1]
    assert sorted(load) == list(range(8)) and hot <= max(load.values()) < hot + 2 * sum(rest) / 7
    assert min(rest) > sum(rest) / 7 / 2


def test_sharding(awkward, empty, spark):
    docs, rows = awkward
    out = sharding.shard(docs, shards=4).collect()
    expected = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == expected
    slots, of_text = defaultdict(list), defaultdict(set)
    for r in out:
        slots[r["shard"]].append(r["slot"])
        of_text[r["text_crc32"], r["size"]].add(r["shard"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert set(slots) <= {0, 1, 2, 3} and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in of_text.values())
    assert sharding.shard(empty).collect() == []
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 900).cast("string")).alias("text"))
    load = Counter()
    for r in sharding.shard(many, 8).collect():
        load[r["shard"]] += r["size"]
    assert sorted(load) == list(range(8)) and max(load.values()) - min(load.values()) <= 8 * 40


PRIVATE = [
    (1, "Mail a.b-1@Mail5.example.com or A.B-1@MAIL5.EXAMPLE.COM, call +1 (743) 555-3824 and 1-743-555-3824. Card 4111 1111 1111 1111 or 4111111111111112."),
    (2, 'Mrs. Anna Schmidt and Mr Otto Weber; госпожа Иванова. 127.0.0.1 v1.2.3 10.20.30.400 token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"###'),
    (3, None), (4, ""), (5, "nothing here 2.0 2024-01-02 12345"), (None, "a.b-1@mail5.example.com again 4111-1111-1111-1111"),
    (6, "SSN 123-45-6789 IBAN DE89 3704 0044 0532 0130 00 end. Mr Otto Weber"), (6, "SSN 123-45-6789 IBAN DE89 3704 0044 0532 0130 00 end. Mr Otto Weber"),
    (7, "x " * 20000 + "c.d@mail1.example.com " + "e" * 30000),
]


def test_surrogates(spark):
    docs = spark.createDataFrame(PRIVATE, "doc_id long, text string").withColumns({c: F.lit(c) for c in CLASHING})
    out = surrogates.replace(docs, "key").collect()
    assert Counter((r["row"]["doc_id"], r["row"]["text"]) for r in out) == Counter(PRIVATE)
    text = {(r["row"]["doc_id"], r["row"]["text"]): r["text"] for r in out}
    one, two, again, six = (text[PRIVATE[k]] for k in (0, 1, 5, 6))
    for k in (2, 3, 4):
        assert text[PRIVATE[k]] == PRIVATE[k][1]
    mail, shout, phone, other, card = re.fullmatch(r"Mail (\S+) or (\S+), call (\+1 \(\d{3}\) \d{3}-\d{4}) and (1-\d{3}-\d{3}-\d{4})\. Card (\d{4} \d{4} \d{4} \d{4}) or 4111111111111112\.", one).groups()
    digits = lambda s: re.sub(r"\D", "", s)
    assert re.fullmatch(r"[a-z]\.[a-z]-\d@[a-z]{4}\d\.[a-z]{7}\.example", mail) and shout == mail.upper()
    assert digits(phone) == digits(other) != "17435553824"
    assert again == f"{mail} again {card.replace(' ', '-')}" and digits(card) != "4111111111111111"
    assert sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits(card)))) % 10 == 0
    her, him, cyrillic, ip, token = re.fullmatch(r'Mrs\. (\w+ \w+) and Mr (\w+ \w+); госпожа (\w+)\. (\S+) v1\.2\.3 10\.20\.30\.400 token = "([0-9a-f]{40})"###', two).groups()
    assert her.split()[0] in surrogates.GIVEN["latin", "female"] and him.split()[0] in surrogates.GIVEN["latin", "male"]
    assert cyrillic in surrogates.FAMILY["cyrillic"] and ip != "127.0.0.1" and token != PRIVATE[1][1][-44:-4]
    assert six.endswith(f"Mr {him}") and re.match(r"SSN \d{3}-\d{2}-\d{4} IBAN [A-Z]{2}\d{2}( \d{4}){4} \d\d end", six)
    assert "c.d@mail1" not in text[PRIVATE[8]] and len(text[PRIVATE[8]]) > 60000
    assert surrogates.replace(docs.limit(0), "key").collect() == []
    assert [r["text"] for r in surrogates.replace(docs, "key").orderBy("text").collect()] == sorted((r["text"] for r in out), key=lambda t: (t is not None, t or ""))


def test_colliding_surrogates_are_drawn_again(spark, monkeypatch):
    names = [(f"male", f"N{chr(97 + k // 26)}{chr(97 + k % 26)} Xy") for k in range(400)]  # more than given times family names
    taken = [("male", f"{g} {f}") for g in surrogates.GIVEN["latin", "male"] for f in surrogates.FAMILY["latin"]]
    entities = spark.createDataFrame(names + taken[:100], "kind string, canonical string")
    out = surrogates.assign(entities, "key").collect()
    assert {(r["kind"], r["canonical"]) for r in out} == set(names + taken[:100])
    chosen = [r["surrogate"] for r in out]
    assert len(set(chosen)) == len(chosen) and not set(chosen) & {c for _, c in names + taken[:100]}


def test_surrogates_of_any_script_and_of_signs(spark):
    """Nothing of them stays in clear, and every candidate changes with the attempt, so the rounds end."""
    emails = ["李雷@例子.公司", "李雷@例子.网络", "محمد١٢@مثال.شبكة", "محمد١٢@مثال.موقع", "דוד@דוגמה.קום", "홍길동@보기.한국", "a李@x.cn"]
    secrets = ["+" * 16, "+/" * 9] + [chr(97 + k) + "-" * 15 for k in range(26)]
    rows = [("email", e) for e in emails] + [("secret", s) for s in secrets]
    entities = spark.createDataFrame(rows, "kind string, canonical string")
    drawn = entities.crossJoin(spark.createDataFrame([(k,) for k in range(4, 8)], "attempt int"))
    candidates = [(r["kind"], r["canonical"], r["surrogate"]) for r in surrogates._with_candidates(drawn, "key").collect()]
    assert len({(k, s) for k, _, s in candidates}) == 4 * len(rows)
    out = {(r["kind"], r["canonical"]): r["surrogate"] for r in surrogates.assign(entities, "key").collect()}
    assert set(out) == set(rows) and len(set(out.values())) == len(rows) and not set(out.values()) & set(emails + secrets)
    for e in emails:
        assert out["email", e].isascii() and out["email", e].endswith(".example") and "@" in out["email", e]
    assert all("+" not in out["secret", s] for s in secrets[:2])


TITLED = [
    (1, "Mr John Smith met Mr Smith. Then John Smith and Dr. Jane Roe left; Professor Roe came back. JOHN SMITH, Johnny John Smithson."),
    (2, "Mrs Smith, Mr John Smith, Frau Dr. Smith and Dr. Smith. Mr McDonald, Mr O'Brien."),
    (3, "Herr Dr. Karl Weber und Dr. Weber, Karl Weber."),
    (4, "IBAN DE89370400440532013000 or GB82 WEST 1234 5698 7654 32, SSN 123-45-6789, call 743-555-3824. Mr John Smith"),
]


def test_people_of_a_document_have_one_surrogate(spark):
    docs = spark.createDataFrame(TITLED, "doc_id long, text string")
    text = {r["row"]["doc_id"]: r["text"] for r in surrogates.replace(docs, "key").collect()}
    john, family, again, jane, roe = re.fullmatch(
        r"Mr (\w+ \w+) met Mr (\w+)\. Then (\w+ \w+) and Dr\. (\w+ \w+) left; Professor (\w+) came back\. JOHN SMITH, Johnny John Smithson\.", text[1]
    ).groups()
    assert john == again and john.split()[1] == family and jane.split()[1] == roe and len({"Smith", "Roe", family, roe}) == 4
    mrs, mr, frau, dr, scot, irish = re.fullmatch(r"Mrs (\w+), Mr (\w+ \w+), Frau Dr\. (\w+) and Dr\. (\w+)\. Mr (\w+), Mr (\w+)\.", text[2]).groups()
    assert mr == john and mrs == frau == dr != family and len({scot, irish, family, roe, mrs}) == 5
    karl, weber, bare = re.fullmatch(r"Herr Dr\. (\w+ \w+) und Dr\. (\w+), (\w+ \w+)\.", text[3]).groups()
    assert karl == bare and karl.split()[1] == weber and karl.split()[0] in surrogates.GIVEN["latin", "male"]
    first, second, ssn, phone, same = re.fullmatch(r"IBAN (\w+) or ([\w ]+), SSN ([\d-]+), call ([\d-]+)\. Mr (\w+ \w+)", text[4]).groups()
    for iban, country, shape in ((first, "DE", r"\d{20}"), (second.replace(" ", ""), "GB", r"\d\d[A-Z]{4}\d{14}")):
        assert iban.startswith(country) and re.fullmatch(shape, iban[2:]) and iban not in TITLED[3][1].replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", ssn) and re.fullmatch(r"[2-9]\d\d-[2-9]\d\d-\d{4}", phone) and same == john


def test_surrogates_of_the_table_against_plain_search(spark):
    """What a plain search finds is replaced, the rest stays byte for byte; one surrogate per entity, one entity per surrogate."""
    docs = queries.documents(spark, SF)
    meant, known = {}, set()
    for r in surrogates.replace(docs, "key").collect():
        before, after = r["row"]["text"], r["text"]
        if before is None:
            assert after is None
            continue
        spans = [m for m in regex.finditer(surrogates.ANY, before)]
        assert bool(spans) or before == after
        titled = {m[0] for m in spans if regex.fullmatch(surrogates._NAME, m[0])}
        assert not any(" " in n for n in titled) or len(titled) < 50  # names are few enough to try all
        pieces = regex.split(surrogates.ANY, before)
        whole = sorted((n for n in titled if " " in n), key=len, reverse=True)
        bare = regex.compile("|".join(rf"(?<!\w)(?:{regex.escape(n)})(?!\w)" for n in whole)) if whole else None
        form = "(.+?)".join("(?:.+?)".join(map(regex.escape, bare.split(p))) if bare else regex.escape(p) for p in pieces)
        got = regex.fullmatch(form, after, regex.S)
        assert got, r["row"]["doc_id"]
        for m, new in zip(spans, got.groups()):
            if "@" in m[0]:
                known.add(m[0].lower())
                assert meant.setdefault(m[0].lower(), new.lower()) == new.lower() != m[0].lower()
    assert len(set(meant.values())) == len(meant) > 0 and not set(meant.values()) & known


def test_pipeline_stages(spark, path):
    """Each stage against the plain rule, on what the stage before kept."""
    docs, kept = queries.documents(spark, SF), []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF)
        docs.write.parquet(path(name))
        docs = spark.read.parquet(path(name))
        if name != "packing":
            assert docs.columns == before.columns and dict(docs.dtypes) == dict(before.dtypes)
        kept.append((before, docs))
    (start, quality), (_, lines), (_, unique), (_, clean), (_, packed) = kept
    judged = {r["doc_id"]: r["kept"] for r in quality_rules.judge(start).select("doc_id", "kept").collect()}
    assert {r["doc_id"] for r in quality.collect()} == {i for i, k in judged.items() if k}
    rows = {r["doc_id"]: r for r in lines.collect()}
    for r in line_dedup.dedup(quality).collect():
        i = r["row"]["doc_id"]
        assert (i not in rows) == (r["n_removed"] > 0 and not r["kept"].strip())
        if i in rows:
            assert rows[i]["text"] == r["kept"] and rows[i]["n_chars"] == len(r["kept"])
    prints = {i: simhash.fingerprint(r["text"]) for i, r in rows.items()}
    assert len({prints[i] for i in prints}) >= unique.count()
    components = {r["component_id"] for r in simhash.near_duplicates(lines).collect()}
    assert {r["doc_id"] for r in unique.collect()} == components
    leaking = {r["doc_id"] for r in decontamination.find(unique, queries.benchmark(spark, SF)).collect()}
    assert {r["doc_id"] for r in clean.collect()} == components - leaking
    tokenizer = packing.ByteTokenizer(queries.byte_vocabulary())
    check_packed(packed.collect(), [(r["doc_id"], r["text"]) for r in clean.collect()], corpus_pipeline.CAPACITY, tokenizer.ids)


def test_every_operator_is_registered():
    names = set(registered.queries())
    assert {re.match(r"op\d+_", n)[0] for n in names if n.startswith("op")} == {f"op{k}_" for k in range(1, 14)}
    assert "pipeline" in names
