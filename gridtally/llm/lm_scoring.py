"""Language-model scores of texts: n-grams with deleted interpolation.

The probability of a token is a mixture of the maximum-likelihood estimates of all orders and a uniform one.
The mixture weights depend on the longest context that was seen and on how often it was seen (a bucket per
power of two); they are learned by expectation-maximisation on a deleted part of the training documents,
against counts of the rest. Scores then use the counts of all training documents.

Texts are tokenized once, into a table of batches that hold word hashes and positions instead of text. Every
batch asks for each of its distinct n-grams once, by hash range; a range adds up the counts of all batches
and answers each of them, so a word that is everywhere costs a row per batch. Tables are written in between.

An n-gram is told by 61 bits of its hash and its order.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.llm.store import stored

#: Tokens a batch holds at least, but for the last of a task; a text is never split.
BATCH_TOKENS = 1 << 20
#: n-grams a hash range holds, on average, at most.
RANGE_KEYS = 1 << 20
#: Rounds of expectation-maximisation at most, and the change of a weight that ends it.
ROUNDS, SETTLED = 25, 1e-3
#: Parts a document can be in.
UNSEEN, RETAINED, DELETED = 0, 1, 2

_END = np.uint64(0x9B1A5C7E3D2F4861)  # stands for the end of a text
_START = np.uint64(0x5D3C9A1B7E4F2680)  # stands before every text, and is no token
_ORDER_BITS = np.uint64(7)
_TOKENS = (
    "batch long, docs array<string>, parts binary, sizes binary, words binary, places binary, "
    "n_tokens long, n_retained_docs long, n_deleted_docs long"
)
#: Rows that hold a range's n-grams of a batch go to Python and to files a few at a time.
_FEW = {"spark__sql__execution__arrow__maxRecordsPerBatch": "64"}
_ASKED = "range int, batch long, keys binary, retained binary, deleted binary"
_COUNTED = "range int, batch long, retained binary, deleted binary, n_words long, n_tokens long, n_retained long"


def _squeezed(numbers: np.ndarray) -> bytes:
    """64-bit numbers byte by byte, all first bytes before all second ones: those of small numbers shrink to nothing."""
    return zstandard.compress(numbers.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _opened(squeezed: bytes, kind=np.int64) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(squeezed), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view(kind).ravel()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tokenized(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of doc, text, part become batches of tokens, numbered within the task and the input."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    ids: dict[bytes, int] = {}
    docs: list = []
    parts, sizes, places = bytearray(), [], []
    held = 0

    def batch() -> pd.DataFrame:
        words = np.fromiter((xxhash.xxh64_intdigest(w) for w in ids), np.uint64, len(ids))
        tokens = np.concatenate(places).tobytes()
        return pd.DataFrame({
            "batch": [number], "docs": [docs], "parts": [bytes(parts)], "sizes": [np.array(sizes, np.int64).tobytes()],
            "words": [words.tobytes()], "places": [zstandard.compress(tokens, 1)], "n_tokens": [held],
            "n_retained_docs": [parts.count(RETAINED)], "n_deleted_docs": [parts.count(DELETED)],
        })

    for rows in batches:
        for doc, text, part in zip(rows["doc"], rows["text"], rows["part"], strict=True):
            words = (text or "").encode("utf-8", "replace").lower().split()
            docs.append(doc)
            parts.append(part)
            sizes.append(len(words) + 1)
            # A word's place is its number in the order of first use; -1 is the end of the text.
            places.append(np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int32, len(words)))
            places.append(np.array([-1], np.int32))
            held += len(words) + 1
            if held >= BATCH_TOKENS:
                yield batch()
                number += 1
                ids, docs, parts, sizes, places, held = {}, [], bytearray(), [], [], 0
    if docs:
        yield batch()


class _Batch:
    """Tokens of a batch's documents, with the keys of the n-grams that end at each."""

    def __init__(self, row, order: int):
        self.docs = row.docs
        self.sizes = np.frombuffer(row.sizes, np.int64)
        self.parts = np.frombuffer(row.parts, np.uint8)
        words = np.append(np.frombuffer(row.words, np.uint64), _END)
        tokens = words[np.frombuffer(zstandard.decompress(row.places), np.int32)]
        self.first = np.cumsum(self.sizes) - self.sizes
        self.part = np.repeat(self.parts, self.sizes)
        self.at = np.arange(len(tokens)) - np.repeat(self.first, self.sizes)  # place in the document
        hashed, self.keys = tokens, []
        for n in range(1, order + 1):
            if n > 1:
                before = np.empty_like(hashed)
                before[1:] = hashed[:-1]
                before[self.at == 0] = _START  # stands for all the starts a context would hold
                hashed = _mixed(before * np.uint64(0x9E3779B97F4A7C15) + tokens + np.uint64(n))
            self.keys.append(_mixed(hashed) & ~_ORDER_BITS | np.uint64(n))
        self.order = order

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted positions of all keys, and where a new key begins among them."""
        keys = np.concatenate(self.keys)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        return order, np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])

    def asked(self, ranges: int) -> list[tuple]:
        order, new = self.distinct()
        keys = np.concatenate(self.keys)[order[new]]
        part = np.tile(self.part, self.order)[order]
        retained = np.add.reduceat((part == RETAINED).astype(np.int64), new)
        deleted = np.add.reduceat((part == DELETED).astype(np.int64), new)
        width = (1 << 64) // ranges + 1
        cuts = np.searchsorted(keys, np.array([k * width for k in range(1, ranges)], np.uint64))
        cuts = [0, *cuts.tolist(), len(keys)]
        return [
            (k, _squeezed(np.diff(keys[a:b], prepend=np.uint64(0))), _squeezed(retained[a:b]), _squeezed(deleted[a:b]))
            for k, (a, b) in enumerate(zip(cuts, cuts[1:]))
            if b > a
        ]

    def counted(self, answers: pd.DataFrame) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Counts of every token's n-grams by order, in all training documents and in the retained ones."""
        answers = answers.sort_values("range")
        retained, deleted = (np.concatenate([_opened(x) for x in answers[part]]) for part in ("retained", "deleted"))
        order, new = self.distinct()
        which = np.empty(len(order), np.int64)
        which[order] = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(order))))
        n = len(self.at)
        at = [which[k * n : (k + 1) * n] for k in range(self.order)]
        return [retained[w] + deleted[w] for w in at], [retained[w] for w in at]


@dataclass(frozen=True)
class Totals:
    """Distinct training words, all training tokens, training documents, and the last two of the retained part."""

    words: int
    tokens: int
    docs: int
    retained_tokens: int
    retained_docs: int


def _estimates(batch: _Batch, counts: list[np.ndarray], tokens: int, docs: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Each token's context bucket, and its maximum-likelihood estimates from order 1 up as (count, count of the context)."""
    bucket = np.zeros(len(batch.at), np.int64)
    contexts = [np.full(len(batch.at), tokens)]
    for n in range(2, batch.order + 1):
        context = np.empty_like(counts[n - 2])
        context[1:] = counts[n - 2][:-1]
        context[batch.at == 0] = docs
        contexts.append(context)
        bucket = np.where(context > 0, 64 * (n - 1) + np.frexp(context.astype(float))[1], bucket)
    return bucket, counts, contexts


def _ask(ranges: int, order: int):
    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for row in rows.itertuples(index=False):
                asked = pd.DataFrame(_Batch(row, order).asked(ranges), columns=["range", "keys", "retained", "deleted"])
                yield asked.assign(batch=row.batch)[["range", "batch", "keys", "retained", "deleted"]]

    return ask


def _answer(asked: pd.DataFrame) -> pd.DataFrame:
    """Counts of one hash range, added up over all batches and dealt out to each in the order it asked."""
    keys = [np.cumsum(_opened(k, np.uint64), dtype=np.uint64) for k in asked["keys"]]
    sizes, keys = [len(k) for k in keys], np.concatenate(keys)
    order = np.argsort(keys, kind="stable")
    new = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]])
    times = np.diff(np.append(new, len(keys)))
    word = keys[order[new]] & _ORDER_BITS == 1
    sums, out = [], {"range": asked["range"], "batch": asked["batch"]}
    for part in ("retained", "deleted"):
        total = np.add.reduceat(np.concatenate([_opened(x) for x in asked[part]])[order], new)
        spread = np.empty(len(keys), np.int64)
        spread[order] = np.repeat(total, times)
        out[part] = [_squeezed(x) for x in np.split(spread, np.cumsum(sizes)[:-1])]
        sums.append(total)
    # What the range knows of all words stands on its first row.
    first = np.arange(len(asked)) == 0
    both = (sums[0] + sums[1])[word]
    out |= {"n_words": first * int((both > 0).sum()), "n_tokens": first * int(both.sum()), "n_retained": first * int(sums[0][word].sum())}
    return pd.DataFrame(out)


class Model:
    """Counts, answered to every batch, and mixture weights by context bucket."""

    def __init__(self, tokens: DataFrame, answers: DataFrame, totals: Totals, order: int):
        self.tokens, self.answers, self.totals, self.order = tokens, answers, totals, order
        self.weights: dict[int, list[float]] = {}

    def _over_batches(self, work: Callable[[_Batch, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
        order = self.order

        def run(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
            return work(_Batch(next(rows.itertuples(index=False)), order), answers)

        return self.tokens.groupBy("batch").cogroup(self.answers.groupBy("batch")).applyInPandas(run, schema)

    def events(self) -> DataFrame:
        """Tokens of the deleted part by bucket, counts and counts of contexts in the retained part, with their number."""
        totals, order = self.totals, self.order
        counts, contexts = [f"c{n}" for n in range(1, order + 1)], [f"h{n}" for n in range(2, order + 1)]

        def deleted(batch: _Batch, answers: pd.DataFrame) -> pd.DataFrame:
            _, retained = batch.counted(answers)
            bucket, found, context = _estimates(batch, retained, totals.retained_tokens, totals.retained_docs)
            mine = batch.part == DELETED
            frame = pd.DataFrame({"bucket": bucket[mine]} | {c: x[mine] for c, x in zip(counts, found)} | {h: x[mine] for h, x in zip(contexts, context[1:])})
            return frame.groupby(list(frame.columns), sort=False).size().reset_index(name="n")

        columns = ["bucket", *counts, *contexts]
        rows = self._over_batches(deleted, ", ".join(f"{c} long" for c in [*columns, "n"]))
        return rows.groupBy(*columns).agg(F.sum("n").alias("n"))

    def learn(self) -> "Model":
        """Expectation-maximisation over the stored events; each round is one aggregate by bucket."""
        totals, order = self.totals, self.order
        events = self.events().withColumn("p0", F.lit(1.0 / (totals.words + 1)))
        events = events.withColumn("p1", F.col("c1") / F.lit(float(max(totals.retained_tokens, 1))))
        for n in range(2, order + 1):
            events = events.withColumn(f"p{n}", F.when(F.col(f"h{n}") > 0, F.col(f"c{n}") / F.col(f"h{n}")).otherwise(0.0))
        estimates = [f"p{n}" for n in range(order + 1)]
        events = stored(events.select("bucket", "n", *estimates), "lm-events")
        # One bucket per order and power of two: some hundred rows at most.
        weights = {r["bucket"]: [1 / (order + 1)] * (order + 1) for r in events.select("bucket").distinct().collect()}
        lambdas = [f"w{n}" for n in range(order + 1)]
        for _ in range(ROUNDS if weights else 0):
            table = events.sparkSession.createDataFrame(
                [(b, *map(float, w)) for b, w in weights.items()], "bucket long, " + ", ".join(f"{w} double" for w in lambdas)
            )
            parts = [(F.col(w) * F.col(p)).alias(p) for w, p in zip(lambdas, estimates)]
            split = events.join(F.broadcast(table), "bucket").select("bucket", "n", *parts)
            whole = sum((F.col(e) for e in estimates[1:]), F.col(estimates[0]))
            sums = split.groupBy("bucket").agg(*[F.sum(F.col("n") * F.col(e) / whole).alias(e) for e in estimates]).collect()
            # One pseudo-token each, so that no estimate ever loses all its weight.
            after = {r["bucket"]: [(r[e] + 1) / (sum(r[x] for x in estimates) + order + 1) for e in estimates] for r in sums}
            moved = max(abs(a - b) for k in after for a, b in zip(after[k], weights[k]))
            weights = after
            if moved < SETTLED:
                break
        self.weights = weights
        return self

    def weight_table(self) -> np.ndarray:
        """Weights by bucket; a bucket without held-out tokens takes those of the nearest of its order."""
        known = sorted(self.weights)
        table = np.zeros((64 * self.order, self.order + 1))
        for b in range(len(table)):
            near = [k for k in known if k // 64 == b // 64]
            seen = b // 64 + 1  # orders with a context of their own, and the uniform estimate
            table[b, : seen + 1] = 1 / (seen + 1)
            if near:
                table[b] = self.weights[min(near, key=lambda k: abs(k - b))]
        return table

    def score(self) -> DataFrame:
        """A row per document: doc_id, n_tokens, n_known, train_tokens, base_score and score (log10)."""
        totals, order = self.totals, self.order
        table = self.weight_table()
        if not totals.tokens:  # only the uniform estimate is left
            table[:] = np.eye(order + 1)[0]

        def scored(batch: _Batch, answers: pd.DataFrame) -> pd.DataFrame:
            counts, _ = batch.counted(answers)
            bucket, found, context = _estimates(batch, counts, totals.tokens, totals.docs)
            base = np.log10((found[0] + 0.5) / (totals.tokens + 0.5 * (totals.words + 1)))
            mass = table[bucket, 0] / (totals.words + 1)
            for n in range(order):
                mass = mass + table[bucket, n + 1] * found[n] / np.maximum(context[n], 1)
            summed = lambda x: np.add.reduceat(x, batch.first)
            return pd.DataFrame({
                "doc_id": list(batch.docs), "n_tokens": batch.sizes, "n_known": summed((found[0] > 0).astype(np.int64)),
                "train_tokens": totals.tokens, "base_score": summed(base), "score": summed(np.log10(mass)),
            })

        return self._over_batches(
            scored, "doc_id string, n_tokens long, n_known long, train_tokens long, base_score double, score double"
        )


def train(docs: DataFrame, part: Column, order: int = 2, doc_id: str = "doc_id", text: str = "text") -> Model:
    """A model of the documents whose ``part`` is RETAINED or DELETED, ready to score all of ``docs``.

    The deleted part teaches the mixture weights; where it is empty, all estimates weigh the same.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("string").alias("doc"), F.col(f"`{text}`").alias("text"), F.coalesce(part, F.lit(UNSEEN)).alias("part")
    )
    tokens = stored(rows.mapInPandas(_tokenized, _TOKENS), "lm-tokens")
    sizes = tokens.agg(F.sum("n_tokens"), F.sum("n_retained_docs"), F.sum("n_deleted_docs")).first()
    all_tokens, retained_docs, deleted_docs = (x or 0 for x in sizes)
    ranges = max(1, math.ceil(all_tokens * order / RANGE_KEYS))
    asked = tokens.mapInPandas(_ask(ranges, order), _ASKED)
    answers = stored(asked.groupBy("range").applyInPandas(_answer, _COUNTED), "lm-answers", **_FEW)
    found = answers.agg(F.sum("n_words"), F.sum("n_tokens"), F.sum("n_retained")).first()
    words, train_tokens, retained = (x or 0 for x in found)
    totals = Totals(words, train_tokens, retained_docs + deleted_docs, retained, retained_docs)
    return Model(tokens, answers.select("range", "batch", "retained", "deleted"), totals, order).learn()


def fold(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """A document's fold by a checksum of its id; null for a null id."""
    return F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % folds


def score_held_out(docs: DataFrame, order: int = 2) -> DataFrame:
    """Scores of all documents under a model of those whose fold is not 1.

    Null and empty texts are a lone end of text. Repeated rows are all learned from and all scored; a row
    without an id is scored, but neither held out nor learned from. A text of any length is scored whole, by
    one task. Without training documents every probability is that of the uniform estimate. An empty table
    gives no rows. Other columns of ``docs``, whatever their names, are not read.
    """
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    # A fifth of the training documents, told by the checksum's next digit to the base 5, is the deleted part.
    part = F.when(fold() == 1, UNSEEN).when(F.floor(checksum / 5) % 5 == 1, DELETED).when(fold().isNotNull(), RETAINED)
    kind = docs.select("doc_id").schema[0].dataType
    scored = train(docs, part, order).score().withColumn("doc_id", F.col("doc_id").cast(kind))
    return scored.select("doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), *scored.columns[1:])
