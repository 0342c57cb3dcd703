"""Ranked lexical search: the best documents of each item, by exact inner products in sparse ball trees.

A document is a sparse vector of the impacts of the items' terms, weighted by term; an item is the vector of its term
counts; their inner product is the score. Each block of documents is split into a tree of balls, down to
leaves of a few documents. No document of a ball scores more than the item's product with the centroid plus
its norm times the radius, so an item visits balls best first and stops at the first that cannot reach its
best ones. To make that bound tight, terms are dealt into groups of about equally common ones, and a ball has
a radius in each. Bounds are floating-point numbers rounded up by more than they can err; scores at the leaves
are whole numbers.

Corpus counts (documents, terms, documents of each term) cover all documents. Items are taken in blocks of a
bounded size, a pass over the documents each.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally.llm.store import stored

#: Bytes of text, and items, that a block of items holds on average at most.
BLOCK_BYTES, BLOCK_ITEMS = 1 << 22, 4096
#: Documents a tree holds at most, and term entries from which a tree is closed.
TREE_DOCS, TREE_ENTRIES = 8192, 1 << 21
#: Documents of a leaf; bands of terms by powers of two of their share of documents, and groups of a band.
LEAF, BANDS, BAND_GROUPS = 32, 12, 16
#: What a bound is rounded up by; sums of doubles err by far less.
SLACK = 1e-9
#: Lists of the best that are merged at a time, so that no task meets all blocks' lists of an item.
MERGES = 256

# Bytes of a term as they are, lower-cased if A-Z; all other bytes are spaces.
_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of letters and digits of ASCII and of any characters beyond it; only A-Z are lower-cased."""
    return (text or "").encode("utf-8", "replace").translate(_TERM_BYTES).split()


@dataclass(frozen=True)
class Items:
    """A block of items: ids, and for each the places of its terms in the vocabulary with their numbers."""

    ids: list
    vocabulary: dict[bytes, int]
    places: list[np.ndarray]
    counts: list[np.ndarray]

    @staticmethod
    def of(rows: list[tuple]) -> "Items":
        counted = [Counter(terms(text)) for _, text in rows]
        vocabulary = {t: k for k, t in enumerate(sorted(set().union(*counted)))} if counted else {}
        places = [np.array([vocabulary[t] for t in c], np.int64) for c in counted]
        return Items([i for i, _ in rows], vocabulary, places, [np.array(list(c.values()), np.int64) for c in counted])


def _vectors(vocabulary):
    """Rows of doc_id, text become doc_id, number of terms, places and numbers of the vocabulary's terms."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            sizes, offsets, places, numbers = [], [0], [], []
            for text in batch.column(1):
                found = terms(text.as_py())
                sizes.append(len(found))
                hits = [(known[t], n) for t, n in Counter(found).items() if t in known]
                places.extend(p for p, _ in hits)
                numbers.extend(n for _, n in hits)
                offsets.append(len(places))
            at = pa.array(offsets, pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(x, pa.int32())) for x in (places, numbers)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "places", "numbers"])

    return scan


@dataclass
class Ball:
    """Rows first..last - 1 of a tree, and the balls they are split into (none: a leaf)."""

    first: int
    last: int
    halves: tuple[int, int] | None = None


class Tree:
    """Ball tree over rows of a sparse matrix of whole numbers (place, value by row)."""

    def __init__(self, sizes: np.ndarray, places: np.ndarray, values: np.ndarray, groups: np.ndarray, leaf: int = LEAF):
        self.leaf, self.groups, self.n_groups = leaf, groups, int(groups.max(initial=0)) + 1
        self.ends = np.cumsum(sizes)
        self.places, self.values = places, values
        self.order = np.arange(len(sizes))
        self.balls: list[Ball] = []
        self.centroids: list[tuple[np.ndarray, np.ndarray]] = []
        self.radii: list[np.ndarray] = []
        if len(sizes):
            self._grow()

    def _part(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row number within ``rows``, place and value of their entries."""
        sizes = self.ends[rows] - np.r_[0, self.ends][rows]
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = np.repeat(self.ends[rows] - sizes, sizes) + within
        return np.repeat(np.arange(len(rows)), sizes), self.places[at], self.values[at].astype(float)

    def _grow(self) -> None:
        width = len(self.groups)
        todo = [(0, len(self.order), None)]
        while todo:
            first, last, parent = todo.pop()
            rows = self.order[first:last]
            row, place, value = self._part(rows)
            centroid = np.bincount(place, value, width) / len(rows)
            used = np.flatnonzero(centroid)
            own = np.bincount(self.groups[used], centroid[used] ** 2, self.n_groups)
            cells = row * self.n_groups + self.groups[place]
            shape = (len(rows), self.n_groups)
            away = np.bincount(cells, value * (value - 2 * centroid[place]), shape[0] * shape[1]).reshape(shape) + own
            scale = np.bincount(cells, value * value, shape[0] * shape[1]).reshape(shape).max(axis=0) + own
            # Differences of squares err by far less than SLACK times what they are taken of.
            radius = np.sqrt(np.maximum(away.max(axis=0), 0) + SLACK * scale)
            number = len(self.balls)
            self.balls.append(Ball(first, last))
            self.centroids.append((used, centroid[used]))
            self.radii.append(radius)
            if parent is not None:
                ball, side = parent
                self.balls[ball].halves = (number, -1) if side == 0 else (self.balls[ball].halves[0], number)
            if len(rows) <= self.leaf:
                continue
            far = away.sum(axis=1)
            if far.max() <= SLACK * scale.sum():
                continue  # copies of one vector
            squares = np.bincount(row, value * value, len(rows))
            pivots = [int(far.argmax())]
            near = []
            for k in range(2):
                pivot = np.zeros(width)
                mine = row == pivots[k]
                pivot[place[mine]] = value[mine]
                near.append(squares - 2 * np.bincount(row, value * pivot[place], len(rows)) + (pivot**2).sum())
                if k == 0:
                    pivots.append(int(near[0].argmax()))
            left = near[0] < near[1]
            cut = int(left.sum())
            if not 0 < cut < len(rows):
                continue
            self.order[first:last] = np.r_[rows[left], rows[~left]]
            todo += [(first + cut, last, (number, 1)), (first, first + cut, (number, 0))]
        row, place, value = self._part(self.order)
        self.place, self.value = place, value.astype(np.int64)
        self.starts = np.searchsorted(row, np.arange(len(self.order) + 1))

    def bounds(self, by_place: tuple[np.ndarray, np.ndarray, np.ndarray], n_items: int, norms: np.ndarray) -> np.ndarray:
        """Upper bounds of the score, a row per ball and a column per item.

        ``by_place`` has the items' entries ordered by place: where each place begins, item, count; ``norms``
        are the items' by group.
        """
        starts, item, count = by_place
        out = np.empty((len(self.balls), n_items))
        for k, ((place, value), radius) in enumerate(zip(self.centroids, self.radii)):
            sizes = starts[place + 1] - starts[place]
            within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            at = np.repeat(starts[place], sizes) + within
            out[k] = np.bincount(item[at], count[at] * np.repeat(value, sizes), n_items)
            out[k] += norms @ radius
        return out * (1 + SLACK) + 1

    def best(self, query: np.ndarray, bounds: np.ndarray, rank: np.ndarray, k: int) -> tuple[list[tuple[int, int]], int]:
        """The k best rows as (score, row) by falling score, then rank; and the number of leaves looked at.

        ``query`` holds a whole number for each place. Scores of zero or less do not count.
        """
        found: list[tuple[int, int]] = []  # heap of (score, -rank): the worst is on top
        todo = [(-bounds[0], 0)] if self.balls else []
        visited = 0
        while todo:
            bound, number = heapq.heappop(todo)
            if len(found) == k and -bound < found[0][0]:
                break
            ball = self.balls[number]
            if ball.halves:
                for half in ball.halves:
                    heapq.heappush(todo, (-bounds[half], half))
                continue
            visited += 1
            a, b = self.starts[ball.first], self.starts[ball.last]
            scores = np.add.reduceat(self.value[a:b] * query[self.place[a:b]], self.starts[ball.first : ball.last] - a)
            least = found[0][0] if len(found) == k else 1
            for at in np.flatnonzero(scores >= least):
                entry = (int(scores[at]), -int(rank[self.order[ball.first + at]]))
                if len(found) < k:
                    heapq.heappush(found, entry)
                elif entry > found[0]:
                    heapq.heapreplace(found, entry)
        return sorted(found, key=lambda e: (-e[0], -e[1])), visited


@dataclass(frozen=True)
class Corpus:
    """Documents with a term, all their terms, and the documents that hold each term of the vocabulary."""

    docs: int
    terms: int
    holding: np.ndarray

    def weights(self) -> np.ndarray:
        return np.array([math.floor(1000 * math.log((2 * self.docs + 2) / (2 * d + 1))) for d in self.holding.tolist()], np.int64)

    def impacts(self, sizes: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Of terms that stand ``numbers`` times in documents of ``sizes`` terms."""
        length = 100 - 25 + (25 * sizes * self.docs) // self.terms
        return (1_000_000_000 * numbers) // (1000 * numbers + 12 * length)


def _search(items, corpus: Corpus, k: int):
    """Rows of doc_id, n, places, numbers become the k best documents of each item in each tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared: Items = items.value
        weights = corpus.weights()
        band = np.minimum(np.log2(corpus.docs / np.maximum(corpus.holding, 1)), BANDS - 1).astype(np.int64)
        groups = band * BAND_GROUPS + np.arange(len(band)) % BAND_GROUPS
        n_groups = int(groups.max(initial=0)) + 1
        place, count = np.concatenate(shared.places), np.concatenate(shared.counts)
        item = np.repeat(np.arange(len(shared.ids)), [len(p) for p in shared.places])
        order = np.argsort(place, kind="stable")
        by_place = np.searchsorted(place[order], np.arange(len(weights) + 1)), item[order], count[order].astype(float)
        cells = item * n_groups + groups[place]
        norms = np.sqrt(np.bincount(cells, count.astype(float) ** 2, len(shared.ids) * n_groups)).reshape(-1, n_groups)

        def searched(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            sizes = np.asarray(pc.list_value_length(rows["places"]), np.int64)
            places = np.asarray(pc.list_flatten(rows["places"]), np.int64)
            numbers = np.asarray(pc.list_flatten(rows["numbers"]), np.int64)
            values = corpus.impacts(np.repeat(np.asarray(rows["n"], np.int64), sizes), numbers) * weights[places]
            tree = Tree(sizes, places, values, groups)
            # Ties go by doc_id, nulls last, whatever its type.
            rank = np.empty(len(rows), np.int64)
            rank[np.asarray(pc.sort_indices(rows["doc_id"], null_placement="at_end"))] = np.arange(len(rows))
            back = np.argsort(rank)
            bounds = tree.bounds(by_place, len(shared.ids), norms)
            query = np.zeros(len(weights), np.int64)
            found = []
            for i, (p, c) in enumerate(zip(shared.places, shared.counts)):
                query[p] = c
                found += [(i, back[-r], s) for s, r in tree.best(query, bounds[:, i], rank, k)[0]]
                query[p] = 0
            number, row, score = (np.array(x, np.int64) for x in (zip(*found) if found else ([], [], [])))
            taken = rows["doc_id"].combine_chunks().take(pa.array(row))
            return pa.RecordBatch.from_arrays([pa.array(number), taken, pa.array(score)], ["item", "doc_id", "score"])

        held, n_docs, n_entries = [], 0, 0
        for batch in batches:
            held.append(batch)
            n_docs += batch.num_rows
            n_entries += pc.sum(pc.list_value_length(batch.column(2))).as_py() or 0
            if n_docs >= TREE_DOCS or n_entries >= TREE_ENTRIES:
                yield searched(pa.Table.from_batches(held))
                held, n_docs, n_entries = [], 0, 0
        if held:
            yield searched(pa.Table.from_batches(held))

    return run


def _search_block(docs: DataFrame, items: Items, k: int) -> DataFrame:
    """(item_id, doc_id, score) of the k best documents of each item of one block; lists of trees are not yet merged."""
    sc, kind = docs.sparkSession.sparkContext, docs.schema["doc_id"].dataType
    read = T.StructType([T.StructField("doc_id", kind), T.StructField("n", T.LongType())])
    read = read.add("places", T.ArrayType(T.IntegerType())).add("numbers", T.ArrayType(T.IntegerType()))
    vectors = stored(docs.mapInArrow(_vectors(sc.broadcast(items.vocabulary)), read), "term-vectors")
    sizes = vectors.filter("n > 0").agg(F.count("*"), F.sum("n")).first()
    holding = np.zeros(len(items.vocabulary), np.int64)
    # As many rows as the block's vocabulary.
    for row in vectors.select(F.explode("places").alias("p")).groupBy("p").agg(F.count("*").alias("n")).toLocalIterator():
        holding[row["p"]] = row["n"]
    corpus = Corpus(sizes[0], sizes[1] or 0, holding)
    out = T.StructType([T.StructField("item", T.LongType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())])
    return vectors.filter(F.size("places") > 0).mapInArrow(_search(sc.broadcast(items), corpus, k), out)


def search(
    docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id"
) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of each item, of all documents.

    Equal scores go by ascending doc_id (null last); documents without a term of the item are not returned.
    Null and empty texts have no terms. Repeated documents are all ranked. Items that are equal in id and text
    are one; different texts under one id are ranked each for itself. Texts of any length are read whole.
    Empty tables give no rows. Other columns, whatever their names, are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    items = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{text}`").alias("text")).distinct()
    size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n_blocks = max(1, -(-size[0] // BLOCK_ITEMS), -(-size[1] // BLOCK_BYTES))
    kind = items.schema["item_id"].dataType
    found = None
    for block in range(n_blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block).collect()
        shared = Items.of([tuple(r) for r in rows])
        if not shared.vocabulary:
            continue
        hits = _search_block(docs, shared, k)
        schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", kind)])
        names = spark.createDataFrame(list(enumerate(shared.ids)), schema)
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        merge = F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGES))
        some = hits.withColumn("merge", merge)
        some = some.withColumn("rank", F.row_number().over(Window.partitionBy("item", "merge").orderBy(*order))).filter(F.col("rank") <= k)
        best = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
        part = stored(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "ranked")
        found = part if found is None else found.unionByName(part)
    if found is None:
        schema = T.StructType([T.StructField("item_id", kind), T.StructField("rank", T.IntegerType())])
        found = spark.createDataFrame([], schema.add("doc_id", docs.schema["doc_id"].dataType).add("score", T.LongType()))
    return found
