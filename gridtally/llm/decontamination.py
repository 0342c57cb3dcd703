"""Benchmark decontamination: size-partitioned MinHash containment search with an exact check.

A test item counts as found in a document that holds at least ``THRESHOLD`` of its word shingles, wherever
they stand. An item's MinHash sketch is its least shingle hashes, one more than it may lack, so every
document that contains the item holds a hash of its sketch: the search misses nothing, however long the
document. Items are partitioned by the number of shingles a document must hold; a document is only probed
for partitions it is long enough for. What a sketch brings up is verified by counting common shingles.

The items are a stated query set. They are taken in blocks of bounded size; each block is one pass over
all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import repeat
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE = 5
THRESHOLD = 0.8
#: Bytes of item text in one block, which is collected and broadcast.
BLOCK_BYTES = 8 << 20

_WORDS = re.compile(r"[^\W_]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    """Lower-case runs of letters and digits."""
    return _WORDS.findall(text.lower()) if text else []


def _hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` word ids; runs with an unknown word (id 0) get the greatest number."""
    starts = len(ids) - size + 1
    mixed, known = np.zeros(starts, np.uint64), np.ones(starts, bool)
    for k in range(size):
        part = ids[k : k + starts]
        mixed = (mixed ^ part.astype(np.uint64)) * _ODD
        mixed ^= mixed >> np.uint64(29)
        known &= part > 0
    mixed[~known] = ~np.uint64(0)
    return mixed


class Items:
    """Sketches and shingles of one block of items."""

    def __init__(self, texts: list[str | None], shingle: int = SHINGLE, threshold: float = THRESHOLD):
        self.word_ids: dict[str, int] = {}
        self.grams: list[frozenset[bytes]] = []
        self.needed: list[int] = []
        sketched: dict[int, list[tuple[int, int, int]]] = {}  # shingle words -> (documents need, hash, item)
        for item, text in enumerate(texts):
            ids = np.array([self.word_ids.setdefault(w, len(self.word_ids) + 1) for w in words(text)], np.int32)
            size = min(shingle, len(ids))
            rows, hashes = self._runs(ids, size)
            self.grams.append(frozenset(rows))
            self.needed.append(ceil(threshold * len(self.grams[-1]) - 1e-9))
            if size:
                lacking = len(self.grams[-1]) - self.needed[-1]
                for h in np.unique(hashes)[: lacking + 1].tolist():
                    sketched.setdefault(size, []).append((self.needed[-1], h, item))
        #: By shingle words: partitions of (documents need at least, sorted hashes, items of each hash).
        self.partitions = {size: self._partition(entries) for size, entries in sketched.items()}

    @staticmethod
    def _runs(ids: np.ndarray, size: int) -> tuple[list[bytes], np.ndarray]:
        if not size:
            return [], np.zeros(0, np.uint64)
        runs = np.lib.stride_tricks.sliding_window_view(ids, size)
        return [r.tobytes() for r in runs], _hashes(ids, size)

    @staticmethod
    def _partition(entries: list[tuple[int, int, int]]) -> list[tuple[int, np.ndarray, dict[int, list[int]]]]:
        classes: dict[int, list[tuple[int, int, int]]] = {}
        for entry in entries:
            classes.setdefault(entry[0].bit_length(), []).append(entry)
        out = []
        for _, members in sorted(classes.items()):
            of: dict[int, list[int]] = {}
            for _, h, item in members:
                of.setdefault(h, []).append(item)
            out.append((min(n for n, _, _ in members), np.array(sorted(of), np.uint64), of))
        return out

    def found_in(self, text: str | None) -> list[tuple[int, int]]:
        """(item, common shingles) of every item that the text contains."""
        body = words(text)
        ids = np.fromiter(map(self.word_ids.get, body, repeat(0)), np.int32, len(body))
        out = []
        for size, partitions in self.partitions.items():
            if len(ids) < size:
                continue
            hashes = _hashes(ids, size)
            at = np.flatnonzero(hashes != ~np.uint64(0))
            if not len(at):
                continue
            probes = np.unique(hashes[at])
            candidates: set[int] = set()
            for least, sketch, of in partitions:
                if len(probes) < least:
                    break
                place = np.searchsorted(sketch, probes)
                place[place == len(sketch)] = 0
                for h in probes[sketch[place] == probes].tolist():
                    candidates.update(of[h])
            if candidates:
                runs = np.lib.stride_tricks.sliding_window_view(ids, size)[at]
                grams = {r.tobytes() for r in runs}
                shared = ((item, len(self.grams[item] & grams)) for item in sorted(candidates))
                out += [(item, n) for item, n in shared if n >= self.needed[item]]
        return out


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list]:
    """Items with a text, in blocks of about BLOCK_BYTES, as rows (id as text, text)."""
    rows = items.select(F.col(f"`{item_id}`").cast("string").alias("id"), F.col(f"`{text}`").alias("text"))
    rows = rows.filter("text is not null")
    total = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    count = -(-total // BLOCK_BYTES)
    for k in range(count):
        yield rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == k).collect()


def find(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """doc_id, item_id, n_shingles, n_shared, containment: a row per document and item it contains.

    Words are lower-case runs of letters and digits. An item of fewer than five words is one shingle of
    its own length; one without words is in no document. Null texts contain nothing and are contained in
    nothing. Repeated rows of either table give repeated pairs.
    """
    id_type = items.select(F.col(f"`{item_id}`")).schema[0].dataType
    doc_type = docs.select(F.col(f"`{doc_id}`")).schema[0].dataType
    rows = docs.select(F.col(f"`{doc_id}`").cast("string").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    context = docs.sparkSession.sparkContext
    columns = ["doc_id", "item_id", "n_shingles", "n_shared"]
    schema = "doc_id string, item_id string, n_shingles long, n_shared long"

    def search(block: list) -> DataFrame:
        shared = context.broadcast((Items([r["text"] for r in block]), [r["id"] for r in block]))

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held, names = shared.value
            for batch in batches:
                out = [
                    (doc, names[item], len(held.grams[item]), n)
                    for doc, body in zip(batch["doc_id"], batch["text"])
                    for item, n in held.found_in(body)
                ]
                yield pd.DataFrame(out, columns=columns)

        return rows.mapInPandas(scan, schema)

    passes = [search(block) for block in _blocks(items, item_id, item_text)]
    none = docs.sparkSession.createDataFrame([], schema)
    pairs = reduce(DataFrame.unionByName, passes) if passes else none
    return pairs.select(
        F.col("doc_id").cast(doc_type), F.col("item_id").cast(id_type), "n_shingles", "n_shared",
        (F.col("n_shared") / F.col("n_shingles")).alias("containment"),
    )


def _contains(items: Items, context, text: str) -> Column:
    shared = context.broadcast(items)

    @F.pandas_udf("boolean")
    def contains(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([bool(shared.value.found_in(t)) for t in texts], dtype=bool)

    return contains(F.col(f"`{text}`"))


def keep_clean(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents that contain no item, as they came; null and empty texts stay."""
    context = docs.sparkSession.sparkContext
    for block in _blocks(items, item_id, item_text):
        docs = docs.filter(~_contains(Items([r["text"] for r in block]), context, text))
    return docs
