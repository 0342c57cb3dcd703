"""Exact removal of repeated byte strings by a sparse suffix array, sorted deep-shallow.

Every string of ``length`` bytes (a window) has an anchor: its first least gram by hash. Equal windows have equal
anchors at equal places, so windows can only be equal where an anchor's gram occurs in several documents.
The suffixes that matter are therefore the windows at such anchors, dealt out by gram; all windows that
could be equal meet in one bucket. There they are sorted deep-shallow: multikey quicksort, on symbols of
eight bytes, orders them to a shallow depth, and blind tries order the groups that still agree. Windows that
agree to full depth are neighbours, and all but those of the smallest document are marked.

Texts travel as chunks of about a megabyte, each a table row. Within a chunk, equal stretches of windows are
sent once, by their first document: later ones are copies of it already. So a passage that a third of all
documents share comes to its bucket once per chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.store import stored

LENGTH = 50
GRAM = 24
#: Bytes of text in a chunk; a longer document is a chunk of its own.
CHUNK = 1 << 20
#: Bytes of text for each bucket that windows are dealt to.
BUCKET = 6 << 20
#: Window starts handled in one numpy pass; below 2^24, as places share a word with the gram's hash.
PASS = 1 << 18
#: Bytes sorted by multikey quicksort before blind tries take over.
SHALLOW = 16
#: Stands for a missing id, which is larger than all others.
LAST = (1 << 63) - 1

_PLACE_BITS = 24
_MIX = 0x9E3779B97F4A7C15
_LETTERS = np.random.default_rng(1).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_MIX, n, 1 << 64))


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at each place, by doubling."""
    eight = _LETTERS[data]
    for size in (1, 2, 4):
        eight = eight[:-size] * _power(size) + eight[size:]
    grams = (eight[:-16] * _power(8) + eight[8:-8]) * _power(8) + eight[16:]
    grams ^= grams >> np.uint64(32)
    grams *= np.uint64(0xD6E8FEB86659FD93)
    grams ^= grams >> np.uint64(32)
    return grams


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of the ``width`` values from each place on."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


class Stretches:
    """Maximal runs of a chunk's windows with the same anchor: first start, windows, document, gram hash."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        parts = []
        starts = len(data) - LENGTH + 1
        for at in range(0, max(starts, 0), PASS):
            stop = min(at + PASS, starts)
            grams = _gram_hashes(data[at : stop + LENGTH - 1])
            places = np.arange(len(grams), dtype=np.uint64)
            keys = (grams >> np.uint64(_PLACE_BITS)) << np.uint64(_PLACE_BITS) | places
            anchor = (_least(keys, LENGTH - GRAM + 1) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
            window = np.arange(at, stop)
            doc = np.searchsorted(ends, window, side="right")
            whole = np.flatnonzero(window + LENGTH <= ends[doc])
            if not len(whole):
                continue
            own = anchor[whole]
            new = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (whole[1:] != whole[:-1] + 1)])
            # Anchors have small hashes by choice; mixed again, they spread evenly over the buckets.
            spread = grams[own[new]] * np.uint64(_MIX)
            spread ^= spread >> np.uint64(32)
            parts.append((window[whole[new]], np.diff(np.r_[new, len(whole)]), doc[whole[new]], spread * np.uint64(_MIX)))
        none = np.zeros(0, np.int64)
        self.start, self.windows, self.doc, self.gram = (
            (np.concatenate(p) for p in zip(*parts)) if parts else (none, none, none, np.zeros(0, np.uint64))
        )

    def __len__(self) -> int:
        return len(self.start)


def _bucket(grams: np.ndarray, buckets: int) -> np.ndarray:
    return ((grams >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _slices(grams: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Buckets that occur among sorted grams, with their part."""
    of = _bucket(grams, buckets).astype(np.int64)
    bounds = np.flatnonzero(np.r_[True, of[1:] != of[:-1], True]) if len(of) else []
    for a, b in zip(bounds[:-1], bounds[1:]):
        yield int(of[a]), slice(a, b)


def _chunks(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(chunk, ids, sizes, data): texts of a task's documents one after another, about CHUNK bytes a row."""

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 33
        ids, texts, held = [], [], 0

        def row() -> pd.DataFrame:
            sizes = np.array([len(t) for t in texts], np.int64).tobytes()
            return pd.DataFrame({"chunk": [number], "ids": [np.array(ids, np.int64).tobytes()], "sizes": [sizes], "data": [b"".join(texts)]})

        for batch in batches:
            for doc, body in zip(batch["id"], batch["text"]):
                raw = body.encode("utf-8", "replace") if body else b""
                if texts and held + len(raw) > CHUNK:
                    yield row()
                    number, ids, texts, held = number + 1, [], [], 0
                ids.append(doc)
                texts.append(raw)
                held += len(raw)
        if texts:
            yield row()

    rows = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(LAST)).alias("id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInPandas(gather, "chunk long, ids binary, sizes binary, data binary")


def _ends(sizes: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(sizes, np.int64))


def _chunk_grams(buckets: int):
    """The distinct anchor grams of each chunk, six bytes each, by bucket."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk, sizes, data in zip(batch["chunk"], batch["sizes"], batch["data"]):
                grams = np.unique(Stretches(np.frombuffer(data, np.uint8), _ends(sizes)).gram)
                rows = [
                    (chunk, bucket, grams[part].view(np.uint8).reshape(-1, 8)[:, :6].tobytes())
                    for bucket, part in _slices(grams, buckets)
                ]
                yield pd.DataFrame(rows, columns=["chunk", "bucket", "grams"])

    return scan


def _shared_grams(batch: pd.DataFrame) -> pd.DataFrame:
    """For each chunk's grams of one bucket, a bit for each that another chunk has too."""
    counts = [len(g) // 6 for g in batch["grams"]]
    wide = np.zeros((sum(counts), 8), np.uint8)
    wide[:, :6] = np.frombuffer(b"".join(batch["grams"]), np.uint8).reshape(-1, 6)
    grams = wide.view(np.uint64).ravel()
    order = np.argsort(grams, kind="stable")
    same = grams[order][1:] == grams[order][:-1]
    shared = np.zeros(len(grams), bool)
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    bounds = np.cumsum([0, *counts])
    bits = [np.packbits(shared[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
    some = [bool(shared[a:b].any()) for a, b in zip(bounds[:-1], bounds[1:])]
    return pd.DataFrame({"chunk": batch["chunk"], "bucket": batch["bucket"], "bits": bits})[some]


def _candidates(stretches: Stretches, flags: list, buckets: int) -> np.ndarray:
    """Stretches whose gram another chunk, or another document of this one, has too."""
    grams, which = np.unique(stretches.gram, return_inverse=True)
    shared = np.zeros(len(grams), bool)
    bits = {f["bucket"]: f["bits"] for f in flags}
    for bucket, part in _slices(grams, buckets):
        if bucket in bits:
            shared[part] = np.unpackbits(np.frombuffer(bits[bucket], np.uint8), count=part.stop - part.start).astype(bool)
    low = np.full(len(grams), LAST)
    high = np.full(len(grams), -1)
    np.minimum.at(low, which, stretches.doc)
    np.maximum.at(high, which, stretches.doc)
    return np.flatnonzero((shared | (low < high))[which])


def _squeezed(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unsqueezed(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


def _pairs(ranges: list[tuple[int, int]] | np.ndarray) -> bytes:
    return np.array(ranges, np.int64).reshape(-1, 2).tobytes()


def _dealt_stretches(buckets: int):
    """For each bucket the chunk's distinct stretches; under negative buckets, windows that are copies within it.

    A stretch is sent once, by its smallest document, with all places it has there. What is dealt out is
    compressed, as stretches overlap and lie in many rows.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk, ids, sizes, raw, flags in zip(batch["chunk"], batch["ids"], batch["sizes"], batch["data"], batch["flags"]):
                found = Stretches(np.frombuffer(raw, np.uint8), _ends(sizes))
                pick = _candidates(found, flags if flags is not None else [], buckets)
                pick = pick[np.argsort(found.gram[pick], kind="stable")]
                docs = np.frombuffer(ids, np.int64)[found.doc[pick]]
                start, windows = found.start[pick], found.windows[pick]
                end = start + windows + LENGTH - 1
                first: dict[bytes, int] = {}
                keys = [raw[a:b] for a, b in zip(start.tolist(), end.tolist())]
                for i, (key, doc) in enumerate(zip(keys, docs.tolist())):
                    j = first.setdefault(key, i)
                    if doc < docs[j]:
                        first[key] = i
                lead = np.array([first[key] for key in keys], np.int64)
                later = docs > docs[lead] if len(lead) else np.zeros(0, bool)
                copies = _pairs(np.stack([start[later], (start + windows)[later]], axis=1))
                rows = [(-1 - chunk % buckets, chunk, b"", b"", b"", b"", b"", _squeezed(copies))]
                places: dict[int, list[int]] = {}
                for i in np.flatnonzero(~later).tolist():
                    places.setdefault(int(lead[i]), []).append(int(start[i]))
                sent = np.array(sorted(places), np.int64)
                for bucket, part in _slices(found.gram[pick][sent], buckets):
                    own = sent[part].tolist()
                    rows.append(
                        (
                            bucket, chunk,
                            found.gram[pick][own].tobytes(), _squeezed(docs[own].tobytes()),
                            _squeezed(np.array([len(keys[i]) for i in own], np.int64).tobytes()),
                            _squeezed(b"".join([keys[i] for i in own])),
                            _squeezed(np.array([len(places[i]) for i in own], np.int64).tobytes()),
                            _squeezed(np.array([p for i in own for p in places[i]], np.int64).tobytes()),
                        )
                    )
                yield pd.DataFrame(rows, columns=STRETCH_COLUMNS)

    return scan


STRETCH_COLUMNS = ["bucket", "chunk", "grams", "docs", "lengths", "data", "repeats", "places"]
STRETCHES = "bucket long, chunk long, grams binary, docs binary, lengths binary, data binary, repeats binary, places binary"


def blind_trie_order(strings: list[bytes]) -> list[bytes]:
    """Distinct strings of one length in order, by a trie that keeps only the places where they branch.

    A string runs down the trie looking at branching places alone, is compared once with the leaf it ends
    at, and is put in where it first differs.
    """
    root: list | bytes = strings[0]  # a node is [place, {byte: node or leaf}]
    for s in strings[1:]:
        node = root
        while isinstance(node, list):
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        place = next(i for i, (a, b) in enumerate(zip(s, node)) if a != b)
        above, node = None, root
        while isinstance(node, list) and node[0] < place:
            above, node = node, node[1][s[node[0]]]
        if isinstance(node, list) and node[0] == place:
            node[1][s[place]] = s
            continue
        other = node
        while isinstance(other, list):
            other = next(iter(other[1].values()))
        split = [place, {other[place]: node, s[place]: s}]
        if above is None:
            root = split
        else:
            above[1][s[above[0]]] = split
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if isinstance(node, bytes):
            out.append(node)
        else:
            todo += [node[1][b] for b in sorted(node[1], reverse=True)]
    return out


def sorted_windows(data: bytes, starts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Deep-shallow sort of the windows at ``starts``: their order, and where in it a new string begins."""
    text = np.frombuffer(data, np.uint8)
    order = np.arange(len(starts))
    fresh = np.zeros(len(starts), bool)
    fresh[:1] = True
    # Multikey quicksort: groups that agree so far are sorted by their next eight bytes, all groups at once.
    for depth in range(0, min(SHALLOW, length - 7), 8):
        group = np.cumsum(fresh) - 1
        open_ = np.flatnonzero(np.bincount(group)[group] > 1)
        if not len(open_):
            break
        at = starts[order[open_]] + depth
        symbol = np.zeros(len(at), np.uint64)
        for k in range(8):
            symbol = symbol << np.uint64(8) | text[at + k].astype(np.uint64)
        inner = np.lexsort((symbol, group[open_]))
        order[open_] = order[open_][inner]
        symbol = symbol[inner]
        fresh[open_[1:]] |= symbol[1:] != symbol[:-1]
    # Blind tries: groups that agree to the shallow depth.
    bounds = np.flatnonzero(np.r_[fresh, True])
    deep = np.flatnonzero(np.diff(bounds) > 1)
    for a, b in zip(bounds[deep].tolist(), bounds[deep + 1].tolist()):
        members = order[a:b].tolist()
        by_string: dict[bytes, list[int]] = {}
        for m, s in zip(members, starts[order[a:b]].tolist()):
            by_string.setdefault(data[s + SHALLOW : s + length], []).append(m)
        if len(by_string) == 1:
            continue
        at = a
        for s in blind_trie_order(list(by_string)):
            same = by_string[s]
            order[at : at + len(same)] = same
            fresh[at] = True
            at += len(same)
    return order, fresh


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _marked_windows(batch: pd.DataFrame) -> pd.DataFrame:
    """Ranges of window starts, by chunk, that a smaller document of this bucket has too."""
    if len(batch) and batch["bucket"].iloc[0] < 0:
        return pd.DataFrame({"chunk": batch["chunk"], "marks": [_unsqueezed(p) for p in batch["places"]]})
    kinds: dict[bytes, int] = {}  # gram and stretch
    data: list[bytes] = []
    least: list[int] = []
    per_gram: dict[bytes, int] = {}
    entries = []  # (row of batch, kind, doc, places)
    for row, (grams, *squeezed) in enumerate(
        zip(batch["grams"], batch["docs"], batch["lengths"], batch["data"], batch["repeats"], batch["places"])
    ):
        docs, lengths, raw, repeats, places = map(_unsqueezed, squeezed)
        ends = np.cumsum(np.frombuffer(lengths, np.int64)).tolist()
        upto = np.cumsum(np.frombuffer(repeats, np.int64)).tolist()
        places = np.frombuffer(places, np.int64).tolist()
        a = p = 0
        for i, (doc, b, q) in enumerate(zip(np.frombuffer(docs, np.int64).tolist(), ends, upto)):
            gram = grams[8 * i : 8 * i + 8]
            stretch = raw[a:b]
            kind = kinds.setdefault(gram + stretch, len(data))
            if kind == len(data):
                data.append(stretch)
                least.append(doc)
                per_gram[gram] = per_gram.get(gram, 0) + 1
            elif doc < least[kind]:
                least[kind] = doc
            entries.append((row, kind, doc, places[p:q]))
            a, p = b, q
    # Stretches that are alone under their gram have no window in common with another.
    several = [kind for key, kind in kinds.items() if per_gram[key[:8]] > 1]
    own: dict[int, list[tuple[int, int]]] = {}
    if several:
        sizes = np.array([len(data[k]) for k in several])
        windows = sizes - LENGTH + 1
        base = np.cumsum(sizes) - sizes
        first = np.cumsum(windows) - windows
        starts = np.arange(windows.sum()) + np.repeat(base - first, windows)
        docs = np.repeat(np.array([least[k] for k in several], np.int64), windows)
        order, fresh = sorted_windows(b"".join([data[k] for k in several]), starts)
        smallest = np.minimum.reduceat(docs[order], np.flatnonzero(fresh))
        marked = np.zeros(len(starts), bool)
        marked[order] = docs[order] > smallest[np.cumsum(fresh) - 1]
        for kind, a, n in zip(several, first.tolist(), windows.tolist()):
            own[kind] = _runs(marked[a : a + n])
    out: dict[int, list[tuple[int, int]]] = {}
    for row, kind, doc, places in entries:
        runs = [(0, len(data[kind]) - LENGTH + 1)] if doc > least[kind] else own.get(kind, ())
        if runs:
            out.setdefault(row, []).extend((p + a, p + b) for p in places for a, b in runs)
    chunks = batch["chunk"].tolist()
    return pd.DataFrame({"chunk": [chunks[r] for r in out], "marks": [_pairs(m) for m in out.values()]})


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per document: sizes, removed bytes and runs, and the hash of the bytes that stay."""
    for batch in batches:
        for ids, sizes, raw, marks in zip(batch["ids"], batch["sizes"], batch["data"], batch["marks"]):
            depth = np.zeros(len(raw) + 1, np.int32)
            for m in marks if marks is not None else ():
                ranges = np.frombuffer(m, np.int64).reshape(-1, 2)
                np.add.at(depth, ranges[:, 0], 1)
                np.add.at(depth, ranges[:, 1] + LENGTH - 1, -1)
            gone = np.cumsum(depth)[:-1] > 0
            data = np.frombuffer(raw, np.uint8)
            rows, a = [], 0
            for doc, b in zip(np.frombuffer(ids, np.int64).tolist(), _ends(sizes).tolist()):
                part = gone[a:b]
                removed = int(np.count_nonzero(part))
                spans = len(_runs(part)) if removed else 0
                kept = data[a:b][~part].tobytes() if removed else raw[a:b]
                rows.append((doc, b - a, removed, spans, hashlib.sha256(kept).hexdigest(), kept))
                a = b
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


#: Chunks per Arrow batch, as each is megabytes.
_FEW = {"spark__sql__execution__arrow__maxRecordsPerBatch": "4"}


def marked_chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(chunk, ids, sizes, data, marks): all texts with the ranges of window starts to cover."""
    chunks = stored(_chunks(docs, doc_id, text), "chunks")
    total = chunks.agg(F.sum(F.length("data"))).first()[0] or 0
    buckets = total // BUCKET + 1
    grams = chunks.select("chunk", "sizes", "data").mapInPandas(_chunk_grams(buckets), "chunk long, bucket long, grams binary")
    shared = grams.groupBy("bucket").applyInPandas(_shared_grams, "chunk long, bucket long, bits binary")
    flags = stored(shared, "flags", **_FEW).groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias("flags"))
    dealt = chunks.join(flags, "chunk", "left").select("chunk", "ids", "sizes", "data", "flags").mapInPandas(_dealt_stretches(buckets), STRETCHES)
    marks = stored(dealt.groupBy("bucket").applyInPandas(_marked_windows, "chunk long, marks binary"), "marks", **_FEW)
    return chunks.join(marks.groupBy("chunk").agg(F.collect_list("marks").alias("marks")), "chunk", "left")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_bytes: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept bytes, a row per row of ``docs``.

    A byte goes if a string of 50 bytes over it also starts in a document with a smaller id. Null texts
    are empty. Rows of equal id never remove from each other; a null id is larger than all others. Cuts may
    fall inside a character, so what is kept is bytes.
    """
    columns = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    chunks = marked_chunks(docs, doc_id, text).select("ids", "sizes", "data", "marks")
    out = stored(chunks.mapInPandas(_digests, columns).drop(*([] if with_bytes else ["kept"])), "kept", **_FEW)
    kind = docs.select(F.col(f"`{doc_id}`")).schema[0].dataType
    return out.withColumn("doc_id", F.when(F.col("doc_id") != LAST, F.col("doc_id")).cast(kind))
