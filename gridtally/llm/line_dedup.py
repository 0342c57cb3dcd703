"""Line deduplication by a suffix array over line ids, built by distributed prefix doubling.

Every document is the sequence of its non-blank lines' ids; lines that occur once break it up, since no
repeat runs through them. Round k ranks all starts by their next 2^k lines: a start's pair of ranks from
the round before is its key, range-sorted, and starts whose key is alone leave. So each round's ranks are
the suffix array to that depth without its singletons, and starts of equal rank are an interval of longest
common prefix 2^k or more. A run of m lines is named by the ranks of the two halves, overlapping if need
be, of the greatest power of two in m: equal names are the intervals of depth m.

A run is long enough with ``min_words`` words. It suffices to name, at each line, the shortest such run that
starts there and the shortest that ends there: they cover all longer ones, so together the repeated
ones make up the maximal repeated runs. All copies but the first are deleted.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.session import saved

MIN_WORDS = 50
#: Rank of documents without an id in the order of copies: they come last.
LAST = (1 << 63) - 1

PLACE = ["o", "d"]
#: What names a run: its lines, and the ranks of its halves.
RUN = ["m", "a", "b"]
#: A run is common with more than one in so many of all copies.
COMMON = 1000


def _order(doc_id: str) -> Column:
    return F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(LAST))


def _document(doc_id: str, text: str) -> Column:
    """Names a document by content, so rows that repeat it are one document."""
    return F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))


def _shortest(n_words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines of the shortest run of ``least`` words that starts, and that ends, at each line; 0 for none."""
    total = np.concatenate([[0], np.cumsum(n_words)])
    n = len(n_words)
    end = np.searchsorted(total, total[:-1] + least)
    forward = np.where(end <= n, end - np.arange(n), 0)
    start = np.searchsorted(total, total[1:] - least, side="right") - 1
    return forward, np.where(start >= 0, np.arange(1, n + 1) - start, 0)


def _lines(docs: DataFrame, doc_id: str, text: str, min_words: int) -> DataFrame:
    """o, d, q (place among the non-blank lines), a 128-bit line hash, and the run lengths at each line."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts, hashes, runs = [], [], []
            for body in batch["text"]:
                lines = [x for x in body.encode("utf-8", "replace").split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
                counts.append(len(lines))
                hashes += map(xxhash.xxh3_128_digest, lines)
                runs.append(_shortest(np.array([len(x.split()) for x in lines], np.int64), min_words))
            if not hashes:
                continue
            digests = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            first = np.cumsum(counts) - counts
            yield pd.DataFrame(
                {
                    "o": np.repeat(batch["o"].to_numpy(), counts), "d": np.repeat(batch["d"].to_numpy(), counts),
                    "q": np.arange(len(digests)) - np.repeat(first, counts), "h1": digests[:, 0], "h2": digests[:, 1],
                    "forward": np.concatenate([f for f, _ in runs]), "back": np.concatenate([b for _, b in runs]),
                }
            )

    rows = docs.select(_order(doc_id).alias("o"), _document(doc_id, text).alias("d"), F.col(f"`{text}`").alias("text"))
    return rows.filter("text <> ''").mapInPandas(split, "o long, d long, q long, h1 long, h2 long, forward long, back long")


def _ranked(keys: DataFrame, order: list[str]) -> DataFrame:
    """Distinct keys with a rank that keeps their order."""
    placed = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    return saved(placed.withColumn("rank", F.monotonically_increasing_id()), "ranks")


def _shifted(ranks: DataFrame, by: int | Column, name: str) -> DataFrame:
    """The ranks of the starts ``by`` lines on, at the start they belong to."""
    return ranks.select(*PLACE, (F.col("q") - by).alias("q"), F.col("rank").alias(name))


def _rank_levels(lines: DataFrame, longest: int) -> list[DataFrame]:
    """(o, d, q, rank) of all starts that share their next 2^k lines with another, for each k up to ``longest`` lines."""
    repeated = lines.groupBy("h1", "h2").count().filter("count > 1").select("h1", "h2")
    first = lines.join(_ranked(repeated, ["h1", "h2"]), ["h1", "h2"]).select(*PLACE, "q", "rank").distinct()
    levels = [saved(first, "level")]
    while 1 << len(levels) <= longest:
        half = 1 << (len(levels) - 1)
        pairs = saved(
            levels[-1].withColumnRenamed("rank", "a").join(_shifted(levels[-1], half, "b"), [*PLACE, "q"]), "pairs"
        )
        shared = pairs.groupBy("a", "b").count().filter("count > 1").select("a", "b")
        levels.append(saved(pairs.join(_ranked(shared, ["a", "b"]), ["a", "b"]).select(*PLACE, "q", "rank"), "level"))
    return levels


def later_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(o, d, runs): for each document with deletions, the runs (first line, end) of its non-blank lines.

    A run is a later copy if a smaller document has it, or the same one earlier and clear of it.
    """
    lines = saved(_lines(docs, doc_id, text, min_words), "lines")
    runs = lines.filter("forward > 0").select(*PLACE, "q", F.col("forward").alias("m"))
    runs = runs.unionByName(lines.filter("back > 0").select(*PLACE, (F.col("q") - F.col("back") + 1).alias("q"), F.col("back").alias("m")))
    # Every line has a word, so no shortest run is longer than min_words lines.
    levels = _rank_levels(lines, max(1, min_words))
    named = []
    for k, ranks in enumerate(levels):
        size = 1 << k
        own = runs.filter((F.col("m") >= size) & (F.col("m") < 2 * size)).distinct()
        heads = own.join(ranks.withColumnRenamed("rank", "a"), [*PLACE, "q"])
        tails = ranks.select(*PLACE, F.col("q").alias("t"), F.col("rank").alias("b"))
        named.append(heads.withColumn("t", F.col("q") + F.col("m") - size).join(tails, [*PLACE, "t"]).drop("t"))
    copies = saved(reduce(DataFrame.unionByName, named), "runs")
    first = copies.groupBy(*RUN).agg(F.min(F.struct("o", "d", "q")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    first = saved(first, "first-copies")
    # Common runs meet their first copy where they lie; so no task of the other join gets more of one run than that share.
    common = F.col("n") * COMMON > copies.count()
    hot = F.broadcast(first.filter(common))  # fewer than COMMON rows
    met = copies.join(hot, RUN).unionByName(copies.join(hot, RUN, "left_anti").join(first.filter(~common), RUN))
    later = met.filter((F.struct("o", "d") != F.struct("first.o", "first.d")) | (F.col("q") >= F.col("first.q") + F.col("m")))
    return later.groupBy(*PLACE).agg(F.array_sort(F.collect_set(F.struct("q", (F.col("q") + F.col("m")).alias("end")))).alias("runs"))


def _cut(body: str, runs: list) -> tuple[str, int, int, int]:
    """What is left of a text, its lines, those deleted, and the maximal deleted runs.

    A blank line goes with the non-blank line before it.
    """
    lines = body.split("\n")
    blank = [not x.strip(" \t\n\x0b\x0c\r") for x in lines]
    gone = np.zeros(len(lines) + 1, np.int64)
    for run in runs:
        gone[run["q"]] += 1
        gone[run["end"]] -= 1
    gone = np.cumsum(gone) > 0
    place, kept, deleted, n_runs = -1, [], False, 0
    for line, empty in zip(lines, blank):
        if not empty:
            place += 1
            n_runs += bool(gone[place]) and not deleted
            deleted = bool(gone[place])
        if not deleted:
            kept.append(line)
    return "\n".join(kept), len(lines), len(lines) - len(kept), n_runs


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(row, kept, n_lines, n_removed, n_runs): each row of ``docs`` as a struct, and its text without later copies.

    Null texts stay null and empty ones empty, with no lines removed. Rows of equal id and text are one
    document and all get its result; of documents with equal ids the smaller content hash counts as the
    earlier, and documents without an id come after all others. Ids must cast to whole numbers. A text is read
    whole, however long; an empty table gives no rows; columns of ``docs`` keep any name, inside ``row``.
    """
    found = later_copies(docs, doc_id, text, min_words)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{text}`").alias("body"), _order(doc_id).alias("o"), _document(doc_id, text).alias("d"),
    )

    @F.pandas_udf("kept string, n_lines long, n_removed long, n_runs long")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for bodies, runs in batches:
            out = [(None, 0, 0, 0) if b is None else _cut(b, r if r is not None else []) for b, r in zip(bodies, runs)]
            yield pd.DataFrame(out, columns=["kept", "n_lines", "n_removed", "n_runs"])

    # Filters on the result must not be pushed below it, which would cut every text twice.
    joined = rows.join(found, PLACE, "left").withColumn("cut", cut.asNondeterministic()("body", "runs"))
    return joined.select("row", "cut.*")


def summary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_lines, n_removed, n_runs and the SHA-256 of what is left, a row per row of ``docs``."""
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    out = dedup(narrow, min_words=min_words)
    kept = F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256)
    return out.select("row.doc_id", "n_lines", "n_removed", "n_runs", kept.alias("kept_sha256"))
