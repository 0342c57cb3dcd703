"""Best-fit packing of token pieces by minimum bin slack.

A plan needs only how many pieces there are of each length, a table of at most ``capacity`` rows. For each
bin the longest piece left is set, and a subset-sum dynamic program over bitsets finds the fullest
combination of the other available lengths. The combination is used for as many bins as the counts allow,
then removed, until nothing is left. Spark numbers the pieces of each length, so every piece finds its bin
and place in the plan by arithmetic, whatever their number.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtally.session import saved

#: Splitting rule of the byte-level vocabularies (a fixed value of the published files).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END_OF_TEXT = 2
MAX_VOCABULARY_BYTES = 64 << 20


def byte_letters() -> dict[str, int]:
    """The letter each byte has in a byte-level vocabulary file: printable bytes stand for themselves."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteTokenizer:
    """Ids of a byte-level vocabulary in the ``tokenizers`` file format.

    The strings of the file's added tokens are read as plain text, or with ``added`` as the library reads
    them by default. Encodes with tiktoken, which gives the same ids several times faster; what it refuses,
    and texts with an added token, go to the library that the file is written for.
    """

    def __init__(self, spec: str, added: bool = False):
        import tiktoken

        letters = byte_letters()
        read = json.loads(spec)
        special = {t["content"] for t in read["added_tokens"]}
        ranks = {bytes(map(letters.__getitem__, t)): i for t, i in read["model"]["vocab"].items() if t not in special}
        self.fast = tiktoken.Encoding("byte_level", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.spec = spec
        self.added = sorted(special) if added else []
        self.as_text = not added
        self.plain = None

    def ids(self, text: str) -> list[int]:
        if any(token in text for token in self.added):
            return self._library_ids(text)
        try:
            return self.fast.encode_ordinary(text)
        except BaseException as failed:  # a stack or backtracking limit in native code is not an Exception
            if isinstance(failed, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return self._library_ids(text)

    def _library_ids(self, text: str) -> list[int]:
        if self.plain is None:
            from tokenizers import Tokenizer

            self.plain = Tokenizer.from_str(self.spec)
            self.plain.encode_special_tokens = self.as_text
        return self.plain.encode(text, add_special_tokens=False).ids


def tokenized_pieces(docs: DataFrame, vocabulary: str, capacity: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32, and a number by task and length.

    Each document ends with ``END_OF_TEXT``. One longer than ``capacity`` is cut into full pieces from its
    end, so only its first piece is shorter. A null text counts as empty.
    """
    if len(vocabulary) > MAX_VOCABULARY_BYTES:
        raise ValueError("the vocabulary is too large to send to every executor")
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = ByteTokenizer(shared.value, added=True)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows = []
            for doc, body in zip(batch["doc_id"], batch["text"]):
                ids = tokenizer.ids(body) if body else []
                ids.append(END_OF_TEXT)
                stream = np.array(ids, dtype="<u4").data.cast("B")
                start, end = 0, len(ids) % capacity or capacity
                piece = 0
                while start < len(ids):
                    rows.append((doc, piece, start, end - start, zlib.crc32(stream[4 * start : 4 * end]), task, seen[end - start]))
                    seen[end - start] += 1
                    piece, start, end = piece + 1, end, end + capacity
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("string").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    out = rows.mapInPandas(cut, "doc_id string, piece int, start long, length int, ids_crc32 long, task int, nth long")
    kind = docs.select(F.col(f"`{doc_id}`")).schema[0].dataType
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


@dataclass(frozen=True)
class Fill:
    """Pieces ``first..last`` of a length go ``each`` to a bin, from bin ``bin`` on, from ``offset`` in it."""

    length: int
    first: int
    last: int
    each: int
    bin: int
    offset: int


def fullest(left: dict[int, int], capacity: int) -> dict[int, int]:
    """Of the lengths ``left`` (with their numbers), the longest and what fills the rest of a bin best."""
    longest = max(left)
    room = capacity - longest
    mask = (1 << (room + 1)) - 1
    sums, steps = 1, []
    for length in sorted(left, reverse=True):
        number = min(left[length] - (length == longest), room // length)
        copies = 1
        while number > 0:
            copies = min(copies, number)
            steps.append((length, copies, sums))
            sums |= (sums << (length * copies)) & mask
            number -= copies
            copies *= 2
        if sums >> room & 1:
            break
    target = sums.bit_length() - 1
    chosen = {longest: 1}
    for length, copies, before in reversed(steps):
        if not before >> target & 1:
            chosen[length] = chosen.get(length, 0) + copies
            target -= length * copies
    return chosen


def plan(numbers: dict[int, int], capacity: int) -> list[Fill]:
    """Fills that place every piece; bins are numbered from 0 without gaps."""
    left = {length: n for length, n in numbers.items() if n > 0}
    used = dict.fromkeys(left, 0)
    fills, bins = [], 0
    while left:
        chosen = fullest(left, capacity)
        times = min(left[length] // n for length, n in chosen.items())
        offset = 0
        for length, n in sorted(chosen.items(), reverse=True):
            fills.append(Fill(length, used[length], used[length] + n * times - 1, n, bins, offset))
            offset += n * length
            used[length] += n * times
            left[length] -= n * times
            if not left[length]:
                del left[length]
        bins += times
    return fills


def pack(docs: DataFrame, vocabulary: str, capacity: int = 1024, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per piece with its sequence and its place there; ``vocabulary`` is the tokenizer file's text.

    Repeated rows are packed as often as they come. An empty table gives no rows. Other columns of
    ``docs`` are not read.
    """
    spark = docs.sparkSession
    pieces = saved(tokenized_pieces(docs, vocabulary, capacity, doc_id, text), "pieces")
    numbers = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    numbers = saved(numbers.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "numbers")
    by_length = {r["length"]: r["n"] for r in numbers.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    fills = pd.DataFrame(
        [(f.length, f.first, f.last, f.each, f.bin, f.offset) for f in plan(by_length, capacity)],
        columns=["length", "first", "last", "each", "bin", "at"],
    )
    # Fills depend on the lengths that occur, at most ``capacity``, not on how many pieces there are.
    fills = F.broadcast(spark.createDataFrame(fills, "length int, first long, last long, each long, bin long, at long"))
    placed = pieces.join(numbers.select("task", "length", "before"), ["task", "length"])
    placed = placed.withColumn("number", F.col("nth") + F.col("before"))
    placed = placed.join(fills, (placed["length"] == fills["length"]) & F.col("number").between(F.col("first"), F.col("last")))
    turn = F.col("number") - F.col("first")
    return placed.select(
        "doc_id", "piece", "start", pieces["length"].cast("long").alias("length"), "ids_crc32",
        (F.col("bin") + F.floor(turn / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + turn % F.col("each") * pieces["length"]).cast("long").alias("offset"),
    )
