"""SimHash near-duplicates: fingerprints within a few bits, found by segment popcounts in a grid.

A fingerprint is embedded as the vector of set bits of its segments. Fingerprints that differ in d bits lie
within Manhattan distance d there, so the vectors bound the bit distance from below. The grid has one cell
per vector; each fingerprint enters its own cell and the adjacent ones within half the range, and two
fingerprints in range always meet in a cell. Those that meet are joined under the Manhattan bound, and the bit
distance decides.

A crowded cell is not paired out but split by finer segments, down to one bit each, where the vector is the
word itself: two fingerprints at most two bits apart have a common word at most one bit from each, that word's
cell is one of those in which they meet, and at most 65 fingerprints share a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtally.llm.components import components
from gridtally.session import saved

SEED = 42
#: Differing bits at which fingerprints are linked.
RANGE = 2
#: Segments of four bits: a cell is the 64-bit word of sixteen counts from 0 to 4.
SEGMENT_BITS = 4
#: Fingerprints in a cell beyond which it is split; no more than share a word of the finest grid.
CROWDED = 64
#: Shingles whose bits are counted at a time.
PASS = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The text's fingerprint as a signed 64-bit number; zero for a text without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    hashes = np.array([xxhash.xxh64_intdigest(g, SEED) for g in grams], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), PASS):
        bits = np.unpackbits(hashes[at : at + PASS].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(text: str, shingle: int = 3) -> Column:
    """``fingerprint`` of a column, Arrow batch by batch."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype=np.int64)

    return of(F.col(f"`{text}`"))


def _signed(word: int) -> Column:
    return F.lit(word - (1 << 64) if word >> 63 else word).cast("long")


def segment_counts(word: Column) -> Column:
    """Set bits of each four-bit segment, in that segment's place."""
    ones = _signed(0x1111111111111111)
    counts = word.bitwiseAND(ones)
    for k in range(1, SEGMENT_BITS):
        counts = counts + F.shiftrightunsigned(word, k).bitwiseAND(ones)
    return counts


def _cells(word: Column) -> Column:
    """The cell of a word and those one step away, by segment and direction."""
    own = segment_counts(word)
    around = [own]
    for place in range(0, 64, SEGMENT_BITS):
        here = F.shiftrightunsigned(own, place).bitwiseAND(F.lit(15))
        step = _signed(1 << place)
        around += [F.when(here < SEGMENT_BITS, own + step), F.when(here > 0, own - step)]
    return F.filter(F.array(*around), lambda c: c.isNotNull())


def _words_near(word: Column) -> Column:
    """The word itself and all words one bit away."""
    return F.array(word, *[word.bitwiseXOR(_signed(1 << b)) for b in range(64)])


def _unary(word: Column) -> Column:
    """Segment counts with as many low bits set as the count says, so that differing bits add up to Manhattan distance."""
    counts, ones = segment_counts(word), _signed(0x1111111111111111)
    two, four = F.shiftrightunsigned(counts, 1), F.shiftrightunsigned(counts, 2)
    steps = [counts.bitwiseOR(two).bitwiseOR(four), two.bitwiseOR(four), counts.bitwiseAND(two).bitwiseOR(four), four]
    return reduce(Column.bitwiseOR, [F.shiftleft(s.bitwiseAND(ones), k) for k, s in enumerate(steps)])


def _apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(fingerprints: DataFrame) -> DataFrame:
    """Edges (u, v) that join all fingerprints of column ``fp`` (distinct) at two bits or fewer.

    In crowded cells not every such pair is an edge of its own: those around one word are joined to the
    least of them.
    """
    entered = fingerprints.select("fp", _unary(F.col("fp")).alias("counts"), F.explode(_cells(F.col("fp"))).alias("cell"))
    crowded = saved(entered.groupBy("cell").count().filter(F.col("count") > CROWDED).select("cell"), "crowded-cells")
    light = entered.join(crowded, "cell", "left_anti")
    a, b = light.alias("a"), light.alias("b")
    met = (F.col("a.cell") == F.col("b.cell")) & (F.col("a.fp") < F.col("b.fp"))
    bound = _apart(F.col("a.counts"), F.col("b.counts")) <= RANGE  # Manhattan distance, never above the bit distance
    pairs = a.join(b, met & bound & (_apart(F.col("a.fp"), F.col("b.fp")) <= RANGE))
    pairs = pairs.select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))

    words = fingerprints.select("fp", F.explode(_words_near(F.col("fp"))).alias("word"))
    points = words.withColumn("cell", segment_counts(F.col("word"))).join(crowded, "cell", "left_semi")
    around = points.groupBy("word").agg(F.collect_set("fp").alias("all")).filter(F.size("all") > 1)  # 65 at most
    close = around.select(F.array_min("all").alias("u"), F.explode("all").alias("v")).filter("u < v")
    close = close.filter(_apart(F.col("u"), F.col("v")) <= RANGE)
    return pairs.unionByName(close).distinct()


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every row, and (fp, root, component_id) of every distinct fingerprint."""
    marked = saved(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), fingerprints(text, shingle).alias("fp")), "fingerprints")
    distinct = saved(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = saved(components(links(distinct.select("fp"))), "roots").withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return marked, saved(rooted.join(least, "root").select("fp", "root", "component_id"), "components")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, a row per row of ``docs``.

    Null and empty texts have fingerprint zero and are linked like any other; very long ones are counted in
    passes. A null id never names a component unless the whole component lacks ids. Repeated rows come out as
    often as they went in. An empty table gives no rows. Other columns of ``docs`` are not read.
    """
    marked, found = groups(docs, doc_id, text, shingle)
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return marked.join(found, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """Of every component the row with the smallest id (any one, if that id is repeated), as it came.

    Null and empty texts are one component. Rows without an id are kept only for components without any id.
    An id of a single row settles the row; texts are read again only of ids that stand for several.
    """
    marked, found = groups(docs, doc_id, text, shingle)
    rows_of = marked.groupBy("doc_id").agg(F.count("*").alias("n"))
    keepers = found.groupBy("root").agg(F.first("component_id").alias("id"))
    sole = F.col("n") == 1
    ids = saved(keepers.join(rows_of, F.col("id").eqNullSafe(F.col("doc_id"))).select("root", "id", sole.alias("sole")), "keepers")
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(own.alias("row"), F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("body"))
    alone = rows.join(ids.filter("sole AND id IS NOT NULL").select("id"), "id", "left_semi").select("row.*")

    shared = ids.filter("NOT sole OR id IS NULL").select("root", F.col("id").alias("least"))
    some = rows.join(shared, F.col("id").eqNullSafe(F.col("least")), "left_semi").withColumn("fp", fingerprints("body", shingle))
    some = some.join(found.select("fp", "root"), "fp").join(shared, "root").filter(F.col("id").eqNullSafe(F.col("least")))
    first = Window.partitionBy("root").orderBy("fp")
    return alone.unionByName(some.withColumn("place", F.row_number().over(first)).filter("place = 1").select("row.*"))
