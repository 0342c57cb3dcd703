"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training sums n-gram counts by language and bucket with a partial aggregate in every task. The matrix of
log probabilities has ``BUCKETS`` rows and a column per language and is broadcast; scoring looks up the
rows of a text's n-grams and adds them, for many texts in one numpy pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
#: Languages one model may hold; bounds what is collected and broadcast.
MAX_LANGUAGES = 128
#: Characters that are hashed in one numpy pass.
PASS = 1 << 18
UNKNOWN = "und"

# Odd multipliers of the n-gram hash.
_MULTIPLIERS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def _codes(text: str) -> np.ndarray:
    """Lower-case characters between two spaces."""
    return np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)


def _passes(texts: list[str]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Runs of (row of each n-gram start, buckets of each order); starts without a whole n-gram get BUCKETS."""
    rows: list[int] = []
    parts: list[tuple[np.ndarray, int]] = []  # (codes, starts)
    held = 0
    reach = max(ORDERS) - 1

    def hashed() -> tuple[np.ndarray, list[np.ndarray]]:
        codes = np.concatenate([c for c, _ in parts])
        lengths = np.array([len(c) for c, _ in parts])
        ends = np.cumsum(lengths)
        left = np.repeat(ends, lengths) - np.arange(len(codes))  # characters to the end of the part
        start = np.arange(len(codes)) - np.repeat(ends - lengths, lengths) < np.repeat([n for _, n in parts], lengths)
        padded = np.concatenate([codes, np.zeros(reach, np.uint32)])
        mixed, buckets = np.zeros(len(codes), np.uint32), []
        for order in ORDERS:
            mixed = (mixed ^ padded[order - 1 : order - 1 + len(codes)]) * _MULTIPLIERS[order - 1]
            mixed ^= mixed >> np.uint32(15)
            bucket = (mixed % np.uint32(BUCKETS)).astype(np.int32)
            bucket[(left < order) | ~start] = BUCKETS
            buckets.append(bucket)
        return np.repeat(rows, lengths), buckets

    for row, text in enumerate(texts):
        codes = _codes(text)
        for at in range(0, len(codes), PASS):
            piece = codes[at : at + PASS + reach]
            rows.append(row)
            parts.append((piece, min(PASS, len(codes) - at)))
            held += len(piece)
            if held >= PASS:
                yield hashed()
                rows, parts, held = [], [], 0
    if parts:
        yield hashed()


@dataclass
class Model:
    """Sorted languages, their log priors, and log probabilities with an empty last row."""

    languages: list[str]
    priors: np.ndarray
    matrix: np.ndarray

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        scored = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t)) and self.languages]
        sums = np.tile(self.priors, (len(scored), 1)) if scored else np.zeros((0, 1))
        for rows, buckets in _passes([texts[i] for i in scored]):
            first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
            for bucket in buckets:
                np.add.at(sums, rows[first], np.add.reduceat(self.matrix[bucket], first, axis=0, dtype=np.float64))
        best = sums.argmax(axis=1) if scored else []
        out = pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0})
        if scored:
            out.loc[scored, "lang_pred"] = [self.languages[k] for k in best]
            out.loc[scored, "score"] = 1.0 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
        return out


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", smoothing: float = 0.1) -> Model:
    """Learn from every row whose text and language are not null."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            for name, group in batch.groupby("lang", sort=False):
                total = totals.setdefault(name, np.zeros(BUCKETS + 1, np.int64))
                docs[name] = docs.get(name, 0) + len(group)
                for _, buckets in _passes(group["text"].tolist()):
                    for bucket in buckets:
                        total += np.bincount(bucket, minlength=BUCKETS + 1)
        for name, total in totals.items():
            some = np.flatnonzero(total[:BUCKETS])
            yield pd.DataFrame({"lang": name, "bucket": some, "n": total[some]})
            yield pd.DataFrame({"lang": [name], "bucket": [-1], "n": [docs[name]]})  # the prior

    rows = labelled.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).dropna()
    counts = rows.mapInPandas(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # At most MAX_LANGUAGES * (BUCKETS + 1) rows; one beyond that tells of too many languages.
    found = counts.limit(MAX_LANGUAGES * (BUCKETS + 1) + 1).toPandas()
    languages = sorted(found["lang"].unique())
    if len(languages) > MAX_LANGUAGES or len(found) > MAX_LANGUAGES * (BUCKETS + 1):
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    grid = np.zeros((BUCKETS + 1, len(languages)))
    column = {name: k for k, name in enumerate(languages)}
    grid[found["bucket"].to_numpy(), found["lang"].map(column).to_numpy(dtype=int)] = found["n"].to_numpy()
    docs, grid = grid[BUCKETS], grid[:BUCKETS] + smoothing
    matrix = np.zeros((BUCKETS + 1, len(languages)), np.float32)
    matrix[:BUCKETS] = np.log(grid / grid.sum(axis=0))
    return Model(languages, np.log(docs / max(docs.sum(), 1)), matrix)


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred and score for every row of ``docs``.

    Texts that are null or have no letter, and all texts of a model that learned nothing, are ``und``
    with score 0. Languages of equal probability are settled by name. Repeated rows are all scored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield shared.value.predict(texts.tolist())

    scored = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), predict(F.col(f"`{text}`")).alias("p"))
    return scored.select("doc_id", "p.*")


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from training: a fifth, by a checksum of its id; never for a null id."""
    remainder = F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % 5
    return F.coalesce(remainder == 0, F.lit(False))


def identify_held_out(docs: DataFrame) -> DataFrame:
    """Train on all but the held-out documents (and those without an id), then predict for all."""
    model = train(docs.filter(F.col("doc_id").isNotNull() & ~held_out()))
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
