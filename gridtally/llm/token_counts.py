"""Word-piece counts by a linear longest-match automaton.

A trie of the vocabulary gets failure links as in linear-time word-piece matching. Where the greedy match
cannot go on, the link leads to the node for what is left, and a number precomputed with the link says how
many pieces that step closes. So one pass over a word counts its pieces, and no piece is ever built.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks the start of a word in the vocabulary.
WORD_START = "▁"
#: Largest vocabulary that is sent to all executors.
MAX_PIECES = 1_000_000
#: Counts of words a Python worker remembers; then it starts afresh.
REMEMBERED_WORDS = 200_000
_CODES = 0x110000


@dataclass
class Automaton:
    """``step[node * _CODES + code]`` is a child; ``link[node]`` is -1 where nothing can match."""

    step: dict[int, int]
    link: list[int]
    popped: list[int]

    @classmethod
    def of(cls, pieces: Iterable[str]) -> Automaton:
        step: dict[int, int] = {}
        whole, nodes = [False], [(0, 0)]  # (parent, code)
        for piece in pieces:
            at = 0
            for code in map(ord, piece):
                key = at * _CODES + code
                if key not in step:
                    step[key] = len(nodes)
                    nodes.append((at, code))
                    whole.append(False)
                at = step[key]
            whole[at] = at > 0
        depth = [0] * len(nodes)
        for v in range(1, len(nodes)):
            depth[v] = depth[nodes[v][0]] + 1
        link, popped = [-1] * len(nodes), [0] * len(nodes)
        for v in sorted(range(1, len(nodes)), key=depth.__getitem__):
            parent, code = nodes[v]
            if whole[v]:
                link[v], popped[v] = 0, 1
                continue
            at, count = link[parent], popped[parent]
            while at >= 0 and at * _CODES + code not in step:
                count += popped[at]
                at = link[at]
            if at >= 0:
                link[v], popped[v] = step[at * _CODES + code], count
        return cls(step, link, popped)

    def count(self, word: str) -> int:
        """Pieces of a word, 0 where the vocabulary cannot spell it."""
        step, link, popped = self.step, self.link, self.popped
        at, count = 0, 0
        for code in map(ord, WORD_START + word):
            child = step.get(at * _CODES + code)
            while child is None:
                count += popped[at]
                at = link[at]
                if at < 0:
                    return 0
                child = step.get(at * _CODES + code)
            at = child
        while at > 0:
            count += popped[at]
            at = link[at]
        return count if at == 0 else 0


class _Counts(dict):
    """Pieces by word, filled as words come up."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        count = self[word] = self.automaton.count(word.decode())
        return count


def sentencepiece_vocabulary(path: str) -> list[str]:
    """Ordinary pieces of a sentencepiece model, without control and byte pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    odd = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not odd(i)]


def token_lengths(docs: DataFrame, pieces: list[str], text: str = "text") -> Column:
    """A struct column: n_words, n_tokens, n_unknown_words of the whole text.

    A word the vocabulary cannot spell is one unknown token. Null and empty texts have no words.
    """
    if len(pieces) > MAX_PIECES:
        raise ValueError(f"{len(pieces)} pieces are too many to send to every executor")
    shared = docs.sparkSession.sparkContext.broadcast(Automaton.of(pieces))

    @F.pandas_udf("n_words long, n_tokens long, n_unknown_words long")
    def lengths(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counts = _Counts(shared.value)
        for texts in batches:
            rows = []
            for body in texts:
                each = list(map(counts.__getitem__, body.encode("utf-8", "replace").split())) if body else []
                unknown = each.count(0)
                rows.append((len(each), sum(each) + unknown, unknown))
            yield pd.DataFrame(rows, columns=["n_words", "n_tokens", "n_unknown_words"])

    return lengths(F.col(f"`{text}`"))


def count_tokens(docs: DataFrame, pieces: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the lengths, one row per row of ``docs``; repeated rows and null ids are kept as they come."""
    counted = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), token_lengths(docs, pieces, text).alias("n"))
    return counted.select("doc_id", "n.*")
