"""Greedy spacing over a stream, with each key's events in Spark's state store.

A key's events lie in leaves: runs of its time line with a few thousand events each, split where they grow too
long. A directory holds where each leaf begins and when the last event up to its end was kept. New events go
into their leaves by time, whatever order they arrive in; a leaf is decided anew from the last kept time
before it, and the leaves after it only as long as that time differs from what it was. What a micro-batch
reads and writes is therefore the leaves it touches, not the key's past.

The output is a log of verdicts: a row when an event becomes kept, and one when it no longer is.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

#: Events from which a leaf is split, into leaves of half as many.
LEAF_EVENTS = 4096
NEVER = -(1 << 62)

VERDICT = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("number", T.LongType()),
        T.StructField("kept", T.BooleanType()),
        T.StructField("row", T.StringType()),
    ]
)
_LEAF = pa.schema([("at", pa.int64()), ("number", pa.int64()), ("kept", pa.bool_()), ("tie", pa.string()), ("row", pa.string())])
_EXACT = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _encoded(leaf: pd.DataFrame) -> bytes:
    batch = pa.RecordBatch.from_pandas(leaf, _LEAF, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _LEAF, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _decoded(stored: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(stored)).read_all().to_pandas()


def _tie(text: str) -> list[tuple]:
    """Values of the order columns as Spark sorts them: nulls first."""
    return [(v is not None, isinstance(v, str), v) for v in json.loads(text).values()]


def ordered(events: pd.DataFrame) -> pd.DataFrame:
    """Events by time, then order columns, then arrival."""
    events = events.sort_values(["at", "number"], kind="stable", ignore_index=True)
    at = events["at"].to_numpy()
    same = np.flatnonzero(at[1:] == at[:-1])
    if not len(same):
        return events
    place = np.arange(len(at))
    firsts = same[np.r_[True, at[same[1:]] != at[same[:-1]]]]
    for first in firsts.tolist():
        last = int(np.searchsorted(at, at[first], side="right"))
        place[first:last] = sorted(range(first, last), key=lambda k: (_tie(events["tie"].iat[k]), events["number"].iat[k]))
    return events.take(place).reset_index(drop=True)


def spaced(at: list[int], gap: int, last: int) -> tuple[np.ndarray, int]:
    """Which of the rising times are kept after one kept at ``last``, and the last kept time then."""
    kept = np.zeros(len(at), bool)
    here = bisect_left(at, last + gap)
    while here < len(at):
        kept[here], last = True, at[here]
        here = bisect_left(at, last + gap, here + 1)
    return kept, last


class Spacing(StatefulProcessor):
    """Keeps one key's events at least ``gap`` microseconds apart."""

    def __init__(self, gap: int, forget_ms: int | None = None):
        self.gap, self.forget_ms = gap, forget_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.directory = handle.getValueState("directory", "leaves string, next_leaf long, next_number long")
        self.leaves = handle.getMapState("leaves", "leaf long", "events binary")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)[["at", "tie", "row"]]
        # Of each leaf: its first time, its number, the last kept time up to its end.
        known, next_leaf, next_number = self.directory.get() if self.directory.exists() else ("[]", 0, 0)
        known = json.loads(known) or [[NEVER, None, NEVER]]
        new = new.assign(number=next_number + np.arange(len(new)), kept=False)
        home = np.searchsorted([begin for begin, _, _ in known[1:]], new["at"].to_numpy(), side="right")
        arrived = dict(iter(new.groupby(home)))
        verdicts, after, last, moved = [], [], NEVER, False
        for place, (begin, number, was) in enumerate(known):
            more = arrived.get(place)
            if more is None and (not moved or number is None):
                after.append([begin, number, was if number is not None else max(was, last)])
                last = after[-1][2]
                continue
            parts = [] if number is None else [_decoded(self.leaves.getValue((number,))[0])]
            if more is not None:
                parts.append(more)
            events = ordered(pd.concat(parts, ignore_index=True)[_LEAF.names])
            at = events["at"].tolist()
            # A leaf without events of its own may still hand on a last kept time from before a clean-up.
            kept, leave = spaced(at, self.gap, max(last, was) if number is None else last)
            changed = kept != events["kept"].to_numpy(bool)
            if changed.any():
                verdicts.append(events[changed].assign(kept=kept[changed])[["number", "kept", "row"]])
            events["kept"] = kept
            moved = number is None or leave != was
            if more is None and not changed.any():
                after.append([begin, number, leave])
            else:
                for low, high in self._cuts(at):
                    number = next_leaf if number is None else number
                    next_leaf = max(next_leaf, number + 1)
                    self.leaves.updateValue((number,), (_encoded(events.iloc[low:high]),))
                    within = np.flatnonzero(kept[low:high])
                    last = at[low + int(within[-1])] if len(within) else last
                    after.append([begin if not low else at[low], number, last])
                    number = None
            last = leave
        self.directory.update((json.dumps(after), next_leaf, next_number + len(new)))
        if self.forget_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.forget_ms)
        if verdicts:
            yield pd.concat(verdicts, ignore_index=True).assign(key=key[0])[VERDICT.names]

    @staticmethod
    def _cuts(at: list[int]) -> list[tuple[int, int]]:
        """Parts of a leaf; events of one time stay together."""
        if len(at) <= LEAF_EVENTS:
            return [(0, len(at))]
        cuts = [0]
        while len(at) - cuts[-1] > LEAF_EVENTS // 2:
            cut = bisect_left(at, at[cuts[-1] + LEAF_EVENTS // 2])
            if cut <= cuts[-1]:  # a leaf's worth of events of one time
                cut = bisect_left(at, at[cuts[-1]] + 1)
            cuts.append(cut)
        return [(a, b) for a, b in zip(cuts, [*cuts[1:], len(at)]) if b > a]

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        """Drop the events of an idle key; its last kept time stays."""
        known, next_leaf, next_number = self.directory.get()
        self.leaves.clear()
        self.directory.update((json.dumps([[NEVER, None, max(last for _, _, last in json.loads(known))]]), next_leaf, next_number))
        return iter(())

    def close(self) -> None:
        pass


def verdicts(events: DataFrame, keys: list[str], time: str, order: list[str], gap: int, forget_ms: int | None = None) -> DataFrame:
    """Stream of VERDICT rows of a stream of events. Events without a time are never kept."""
    rows = events.filter(F.col(time).isNotNull()).select(
        F.to_json(F.struct(*keys), _EXACT).alias("key"),
        F.unix_micros(F.col(time).cast("timestamp")).alias("at"),
        (F.to_json(F.struct(*order), _EXACT) if order else F.lit("{}")).alias("tie"),
        F.to_json(F.struct("*"), _EXACT).alias("row"),
    )
    mode = "None" if forget_ms is None else "ProcessingTime"
    return rows.groupBy("key").transformWithStateInPandas(Spacing(gap, forget_ms), VERDICT, "Update", mode)


def kept_rows(deltas: DataFrame, schema: T.StructType) -> DataFrame:
    """Events whose verdict of the latest ``batch`` is to keep them."""
    latest = deltas.groupBy("key", "number").agg(F.max_by(F.struct("kept", "row"), "batch").alias("v"))
    return latest.filter("v.kept").select(F.from_json("v.row", schema, _EXACT).alias("r")).select("r.*")
