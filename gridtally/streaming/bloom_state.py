"""Approximate dedup of a stream against its past: scalable Bloom filters in Spark's state store.

A day's ids are dealt into shares by hash, a state key each, so a busy day is spread over tasks. A share's filter is a
row of layers: each holds twice the ids of the one before, at half its error, and a new one is opened
when the last is full. The errors add up to less than the wanted one however many ids a day brings.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from gridtally.operators.bloom import ERROR_RATE

#: Ids of a share's first layer, and shares of a day; the latter are fixed by a stream's first start.
FIRST_LAYER, SHARES = 1 << 14, 32
_DAY_MS = 24 * 3600 * 1000


class Layer:
    """A Bloom filter of a fixed size, at an error of ERROR_RATE / 2 for layer 0, and half as much for each further one."""

    def __init__(self, number: int, first: int, bits: bytes | None = None):
        error = ERROR_RATE / 2 ** (number + 1)
        self.number, self.capacity = number, first << number
        self.hashes = math.ceil(-math.log2(error))
        self.size = math.ceil(-self.capacity * math.log(error) / math.log(2) ** 2 / 8) * 8
        self.bits = np.zeros(self.size // 8, np.uint8) if bits is None else np.frombuffer(bits, np.uint8).copy()

    def _places(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = (ids ^ (ids >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        step = (step ^ (step >> np.uint64(32))) | np.uint64(1)
        at = ids.copy()
        for _ in range(self.hashes):
            place = at % np.uint64(self.size)
            yield (place >> np.uint64(3)).astype(np.int64), np.left_shift(1, (place & np.uint64(7)).astype(np.uint8), dtype=np.uint8)
            at += step

    def holds(self, ids: np.ndarray) -> np.ndarray:
        held = np.ones(len(ids), bool)
        for byte, bit in self._places(ids):
            held &= self.bits[byte] & bit != 0
        return held

    def add(self, ids: np.ndarray) -> None:
        for byte, bit in self._places(ids):
            np.bitwise_or.at(self.bits, byte, bit)


class SeenIds(StatefulProcessor):
    """Lets each id of a (day, share) through once; a false hit, at most ERROR_RATE of them, holds one back."""

    def __init__(self, first_layer: int, keep_ms: int):
        self.first_layer, self.keep_ms = first_layer, keep_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "layer int, ids long")
        self.layers = handle.getMapState("layers", "layer int", "bits binary")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(rows), ignore_index=True)
        if rows["id"].duplicated().any():
            # Copies that differ are settled by time, user, song; nulls first.
            rows = rows.sort_values(["listened_at", "user_id", "song_id"], na_position="first").drop_duplicates("id")
        ids = rows["id"].to_numpy(np.int64).view(np.uint64)
        # Every call to the state is a round trip to the JVM; a new key has nothing to ask for but this.
        newest = self.newest.get()
        number, held = newest or (0, 0)
        layers = [Layer(k, self.first_layer, bytes(self.layers.getValue((k,))[0]) if newest else None) for k in range(number + 1)]
        fresh = ~np.logical_or.reduce([layer.holds(ids) for layer in layers])
        left = ids[fresh]
        touched = {number}
        while len(left):
            room = layers[-1].capacity - held
            layers[-1].add(left[:room])
            held += len(left[:room])
            left = left[room:]
            if len(left):
                number, held = number + 1, 0
                layers.append(Layer(number, self.first_layer))
                touched.add(number)
        if fresh.any():
            for k in touched:
                self.layers.updateValue((k,), (layers[k].bits.tobytes(),))
            self.newest.update((number, held))
        for timer in list(self.handle.listTimers()) if newest else ():
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.keep_ms)
        if fresh.any():
            yield rows.loc[fresh, ["user_id", "song_id"]].assign(day=key[0])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.layers.clear()
        self.newest.clear()
        return iter(())

    def close(self) -> None:
        pass


def fresh_events(events: DataFrame, first_layer: int = FIRST_LAYER, shares: int = SHARES, keep_days: float = 8) -> DataFrame:
    """Stream of user_id, song_id and day of events not seen before; ``events`` have their day."""
    rows = events.select(
        F.col("day").cast("string").alias("day"),
        F.pmod(F.xxhash64("event_id"), F.lit(shares)).cast("int").alias("share"),
        F.xxhash64("event_id", "day").alias("id"),
        F.coalesce(F.col("listened_at"), F.lit(-(1 << 63)).cast("bigint")).alias("listened_at"),
        "user_id",
        "song_id",
    )
    seen = SeenIds(first_layer, int(keep_days * _DAY_MS))
    fresh = rows.groupBy("day", "share").transformWithStateInPandas(
        seen, "user_id string, song_id string, day string", "Update", "ProcessingTime"
    )
    return fresh.withColumn("day", F.col("day").cast("date"))
