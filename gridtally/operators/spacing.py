"""Greedy spacing: keep a row only if it comes long enough after the last kept row of its key.

The rule is sequential per key, and one key may hold a third of all rows, so keys are cut into time
chunks that are worked on in parallel:

1. each chunk is reduced to steps "if the first row kept here is at ``start``, the last one is at
   ``leave``" (only rows within one gap of the chunk's start can be that first row, unless there
   are none);
2. the few steps of each key are followed in chunk order, which gives the last kept time before
   every chunk;
3. each chunk applies the rule from there; the last kept time travels as a marker row in front of
   the chunk's own rows.

Rows move between stages only by hashing on (key, chunk); Python sees Arrow blocks of whole chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bounds and default of the event rate, in events per second.
MIN_RATE, MAX_RATE, DEFAULT_RATE = 1, 240, 60
CHUNK_US = 60 * 1_000_000


def gap_for_rate(rate: float | None) -> int:
    """Smallest whole number of microseconds between kept events at ``rate`` events per second."""
    clamped = max(MIN_RATE, min(MAX_RATE, rate or DEFAULT_RATE))
    return int(-(-1_000_000 // clamped))


def thin_events(
    events: DataFrame, rate: float | None = None, keys: tuple[str, ...] = ("client_id", "screen_id"),
    time: str = "event_time", order: tuple[str, ...] = (),
) -> DataFrame:
    """Cap the event rate per (client, screen)."""
    return keep_spaced(events, list(keys), time, gap_for_rate(rate), list(order))


def keep_spaced(
    df: DataFrame, keys: list[str], time: str, gap_us: int, order: list[str], chunk_us: int | None = None
) -> DataFrame:
    """Rows at least ``gap_us`` after the last kept row of the same key; the first one is kept.

    ``order`` settles rows of equal time. Rows without a time are never kept. A chunk must not be shorter
    than the gap; the more rows a key has, the shorter its chunks should be.
    """
    chunk_us = max(chunk_us or CHUNK_US, gap_us)
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    chunked = (
        df.filter(F.col(time).isNotNull())
        .withColumn("_at", F.pmod(micros, F.lit(chunk_us).cast("bigint")))
        .withColumn("_chunk", ((micros - F.col("_at")) / chunk_us).cast("bigint"))
    )
    group = [*keys, "_chunk"]

    def marked(rows: DataFrame, ties: list[str]) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*group).orderBy("_at", *ties))
        return rows.withColumn("_first", place == 1)

    key_fields = [df.schema[k] for k in keys]
    long = T.LongType()
    step_schema = T.StructType(
        key_fields + [T.StructField(n, long) for n in ("_chunk", "_start", "_leave")]
    )
    enter_schema = T.StructType(key_fields + [T.StructField(n, long) for n in ("_chunk", "_enter")])

    times = marked(chunked.select(*group, "_at"), []).select(*group, "_at", "_first")
    steps = times.mapInArrow(_chunk_steps(gap_us, chunk_us), step_schema)
    enters = steps.groupBy(*keys).applyInPandas(_follow(keys, gap_us, chunk_us), enter_schema)

    markers = enters.withColumn("_at", F.lit(-1).cast("bigint"))
    entered = chunked.withColumn("_enter", F.lit(None).cast("bigint")).unionByName(markers, allowMissingColumns=True)
    final = marked(entered, order).select(*df.columns, "_at", "_enter", "_first")
    return final.mapInArrow(_kept_rows(gap_us, chunk_us, df.columns), df.schema)


def _whole_groups():
    """Reader of Arrow batches that yields tables made of whole groups, marked by ``_first``."""
    import numpy as np
    import pyarrow as pa

    def tables(batches, rows: int = 500_000):
        held, size, enough = [], 0, rows
        for batch in batches:
            if batch.num_rows == 0:
                continue
            held.append(batch)
            size += batch.num_rows
            if size < enough:
                continue
            table = pa.Table.from_batches(held)
            starts = np.flatnonzero(table.column("_first").to_numpy())
            cut = int(starts[-1]) if len(starts) else 0
            if cut > 0:
                yield table.slice(0, cut).combine_chunks()
                table = table.slice(cut)
            held, size = table.to_batches(), table.num_rows
            enough = max(rows, 2 * size)  # a long group is looked through again only once doubled
        if held:
            yield pa.Table.from_batches(held).combine_chunks()

    return tables


def _axis(gap_us: int, chunk_us: int):
    """Puts all groups of a table on one rising axis, far enough apart not to touch."""
    import numpy as np

    def lay_out(table, rows=slice(None)):
        group = (np.cumsum(table.column("_first").to_numpy()) - 1)[rows]
        at = table.column("_at").to_numpy()[rows]
        axis = group * (chunk_us + 2 * gap_us) + at
        following = np.searchsorted(axis, axis + gap_us, side="left")
        inside = following < len(axis)
        inside[inside] = group[following[inside]] == group[inside]
        return at, group, axis, np.where(inside, following, -1)

    return lay_out


def _chunk_steps(gap_us: int, chunk_us: int):
    tables, lay_out = _whole_groups(), _axis(gap_us, chunk_us)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for table in tables(batches):
            at, group, axis, following = lay_out(table)
            last = np.where(following < 0, np.arange(len(at)), following)
            while True:  # follow the chain in doubling strides
                further = last[last]
                if np.array_equal(further, last):
                    break
                last = further
            leave = at[last]
            beyond = np.searchsorted(axis, group * (chunk_us + 2 * gap_us) + gap_us, side="left")
            candidate = (at < gap_us) | (beyond == np.arange(len(at)))
            rows = np.flatnonzero(candidate)
            # Neighbouring starts with the same outcome are one step; its latest start decides.
            same = (group[rows[1:]] == group[rows[:-1]]) & (leave[rows[1:]] == leave[rows[:-1]])
            rows = rows[np.append(~same, True)]
            picked = table.drop_columns(["_at", "_first"]).take(pa.array(rows))
            picked = picked.append_column("_start", pa.array(at[rows], pa.int64()))
            picked = picked.append_column("_leave", pa.array(leave[rows], pa.int64()))
            yield from picked.combine_chunks().to_batches()

    return run


def _follow(keys: list[str], gap_us: int, chunk_us: int):
    def run(steps):
        import numpy as np
        import pandas as pd

        steps = steps.sort_values(["_chunk", "_start"], kind="stable")
        chunk, start, leave = (steps[c].to_numpy() for c in ("_chunk", "_start", "_leave"))
        bounds = np.append(np.flatnonzero(np.diff(chunk, prepend=chunk[0] - 1)), len(chunk))
        out_chunk, out_enter = [], []
        last = None
        for low, high in zip(bounds[:-1], bounds[1:]):
            base = int(chunk[low]) * chunk_us
            place = low
            if last is not None and last + gap_us > base:
                out_chunk.append(int(chunk[low]))
                out_enter.append(last - base)
                place = low + int(np.searchsorted(start[low:high], last + gap_us - base, side="left"))
            if place < high:
                last = base + int(leave[place])
        out = pd.DataFrame({"_chunk": pd.Series(out_chunk, dtype="int64"), "_enter": pd.Series(out_enter, dtype="int64")})
        for k in reversed(keys):
            out.insert(0, k, steps[k].iloc[0])
        return out

    return run


def _kept_rows(gap_us: int, chunk_us: int, columns: list[str]):
    tables, lay_out = _whole_groups(), _axis(gap_us, chunk_us)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for table in tables(batches):
            enter = table.column("_enter").fill_null(-gap_us).to_numpy()[table.column("_first").to_numpy()]
            at, group, axis, following = lay_out(table, table.column("_at").to_numpy() >= 0)
            heads = np.flatnonzero(np.diff(group, prepend=-1))
            floor = np.clip(enter + gap_us, 0, chunk_us + gap_us)
            begin = np.searchsorted(axis, axis[heads] - at[heads] + floor, side="left")
            ends = np.append(heads[1:], len(at))
            # A row one gap after its neighbour is kept whichever rows before it were, so all
            # runs between such rows are walked side by side.
            free = np.flatnonzero(np.diff(axis, prepend=axis[0]) >= gap_us)
            free = free[(at[free] >= floor[group[free]]) & ~np.isin(free, heads)]
            here = np.union1d(begin[begin < ends], free)
            kept = np.zeros(len(at), dtype=bool)
            while len(here):
                kept[here] = True
                here = following[here]
                here = here[here >= 0]
                here = np.unique(here[~kept[here]])
            own = table.column("_at").to_numpy() >= 0
            own[own] = kept
            yield from table.select(columns).filter(pa.array(own)).combine_chunks().to_batches()

    return run
