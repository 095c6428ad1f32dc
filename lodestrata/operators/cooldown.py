"""Firings that keep a cooldown, for keys of any size.

Whether an instant fires depends on the last firing, which depends on the one before, and so on: built-in expressions can't follow
that. A key's instants are range-partitioned by time and cut into pieces that lie in one task each. All that
is before a piece tells it only from when on it may fire, and it passes on its own last firing. So each piece
gives a small map from the one to the other; the maps of a key are gone through in order, and the pieces are filled in.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.session import cut_lineage


def chain(times: np.ndarray, gap: int, start: int) -> np.ndarray:
    """The firings of a piece of ascending instants whose first is at position ``start``."""
    after = np.searchsorted(times, times + gap).tolist()
    out, n = [], len(times)
    while start < n:
        out.append(start)
        start = max(after[start], start + 1)
    return times[out]


def exits(times: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Steps of a piece's map: up to which earliest instant it holds, and the last firing that follows.

    The last firing before the piece is before its first instant, so only starts within one cooldown matter.
    """
    n = len(times)
    jump = np.append(np.maximum(np.searchsorted(times, times + gap), np.arange(n) + 1), n)
    last = np.arange(n + 1)
    while (jump[:n] < n).any():
        last, jump = np.where(jump < n, last[jump], last), jump[jump]
    count = int(np.searchsorted(times, times[0] + gap)) + 1
    until, out = times[: min(count, n)], times[last[: min(count, n)]]
    steps = np.append(np.flatnonzero(out[1:] != out[:-1]), len(out) - 1)
    return until[steps], out[steps]


def firings_with_cooldown(df: DataFrame, keys: Sequence[str], ts: str, minutes: int) -> DataFrame:
    """Instants at which a key fires: its first, then each first one at least ``minutes`` after the last firing.

    Repeated instants are one, rows without an instant never fire, NULL keys are a key. Pieces whose key ends
    inside the batch that a task reads are settled at once; only those at the borders of batches and tasks take part in the
    pass over maps, where a task holds one map at a time.
    """
    gap, kind = minutes * 60 * 1_000_000, df.schema[ts].dataType
    if gap == 0:
        return df.filter(F.col(ts).isNotNull()).select(*keys, ts).distinct()
    order = [*[F.col(k).asc_nulls_first() for k in keys], F.col("_us").asc()]
    rows = df.filter(F.col(ts).isNotNull()).select(*keys, F.unix_micros(F.col(ts).cast("timestamp")).alias("_us"))
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    many = T.ArrayType(T.LongType())
    fields = [df.schema[k] for k in keys]
    place = [T.StructField(n, T.LongType()) for n in ("_part", "_at")]
    piece = [*fields, *place, *[T.StructField(n, many) for n in ("_fired", "_times", "_until", "_exit")]]
    names = [f.name for f in piece]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            times, new = batch.column("_us").to_numpy(), np.zeros(n, bool)
            new[0] = True
            for k in range(len(keys)):
                codes = batch.column(k).dictionary_encode(null_encoding="encode").indices.to_numpy()
                new[1:] |= codes[1:] != codes[:-1]
            starts = np.flatnonzero(new)
            made: list[tuple] = []
            for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), n]):
                own = np.unique(times[lo:hi])
                if 0 < lo and hi < n:
                    made.append((chain(own, gap, 0).tolist(), None, None, None))
                else:
                    made.append((None, own.tolist(), *(x.tolist() for x in exits(own, gap))))
            at = pa.array(starts)
            lists = [pa.array(np.full(len(starts), part)), pa.array(done + starts), *[pa.array([m[k] for m in made], pa.list_(pa.int64())) for k in range(4)]]
            yield pa.RecordBatch.from_arrays([*[batch.column(k).take(at) for k in range(len(keys))], *lists], names)
            done += n

    pieces = cut_lineage(ordered.mapInArrow(cut, T.StructType(piece)))
    open_ = pieces.filter("_fired IS NULL").select(*keys, "_part", "_at", "_until", "_exit")
    in_turn = open_.repartition(*keys) if keys else open_.coalesce(1)
    in_turn = in_turn.sortWithinPartitions(*order[:-1], "_part", "_at")
    entry = [*place, T.StructField("_from", T.LongType())]

    def go_through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, free = None, None  # free: from when on the key may fire again
        for batch in batches:
            begins = []
            own = list(zip(*(batch.column(k).to_pylist() for k in range(len(keys))))) if keys else [()] * batch.num_rows
            for key, until, after in zip(own, batch.column("_until").to_pylist(), batch.column("_exit").to_pylist()):
                if key != current:
                    current, free = key, None
                begins.append(free)
                step = 0 if free is None else bisect_left(until, free)
                if step < len(until):
                    free = after[step] + gap
            yield pa.RecordBatch.from_arrays([batch.column("_part"), batch.column("_at"), pa.array(begins, pa.int64())], [f.name for f in entry])

    begun = in_turn.mapInArrow(go_through, T.StructType(entry))
    waiting = pieces.filter("_fired IS NULL").join(begun, ["_part", "_at"]).select(*keys, "_times", "_from")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for times, begin in zip(batch.column("_times").to_pylist(), batch.column("_from").to_pylist()):
                own = np.array(times, np.int64)
                out.append(chain(own, gap, 0 if begin is None else int(np.searchsorted(own, begin))).tolist())
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(len(keys))], pa.array(out, pa.list_(pa.int64()))], [*keys, "_fired"])

    filled = waiting.mapInArrow(fill, T.StructType([*fields, T.StructField("_fired", many)]))
    fired = pieces.filter("_fired IS NOT NULL").select(*keys, "_fired").unionAll(filled).select(*keys, F.explode("_fired").alias("_us"))
    instant = F.timestamp_micros("_us")
    return fired.select(*keys, instant.cast(kind).alias(ts))
