"""Texts as numpy arrays inside tasks, word hashes, and small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What separates words: space and the five control characters from tab to carriage return.
SPACES = b" \t\n\x0b\x0c\r"
#: The same for Spark's regular expressions.
SPACE_CLASS = "[\\x20\\x09-\\x0D]"
#: Bytes of text that a task turns into arrays at a time.
BLOCK_BYTES = 1 << 20

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
_ODD = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes with A-Z as a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Stretches of more bytes are hashed in blocks first.
LONG, BLOCK = 512, 64
_FIRST = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def text_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a text column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(at) or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def words_of(data: np.ndarray, offsets: np.ndarray, apart_at: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, byte after the last, and text number of each word of consecutive texts.

    ``apart_at`` marks the bytes that separate words.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~apart_at[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    apart = edge[1:n] | (solid[1:] != solid[:-1])
    starts = np.flatnonzero(solid & np.concatenate(([True], apart)))
    ends = np.flatnonzero(solid & np.concatenate((apart, [True]))) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number; zeros stand behind the end."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def code_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each stretch of bytes, the same wherever it lies.

    Eight bytes at a time are mixed into what came before. No step is a sum, so no pattern of letters makes
    different stretches equal.
    """
    size = ends - starts
    code = mix(size.astype(np.uint64) + np.uint64(_ODD))
    long = np.flatnonzero(size > LONG)
    if len(long):
        # blocks of long stretches become numbers, whose bytes are stretches an eighth as long
        blocks = -(-size[long] // BLOCK)
        low = spread(np.zeros(len(long), np.int64), blocks) * BLOCK + np.repeat(starts[long], blocks)
        inner = code_of(data, low, np.minimum(low + BLOCK, np.repeat(ends[long], blocks)))
        until = 8 * np.cumsum(blocks)
        code[long] = mix(code[long] ^ code_of(inner.view(np.uint8), until - 8 * blocks, until))
    at, left, on = starts, size, np.flatnonzero((size > 0) & (size <= LONG))
    bytes_at, step = eights(data), 0
    while len(on):
        rest = left[on] - step
        code[on] = mix(code[on] ^ (bytes_at[at[on] + step] & _FIRST[np.minimum(rest, 8)]))
        step += 8
        on = on[rest > 8]
    return code


def equal_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes from a and from b are the same."""
    equal, bytes_at, step = np.ones(len(a), bool), eights(data), 0
    on = np.flatnonzero((size > 0) & (a != b))
    while len(on):
        rest = size[on] - step
        equal[on] &= ((bytes_at[a[on] + step] ^ bytes_at[b[on] + step]) & _FIRST[np.minimum(rest, 8)]) == 0
        step += 8
        on = on[(rest > 8) & equal[on]]
    return equal


def gram_codes(words: np.ndarray, n: int, apart: int = 1) -> np.ndarray:
    """Hash of n codes from each position on, ``apart`` positions from one to the next (as many as there are whole n-grams)."""
    count = len(words) - (n - 1) * apart
    if count <= 0:
        return np.zeros(0, np.uint64)
    total, part, size = None, words, 1
    join = lambda first, rest: mix(first[: len(rest)] * np.uint64(_ODD) + rest)
    while True:
        if n & size:
            # what is there so far stands after this part
            total = part if total is None else join(part, total[size * apart :])
        if 2 * size > n:
            return mix(total[:count] + np.uint64(n))
        part = join(part, part[size * apart :])
        size *= 2


def codes_along(data: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n bytes from each position on."""
    if len(data) < n:
        return np.zeros(0, np.uint64)
    if n < 8:
        return mix((eights(data)[: len(data) - n + 1] & _FIRST[n]) + np.uint64(n))
    eight = mix(eights(data)[: len(data) - 7])
    total = gram_codes(eight, n // 8, 8)
    return mix(total[: len(data) - n + 1] * np.uint64(_ODD) + eight[n - 8 :]) if n % 8 else total


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    low, have = values, 1
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[: len(low) - step], low[step:])
        have += step
    return low


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions start, start+1, ... of each stretch, one stretch after the other."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(int(counts.sum()), dtype=np.int64)


def row_slices(batch: pa.RecordBatch, text: str | None, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of whole rows with up to ``limit`` bytes of text or list items (a longer one alone)."""
    if text is None:
        yield batch
        return
    column = batch.column(text)
    length = pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length
    sizes = pc.fill_null(length(column), 0).to_numpy(zero_copy_only=False)
    ends, lo = np.cumsum(sizes), 0
    while lo < batch.num_rows:
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidy(run: Task) -> Task:
    """``run``, after which the worker gives the memory of its Arrow batches back: workers outlive their tasks."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return task


Extra = Callable[[pa.RecordBatch], Sequence[pa.Array]]


def extend(
    df: DataFrame, text: str, fields: Sequence[T.StructField], make: Callable[[], Extra], limit: int = BLOCK_BYTES
) -> DataFrame:
    """``df`` with columns that Python computes from blocks of rows; a column of the same name is replaced.

    ``make`` runs once in each task and returns the function from a block to its new columns.
    """
    kept = df.drop(*[f.name for f in fields])
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extra = make()
        for batch in batches:
            for part in row_slices(batch, text, limit):
                yield pa.RecordBatch.from_arrays([*part.columns, *extra(part)], [*names, *[f.name for f in fields]])

    return kept.mapInArrow(tidy(run), T.StructType([*kept.schema.fields, *fields]))


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each row's list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


#: The name under which :func:`packed` keeps a table's own columns.
ROW = "_row"


def packed(df: DataFrame, **named: str) -> DataFrame:
    """The named columns beside one struct of all others, so that no name of the user's meets a helper's."""
    rest = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(df.columns) if c not in named.values()]
    whole = F.struct(*rest) if rest else F.lit(None).cast("boolean")
    return df.select(whole.alias(ROW), *[F.col(f"`{c}`").alias(name) for name, c in named.items()])


def unpacked(rows: DataFrame, df: DataFrame, made: dict[str, Column], **named: str) -> DataFrame:
    """The columns of ``df``, as :func:`packed` took it, again, with ``made`` in the place of columns of these names or behind the others."""
    beside = {c: F.col(name) for name, c in named.items()}
    old = [made[c].alias(c) if c in made else beside.get(c, F.col(f"{ROW}.c{k}")).alias(c) for k, c in enumerate(df.columns)]
    return rows.select(*old, *[v.alias(c) for c, v in made.items() if c not in df.columns])


def only(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Just these columns, quoted, so that names with dots or of other tables do no harm."""
    return df.select(*[F.col(f"`{c}`") for c in columns])
