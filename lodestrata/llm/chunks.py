"""Rows of a key in order, cut into chunks of bounded size that lie in one task each."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Rows of a chunk.
CHUNK = 1024


def run_starts(keys: pa.Array) -> np.ndarray:
    """Positions at which a value differs from the one before (NULLs are equal)."""
    if len(keys) < 2:
        return np.arange(len(keys))
    a, b = keys.slice(0, len(keys) - 1), keys.slice(1)
    same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(a.is_null(), b.is_null()))
    return np.concatenate(([0], np.flatnonzero(~same.to_numpy(zero_copy_only=False)) + 1))


def in_order(df: DataFrame, key: str, order: Sequence[Column], items: Sequence[str], size: int = CHUNK) -> DataFrame:
    """``key``, ``_part``, ``_at`` and ``items`` as lists: consecutive rows of one key, at most ``size`` of them.

    Rows are range-partitioned by key and order, so a key of any size is spread over tasks. The chunks
    of a key follow each other by (``_part``, ``_at``); the pair names a chunk.
    """
    by = [F.col(key).asc_nulls_first(), *order]
    ordered = df.repartitionByRange(*by).sortWithinPartitions(*by).select(key, *items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            runs = run_starts(batch.column(0))
            within = np.arange(n) - np.repeat(runs, np.diff(np.append(runs, n)))
            starts = np.flatnonzero(within % size == 0)
            offsets = pa.array(np.append(starts, n).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, c) for c in batch.columns[1:]]
            numbers = [pa.array(np.full(len(starts), part, np.int32)), pa.array(at + starts.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(starts)), *numbers, *lists], [key, "_part", "_at", *items])
            at += n

    fields = [T.StructField(f.name, T.ArrayType(f.dataType)) for f in ordered.schema.fields[1:]]
    schema = T.StructType([ordered.schema.fields[0], T.StructField("_part", T.IntegerType()), T.StructField("_at", T.LongType()), *fields])
    return ordered.mapInArrow(run, schema)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches of rows sorted by ``key``, cut so that no value of it lies in two of them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        runs = run_starts(batch.column(key))
        same = held and held[-1].column(key)[-1].as_py() == batch.column(key)[0].as_py()
        if held and not same:
            yield together(held)
            held = []
        if held and len(runs) > 1:
            yield together([*held, batch.slice(0, runs[1])])
            batch, held, runs = batch.slice(runs[1]), [], runs[1:] - runs[1]
        if not held and len(runs) > 1:
            yield batch.slice(0, runs[-1])
            batch = batch.slice(runs[-1])
        held.append(batch)
    if held:
        yield together(held)


def together(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def flat(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Items and offsets (from 0) of a list column without NULL lists."""
    offsets = column.offsets.to_numpy()
    return column.values.slice(offsets[0], offsets[-1] - offsets[0]), offsets - offsets[0]


def digests(df: DataFrame, key: Sequence[str], order: Sequence[str], piece: str, name: str, between: str = "") -> DataFrame:
    """``key`` and SHA-256 in hex (``name``) of the texts of ``piece`` in order, put together with ``between``.

    A digest can't be put together from parts, so one task reads all texts of a key; it keeps none of them. Rows
    equal in ``order`` count once.
    """
    ordered = df.repartition(*key).sortWithinPartitions(*key, *order).select(*key, *order, piece)
    n = len(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, last, state, glue = None, None, None, between.encode()
        for batch in batches:
            done: list[tuple[tuple, str]] = []
            keys, places = ([list(zip(*(c.to_pylist() for c in cols))) for cols in (batch.columns[:n], batch.columns[n:-1])])
            for own, place, text in zip(keys, places, batch.column(piece)):
                if state is None or own != current:
                    if state is not None:
                        done.append((current, state.hexdigest()))
                    current, state = own, hashlib.sha256()
                elif place == last:
                    continue
                else:
                    state.update(glue)
                state.update(text.as_buffer())
                last = place
            yield rows(done)
        if state is not None:
            yield rows([(current, state.hexdigest())])

    kinds = [to_arrow_type(f.dataType) for f in ordered.schema.fields[:n]]

    def rows(done: list[tuple[tuple, str]]) -> pa.RecordBatch:
        columns = [pa.array([own[k] for own, _ in done], kinds[k]) for k in range(n)]
        return pa.RecordBatch.from_arrays([*columns, pa.array([h for _, h in done], pa.string())], [*key, name])

    schema = T.StructType([*ordered.schema.fields[:n], T.StructField(name, T.StringType())])
    return ordered.mapInArrow(run, schema)
