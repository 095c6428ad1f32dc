"""Documents cut and packed into sequences of equal cost for training."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lodestrata.llm.bpe import file_content, vocabulary
from lodestrata.llm.common import only, row_slices, text_arrays, tidy

#: Sequences that are filled together: a task holds this many times the capacity in tokens.
TOGETHER = 256


class Piece:
    """Consecutive ids of one document."""

    __slots__ = ("key", "start", "ids", "total")

    def __init__(self, key, start: int, ids: np.ndarray, total: int):
        self.key, self.start, self.ids, self.total = key, start, ids, total

    def cut(self, size: int) -> tuple[Piece, Piece]:
        return Piece(self.key, self.start, self.ids[:size], self.total), Piece(self.key, self.start + size, self.ids[size:], self.total)


def cost_of(size, linear: float, quadratic: float):
    """Estimated cost of a piece: attention looks back within the piece only."""
    return linear * size + quadratic * size * size


def fill(pieces: list[Piece], capacity: int, linear: float, quadratic: float) -> tuple[list[list[Piece]], list[Piece]]:
    """Fill as many whole sequences as there are tokens for; also what is left over.

    Pieces go by descending cost to the cheapest sequence that has room. A piece that fits
    nowhere is cut at the most room left, so every sequence ends full.
    """
    count = sum(len(p.ids) for p in pieces) // capacity
    if not count:
        return [], pieces
    cost, room = np.zeros(count), np.full(count, capacity)
    filled: list[list[Piece]] = [[] for _ in range(count)]
    over: list[Piece] = []
    for piece in sorted(pieces, key=lambda p: -len(p.ids)):
        while len(piece.ids):
            size = len(piece.ids)
            fits = np.flatnonzero(room >= size)
            best = fits[np.argmin(cost[fits])] if len(fits) else int(np.argmax(room))
            if not room[best]:
                over.append(piece)
                break
            rest = piece.cut(size)[1]
            if room[best] < size:
                piece, rest = piece.cut(int(room[best]))
            filled[best].append(piece)
            room[best] -= len(piece.ids)
            cost[best] += cost_of(len(piece.ids), linear, quadratic)
            piece = rest
    return filled, over


def last_sequences(pieces: list[Piece]) -> list[list[Piece]]:
    """Fewer tokens than a sequence, in sequences of different powers of two, which need no padding."""
    left, out = sum(len(p.ids) for p in pieces), []
    waiting = sorted(pieces, key=lambda p: len(p.ids))
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        sequence: list[Piece] = []
        while size:
            piece = waiting.pop()
            if len(piece.ids) > size:
                piece, rest = piece.cut(size)
                waiting.append(rest)
            sequence.append(piece)
            size -= len(piece.ids)
        out.append(sequence)
    return out


def pack(
    df: DataFrame, key: str, text: str, vocabulary_path: str, end_id: int, capacity: int = 4096, linear: float = 1.0, quadratic: float = 1 / 4096
) -> DataFrame:
    """Pack all documents into sequences of ``capacity`` tokens; one row per piece of a document.

    Columns: ``key`` (as named), ``start`` (ids of the document before the piece), ``length``,
    ``ids`` (binary, little-endian unsigned 32-bit), ``doc_tokens`` (with the closing ``end_id``),
    ``sequence_id``, ``offset`` (tokens before it in its sequence).

    Whole multiples of the capacity in a long document are sequences of their own. What is left
    of each document is placed by cost (see :func:`fill`) in groups of ``TOGETHER`` sequences. All
    sequences are full but the last few of each task, whose lengths are different powers of two:
    there is no padding at all. Each task packs the rows that it reads: no shuffle, and memory for
    one group. A repeated task gives the same pieces, as it reads the same rows in order.

    NULL and empty texts are documents of the one token ``end_id``; repeated rows and NULL keys
    are packed like any other; an empty table gives no rows; other columns are left out.
    """
    content = df.sparkSession.sparkContext.broadcast(file_content(vocabulary_path))
    kind = df.schema[key]
    fields = [
        T.StructField(key, kind.dataType), T.StructField("start", T.LongType(), False), T.StructField("length", T.LongType(), False),
        T.StructField("ids", T.BinaryType(), False), T.StructField("doc_tokens", T.LongType(), False),
        T.StructField("sequence_id", T.LongType(), False), T.StructField("offset", T.LongType(), False),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, number = vocabulary(content.value), TaskContext.get().partitionId() << 32
        waiting: list[Piece] = []
        tokens, key_type = 0, None

        def rows(sequences: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal number
            placed = []
            for sequence in sequences:
                at = 0
                for p in sequence:
                    placed.append((p, number, at))
                    at += len(p.ids)
                number += 1
            columns = [
                pa.array([p.key for p, _, _ in placed], key_type),
                pa.array([p.start for p, _, _ in placed], pa.int64()),
                pa.array([len(p.ids) for p, _, _ in placed], pa.int64()),
                pa.array([p.ids.astype("<u4").tobytes() for p, _, _ in placed], pa.binary()),
                pa.array([p.total for p, _, _ in placed], pa.int64()),
                pa.array([n for _, n, _ in placed], pa.int64()),
                pa.array([o for _, _, o in placed], pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

        for batch in batches:
            for part in row_slices(batch, text):
                key_type = part.column(key).type
                flat, counts = vocab.encode_texts(*text_arrays(part.column(text)))
                ends, whole = np.cumsum(counts).tolist(), []
                for k, (name, count) in enumerate(zip(part.column(key).to_pylist(), counts.tolist())):
                    ids = np.append(flat[ends[k] - count : ends[k]], np.int32(end_id))
                    full = len(ids) // capacity * capacity
                    whole += [[Piece(name, at, ids[at : at + capacity], len(ids))] for at in range(0, full, capacity)]
                    if full < len(ids):
                        waiting.append(Piece(name, full, ids[full:], len(ids)))
                        tokens += len(ids) - full
                if whole:
                    yield rows(whole)
                while tokens >= TOGETHER * capacity:
                    done, waiting = fill(waiting, capacity, linear, quadratic)
                    tokens = sum(len(p.ids) for p in waiting)
                    yield rows(done)
        done, waiting = fill(waiting, capacity, linear, quadratic)
        if done or waiting:
            yield rows(done + last_sequences(waiting))

    return only(df, [key, text]).mapInArrow(tidy(run), T.StructType(fields))
