"""Repeated byte strings by a run-length index of the Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.llm.common import packed, unpacked
from lodestrata.llm.segments import DIGEST, ID, Stretches, Windows, compare, covered, keyed, repeated_anchors, spans_of, stretches, with_spans

SPAN_FIELDS = [T.StructField(n, T.LongType()) for n in (ID, DIGEST, "_start", "_length")]
#: Symbols in the first sorting key: seven of nine bits each.
FIRST = 7


def first_keys(symbols: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The next seven symbols of each position in one number; nothing stands behind a string's end."""

    def behind(key: np.ndarray, step: int) -> np.ndarray:
        return np.where(left > step, np.concatenate((key[step:], np.zeros(min(step, len(key)), np.int64))), 0)

    one = symbols.astype(np.int64) + 1
    two = one << 9 | behind(one, 1)
    four = two << 18 | behind(two, 2)
    return four << 27 | behind(four, 4) >> 9


def suffix_order(first: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Positions of consecutive strings in suffix order; equal suffixes go by position.

    ``first`` are the positions' first keys, ``left`` the symbols from a position to the end of its
    string. Ranks double their depth each round; only suffixes that still share a rank are sorted again.
    """
    n = len(first)
    index = np.arange(n)
    order = np.argsort(first)
    head = np.diff(first[order], prepend=-1) != 0
    rank, depth = np.empty(n, np.int64), FIRST
    rank[order] = np.maximum.accumulate(np.where(head, index, 0))
    tied = order[~(head & np.append(head[1:], True))]
    longest = int(left.max(initial=0))
    while len(tied) and depth < longest:
        old = rank[tied]
        key = old * (n + 1) + np.where(left[tied] > depth, rank[np.minimum(tied + depth, n - 1)] + 1, 0)
        by = np.argsort(key)
        tied, key, old = tied[by], key[by], old[by]
        head, group, own = np.diff(key, prepend=-1) != 0, np.diff(old, prepend=-1) != 0, index[: len(tied)]
        rank[tied] = old + np.maximum.accumulate(np.where(head, own, 0)) - np.maximum.accumulate(np.where(group, own, 0))
        tied = tied[~(head & np.append(head[1:], True))]
        depth *= 2
    return np.argsort(rank * n + index)


def common_length(first: np.ndarray, symbols: np.ndarray, left: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal symbols from each pair of positions on, inside their strings."""
    most = np.minimum(left[a], left[b])
    same, going = np.zeros(len(a), np.int64), np.flatnonzero(most >= FIRST)
    while len(going):
        going = going[first[a[going] + same[going]] == first[b[going] + same[going]]]
        same[going] += FIRST
        going = going[same[going] + FIRST <= most[going]]
    going = np.flatnonzero(same < most)
    while len(going):
        going = going[symbols[a[going] + same[going]] == symbols[b[going] + same[going]]]
        same[going] += 1
        going = going[same[going] < most[going]]
    return same


class RunIndex:
    """Burrows-Wheeler transform of consecutive strings as runs, with the text positions of their ends.

    For the first row of a run the index keeps the text position, that of the row above, and how
    many symbols the two suffixes share: three numbers a run. Inside a run, going one symbol
    to the right in the text loses one shared symbol, so the matching statistics of all
    positions follow from the samples.
    """

    def __init__(self, symbols: np.ndarray, left: np.ndarray, begins: np.ndarray):
        self.length = len(symbols)
        first = first_keys(symbols, left)
        self.order = suffix_order(first, left)
        before = symbols[self.order - 1].astype(np.int64)
        starting = np.zeros(self.length, bool)
        starting[begins] = True
        before[starting[self.order]] = -1  # nothing stands before a string's first symbol
        heads = np.flatnonzero(np.concatenate(([True], before[1:] != before[:-1])) | (before < 0))
        self.at = self.order[heads]
        self.above = np.where(heads > 0, self.order[heads - 1], -1)
        self.shared = np.zeros(len(heads), np.int64)
        inner = heads > 0
        self.shared[inner] = common_length(first, symbols, left, self.at[inner], self.above[inner])

    def matching_statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """For each text position: symbols shared with the suffix above it in order, and its position."""
        sample = np.full(self.length, -1)
        sample[self.at] = np.arange(len(self.at))
        near = np.maximum.accumulate(np.where(sample >= 0, np.arange(self.length), 0))
        run, away = sample[near], np.arange(self.length) - near
        return self.shared[run] - away, self.above[run] + away


def earliest(index: RunIndex, width: int) -> np.ndarray:
    """For each position the first position of the text that begins with the same ``width`` symbols."""
    shared, _ = index.matching_statistics()
    fresh = shared[index.order] < width
    begin = np.flatnonzero(fresh)
    first = np.minimum.reduceat(index.order, begin)
    out = np.empty(index.length, np.int64)
    out[index.order] = np.repeat(first, np.diff(np.concatenate((begin, [index.length]))))
    return out


def mark(found: Stretches, width: int) -> list[np.ndarray]:
    """Spans of one block in which every string of ``width`` bytes also starts earlier."""
    size = np.diff(found.offsets)
    string = np.repeat(np.arange(len(size)), size)
    if not len(string):
        return found.all_of(string, string, string)
    inside = np.arange(len(string)) - found.offsets[:-1][string]
    left = size[string] - inside
    # stretches lie in the order of anchor and place, so the first of equal strings is the earliest
    source = earliest(RunIndex(found.data, left, found.offsets[:-1]), width)
    doc, start = found.doc[string], found.at[string] + inside
    at = np.flatnonzero((left >= width) & ((doc[source] < doc) | ((doc[source] == doc) & (start[source] < start))))
    if not len(at):
        return found.all_of(at, at, at)
    head, tail = spans_of(string[at], at, np.zeros(len(at), bool))
    own = at[head]
    return found.all_of(string[own], inside[own], at[tail] - own + width)


def repeated_spans(df: DataFrame, key: str, text: str, width: int = 100, gram: int = 32) -> DataFrame:
    """Byte spans (``_doc``, ``_digest``, ``_start``, ``_length``) covered by strings that start earlier."""
    windows = Windows(False, width, gram)
    parts = stretches(keyed(df, key, text), text, repeated_anchors(df, key, text, windows, False), windows, True)
    return compare(parts, SPAN_FIELDS, lambda found: mark(found, width), windows, True)


def without_repeats(df: DataFrame, key: str, text: str, width: int = 100, gram: int = 32) -> DataFrame:
    """``df`` with ``n_bytes``, ``n_removed``, ``n_spans`` (long) and ``kept`` (binary).

    Removed is every byte covered by a string of ``width`` bytes that also starts in a text with
    a smaller ``key``, or earlier in the same text; overlapping occurrences count, matches never
    cross texts, and all is judged on the input. ``n_spans`` are the maximal removed runs;
    ``kept`` are the other bytes in order (a cut may split a letter, so they are not text). NULL
    texts count as empty; rows with a NULL key are left alone and are no source; rows with the
    same key are one text; equal rows get equal results; columns of these names are replaced.
    """

    def cut(data, offsets, row, start, length, column):
        gone = covered(offsets[:-1], len(data), row, start, length)
        rows, sizes = len(offsets) - 1, np.diff(offsets)
        owner = np.repeat(np.arange(rows), sizes)
        edge = gone.copy()
        edge[1:] &= ~gone[:-1] | (owner[1:] != owner[:-1])
        removed, spans = np.bincount(owner[gone], minlength=rows), np.bincount(owner[edge], minlength=rows)
        ends = np.zeros(rows + 1, np.int32)
        np.cumsum(sizes - removed, out=ends[1:])
        kept = pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(ends), pa.py_buffer(data[~gone])])
        return [*[pa.array(c, pa.int64()) for c in (sizes, removed, spans)], kept]

    fields = [*[T.StructField(n, T.LongType(), False) for n in ("n_bytes", "n_removed", "n_spans")], T.StructField("kept", T.BinaryType(), False)]
    given = df.drop(*[f.name for f in fields])
    rows = packed(given, _key=key, _text=text)
    done = with_spans(keyed(rows, "_key", "_text"), "_text", repeated_spans(rows, "_key", "_text", width, gram), fields, cut)
    return unpacked(done, given, {f.name: F.col(f.name) for f in fields}, _key=key, _text=text)
