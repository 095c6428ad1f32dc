"""Duplicate passages by relative Lempel-Ziv parsing of documents against earlier ones."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.llm.common import code_of, gram_codes, packed, unpacked, words_of
from lodestrata.llm.segments import DIGEST, ID, Stretches, Windows, compare, covered, keyed, repeated_anchors, spans_of, stretches, with_spans

FACTOR_FIELDS = [T.StructField(n, T.LongType()) for n in (ID, DIGEST, "_start", "_length")]


def parse(found: Stretches, width: int) -> list[np.ndarray]:
    """Factors of ``width`` words and more of one block whose source lies in an earlier document.

    The reference block is the first occurrence of every window, in document order; its index
    maps a window's hash to its place there. A window whose first occurrence lies in an earlier
    document opens a factor, which goes on greedily as long as the next window is also the next one
    of the source. Windows across the border of two factors are looked up like all others, so a
    passage that no single factor holds is still covered.
    """
    starts, ends, row = words_of(found.data, found.offsets)
    code = gram_codes(code_of(found.data, starts, ends), width)
    count = len(code)
    at = np.flatnonzero(row[:count] == row[width - 1 :]) if count else np.zeros(0, np.int64)
    # stretches lie in the order of anchor and document, so the first of equal windows is the earliest
    _, first, which = np.unique(code[at], return_index=True, return_inverse=True)
    source = at[first[which]]
    late = found.doc[row[source]] < found.doc[row[at]]
    at, source = at[late], source[late]
    if not len(at):
        return found.all_of(at, at, at)
    head, tail = spans_of(row[at], at, np.diff(source, prepend=-2) != 1)
    own = at[head]
    return found.all_of(row[own], own - np.searchsorted(row, row[own]), at[tail] - own + width)


def factors(df: DataFrame, key: str, text: str, width: int = 50, gram: int = 8) -> DataFrame:
    """Factors of all documents relative to documents with a smaller ``key``.

    Columns: ``_doc``, ``_digest`` (hash of the text), ``_start`` and ``_length`` in words. Every word
    covered by a window of ``width`` words that also starts in a document with a smaller key lies in a
    factor, and no other word.
    """
    windows = Windows(True, width, gram)
    parts = stretches(keyed(df, key, text), text, repeated_anchors(df, key, text, windows, True), windows, False)
    return compare(parts, FACTOR_FIELDS, lambda found: parse(found, width), windows, False)


def without_repeats(df: DataFrame, key: str, text: str, width: int = 50, gram: int = 8) -> DataFrame:
    """``df`` with repeated passages cut out of ``text``, and ``n_words`` and ``n_removed`` (long).

    Words are runs of bytes other than space and tab to carriage return. Removed words go with
    the white space after them; a text that loses nothing stays as it is. Windows are judged on the
    input. NULL texts have no words and stay NULL; rows with a NULL key are left alone and are
    no source for others; rows with the same key are one document (their texts are no copies of
    each other); equal rows get equal results; a text of repeats only becomes empty; columns named
    ``n_words`` or ``n_removed`` are replaced.
    """

    def cut(data, offsets, row, start, length, column):
        starts, ends, owner = words_of(data, offsets)
        rows = len(offsets) - 1
        before = np.searchsorted(owner, np.arange(rows))
        gone = covered(before, len(starts), row, start, length)
        removed = np.bincount(owner[gone], minlength=rows)
        texts = column.to_pylist()
        raw, keep = data.tobytes(), ~gone
        until = np.concatenate((starts[1:], [len(data)])) if len(starts) else starts
        until = np.minimum(until, offsets[1:][owner])  # a word with the white space after it
        if removed.any():
            for k in np.flatnonzero(removed):
                lo, hi = before[k], before[k + 1] if k + 1 < rows else len(starts)
                kept = np.flatnonzero(keep[lo:hi]) + lo
                edge = np.flatnonzero(np.diff(kept) != 1)
                heads, tails = np.concatenate((kept[:1], kept[edge + 1])), np.concatenate((kept[edge], kept[-1:]))
                texts[k] = b"".join(raw[a:b] for a, b in zip(starts[heads].tolist(), until[tails].tolist())).decode()
        counts = np.bincount(owner, minlength=rows)
        return [pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())]

    kept = df.drop("n_words", "n_removed")
    rows = packed(kept, _key=key, _text=text)
    fields = [rows.schema["_text"], T.StructField("n_words", T.LongType(), False), T.StructField("n_removed", T.LongType(), False)]
    done = with_spans(keyed(rows, "_key", "_text"), "_text", factors(rows, "_key", "_text", width, gram), fields, cut)
    return unpacked(done, kept, {"n_words": F.col("n_words"), "n_removed": F.col("n_removed")}, _key=key, _text=text)
