"""Number of greedy word pieces without building the pieces."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lodestrata.llm.bpe import MEMORY, REMEMBERED, Vocabulary, distinct_pieces, file_content, vocabulary
from lodestrata.llm.common import extend, text_arrays


class LongestMatch:
    """Trie of the pieces with failure links and the number of pieces that each link takes off.

    ``first`` are the pieces that may begin a word, ``later`` those that may follow. Reading a
    word moves down the trie; where it can't, the failure link leads to the node of what is not
    yet covered by the pieces taken off, whose number was counted when the trie was built. Each
    symbol is read once, so the time is linear in the word.
    """

    def __init__(self, first: Iterable[str], later: Iterable[str] | None = None):
        self.down: list[dict[str, int]] = [{}]
        whole = [False]
        self.rest = 0 if later is None else 1  # the root after the first piece
        if later is not None:
            self.down.append({})
            whole.append(False)
        for root, pieces in ((0, first), (self.rest, later or ())):
            for piece in pieces:
                node = root
                for c in piece:
                    if c not in self.down[node]:
                        self.down[node][c] = len(self.down)
                        self.down.append({})
                        whole.append(False)
                    node = self.down[node][c]
                whole[node] = True
        self.fail, self.taken = [-1] * len(self.down), [0] * len(self.down)
        layer = [0] if later is None else [0, 1]
        while layer:
            below = []
            for parent in layer:
                for c, node in self.down[parent].items():
                    below.append(node)
                    if whole[node]:
                        self.fail[node], self.taken[node] = self.rest, 1
                        continue
                    taken, z = self.taken[parent], self.fail[parent]
                    while z >= 0 and c not in self.down[z]:
                        taken, z = taken + self.taken[z], self.fail[z]
                    if z >= 0:
                        self.fail[node], self.taken[node] = self.down[z][c], taken
            layer = below

    def count(self, word: str) -> int:
        """Pieces of the word; -1 if greedy matching gets stuck."""
        down, fail, taken, node, pieces = self.down, self.fail, self.taken, 0, 0
        for c in word:
            while c not in down[node]:
                pieces += taken[node]
                node = fail[node]
                if node < 0:
                    return -1
            node = down[node][c]
        while node != self.rest or not pieces:
            if fail[node] < 0:
                return -1 if word else 0
            pieces += taken[node]
            node = fail[node]
        return pieces


class PieceCounter:
    """Word and piece numbers of texts, by the words of a tokenizer file and its tokens as pieces."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.match = vocab, LongestMatch(vocab.symbol_tokens())
        self.seen: dict[tuple[bytes, bool], tuple[int, int, int]] = {}

    def of_piece(self, raw: bytes, odd: bool) -> tuple[int, int, int]:
        """Words, pieces and unknown words of a piece of text; an unknown word is one piece, a special token too."""
        key = (raw, odd)
        found = self.seen.get(key)
        if found is None:
            if len(self.seen) >= MEMORY:
                self.seen.clear()
            words = self.vocab.words(raw.decode()) if odd else [self.vocab.symbols_of(raw.decode().lower())]
            counts = [1 if isinstance(w, int) else self.match.count(w) for w in words]
            found = (len(words), sum(abs(c) for c in counts), counts.count(-1))
            if len(raw) <= REMEMBERED:
                self.seen[key] = found
        return found

    def of_texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Words, pieces and unknown words of consecutive texts, a column each."""
        pieces, which, row = distinct_pieces(data, offsets)
        rows = len(offsets) - 1
        if not pieces:
            return np.zeros((rows, 3), np.int64)
        values = np.array([self.of_piece(*p) for p in pieces], np.int64)[which]
        return np.stack([np.bincount(row, values[:, k], rows).astype(np.int64) for k in range(3)], axis=1)


_counters: dict[int, PieceCounter] = {}


def counter(content: bytes) -> PieceCounter:
    """The tables for counting by a vocabulary file's content, built once in each worker."""
    vocab = vocabulary(content)
    if id(vocab) not in _counters:  # vocabularies stay loaded as long as the worker
        _counters[id(vocab)] = PieceCounter(vocab)
    return _counters[id(vocab)]


def count_pieces(df: DataFrame, text: str, vocabulary_path: str) -> DataFrame:
    """Add ``n_words``, ``n_pieces`` and ``n_unknown`` (long): greedy longest-match pieces of every word.

    Words are those of the tokenizer file's own normalizer and pre-tokenizer; from the left, each
    word is cut into the longest token that fits, tokens with an end mark only at its end. A
    word that can't be cut is one unknown piece. NULL and empty texts give zeros; equal rows give
    equal numbers; columns of these names are replaced. Nothing is shuffled.
    """
    content = df.sparkSession.sparkContext.broadcast(file_content(vocabulary_path))

    def make():
        counting = counter(content.value)

        def extra(part: pa.RecordBatch):
            return [pa.array(c, pa.int64()) for c in counting.of_texts(*text_arrays(part.column(text))).T]

        return extra

    return extend(df, text, [T.StructField(n, T.LongType(), False) for n in ("n_words", "n_pieces", "n_unknown")], make)
