"""Exact byte-pair encoding in linear time, and decoding by an offset table.

The encoder never replays merges. An Aho-Corasick automaton finds the longest token at every
position of a word; the tokens are laid end to end, longest first, and a pair of neighbours is
accepted only if merging could not have crossed its border (the compatibility table). Where no
token fits, the encoder steps back and shortens the token before. Positions found to lead nowhere
are marked, so each is left at most once. The only segmentation whose neighbours are all
compatible is the one that the merges produce.

Texts are cut into pieces that no token crosses. Within a block of texts each different piece
is encoded once and its ids are copied to wherever it occurs.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lodestrata.llm.common import LOWER, SPACES, code_of, equal_bytes, extend, list_array, spread, text_arrays, words_of

#: Entries kept of each worker's memory of pieces and of pairs; a full one starts anew.
MEMORY = 250_000
#: Longest piece that is remembered, in bytes.
REMEMBERED = 64


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself, or the next free one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in plain else next(free)) for b in range(256)]


class Vocabulary:
    """Tables of a byte-pair vocabulary with marked word ends.

    A word is a string of symbols: code points 0-255 for its bytes, its last byte plus 256.
    """

    def __init__(self, content: bytes):
        model = json.loads(content)
        self.library = tokenizers.Tokenizer.from_str(content.decode())
        end = model["model"]["end_of_word_suffix"]
        letters = {c: chr(b) for b, c in enumerate(byte_letters())}
        self.to_symbols = {ord(c): s for c, s in letters.items()}

        def symbols(token: str) -> str:
            if token.endswith(end):
                s = "".join(letters[c] for c in token[: -len(end)])
                return s[:-1] + chr(ord(s[-1]) + 256)
            return "".join(letters[c] for c in token)

        vocab = model["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.length, self.split, self.pair = [0] * size, [(i, i) for i in range(size)], {}
        by_symbols: dict[str, int] = {}
        self.automaton = ahocorasick.Automaton()
        for token, i in vocab.items():
            s = symbols(token)
            by_symbols[s], self.length[i] = i, len(s)
            self.automaton.add_word(s, (i, len(s)))
        self.automaton.make_automaton()
        ranks = [0] * size
        for rank, (a, b) in enumerate(model["model"]["merges"]):
            whole = vocab[a + b]
            ranks[whole], self.split[whole], self.pair[vocab[a], vocab[b]] = rank + 1, (vocab[a], vocab[b]), whole
        self.rank = ranks
        # the next shorter token that begins a token
        self.shorter = [-1] * size
        for s, i in by_symbols.items():
            self.shorter[i] = next((by_symbols[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in by_symbols), -1)
        self.seen: dict[bytes, np.ndarray] = {}
        self.fits: dict[tuple[int, int], bool] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether the border between two neighbouring tokens survives all merges across it."""
        # The border is undone in reverse: at each step the side built last is opened. A pair that could
        # merge counts only if its merge comes before the one that made the side which was opened.
        rank, split, pair = self.rank, self.split, self.pair
        limit = len(rank) + 1
        while True:
            whole = pair.get((left, right))
            if whole is not None and rank[whole] < limit:
                return False
            if rank[left] > rank[right]:
                limit, left = rank[left], split[left][1]
            elif rank[right]:
                # merges of one rank go from left to right: a merge of equal rank on the left comes first
                limit, right = rank[right] + 1, split[right][0]
            else:
                return True

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word of symbols."""
        n = len(word)
        longest = [0] * n
        for last, (token, size) in self.automaton.iter(word):
            longest[last - size + 1] = token  # a later end is a longer token
        token = longest[0]
        length, shorter, fits = self.length, self.shorter, self.fits
        if length[token] == n:
            return [token]
        if len(fits) >= MEMORY:
            fits.clear()
        dead: set[int] = set()
        out, at = [], 0
        while at < n:
            left = out[-1] if out else -1
            while token >= 0:
                if not dead or at + length[token] not in dead:
                    if left < 0:
                        break
                    ok = fits.get((left, token))
                    if ok is None:
                        ok = fits[left, token] = self.compatible(left, token)
                    if ok:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += length[token]
                token = longest[at] if at < n else -1
            else:
                dead.add(at)
                last = out.pop()
                at -= length[last]
                token = shorter[last]
        return out

    def encode_piece(self, raw: bytes, odd: bool) -> bytes:
        """Ids (32 bits each) of a piece from :func:`distinct_pieces`."""
        if len(self.seen) >= MEMORY:
            self.seen.clear()
        ids = self._stretch(raw.decode()) if odd else self.encode_word(self.symbols_of(raw.decode() if raw.isascii() else raw.decode().lower()))
        out = array("i", ids).tobytes()
        if len(raw) <= REMEMBERED:
            self.seen[raw] = out  # odd pieces hold what no other does, so the letters alone are a key
        return out

    @staticmethod
    def symbols_of(word: str) -> str:
        s = word if word.isascii() else word.encode().decode("latin-1")
        return s[:-1] + chr(ord(s[-1]) + 256)

    def symbol_tokens(self) -> list[str]:
        """All tokens but the special ones, as symbols."""
        return list(self.automaton.keys())

    def words(self, text: str) -> list[str | int]:
        """The words of a text as symbols, and the ids of special tokens, by the tokenizer's own rules."""
        out: list[str | int] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                part = self.library.normalizer.normalize_str(part)
                for word, _ in self.library.pre_tokenizer.pre_tokenize_str(part):
                    s = word.translate(self.to_symbols)
                    out.append(s[:-1] + chr(ord(s[-1]) + 256))
        return out

    def _stretch(self, text: str) -> list[int]:
        out: list[int] = []
        for word in self.words(text):
            out += [word] if isinstance(word, int) else self.encode_word(word)
        return out

    def encode_texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive texts and the number of ids of each."""
        pieces, which, row = distinct_pieces(data, offsets)
        if not pieces:
            return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        known = self.seen.get
        found = [known(raw) or self.encode_piece(raw, odd) for raw, odd in pieces]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        flat = np.frombuffer(b"".join(found), np.int32)
        counts = sizes[which]
        ids = flat[spread((np.cumsum(sizes) - sizes)[which], counts)]
        return ids, np.bincount(row, counts, len(offsets) - 1).astype(np.int64)


class TokenTexts:
    """The letters of all tokens in one blob, addressed by an offset table."""

    def __init__(self, content: bytes):
        model = json.loads(content)
        names = {**model["model"]["vocab"], **{t["content"]: t["id"] for t in model["added_tokens"]}}
        texts = [b""] * (max(names.values()) + 1)
        for token, i in names.items():
            texts[i] = token.encode()
        # decoding joins tokens by a space where the file names no decoder
        self.blob, self.offsets = blob_of([t + b" " for t in texts])

    def decode_ids(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the texts of consecutive id lists and the number of bytes of each."""
        return join_pieces(self.blob, self.offsets, ids, counts)


def blob_of(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.zeros(len(pieces) + 1, np.int64)
    np.cumsum([len(p) for p in pieces], out=offsets[1:])
    return np.frombuffer(b"".join(pieces), np.uint8), offsets


def join_pieces(blob: np.ndarray, offsets: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lay the pieces of each list side by side; the separator after a list's last piece is left out."""
    sizes = offsets[ids + 1] - offsets[ids]
    ends = np.cumsum(counts)
    sizes[ends[counts > 0] - 1] -= 1
    total = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=total[1:])
    return blob[spread(offsets[ids], sizes)], total[ends] - total[ends - counts]


#: Kinds of bytes: 0 white space, 1 letter, 2 digit, 3 other.
KIND = np.full(256, 3, np.uint8)
KIND[list(SPACES)] = 0
KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
KIND[48:58] = 2


def pieces_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, text number and oddness of the pieces that are encoded alone.

    A stretch between white space that holds an apostrophe, ``<`` or a letter beyond the Latin-1
    letters (two bytes, the first 0xC3) is one odd piece: contractions, special tokens and other
    scripts need the tokenizer's own rules. Others are cut into runs of letters, single digits
    and runs of other characters, as the pre-tokenizer cuts them.
    """
    starts, ends, row = words_of(data, offsets)
    if not len(starts):
        return starts, ends, row, np.zeros(0, bool)
    strange = (data == 39) | (data == 60)
    high = data >= 128
    after = np.concatenate(([False], data[:-1] == 0xC3)) & high
    latin = after & (data != 0x97) & (data != 0xB7) & (data < 0xC0)
    strange |= high & ~latin & (data != 0xC3)
    odd = np.add.reduceat(strange, starts, dtype=np.int64) > 0 if strange.any() else np.zeros(len(starts), bool)
    # reduceat sums up to the next start, which takes in white space only
    kind = KIND[data]
    first = np.zeros(len(data), bool)
    first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    whole = spread(starts[odd], ends[odd] - starts[odd])
    first[whole] = False
    first[starts] = True
    first &= kind > 0
    at = np.flatnonzero(first)
    word = np.searchsorted(starts, at, side="right") - 1
    until = np.minimum(np.concatenate((at[1:], [len(data)])), ends[word])
    return at, until, row[word], odd[word]


def distinct_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[list[tuple[bytes, bool]], np.ndarray, np.ndarray]:
    """The different pieces of a block, A-Z as a-z but in odd ones, with their oddness; for each piece in order its number and its text.

    Pieces meet by a hash; those of one hash are then compared byte by byte.
    """
    starts, ends, row, odd = pieces_of(data, offsets)
    if not len(starts):
        return [], starts, row
    lower = LOWER[data]
    whole = spread(starts[odd], ends[odd] - starts[odd])
    lower[whole] = data[whole]  # odd pieces keep their letters
    code = code_of(lower, starts, ends)
    code = np.where(odd, code, ~code)
    _, first, which = np.unique(code, return_index=True, return_inverse=True)
    raw = lower.tobytes()
    near = first[which]
    same = (ends - starts == (ends - starts)[near]) & (odd == odd[near]) & equal_bytes(lower, starts, starts[near], ends - starts)
    if not same.all():
        known: dict[tuple[bytes, bool], int] = {}
        which = np.array([known.setdefault((raw[a:b], o), len(known)) for a, b, o in zip(starts.tolist(), ends.tolist(), odd.tolist())])
        _, first = np.unique(which, return_index=True)
    spans = zip(starts[first].tolist(), ends[first].tolist(), odd[first].tolist())
    return [(raw[a:b], o) for a, b, o in spans], which, row


_loaded: dict[tuple[type, str], object] = {}


def _once(kind: type, content: bytes):
    key = kind, hashlib.sha256(content).hexdigest()
    if key not in _loaded:
        _loaded[key] = kind(content)
    return _loaded[key]


def vocabulary(content: bytes) -> Vocabulary:
    """The encoder's tables of a vocabulary file's content, built once in each worker."""
    return _once(Vocabulary, content)


def token_texts(content: bytes) -> TokenTexts:
    """The decoder's table of a vocabulary file's content, built once in each worker."""
    return _once(TokenTexts, content)


def file_content(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(df: DataFrame, text: str, vocabulary_path: str, ids: str = "ids") -> DataFrame:
    """Add the token ids of ``text`` as ``ids`` (array of int).

    NULL and empty texts give an empty array; equal texts give equal ids; a column named ``ids``
    is replaced and all others stay. No shuffle: rows are encoded where they are read. The
    vocabulary is read by the driver and sent to the executors (a file of fixed size).
    """
    content = df.sparkSession.sparkContext.broadcast(file_content(vocabulary_path))

    def make():
        vocab = vocabulary(content.value)

        def extra(part: pa.RecordBatch):
            return [list_array(*vocab.encode_texts(*text_arrays(part.column(text))), pa.int32())]

        return extra

    return extend(df, text, [T.StructField(ids, T.ArrayType(T.IntegerType(), False))], make)


def decode(df: DataFrame, ids: str, vocabulary_path: str, text: str = "decoded") -> DataFrame:
    """Add the text of the token ids as ``text``: each token's letters, joined by a space.

    That is what the library gives for a file without a decoder. NULL and empty arrays give an
    empty text; a column named ``text`` is replaced. Token letters lie in one blob, addressed by
    an offset table.
    """
    content = df.sparkSession.sparkContext.broadcast(file_content(vocabulary_path))

    def make():
        table = token_texts(content.value)

        def extra(part: pa.RecordBatch):
            column = part.column(ids)
            counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            data, sizes = table.decode_ids(flat, counts)
            offsets = np.zeros(len(sizes) + 1, np.int32)
            np.cumsum(sizes, out=offsets[1:])
            return [pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(data))]

        return extra

    return extend(df, ids, [T.StructField(text, T.StringType())], make)
