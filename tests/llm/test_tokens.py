"""Byte-pair ids, word pieces and packing against the library and brute force."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lodestrata.llm import bpe, packing, wordpiece
from lodestrata.llm.common import text_arrays
from tests.llm import data

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocab():
    return bpe.vocabulary(bpe.file_content(PATH))


def strange_texts() -> list[str]:
    r = random.Random(1)
    parts = ["a", "e", "th", "ing", " ", "\n", "'s", "'ll", "<|endoftext|>", "<|ENDOFTEXT|>", "É", "é", "Σ", "İ", "ß", "1", "½", " ", "\x1c", "\x85", "...", "語", "😀", "​", "<|", "\x00", "'", "’s"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(0, 25))) for _ in range(4000)]
    return texts + ["".join(chr(r.choice([r.randrange(1, 0x300), r.randrange(0x300, 0xD800), r.randrange(0xE000, 0x10FFFF)])) for _ in range(8)) for _ in range(4000)]


def test_ids_and_decoded_texts_are_the_library_s(library, vocab):
    texts = strange_texts()
    ids, counts = vocab.encode_texts(*text_arrays(pa.array(texts)))
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == expected
    blob, sizes = bpe.token_texts(bpe.file_content(PATH)).decode_ids(ids.astype(np.int64), counts)
    ends = np.cumsum(sizes)
    assert [blob[e - s : e].tobytes().decode() for e, s in zip(ends, sizes)] == [library.decode(x, skip_special_tokens=False) for x in expected]


def test_every_token_of_the_vocabulary_encodes_as_in_the_library(library, vocab):
    words = [library.id_to_token(i) for i in range(512, 49406, 7)]
    texts = [w.removesuffix("</w>") for w in words if w.isascii()]
    ids, counts = vocab.encode_texts(*text_arrays(pa.array(texts)))
    assert ids.tolist() == [i for e in library.encode_batch(texts, add_special_tokens=False) for i in e.ids] and counts.min() > 0


def test_encode_and_decode_as_columns(spark, library):
    rows = data.rows()
    df = spark.createDataFrame(rows, data.SCHEMA).withColumnRenamed("score", "ids")
    out = bpe.decode(bpe.encode(df, "text", PATH), "ids", PATH)
    got = out.collect()
    assert len(got) == len(rows) and set(out.columns) == {*df.columns, "decoded"}
    for r in got:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == ids and r["decoded"] == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode(spark.createDataFrame([], data.SCHEMA), "text", PATH).collect() == []


def greedy(word: str, first: set[str], later: set[str]) -> int:
    count, at = 0, 0
    while at < len(word):
        end = next((k for k in range(len(word), at, -1) if word[at:k] in (later if at else first)), 0)
        if not end:
            return -1
        at, count = end, count + 1
    return count


def test_failure_links_count_greedy_pieces():
    r = random.Random(3)
    for turn in range(400):
        make = lambda: {"".join(r.choice("abc") for _ in range(r.randrange(1, 6))) for _ in range(r.randrange(1, 12))}
        first, later = make(), make() if turn % 2 else None
        match = wordpiece.LongestMatch(first, later)
        for _ in range(20):
            word = "".join(r.choice("abc") for _ in range(r.randrange(0, 12)))
            assert match.count(word) == greedy(word, first, first if later is None else later)


def test_piece_counts_of_documents(spark, vocab):
    rows = data.rows()
    df = spark.createDataFrame(rows, data.SCHEMA).withColumnRenamed("score", "n_words")
    tokens = set(vocab.symbol_tokens())
    got = wordpiece.count_pieces(df, "text", PATH).collect()
    assert len(got) == len(rows)
    for r in got:
        found = vocab.words(r["text"] or "")
        counts = [1 if isinstance(w, int) else greedy(w, tokens, tokens) for w in found]
        assert (r["n_words"], r["n_pieces"], r["n_unknown"]) == (len(found), sum(map(abs, counts)), counts.count(-1))
    assert wordpiece.count_pieces(spark.createDataFrame([], data.SCHEMA), "text", PATH).collect() == []


def test_packing_places_every_id_once(spark, library):
    rows = data.rows(count=80)
    df = spark.createDataFrame(rows, data.SCHEMA).coalesce(2)
    got = packing.pack(df, "doc_id", "text", PATH, 2, capacity=256).collect()
    assert sum(r["length"] for r in got if r["start"] + r["length"] == r["doc_tokens"]) > 0
    sequences, pieces = {}, {}
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], ids))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 256 or at & (at - 1) == 0
    expected = {}
    for key, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        expected.setdefault((key, len(ids)), []).extend(enumerate(ids))
    assert {k: sorted((s + i, x) for s, ids in v for i, x in enumerate(ids)) for k, v in pieces.items()} == {k: sorted(v) for k, v in expected.items()}
    assert packing.pack(spark.createDataFrame([], data.SCHEMA), "doc_id", "text", PATH, 2).collect() == []


def test_costs_are_balanced():
    r = random.Random(2)
    pieces = [packing.Piece(k, 0, np.zeros(r.randrange(1, 1000), np.int32), 0) for k in range(900)]
    filled, over = packing.fill(pieces, 1000, 1.0, 1 / 1000)
    assert all(sum(len(p.ids) for p in s) == 1000 for s in filled) and sum(len(p.ids) for p in over) < 1000
    costs = [sum(packing.cost_of(len(p.ids), 1.0, 1 / 1000) for p in s) for s in filled]
    in_order = [1000 + sum(len(p.ids) ** 2 for p in pieces[k : k + 2]) / 1000 for k in range(0, 900, 2)]
    assert np.std(costs) < np.std(in_order)
