"""Texts that sums of powers can't tell apart: words in the order of Thue and Morse, and their complements."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lodestrata.llm import bpe, factors, lines, ngrams, quality, runs, wordpiece
from lodestrata.llm.common import code_of, codes_along, equal_bytes, gram_codes, text_arrays
from tests.llm import data

PATH = public_tokenizers.path("word_bpe_49k.json")


def pattern(n: int, letters: str = "ab") -> str:
    return "".join(letters[bin(i).count("1") & 1] for i in range(n))


def pair(n: int) -> tuple[str, str]:
    return pattern(n), pattern(n, "ba")


@pytest.mark.parametrize("n", [256, 1024, 2048, 8192])
def test_patterned_words_have_their_own_hashes(n):
    words = [*pair(n), *("".join(random.Random(k).choices("ab", k=n)) for k in range(200))]
    raw, offsets = text_arrays(pa.array(words))
    assert len(set(code_of(raw, offsets[:-1], offsets[1:]).tolist())) == len(words)
    assert not equal_bytes(raw, offsets[:1], offsets[1:2], np.array([n]))[0] and equal_bytes(raw, offsets[:1], offsets[:1], np.array([n]))[0]
    bits = np.array([c == "a" for c in pattern(n)], np.uint64)
    both = [gram_codes(x.astype(np.uint64), 64) for x in (bits, 1 - bits)]
    assert len(set(np.concatenate(both).tolist())) == len({tuple(x[i : i + 64].tolist()) for x in (bits, 1 - bits) for i in range(n - 63)})
    seen = {}
    for text in words[:4]:
        for i, code in enumerate(codes_along(np.frombuffer(text.encode(), np.uint8), 100).tolist()):
            assert seen.setdefault(code, text[i : i + 100]) == text[i : i + 100]


def test_a_stretch_has_one_hash_wherever_it_lies():
    r = random.Random(2)
    for n in (0, 1, 7, 8, 9, 63, 64, 511, 512, 513, 5000, 70000):
        word = "".join(r.choices("abcdefgh ", k=n))
        codes = set()
        for before in ("", "xyz", "q" * 17):
            raw, _ = text_arrays(pa.array([before + word + "tail"]))
            codes.add(int(code_of(raw, np.array([len(before)]), np.array([len(before) + n]))[0]))
        assert len(codes) == 1
    for n in (3, 8, 12, 32, 100):
        text = np.frombuffer("".join(r.choices("ab", k=400)).encode(), np.uint8)
        codes = codes_along(text, n)
        assert len(codes) == 401 - n
        for i in range(0, 401 - n, 37):
            assert codes_along(text[i : i + n], n)[0] == codes[i]


@pytest.mark.parametrize("n", [1024, 2048, 8192])
def test_encoder_and_word_pieces_on_patterned_words(n):
    texts = [*pair(n), " ".join(pair(n)), " ".join(reversed(pair(n)))]
    library = Tokenizer.from_file(PATH)
    ids, counts = bpe.vocabulary(bpe.file_content(PATH)).encode_texts(*text_arrays(pa.array(texts)))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    both = wordpiece.counter(bpe.file_content(PATH)).of_texts(*text_arrays(pa.array(texts)))
    alone = [int(wordpiece.counter(bpe.file_content(PATH)).of_texts(*text_arrays(pa.array([t])))[0][1]) for t in texts]
    assert both[:, 1].tolist() == alone


def test_shingles_and_windows_of_patterned_words(spark):
    s, t = pair(2048)
    a, b = " ".join([s] * 5), " ".join([t] * 5)
    one, two = (" ".join(s if c == "a" else t for c in pattern(64, letters)) for letters in ("ab", "ba"))
    rows = [(1, a), (2, b), (3, one), (4, two), (5, two + " end")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {k: data.shingles(x, 5) for k, x in rows}
    links = [(x, y) for x in sets for y in sets if x < y and 5 * len(sets[x] & sets[y]) >= 4 * len(sets[x] | sets[y])]
    got = ngrams.similar_documents(df, "doc_id", "text")
    assert {r["_doc"]: r["_component"] for r in got.collect()} == data.reach(list(sets), links)
    expected = data.repeated_words(rows, 50)
    cut = factors.without_repeats(df, "doc_id", "text")
    assert {(r["doc_id"], r["n_removed"]) for r in cut.collect()} == {(k, len(data.words(x)) - len(expected[k, x])) for k, x in rows}
    short = [(k, x[:3000]) for k, x in rows]
    kept = data.repeated_bytes(short, 100)
    left = runs.without_repeats(spark.createDataFrame(short, "doc_id long, text string"), "doc_id", "text")
    assert {r["doc_id"]: bytes(r["kept"]) for r in left.collect()} == {k: kept[k, x][0] for k, x in short}


def test_columns_may_have_any_name(spark):
    names = ["__host", "__lines", "__drop", "__w", "__h", "__number", "__digest", "__text", "_later", "_row", "_key", "_text", "c0", "_own", "_turn"]
    schema = "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in names)
    rows = [(k, t, "s", *["v"] * len(names)) for k, t, *_ in data.rows() if k is not None]
    df = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(1,)], "doc_id long")
    for out in (
        lines.drop_site_lines(df, "source", "text"), quality.judge(df, "doc_id", "text", labels), ngrams.one_of_each(df, "doc_id", "text"),
        factors.without_repeats(df, "doc_id", "text"), runs.without_repeats(df, "doc_id", "text"),
    ):
        assert out.columns[: len(df.columns)] == df.columns
        assert {tuple(r[c] for c in names) for r in out.collect()} == {("v",) * len(names)}
