"""Passages, byte strings and similar documents against brute force."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from lodestrata.llm import factors, ngrams, runs, segments
from lodestrata.llm.components import components
from tests.llm import data


@pytest.fixture(scope="module")
def docs(spark):
    rows = data.rows()
    return rows, spark.createDataFrame(rows, data.SCHEMA).repartition(5)


def test_passages_of_earlier_documents_go(docs):
    rows, df = docs
    expected = data.repeated_words(rows, 12)
    out = factors.without_repeats(df, "doc_id", "text", width=12, gram=4)
    got = out.collect()
    assert len(got) == len(rows) and set(out.columns) == set(df.columns) | {"n_words"}
    for r in got:
        source = [t for k, t, *_ in rows if k == r["doc_id"]]
        text = next(t for t in source if len(data.words(t)) == r["n_words"])
        kept = expected[r["doc_id"], text]
        assert data.words(r["text"]) == kept and r["n_removed"] == r["n_words"] - len(kept)
        assert (r["text"] is None) == (text is None) and (r["n_removed"] or r["text"] == text)
    assert sum(r["n_removed"] for r in got) > 200


def test_byte_strings_that_start_earlier_go(docs):
    rows, df = docs
    expected = data.repeated_bytes(rows, 40)
    got = runs.without_repeats(df, "doc_id", "text", width=40, gram=12).collect()
    assert len(got) == len(rows)
    for r in got:
        kept, spans = expected[r["doc_id"], r["text"]]
        assert (bytes(r["kept"]), r["n_spans"], r["n_bytes"]) == (kept, spans, len((r["text"] or "").encode()))
        assert r["n_removed"] == r["n_bytes"] - len(kept)


@pytest.mark.parametrize("words", [True, False])
def test_one_passage_of_all_documents_is_compared_in_blocks(spark, monkeypatch, words):
    monkeypatch.setattr(segments, "MANY", 8)
    r = random.Random(6)
    prose = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(n))
    passage, around = prose(30), [prose(20) for _ in range(40)]
    # half of the surroundings are shared by a few documents, so that blocks meet outside the passage too
    texts = [f"{r.choice(around[:20]) if k % 2 else prose(20)} {passage} {prose(20) if k % 3 else r.choice(around[20:])}" for k in range(200)]
    texts[50], texts[60] = texts[150], passage + " " + passage
    rows = [(k, t) for k, t in enumerate(texts)] + [(7, texts[7]), (7, texts[8]), (None, texts[9])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)

    windows, other = (segments.Windows(True, 12, 4), True) if words else (segments.Windows(False, 40, 12), False)
    kept = segments.keyed(df, "doc_id", "text")
    parts = segments.stretches(kept, "text", segments.repeated_anchors(df, "doc_id", "text", windows, other), windows, not other)
    sizes = Counter((x["_anchor"], x["_block"]) for x in parts.collect())
    whole = Counter()
    for (anchor, _), n in sizes.items():
        whole[anchor] += n
    assert max(whole.values()) > 100 and max(sizes.values()) <= 4 * 8

    if words:
        expected = data.repeated_words(rows, 12)
        got = factors.without_repeats(df, "doc_id", "text", width=12, gram=4).collect()
        assert sorted((r["doc_id"] or -1, data.words(r["text"])) for r in got) == sorted((k or -1, expected[k, t]) for k, t in rows)
    else:
        expected = data.repeated_bytes(rows, 40)
        got = runs.without_repeats(df, "doc_id", "text", width=40, gram=12).collect()
        assert sorted((r["doc_id"] or -1, bytes(r["kept"]), r["n_spans"]) for r in got) == sorted((k or -1, *expected[k, t]) for k, t in rows)
    assert len(got) == len(rows) and sum(r["n_removed"] for r in got) > 1000


@pytest.mark.parametrize("tile", [4096, 2])
def test_similar_documents_share_a_component(docs, monkeypatch, tile):
    monkeypatch.setattr(ngrams, "TILE", tile)
    rows, df = docs
    sets = {k: data.shingles(t, 5) for k, t, *_ in rows if k is not None}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    label = data.reach(list(sets), links)
    got = ngrams.similar_documents(df, "doc_id", "text").distinct().collect()
    assert {r["_doc"]: (r["_n"], r["_component"]) for r in got} == {k: (len(sets[k]), label[k]) for k in sets}
    assert len(set(label.values())) < len(sets) - 3


def test_only_the_first_of_similar_documents_stays(docs):
    rows, df = docs
    sets = {k: data.shingles(t, 5) for k, t, *_ in rows if k is not None}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    label = data.reach(list(sets), links)
    out = ngrams.one_of_each(df, "doc_id", "text")
    assert out.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(str(k) for k, *_ in rows if k is None or label[k] == k)


@pytest.mark.parametrize("call", [factors.without_repeats, runs.without_repeats, ngrams.similar_documents, ngrams.one_of_each])
def test_an_empty_table_gives_no_rows(spark, call):
    assert call(spark.createDataFrame([], data.SCHEMA), "doc_id", "text").collect() == []


def test_a_prefix_tree_finds_what_counting_finds():
    rng = np.random.default_rng(3)
    for _ in range(200):
        pool = np.unique(rng.integers(0, 60, 40)).astype(np.uint64)
        sets = [np.sort(rng.choice(pool, rng.integers(1, len(pool)), replace=False)) for _ in range(30)]
        query, partners = sets[0], list(enumerate(sets[1:]))
        expected = [k for k, s in partners if 5 * len(np.intersect1d(s, query)) >= 4 * len(np.union1d(s, query))]
        assert sorted(ngrams.tree_links(query, partners)) == expected


def test_run_index_matches_sorted_suffixes():
    rng = np.random.default_rng(4)
    for _ in range(60):
        texts = [bytes(rng.integers(97, 97 + int(rng.integers(1, 4)), int(rng.integers(1, 40)), dtype=np.uint8)) for _ in range(6)]
        symbols = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts])
        left = np.concatenate([np.arange(n, 0, -1) for n in sizes])
        index = runs.RunIndex(symbols, left, np.cumsum(sizes) - sizes)
        suffix = [symbols[i : i + n].tobytes() for i, n in enumerate(left)]
        order = sorted(range(len(symbols)), key=lambda i: (suffix[i], i))
        assert index.order.tolist() == order
        shared, _ = index.matching_statistics()
        for above, i in zip(order, order[1:]):
            common = 0
            while common < min(len(suffix[i]), len(suffix[above])) and suffix[i][common] == suffix[above][common]:
                common += 1
            assert shared[i] == common
        for width in (1, 3):
            first = runs.earliest(index, width)
            for i, s in enumerate(suffix):
                if len(s) >= width:
                    assert first[i] == next(j for j, t in enumerate(suffix) if t[:width] == s[:width])


def test_components_follow_long_chains(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100 + i, 100) for i in range(1, 30)] + [(7, 7), (60, 61)]
    got = {r["_node"]: r["_component"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    expected = data.reach(sorted({x for p in links if p[0] != p[1] for x in p}), [p for p in links if p[0] != p[1]])
    assert got == expected


def test_set_hashes_do_not_depend_on_the_block():
    texts = pa.array(["a b c d e f", "b c", None, "A  B\tc D\nE F", "c b"])
    value, owner = ngrams.ngram_sets(*ngrams.text_arrays(texts), 5)
    alone = [ngrams.ngram_sets(*ngrams.text_arrays(texts[k : k + 1]), 5)[0].tolist() for k in range(5)]
    assert [value[owner == k].tolist() for k in range(5)] == alone
    assert alone[0] == alone[3] and alone[1] != alone[4] and alone[2] == []


def test_open_pairs_are_those_of_all_comparisons():
    rng = np.random.default_rng(8)
    words = rng.choice([1, 2, 4], 40)
    sketches = [rng.integers(0, 2**62, n) & rng.integers(0, 2**62, n) & rng.integers(0, 2**62, n) for n in words]
    sizes, component = words * 40 + rng.integers(0, 24, 40), rng.integers(0, 6, 40)
    gram = np.repeat([1, 2], 20)
    for tile in (False, True):
        side = np.tile(np.repeat([0, 1], 10), 2) if tile else np.zeros(40, int)
        table = pa.table({"_gram": gram, "_i": np.zeros(40, int), "_j": np.full(40, int(tile)), "_side": side, "_rep": np.arange(40), "_n": sizes,
                          "_component": component, "_bits": pa.array([x.tolist() for x in sketches])})
        got = sorted((int(x), int(y)) for a, b in ngrams.Lists(table).open_pairs(limit=7) for x, y in zip(a, b))
        expected = []
        for i in range(40):
            for j in range(i + 1, 40):
                x, y = (np.asarray(s).view(np.uint64) for s in (sketches[i], sketches[j]))
                while len(x) > len(y):
                    x = ngrams.half(x)
                while len(y) > len(x):
                    y = ngrams.half(y)
                alike = 5 * sizes[i] >= 4 * sizes[j] and 5 * sizes[j] >= 4 * sizes[i]
                meets = gram[i] == gram[j] and (not tile or side[i] < side[j])
                if meets and alike and component[i] != component[j] and 9 * np.bitwise_count(x ^ y).sum() <= sizes[i] + sizes[j]:
                    expected.append((i, j))
        assert got == expected and got


def test_a_stray_document_meets_a_group_once(spark, monkeypatch):
    monkeypatch.setattr(ngrams, "TILE", 4)
    # list 1: a group of 200 and one stray; list 2: three components of 12, 5 and 3
    lists = [(1, k, 100, 0 if k < 200 else 200) for k in range(201)] + [(2, k, 100, 300 if k < 312 else 312 if k < 317 else 317) for k in range(300, 320)]
    bits = spark.createDataFrame([(k, [0]) for _, k, _, _ in lists], "_rep long, _bits array<long>")
    rest = spark.createDataFrame(lists, "_gram long, _rep long, _n long, _component long")
    rows = ngrams.tiles(rest, bits).filter("_gram = 1").count()
    assert rows <= 200 + 1 + 50 + 1
    table = ngrams.tiles(rest, bits).toArrow()
    assert ngrams.Lists(table).count.sum() == 200 + 12 * 5 + 12 * 3 + 5 * 3
    component = {(g, k): c for g, k, _, c in lists}
    expected = {(a, b) for g, a in component for h, b in component if g == h and a < b and component[g, a] != component[g, b]}
    assert {tuple(r) for r in ngrams.pairs_across(rest, bits).collect()} == expected
