"""Toxicity, quality, boilerplate lines and vectors."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestrata.llm import lines, quality, toxicity, vectors
from tests.llm import data


def labelled(count: int = 900) -> tuple[list[str], np.ndarray, list[str]]:
    r = random.Random(9)
    plain = ["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(200)]
    texts, toxic, languages = [], [], []
    for k in range(count):
        w = [r.choice(plain) for _ in range(r.randrange(10, 80))]
        if k % 3 == 0:
            w[r.randrange(len(w))] = "vile" + r.choice(plain)
        texts.append(" ".join(w))
        toxic.append(k % 3 == 0)
        languages.append("en" if k % 2 else "fr")
    return texts, np.array(toxic, float), languages


def test_held_out_texts_are_told_apart():
    texts, toxic, languages = labelled(1500)
    model = toxicity.train(texts[:1000], toxic[:1000], languages[:1000], 1 / 3)
    score = model.scores(model.tables(), *toxicity.text_arrays(pa.array(texts[1000:])))
    assert ((score >= 0.5) == (toxic[1000:] == 1)).mean() > 0.97
    assert set(model.thresholds) == {"en", "fr"} and all(0 < t < 1 for t in model.thresholds.values())


def test_scores_of_awkward_rows(spark):
    texts, toxic, languages = labelled(300)
    docs = spark.createDataFrame([(k, t, language) for k, (t, language) in enumerate(zip(texts, languages))], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(t)) for k, t in enumerate(toxic)] + [(0, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, "doc_id", "text", "lang", "toxic", F.col("doc_id") >= 0)
    rows = data.rows()
    df = spark.createDataFrame(rows, data.SCHEMA)
    got = toxicity.score(df, "text", "lang", model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if not data.words(r["text"])}) == 1
    same = {}
    for r in got:
        assert same.setdefault(r["text"], r["score"]) == r["score"]
    again = toxicity.fit(docs, labels, "doc_id", "text", "lang", "toxic", F.col("doc_id") >= 0)
    assert np.array_equal(again.embedding, model.embedding)
    nothing = toxicity.fit(docs, labels.limit(0), "doc_id", "text", "lang", "toxic", F.lit(True))
    assert {round(r["score"], 3) for r in toxicity.score(df, "text", "lang", nothing).collect()} == {0.0}
    assert toxicity.score(df.limit(0), "text", "lang", model).collect() == []


def test_rule_counts_and_verdicts(spark):
    rows = data.rows() + [(900 + k, t, None, None, None, None, None, None) for k, t in enumerate(["a b c d e\n" * 3 + "f #*$ <|>", "#% & a\n\n \n#% & a", "p q r s t " * 40, "a b c d e f g h i j"])]
    df = spark.createDataFrame(rows, data.SCHEMA).withColumnRenamed("n_removed", "n_words")
    trusted = df.select("doc_id").filter("doc_id % 2 = 0")
    got = quality.judge(df, "doc_id", "text", trusted, least=0.0).collect()
    assert len(got) == len(rows)
    for r in got:
        counts = data.rule_counts(r["text"])
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == counts
        assert r["base_failed"] == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert r["kept"] == (not r["base_failed"] and r["likeness"] >= 0)
    good, other = ([r["likeness"] for r in got if r["doc_id"] is not None and r["doc_id"] % 2 == k and r["n_words"] > 50] for k in (0, 1))
    assert np.mean(good) > np.mean(other)
    assert quality.judge(df.limit(0), "doc_id", "text", trusted).collect() == []


def test_likeness_is_the_mean_log_ratio(spark):
    import xxhash

    texts = {1: "a b a", 2: "b c", 3: "a"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["likeness"] for r in quality.judge(df, "doc_id", "text", df.filter("doc_id = 1"), buckets=64).collect()}

    def grams(text):
        w = [xxhash.xxh64_intdigest(x.encode(), 42) for x in text.split()]
        pair = lambda a, b: xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42))
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        return [signed(x) % 64 for x in [*w, *[pair(a, b) for a, b in zip(w, w[1:])]]]

    raw = np.bincount([g for t in texts.values() for g in grams(t)], minlength=64) + 1.0
    target = np.bincount(grams(texts[1]), minlength=64) + 1.0
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    for k, t in texts.items():
        assert got[k] == pytest.approx(np.mean(ratio[grams(t)]))


def test_the_ratio_decides_on_small_sites_too(spark):
    rows = [(k, f"menu\nown {k}" if k < 5 else f"own {k}", "small") for k in range(20)]
    rows += [(20 + k, f"rare\nown {k}" if k < 2 else f"own {k}", "other") for k in range(20)] + [(50, "alone", "single")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r["text"] for r in lines.drop_site_lines(df, "source", "text").collect()}
    assert [got[k] for k in range(5)] == [f"own {k}" for k in range(5)]
    assert got[20] == "rare\nown 0" and got[50] == "alone"


def test_lines_of_many_pages_of_a_site_go(spark):
    rows = [(k, "menu\n" + f"own {k}\nmenu\n \nrare" if k < 12 else f"own {k}", "site" if k != 3 else None) for k in range(60)]
    rows += [(100, None, "site"), (101, "", "site"), (102, "menu", "site"), (103, "menu", "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_lines", F.lit("x"))
    got = {r["doc_id"]: r for r in lines.drop_site_lines(df, "source", "text", ratio=0.1, least=10).collect()}
    assert len(got) == len(rows)
    assert (got[0]["text"], got[0]["n_lines"], got[0]["n_dropped"]) == ("own 0\n ", 5, 3)
    assert got[3]["text"] == rows[3][1] and got[3]["n_dropped"] == 0
    assert got[100]["text"] is None and (got[100]["n_lines"], got[100]["n_dropped"]) == (0, 0)
    assert (got[101]["text"], got[101]["n_lines"]) == ("", 1)
    assert (got[102]["text"], got[102]["n_dropped"]) == ("", 1) and got[103]["text"] == "menu"
    assert lines.drop_site_lines(df.limit(0), "source", "text").collect() == []


def vector_rows() -> list[tuple]:
    rng = np.random.default_rng(6)
    centres = rng.normal(0, 1, (12, 16))
    made = [(k, (centres[rng.integers(12)] + rng.normal(0, 0.12, 16)).astype(np.float32).tolist(), int(k % 3)) for k in range(240)]
    made += [(300, made[5][1], made[5][2]), (301, made[5][1], None), (302, None, 1), (303, [0.0] * 16, 1), (304, [1.0, None] + [0.0] * 14, 1)]
    made += [(305, [float("nan")] * 16, 1), (306, [float("inf")] + [0.0] * 15, 1), (307, [], 1), (308, [1.0, 2.0], 1), (309, [2.0, 4.0], 1), (None, made[5][1], made[5][2])]
    return made + [(310, [2 * x for x in made[7][1]], made[7][2]), made[9]]


@pytest.mark.parametrize("tile", [1024, 16])
def test_vectors_are_linked_as_by_comparing_all(spark, monkeypatch, tile):
    monkeypatch.setattr(vectors, "TILE", tile)
    rows = vector_rows()
    good = [(k, np.array(v, float), g) for k, v, g in rows if None not in (k, v, g) and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = []
    for (i, (a, x, g)), (j, (b, y, h)) in combinations(enumerate(good), 2):
        if g == h and len(x) == len(y) and x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= 0.98:
            links.append((i, j))
    names = [k for k, _, _ in good]
    label = data.reach(names, [(names[i], names[j]) for i, j in links])
    count = np.zeros(len(good), int)
    for i, j in links:
        count[i] += 1
        count[j] += 1
    expected = sorted((k, int(c), label[k], label[k] == k) for (k, _, _), c in zip(good, count))
    expected += [(k, 0, k, True) for k, v, g in rows if k is not None and k not in names]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("_n", F.lit(1))
    got = [tuple(r) for r in vectors.near_vectors(df, "vec_id", "embedding", "label").collect()]
    assert sorted(r for r in got if r[0] is not None) == sorted(expected)
    assert [r for r in got if r[0] is None] == [(None, 0, None, True)]
    assert max(count) > 5


def test_no_vectors(spark):
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"), "vec_id", "embedding", "label").collect() == []
