"""The classifier against a plain forward pass, and what it may learn from."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodestrata.llm import toxicity
from lodestrata.llm.common import LOWER, code_of, mix, text_arrays
from lodestrata.llm.queries import learnable
from tests.llm import data


def made_up(count: int = 240, seed: int = 3) -> tuple[list[str], np.ndarray]:
    r = random.Random(seed)
    words = ["".join(r.choices("abcdefgh", k=r.randrange(1, 9))) for _ in range(150)]
    texts, toxic = [], []
    for k in range(count):
        w = [r.choice(words) for _ in range(r.randrange(0, 30))]
        bad = k % 3 == 0
        if bad:
            w.insert(r.randrange(len(w) + 1), "vile nasty")
        texts.append(" ".join(w))
        toxic.append(float(bad))
    return texts, np.array(toxic)


def bucket(word: bytes, k: int, size: int) -> int:
    raw = LOWER[np.frombuffer(word, np.uint8)]
    code = code_of(raw, np.array([0]), np.array([len(raw)]))
    return int((mix(code + np.uint64(k)) % np.uint64(size))[0])


def forward(model: toxicity.Model, text: str) -> float:
    """Word by word, width by width, filter by filter."""
    size, vectors = len(model.embedding), []
    for w in split(text.encode()):
        vectors.append(sum(model.embedding[bucket(p, k, size)].astype(np.float64) for k, p in enumerate((w, w[:4], w[:6]))))
    pooled = []
    for width in toxicity.WIDTHS:
        filters = model.filters[width]
        for f in range(filters.shape[2]):
            best = None
            for at in range(len(vectors)):
                total = sum(float(vectors[at + s] @ filters[s, :, f]) for s in range(width) if at + s < len(vectors))
                best = total if best is None else max(best, total)
            pooled.append(0.0 if best is None else best)
    hidden = np.maximum(np.array(pooled) + model.bias, 0)
    return float(1 / (1 + np.exp(-(hidden @ model.weights.astype(np.float64) + model.intercept))))


def split(raw: bytes) -> list[bytes]:
    out, word = [], b""
    for b in raw:
        if toxicity.NOT_LETTER[b]:
            out, word = out + ([word] if word else []), b""
        else:
            word += bytes([b])
    return out + ([word] if word else [])


def test_scores_are_those_of_a_plain_forward_pass():
    texts, toxic = made_up()
    model = toxicity.train(texts, toxic, ["en"] * len(texts), 0.3, buckets=512, examples=600)
    odd = ["", " \n", "a", "VILE Nasty", "vile nasty " * 40, "é ü ñ", "x" * 500, "one two three, four-five"]
    got = model.scores(model.tables(), *text_arrays(pa.array([*texts[:60], *odd, None])))
    assert np.allclose(got, [forward(model, t) for t in [*texts[:60], *odd, ""]], atol=1e-4)
    alone = np.concatenate([model.scores(model.tables(), *text_arrays(pa.array([t]))) for t in [*texts[:60], *odd, ""]])
    assert np.array_equal(got, alone)


def test_held_out_labels_are_never_learnt(spark):
    texts, toxic = made_up(150)
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(y)) for k, y in enumerate(toxic)], "doc_id long, toxic int")
    turned = labels.withColumn("toxic", F.when(learnable("doc_id"), F.col("toxic")).otherwise(1 - F.col("toxic")))
    models = [toxicity.fit(docs, x, "doc_id", "text", "lang", "toxic", learnable("doc_id")) for x in (labels, turned)]
    assert models[0].intercept == models[1].intercept and models[0].thresholds == models[1].thresholds
    assert np.array_equal(models[0].embedding, models[1].embedding) and np.array_equal(models[0].weights, models[1].weights)


def test_every_labelled_text_is_learnt(spark):
    """Texts of any length and number: the long ones alone show some words."""
    texts, toxic = made_up(400)
    clean = "abc def " * 2600
    texts += [clean + ("foul grim" if k % 2 else "fair calm") for k in range(120)]
    toxic = np.append(toxic, np.arange(120) % 2)
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(y)) for k, y in enumerate(toxic)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, "doc_id", "text", "lang", "toxic", F.lit(True))
    said = model.scores(model.tables(), *text_arrays(pa.array(["vile nasty", clean + "foul grim", clean + "fair calm"]))) >= 0.5
    assert said.tolist() == [True, True, False]


def test_a_round_over_many_tasks_is_the_mean_of_their_changes(spark):
    texts, toxic = made_up(200)
    df = spark.createDataFrame([(k, int(y), t) for k, (t, y) in enumerate(zip(texts, toxic))], "k int, _toxic int, _text string")
    stored = toxicity.hashed_words(df.repartitionByRange(3, "k")).select("_toxic", "_words", F.spark_partition_id().alias("p"))
    stored = spark.createDataFrame(stored.collect(), stored.schema).repartitionByRange(3, "p").sortWithinPartitions("_words", "_toxic").drop("p")
    learner, before, alone = toxicity.Learner(), toxicity.Learner(), []
    for part in stored.rdd.glom().collect():
        mine, steps, moved = toxicity.Learner(), 0, np.zeros(toxicity.BUCKETS)
        words = [np.frombuffer(bytes(r["_words"]), "<u2").reshape(-1, 3).astype(np.int64) for r in part]
        given = np.concatenate(words), np.array([len(w) for w in words]), np.array([r["_toxic"] for r in part])
        for rows in mine.learn(*given, 2, np.random.default_rng([0, len(alone)])):
            steps, moved[rows] = steps + 1, moved[rows] + 1
        alone.append((mine, steps, moved))
    toxicity.one_round(stored, learner, 2, 0)
    steps = sum(s for _, s, _ in alone)
    dense = sum((m.dense() - before.dense()) * s for m, s, _ in alone) / steps
    assert steps and np.allclose(learner.dense(), before.dense() + dense, atol=1e-5)
    moved = np.maximum(sum(n for _, _, n in alone), 1)[:, None]
    change = sum((m.model.embedding - before.model.embedding) * n[:, None] for m, _, n in alone) / moved
    assert np.allclose(learner.model.embedding, before.model.embedding + change, atol=1e-5)


def test_thresholds_from_counts_make_the_fewest_errors(spark):
    texts, toxic = made_up(300)
    model = toxicity.train(texts, toxic, ["en"] * 300, 0.3, examples=600)
    languages = ["en" if k % 2 else None if k % 4 else "xx" if k < 20 else "fr" for k in range(300)]
    noisy = [int(y) if k % 7 else 1 - int(y) for k, y in enumerate(toxic)]
    df = spark.createDataFrame(list(zip(languages, noisy, texts)), "_lang string, _toxic int, _text string")
    score, y, names = model.scores(model.tables(), *text_arrays(pa.array(texts))), np.array(noisy), np.array([x or "" for x in languages])
    model.thresholds, model.threshold = {}, 0.5
    toxicity.set_thresholds(model, toxicity.hashed_words(df))
    assert set(model.thresholds) == {"en", "fr"}
    for name, limit in [*model.thresholds.items(), (None, model.threshold)]:
        s, t = (score, y) if name is None else (score[names == name], y[names == name])
        wrong = lambda at: int(((s >= at) != (t == 1)).sum())
        assert 0 < limit < 1 and wrong(limit) <= min(wrong(at) for at in [*s, 0.0, 1.1]) + 1


@pytest.mark.parametrize("rows", ["awkward", "none"])
def test_stages_take_awkward_and_empty_tables(spark, sf, rows):
    """NULLs in every column, empty and repeated rows and clashing names go through every stage."""
    given = data.rows() if rows == "awkward" else []
    before = spark.createDataFrame([r[:5] for r in given], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, sf)
        found, came = after.collect(), before.collect()
        if name != "packing":
            assert after.columns == before.columns
            before = spark.createDataFrame([tuple(r) for r in found], before.schema)
        if rows == "none":
            assert found == []
        elif name == "ngram_join":
            sets = {r.doc_id: data.shingles(r.text, 5) for r in came if r.doc_id is not None}
            links = [(a, b) for a in sets for b in sets if a < b and sets[a] & sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
            first = data.reach(list(sets), links)
            assert links and {r.doc_id for r in found} == {k for k in sets if first[k] == k} | {None}
        elif name == "packing":
            assert {r.doc_id for r in found} == {r.doc_id for r in came}
