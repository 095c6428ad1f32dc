"""The stages of the pipeline one after the other, each held against its operator or brute force."""

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lodestrata.session import cut_lineage
from tests.llm import data


def test_each_stage_on_its_own_input(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "ngram_join", "substring_dedup", "packing"]
    before, tables = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        tables[name] = cut_lineage(stage(spark, before, sf))
        if name != "packing":
            assert tables[name].columns == docs.columns
        before = tables[name]
    texts = {name: {r["doc_id"]: r["text"] for r in t.collect()} for name, t in tables.items() if name != "packing"}
    original = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert texts["toxicity"].items() <= original.items()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    clean = [k for k, t in labels.items() if not t]
    assert np.mean([k in texts["toxicity"] for k in clean]) > 0.95
    assert texts["line_dedup"].keys() == texts["toxicity"].keys()

    sets = {k: data.shingles(t, 5) for k, t in texts["line_dedup"].items()}
    by_gram: dict = {}
    for k, s in sets.items():
        for g in s:
            by_gram.setdefault(g, []).append(k)
    pairs = {(a, b) for ks in by_gram.values() for a in ks for b in ks if a < b}
    label = data.reach(list(sets), [(a, b) for a, b in pairs if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])])
    assert texts["ngram_join"].keys() == {k for k in sets if label[k] == k}

    expected = data.repeated_words(list(texts["ngram_join"].items()), 50)
    assert {k: data.words(t) for k, t in texts["substring_dedup"].items()} == {k: v for (k, _), v in expected.items()}

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got: dict = {}
    for r in tables["packing"].orderBy("doc_id", "start").collect():
        got.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert got == {k: library.encode(t, add_special_tokens=False).ids + [2] for k, t in texts["substring_dedup"].items()}
    assert tables["packing"].groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 4096").count() == 0
