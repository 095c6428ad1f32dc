"""Stored parts that are put together, and indexes that spare reading: against direct results."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestrata.operators import access, documents, governance, history, mergeable
from lodestrata.plans.registry import at
from lodestrata.sources.writers import write_load

T0 = dt.datetime(2024, 1, 1)


def test_profiles_of_two_loads_are_that_of_their_union(spark, tmp_path):
    r = random.Random(3)
    rows = [(i, r.choice(["a", "b", "c", None]), r.gauss(1e9, 1.0) if r.random() > 0.1 else None, str(r.randrange(40_000))) for i in range(20_000)]
    df = spark.createDataFrame(rows, "id int, kind string, amount double, token string")
    columns = ["id", "kind", "amount", "token"]
    for load, part in (("a", df.filter("id < 3000")), ("b", df.filter("id >= 3000")), ("empty", df.limit(0))):
        mergeable.profile_load(part, columns, load).write.mode("append").parquet(str(tmp_path / "p"))
    got = {x.column_name: x for x in mergeable.merge_profiles(spark.read.parquet(str(tmp_path / "p"))).collect()}
    for k, c in enumerate(columns):
        values = [x[k] for x in rows if x[k] is not None]
        assert (got[c].total_rows, got[c].null_count) == (20_000, 20_000 - len(values))
        assert abs(got[c].distinct_count - len(set(values))) <= mergeable.DISTINCT_BOUND * len(set(values))
        if c in ("id", "amount"):
            assert (got[c].min_value, got[c].max_value) == (min(values), max(values))
            assert got[c].avg_value == pytest.approx(np.mean(values), rel=1e-14) and got[c].std_dev == pytest.approx(np.std(values, ddof=1), rel=1e-6)
            for q, v in zip((25, 50, 75), got[c].quartiles):
                assert np.percentile(values, q - 2) <= v <= np.percentile(values, q + 2)
        else:
            assert got[c].quartiles is None and got[c].min_value is None
    counts = {v: sum(x[1] == v for x in rows) for v in "abc"}
    assert {x["item"]: x["count"] for x in got["kind"].top_values if x["item"] is not None} == counts


def test_a_day_is_read_once_and_thirty_days_are_put_together(spark, tmp_path):
    r = random.Random(5)
    rows = [(k, T0 + dt.timedelta(days=d, hours=r.randrange(24)), r.choice([None, 1e12 + r.random()])) for d in range(35) for k in ("x", "y", None) for _ in range(r.randrange(6))]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    path = str(tmp_path / "days")
    for d in [*range(35), 20, 3]:  # every day alone, two of them again
        day = df.filter(F.col("ts").cast("date") == F.lit((T0 + dt.timedelta(days=d)).date()))
        write_load(mergeable.day_moments(day, ["k"], "ts", ["v"]), path, "partitions", ["day"])
    since = (T0 + dt.timedelta(days=5)).date()
    got = {x.k: x for x in mergeable.combine_days(spark.read.parquet(path).filter(F.col("day") >= F.lit(since)), ["k"], ["v"]).collect()}
    for k in ("x", "y", None):
        values = [v for kk, t, v in rows if kk == k and t.date() >= since and v is not None]
        assert got[k].avg_v == pytest.approx(np.mean(values), rel=1e-15) and got[k].std_v == pytest.approx(np.std(values, ddof=1), rel=1e-3)


def test_stored_access_days_give_the_same_baseline(spark, tmp_path):
    r = random.Random(1)
    rows = [(r.randrange(5), T0 + dt.timedelta(hours=r.randrange(24 * 50)), f"t{r.randrange(4)}", r.choice(["read", "write", None]), r.randrange(10**9)) for _ in range(600)]
    log = spark.createDataFrame(rows, "user_id int, ts timestamp_ntz, table_name string, operation string, bytes_scanned bigint")
    now = at("2024-02-15 12:00:00")
    want, got = (sorted(map(tuple, x.collect())) for x in (access.access_baseline(log, now), mergeable.access_baseline(mergeable.access_days(log), now)))
    assert [w[:4] for w in want] == [g[:4] for g in got] and np.allclose([w[4:] for w in want], [g[4:] for g in got])


TEXTS = ["Breathe is in", "the is the is", "the  is not it", "the\nis no", "this the is", "", None, "the isle of the", "IS the", "the, is", "other things", "the is"]


@pytest.mark.parametrize("phrase", ["the is", "the", "is", "e is th", "the  is", "no such", "is the is", "the is "])
def test_the_index_finds_what_a_scan_finds(spark, tmp_path, phrase):
    df = spark.createDataFrame([(i, t, "en" if i % 3 else "de") for i, t in enumerate(TEXTS)], "p int, t string, lang string")
    index = documents.document_index(df, "p", "t", keep=["p", "lang"])
    documents.write_postings(index, str(tmp_path / "ix"), 3)
    shown = index.drop("searchable_text")
    for kinds in (None, ["en"]):
        want = documents.search(index, phrase, 5, kinds, "lang")
        got = documents.search_postings(spark.read.parquet(str(tmp_path / "ix")), shown, phrase, 5, kinds, "lang")
        assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "searchable_text" not in plan or "posexplode" not in plan


def test_the_index_is_written_without_a_shuffle(spark, tmp_path):
    """A row a word through an exchange took more than twenty times the input of disk; each document's id is stored once."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "p int, t string").repartition(3)
    index = documents.document_index(df, "p", "t").cache()
    plan = documents.postings(index)._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    assert "Exchange" not in plan
    documents.write_postings(index, str(tmp_path / "ix"))
    stored = spark.read.parquet(str(tmp_path / "ix"))
    assert stored.filter("document_id IS NOT NULL").count() == len(TEXTS) == stored.select("document_no").distinct().count()
    words = sum(len(r[0].split(" ")) for r in index.select("searchable_text").collect())
    assert stored.select(F.explode("places")).count() == words
    got = documents.search_postings(stored, index.drop("searchable_text"), "the is", 5).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, documents.search(index, "the is", 5).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_pivots_leave_vectors_out_and_lose_none(spark, tmp_path, seed):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, 10))
    rows = [(i, [float(x) for x in centres[i % 12] + r.normal(size=10) * 0.1]) for i in range(600)] + [(600, [0.0] * 10), (601, None), (602, [float(x) for x in centres[0]])]
    df = spark.createDataFrame(rows, "id int, e array<double>")
    pivots = documents.choose_pivots(df, "e", "id", 6)
    documents.write_pivot_index(df, "e", pivots, str(tmp_path / "ix"))
    for q in ([float(x) for x in centres[0]], [float(x) for x in r.normal(size=10)], [0.0] * 10):
        found, read = documents.nearest_by_pivots(spark.read.parquet(str(tmp_path / "ix")), pivots, q, "e", "id", 10)
        wanted = spark.createDataFrame([(q,)], "query_vector array<double>")
        want = [(x.id, x.similarity) for x in documents.nearest_vectors(df, wanted, "e", "id", 10).collect()]
        assert [(x.id, x.similarity) for x in found.collect()] == want
        if q[0] == float(centres[0][0]):
            assert read.count() < 200


def test_only_buckets_that_differ_are_joined(spark):
    old = spark.range(5000).select("id", F.concat(F.lit("n"), "id").alias("v"))
    new = old.filter("id <> 17").withColumn("v", F.when(F.col("id") == 99, "changed").otherwise(F.col("v"))).unionAll(spark.createDataFrame([(9999, "new")], old.schema))
    old, new = (x.withColumn("_record_hash", F.sha2("v", 256)) for x in (old, new))
    digests = [history.bucket_digests(x, ["id"], buckets=512) for x in (old, new)]
    changed = history.changed_buckets(*digests)
    assert changed.count() <= 3
    assert history.rows_of_buckets(old, ["id"], changed, 512).count() < 60
    feeds = [history.change_feed(old, new, ["id"]), history.change_feed_by_buckets(old, new, ["id"], buckets=512), history.change_feed_by_buckets(old, new, ["id"], "_record_hash", 512, *digests)]
    assert sorted(map(tuple, feeds[0].collect())) == sorted(map(tuple, feeds[1].collect())) == sorted(map(tuple, feeds[2].collect()))
    assert len(feeds[0].collect()) == 4
    assert history.change_feed_by_buckets(old, old, ["id"]).count() == 0
    with pytest.raises(ValueError):
        history.change_feed_by_buckets(old, new, ["id"], buckets=0)


def test_contained_names_by_their_rarest_gram(spark):
    r = random.Random(7)
    names = lambda n: ["".join(r.choices("abc", k=r.randrange(0, 9))) for _ in range(n)] + ["", "é", "aé", "premium_amount", "amount"]
    inner, outer = sorted(set(names(150))), sorted(set(names(150)))
    got = governance.contained_names(spark.createDataFrame([(x,) for x in inner], "inner string"), spark.createDataFrame([(x,) for x in outer], "outer string"))
    assert sorted(map(tuple, got.collect())) == sorted((a, b) for a in inner for b in outer if a and a in b)


@pytest.mark.parametrize("places, reach", [(governance.PLACES, governance.REACH), (5, 2), (1, 1)])
def test_rarest_grams_lose_no_name(spark, monkeypatch, places, reach):
    """Also where grams share a place, or where only the first letters of a name are tried."""
    monkeypatch.setattr(governance, "PLACES", places)
    monkeypatch.setattr(governance, "REACH", reach)
    r = random.Random(11)
    names = lambda n: ["".join(r.choices("abé", k=r.randrange(0, 8))) for _ in range(n)] + ["zzz", "aab", "premium_amount"]
    inner, outer = sorted({*names(120), "amount", "amounts"}), sorted(set(names(120)))
    i, o = spark.createDataFrame([(x,) for x in inner], "inner string"), spark.createDataFrame([(x,) for x in outer], "outer string")
    found = [tuple(x) for x in governance.rarest_grams(i, o).collect()]
    assert len({name for name, _ in found}) == len(found)
    assert all(len(gram) == 3 and gram in name for name, gram in found)
    assert {a for a in inner if len(a) >= 3 and any(a in b for b in outer)} <= {name for name, _ in found}
    if places > 5:
        assert "amounts" not in {name for name, _ in found}
    got = governance.contained_names(i, o)
    assert sorted(map(tuple, got.collect())) == sorted((a, b) for a in inner for b in outer if a and a in b)
