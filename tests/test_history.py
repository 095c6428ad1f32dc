import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestrata.operators import history
from lodestrata.operators.history import with_row_hash
from lodestrata.plans.registry import at


def rows(spark, pairs):
    return with_row_hash(spark.createDataFrame(pairs, "id int, v string"), ["v"])


def test_keep_latest(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [("C001", "John Doe", t), ("C001", "John Doe", t), ("C002", "Jane Smith", t)], "customer_id string, name string, ts timestamp_ntz"
    )
    assert history.keep_latest(df, ["customer_id"], [F.col("ts").desc()]).count() == 2


def versions(df):
    return sorted((r.id, r.v, r._is_current) for r in df.collect())


def test_scd2_lifecycle(spark):
    v1 = history.open_version(rows(spark, [(1, "A"), (2, "B")]), at("2024-01-01"))
    v2 = history.scd2_merge(v1, rows(spark, [(1, "A"), (2, "B2"), (3, "C")]), ["id"], at("2024-02-01"))
    want = [(1, "A", True), (2, "B", False), (2, "B2", True), (3, "C", True)]
    assert versions(v2) == want
    again = history.scd2_merge(v2, rows(spark, [(1, "A"), (2, "B2"), (3, "C")]), ["id"], at("2024-03-01"))
    assert versions(again) == want
    v3 = history.scd2_merge(again, rows(spark, [(2, "B3")]), ["id"], at("2024-04-01"))
    assert v3.count() == 5
    assert v3.filter("_is_current").groupBy("id").count().filter("count > 1").count() == 0
    late = history.scd2_merge(v3, rows(spark, [(2, "OLD")]), ["id"], at("2024-01-15"))
    assert versions(late) == versions(v3)


states = st.dictionaries(st.integers(1, 6), st.sampled_from("ABC"), max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(states, min_size=1, max_size=3))
def test_scd2_properties(spark, loads):
    schema = rows(spark, [(0, "x")]).schema
    target = history.open_version(spark.createDataFrame([], schema), at("2024-01-01"))
    for i, load in enumerate(loads, start=1):
        source = rows(spark, list(load.items())) if load else spark.createDataFrame([], schema)
        target = history.scd2_merge(target, source, ["id"], at(f"2024-01-{i + 1:02d}"))
    found = target.collect()
    for key in {r.id for r in found}:
        mine = sorted((r for r in found if r.id == key), key=lambda r: r._effective_from)
        assert sum(r._is_current for r in mine) == 1
        for a, b in zip(mine, mine[1:]):
            assert a._effective_to <= b._effective_from


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(states, states)
def test_change_feed_replays(spark, before, after):
    schema = rows(spark, [(0, "x")]).schema
    old = rows(spark, list(before.items())) if before else spark.createDataFrame([], schema)
    new = rows(spark, list(after.items())) if after else spark.createDataFrame([], schema)
    feed = history.change_feed(old, new, ["id"])
    replayed = history.apply_change_feed(old, feed, ["id"])
    assert sorted((r.id, r.v) for r in replayed.collect()) == sorted(after.items())


def test_null_fields_hash_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    assert with_row_hash(df, ["x", "y", "z"]).select("_record_hash").distinct().count() == 2


def test_delete_keeps_unknown(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id int, v int")
    assert [r.id for r in history.conditional_delete(df, F.col("v") > 1).collect()] == [1]


def test_find_date_column():
    from pyspark.sql import types as T

    two = T.StructType([T.StructField("x", T.DateType()), T.StructField("event_timestamp", T.TimestampType())])
    assert history.find_date_column(two) == "event_timestamp"
    assert history.find_date_column(T.StructType([T.StructField("x", T.DateType())])) == "x"
    assert history.find_date_column(T.StructType([T.StructField("x", T.StringType())])) is None


def test_archive_writes_both_parts(spark, tmp_path):
    df = spark.sql("SELECT id, date_add(DATE'2024-01-01', CAST(id AS INT)) AS d FROM range(10)")
    history.run_retention(df, {"action": "archive", "retention_days": 5}, "d", at("2024-01-10"), f"{tmp_path}/a", f"{tmp_path}/k")
    assert spark.read.parquet(f"{tmp_path}/a").count() == 4
    assert spark.read.parquet(f"{tmp_path}/k").count() == 6
