import datetime as dt

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import calls, documents, enrich, governance, monitoring, profile, scoring
from lodestrata.plans.registry import at
from lodestrata.session import shared_folder
from lodestrata.sources import readers, writers

T0 = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("n, want", [(10, [(0, 4), (4, 8), (8, 9)]), (9, [(0, 4), (4, 8)]), (5, [(0, 4)]), (1, [(0, 0)]), (0, [])])
def test_chunks(spark, n, want):
    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(n)))], "id int, text string")
    got = [r.chunk_text.split() for r in documents.chunk_words(df, ["id"], "text", 5, 1).orderBy("chunk_index").collect()]
    assert got == [[f"w{i}" for i in range(a, b + 1)] for a, b in want]


def test_chunk_overlap_must_be_smaller(spark):
    with pytest.raises(ValueError):
        documents.chunk_words(spark.createDataFrame([(1, "a")], "id int, text string"), ["id"], "text", 5, 5)


def test_transcript_parts_are_whole(spark):
    rows = [("c", i, "agent" if i % 2 else "caller", f"line {i}") for i in range(7)] * 2
    df = spark.createDataFrame(rows, "call_id string, segment_index int, speaker_label string, text string")
    parts = calls.transcripts(df, segments_per_part=3).orderBy("part_no").collect()
    assert [p.segment_count for p in parts] == [3, 3, 1]
    assert "\n".join(p.transcript for p in parts).split("\n")[1] == "agent: line 1"


def test_search_scores_occurrences(spark):
    df = spark.createDataFrame([("a", "Fire, fire! in the barn"), ("b", "fire"), ("c", "none")], "p string, t string")
    index = documents.document_index(df, "p", "t", keep=["p"])
    assert [(r.p, r.relevance_score) for r in documents.search(index, "FIRE").collect()] == [("a", 2.0), ("b", 1.0)]


def test_jdbc_options():
    base = {"url": "jdbc:x", "source_table_or_path": "t"}
    assert readers.jdbc_options(base) == {"url": "jdbc:x", "dbtable": "t", "fetchsize": "100000"}
    more = readers.jdbc_options({**base, "ingestion_mode": "incremental", "incremental_column": "c", "incremental_value": "o'x",
                                 "partition_column": "id", "lower_bound": 0, "upper_bound": 9, "num_partitions": 3,
                                 "authentication_type": "managed_identity"})
    assert more["dbtable"] == "(SELECT * FROM t WHERE c > 'o''x') AS src" and more["numPartitions"] == "3" and more["authentication"]
    step = {**base, "ingestion_mode": "incremental", "incremental_column": "c"}
    assert readers.jdbc_options({**step, "incremental_value": 0})["dbtable"] == "(SELECT * FROM t WHERE c > '0') AS src"
    assert readers.jdbc_options({**step, "incremental_value": 3, "incremental_upto": 9})["dbtable"] == "(SELECT * FROM t WHERE c > '3' AND c <= '9') AS src"
    assert readers.jdbc_options({**step, "incremental_upto": 9})["dbtable"] == "(SELECT * FROM t WHERE (c <= '9' OR c IS NULL)) AS src"
    assert readers.jdbc_options(step)["dbtable"] == "t"
    assert readers.jdbc_options({**base, "source_query": "SELECT 1"})["dbtable"] == "(SELECT 1) AS custom_src"


def test_catalog_crawl(spark, sf):
    spark.read.parquet(f"{sf}/nation.parquet").createOrReplaceTempView("crawl_me")
    got = readers.catalog_columns(spark, "default").filter("table_name = 'crawl_me'")
    assert {r.column_name for r in got.collect()} == {"n_nationkey", "n_name", "n_regionkey"}
    listed = readers.schema_columns(spark, {"n": readers.read_table(spark, "crawl_me")})
    assert listed.count() == 3


def test_unknown_export(spark):
    with pytest.raises(ValueError):
        writers.export(spark.range(1), "/nowhere", "parchment")


def test_z_order_keeps_rows(spark):
    df = spark.range(100).select(F.col("id").alias("a"), (F.col("id") * 3 % 100).alias("b"))
    assert writers.cluster_by_z(df, {"a": (0, 100), "b": (0, 100)}, 4).count() == 100
    assert writers.file_count_for(300 * 1024 * 1024) == 3


def test_single_file_export(spark, tmp_path):
    writers.export_csv(spark.range(10), f"{tmp_path}/x", single_file=True)
    stats = readers.file_statistics(spark, str(tmp_path), "csv").first()
    assert stats.num_files == 1 and stats.size_bytes > 0


def test_shared_folder_is_the_cluster_setting(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == (named or spark.sparkContext.getCheckpointDir())


def test_routing_without_anyone_on_shift(spark):
    alerts = spark.createDataFrame([(1, T0), (2, T0 + dt.timedelta(hours=5))], "id int, ts timestamp_ntz")
    shifts = spark.createDataFrame(
        [("lead", "team_lead", T0, T0 + dt.timedelta(hours=1), True, True), ("prime", "on_call_primary", T0, T0 + dt.timedelta(hours=1), True, True)],
        "team_member string, role string, shift_start timestamp_ntz, shift_end timestamp_ntz, is_on_call boolean, is_active boolean",
    )
    got = {r.id: r.team_member for r in monitoring.route_alerts(alerts, shifts, "ts").collect()}
    assert got == {1: "prime", 2: None}


def test_anomaly_with_constant_history(spark):
    rows = [(i, 1, "succeeded", T0 + dt.timedelta(hours=i), 10.0, 5) for i in range(20)] + [(99, 1, "succeeded", T0 + dt.timedelta(hours=30), 11.0, 5)]
    df = spark.createDataFrame(rows, "execution_id int, asset_id int, status string, start_time timestamp_ntz, duration_seconds double, records_written int")
    got = monitoring.execution_anomalies(df, at("2024-01-02 07:00:00"), recent="2 HOURS").collect()
    assert [(r.execution_id, r.anomaly_type) for r in got] == [(99, "duration_spike")]


def test_glossary_rows(spark):
    terms = governance.create_terms(spark, [{"term_name": "Premium", "definition": "price", "tags": ["kpi"]}], at("2024-01-01"))
    tid = terms.first().term_id
    assert governance.approve_term(terms, tid, at("2024-01-02")).first().status == "published"
    link = governance.link_term(terms, tid, "gold", "fact", "premium", "auto_approved").first()
    assert link.verified and link.full_path == "gold.fact.premium"
    assert not governance.link_term(terms, tid, "gold", "fact", "premium", "auto_suggested").first().verified
    assert governance.create_policy(spark, "P", "x", "d").first().enabled
    assert governance.term_versions(terms, at("2024-01-02")).count() == 1
    csv = spark.createDataFrame([("A", "d", "b", "c", "e", "x|y"), ("B", "d", "b", "c", "e", None)], "term_name string, definition string, business_definition string, category string, domain string, tags string")
    assert [r.tags for r in governance.import_terms(csv, at("2024-01-01")).orderBy("term_name").collect()] == [["x", "y"], []]


def test_profile_of_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "user_id int, note string")
    got = {r.column_name: (r.null_count, r.distinct_count, r.cardinality) for r in profile.profile_columns(df).collect()}
    assert got == {"user_id": (0, 3, "high"), "note": (2, 2, "medium")}
    near = {r.column_name: r.distinct_count for r in profile.profile_columns(df, approximate=True).collect()}
    assert near == {"user_id": 3, "note": 2}


def test_unknown_area_has_no_loading(spark):
    policies = spark.createDataFrame([("X", 100.0)], "area string, base_premium double")
    risk = spark.createDataFrame([], "area string, catastrophe_tier string")
    assert enrich.adjusted_premium(policies, risk, "area").first().adjusted_premium == 100.0


def test_model_learns(spark, sf):
    from lodestrata.plans.enrichment import FRAUD_FEATURES, fraud_rows

    train, test = scoring.split_rows(fraud_rows(spark, sf))
    model = scoring.train_fraud_model(train, FRAUD_FEATURES, "is_fraud", trees=10, depth=6)
    assert scoring.area_under_roc(model.transform(test), "is_fraud") > 0.9


def test_full_load_replaces_and_partition_load_keeps(spark, tmp_path):
    two = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    one = spark.createDataFrame([(9, "a")], "v int, p string")
    for mode, want in (("full", [9]), ("partitions", [2, 9])):
        path = f"{tmp_path}/{mode}"
        writers.write_load(two, path, "full", ["p"])
        writers.write_load(one, path, mode, ["p"])
        assert sorted(r.v for r in spark.read.parquet(path).collect()) == want


def test_training_rows_are_dealt_in_bounded_parts(spark):
    """A task's share must not grow with the input: one split of a file can hold any number of rows."""
    parts = scoring.dealt(spark.range(0, 10_000, 1, 1), 1000).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in parts) == 10_000 and max(r["count"] for r in parts) <= 1100
