import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lodestrata.functions.cleansing import standard_zip
from lodestrata.operators import ingest, quality, rules


def rule(kind, handling="skip_record", expression=None, parameters=None, name="r"):
    return {"rule_name": name, "rule_type": kind, "rule_expression": expression, "rule_parameters": parameters, "error_handling": handling}


@pytest.fixture()
def df(spark):
    return spark.createDataFrame([(1, " ab ", "7"), (2, None, "x")], "id int, name string, n string")


def test_skip_and_fail(df):
    bad = rule("sql_expr", expression="nope + 1")
    out = rules.apply_rules(df, [bad, rule("filter", expression="id = 1", name="f")])
    assert list(out.skipped) == ["r"] and out.applied == ["f"] and out.df.count() == 1
    with pytest.raises(AnalysisException):
        rules.apply_rules(df, [rule("sql_expr", "fail_batch", "nope + 1")])


def test_default_value_policy(df):
    bad = rule("sql_expr", "default_value", "nope + 1", '{"target_column":"t","default":5}')
    assert [r.t for r in rules.apply_rules(df, [bad]).df.collect()] == [5, 5]


def test_cast_never_fails_a_batch(df):
    out = rules.apply_rules(df, [rule("cast", parameters='{"column":"n","type":"int"}')]).df
    assert [r.n for r in out.orderBy("id").collect()] == [7, None]


def test_standardize_default_function_aggregate(df):
    ctx = rules.RuleContext(functions={"twice": lambda d: d.unionByName(d)})
    steps = [
        rule("standardize", parameters='{"column":"name"}'),
        rule("default", parameters='{"column":"name","value":"NONE"}'),
        rule("python_func", parameters='{"function":"twice"}'),
        rule("aggregate", parameters='{"group_by":["name"],"measures":{"c":"count(*)"}}'),
    ]
    assert sorted(tuple(r) for r in rules.apply_rules(df, steps, ctx).df.collect()) == [("AB", 2), ("NONE", 2)]


def test_history_rule(spark):
    from lodestrata.operators import history
    from lodestrata.plans.registry import at

    base = history.with_row_hash(spark.createDataFrame([(1, "A")], "id int, v string"), ["v"])
    new = history.with_row_hash(spark.createDataFrame([(1, "B")], "id int, v string"), ["v"])
    ctx = rules.RuleContext({"t": history.open_version(base, at("2024-01-01"))})
    step = rule("scd2", parameters='{"target":"t","keys":["id"],"as_of":"TIMESTAMP_NTZ\'2024-02-01\'"}')
    assert rules.apply_rules(new, [step], ctx).df.count() == 2


POLICIES = [("POL001", 1200.50), (None, 800.00), ("POL003", -100.00)]


def test_completeness_and_validity(spark):
    df = spark.createDataFrame(POLICIES, "policy_number string, premium double")
    row = df.agg(quality.completeness_pct(F.col("policy_number")).alias("c"), quality.validity_pct(F.col("premium") > 0).alias("v")).first()
    assert round(row.c, 1) == 66.7 and round(row.v, 1) == 66.7


@pytest.mark.parametrize("null_passes, failed", [(True, 1), (False, 2)])
def test_null_policy(spark, null_passes, failed):
    df = spark.createDataFrame([*POLICIES, ("POL004", None)], "policy_number string, premium double")
    check = quality.typed_check({"column": "premium", "rule": "positive"})
    assert quality.run_rules(df, "p", [check], null_passes).first().failed_rows == failed


def test_unique_counts_null_once(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "k string")
    row = quality.run_rules(df, "t", [quality.typed_check({"column": "k", "rule": "unique"})]).first()
    assert (row.total_rows, row.failed_rows) == (4, 2)


def test_empty_table_does_not_divide_by_zero(spark):
    df = spark.createDataFrame([], "k string")
    checks = [quality.typed_check({"column": "k", "rule": r}) for r in ("not_null", "unique")]
    assert [r.failure_rate for r in quality.run_rules(df, "t", checks).collect()] == [0.0, 0.0]


def test_seed_rules_fit_their_tables():
    assert len(quality.seed_rules(["policy_number", "premium_amount"])) == 4
    assert [r["rule_name"] for r in quality.seed_rules(["email", "ssn"])] == ["Email Format Valid", "SSN Format Valid"]


def test_seeded_formats(spark):
    df = spark.createDataFrame(
        [(1, "valid@email.com", "123-45-6789"), (2, None, "invalid"), (3, "another@email.com", "987-65-4321")], "id int, email string, ssn string"
    )
    got = {r.rule_name: r.failed_rows for r in quality.run_rules(df, "c", quality.seed_rules(df.columns)).collect()}
    assert got == {"Email Format Valid": 0, "SSN Format Valid": 1}


def test_schema_difference(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert ingest.schema_difference(df, ["a", "c"]) == (["c"], ["b"])


def test_config_and_watermark(spark):
    config = spark.createDataFrame([("k", "prod", "v"), ("k", "dev", "w")], "config_key string, environment string, config_value string")
    assert ingest.config_value(config, "k", "dev") == "w" and ingest.config_value(config, "z", "dev") is None
    rules_df = spark.createDataFrame([("R1", "1"), ("R2", "2")], "rule_id string, incremental_value string")
    assert {r.rule_id: r.incremental_value for r in ingest.advance_watermark(rules_df, "R1", "9").collect()} == {"R1": "9", "R2": "2"}


def test_active_rules(spark):
    r = spark.createDataFrame(
        [("R1", "S1", True, 2, "claims"), ("R2", "S1", True, 1, "policy"), ("R3", "S1", False, 1, "claims"), ("R4", "S2", True, 1, "claims")],
        "rule_id string, source_id string, is_active boolean, priority int, domain string",
    )
    s = spark.createDataFrame([("S1", True, "prod"), ("S2", True, "dev")], "source_id string, is_active boolean, environment string")
    assert [x.rule_id for x in ingest.active_rules(r, s, "prod").collect()] == ["R2", "R1"]
    assert [x.rule_id for x in ingest.active_rules(r, s, "prod", "claims").collect()] == ["R1"]


def test_zip(spark):
    df = spark.createDataFrame([("12345-6789",), ("123456",), ("12",), (None,)], "z string")
    assert [r[0] for r in df.select(standard_zip(F.col("z"))).collect()] == ["12345-6789", "12345", None, None]


def test_schema_enforcement(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert ingest.enforce_schema(df, ["a"], "ignore").columns == ["a"]
    assert ingest.enforce_schema(df, ["a", "c"], "evolve").columns == ["a", "b"]
    for expected, mode in ((["a"], "strict"), (["c"], "ignore")):
        with pytest.raises(ValueError):
            ingest.enforce_schema(df, expected, mode)


def test_an_incremental_run_takes_up_where_the_target_ends(spark, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    rule = {"rule_id": "R", "source_type": "file", "file_format": "parquet", "source_table_or_path": source, "target_table": "t", "ingestion_mode": "incremental", "incremental_column": "id"}
    run = lambda name: ingest.run_ingestion(spark, [rule], {}, target, name, F.lit("2024-01-01").cast("timestamp_ntz")).first().record_count
    spark.range(10).write.parquet(source)
    assert run("a") == 10 and run("b") == 0 and run("a") == 10
    spark.range(10, 15).write.mode("append").parquet(source)
    assert run("c") == 5 and run("c") == 5
    assert sorted(r.id for r in spark.read.parquet(f"{target}/t").collect()) == list(range(15))


@pytest.mark.parametrize("kind", ["bigint", "string", "timestamp_ntz"])
def test_executions_repeat_their_own_range_in_any_order(spark, tmp_path, kind):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    rule = {"rule_id": "R", "source_type": "file", "file_format": "parquet", "source_table_or_path": source, "target_table": "t", "ingestion_mode": "incremental", "incremental_column": "mark"}

    def grow(lo, hi, change=""):
        mark = {"bigint": F.col("id"), "string": F.format_string("%05d", "id"), "timestamp_ntz": F.expr("timestampadd(SECOND, id, TIMESTAMP_NTZ'2024-01-01 00:00:00.25')")}[kind]
        spark.range(lo, hi).select("id", mark.alias("mark"), F.lit(change).alias("note")).coalesce(1).write.mode("append").parquet(source)

    def run(name):
        log = ingest.run_ingestion(spark, [rule], {}, target, name, F.lit("2024-01-01").cast("timestamp_ntz")).first()
        assert log.status == "succeeded"
        return log.record_count

    def stored():
        return sorted(r.id for r in spark.read.parquet(f"{target}/t").collect())

    spark.createDataFrame([(-1, None, "")], f"id bigint, mark {kind}, note string").write.parquet(source)
    grow(0, 100)
    assert run("first") == 101
    grow(100, 200)
    assert run("second") == 100
    grow(200, 250)
    assert run("first") == 101 and stored() == list(range(-1, 200))
    assert run("second") == 100 and stored() == list(range(-1, 200))
    assert run("third") == 50 and run("first") == 101 and run("third") == 50 and run("second") == 100
    assert stored() == list(range(-1, 250))
    assert run("fourth") == 0 and stored() == list(range(-1, 250))


def test_repeats_keep_the_newest_row(spark, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    spark.createDataFrame([(1, 5, "old"), (1, 9, "new"), (2, 1, "only")], "k int, v int, t string").write.parquet(source)
    rule = {"rule_id": "R", "source_type": "file", "file_format": "parquet", "source_table_or_path": source, "target_table": "t", "ingestion_mode": "full", "incremental_column": "v", "dedup_columns": "k"}
    ingest.run_ingestion(spark, [rule], {}, target, "a", F.lit("2024-01-01").cast("timestamp_ntz"))
    assert sorted((r.k, r.t) for r in spark.read.parquet(f"{target}/t").collect()) == [(1, "new"), (2, "only")]
