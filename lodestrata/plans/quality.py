"""Data quality, profiling and freshness."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lodestrata.operators import aggregates as agg
from lodestrata.operators import mergeable, profile, quality
from lodestrata.operators.quality import UNIQUENESS
from lodestrata.plans import bindings as b
from lodestrata.plans.registry import at, plain, query, table
from lodestrata.session import shared_folder

TYPED = [
    {"column": "o_orderkey", "rule": "not_null", "threshold": 0.0},
    {"column": "o_custkey", "rule": "unique", "threshold": 0.0},
    {"column": "o_totalprice", "rule": "positive", "threshold": 0.0},
    {"column": "o_orderpriority", "rule": "email_format", "threshold": 0.05},
]


def _result_sql(table_name, rules, total="count(*)"):
    """SQL of a rule run; a rule is (name, column, type, category, failing-rows expression, threshold)."""
    parts = []
    for name, column, kind, category, failed, threshold in rules:
        parts.append(
            f"SELECT '{table_name}' AS table_name, '{name}' AS rule_name, '{column}' AS column_name, '{kind}' AS rule_type, "
            f"'{category}' AS rule_category, {total} AS total_rows, {failed} AS failed_rows, CAST({threshold} AS DOUBLE) AS threshold_value FROM {table_name}"
        )
    return (
        "WITH r AS (" + "\nUNION ALL ".join(parts) + ")\nSELECT *, CAST(failed_rows AS DOUBLE) / total_rows AS failure_rate, "
        "CAST(failed_rows AS DOUBLE) / total_rows <= threshold_value AS check_passed, "
        "(1.0::DOUBLE - CAST(failed_rows AS DOUBLE) / total_rows) * 100.0::DOUBLE AS quality_score FROM r"
    )


@query("typed_quality_checks", _result_sql("orders", [
    ("o_orderkey.not_null", "o_orderkey", "not_null", "high", "count(*) FILTER (WHERE o_orderkey IS NULL)", 0.0),
    ("o_custkey.unique", "o_custkey", "unique", "high", "count(*) - count(DISTINCT o_custkey)", 0.0),
    ("o_totalprice.positive", "o_totalprice", "positive", "high", "count(*) FILTER (WHERE NOT (o_totalprice > 0))", 0.0),
    ("o_orderpriority.email_format", "o_orderpriority", "email_format", "high", "count(*) FILTER (WHERE NOT regexp_matches(o_orderpriority, '^[\\w\\._%+-]+@[\\w\\.-]+\\.[A-Za-z]{2,}$'))", 0.05),
]))
def typed_quality_checks(spark, sf):
    return quality.run_rules(table(spark, sf, "orders"), "orders", [quality.typed_check(r) for r in TYPED])


def _rule(name, column, kind, category, check, threshold):
    return {"rule_name": name, "column_name": column, "rule_type": kind, "rule_category": category, "check_expression": check, "threshold_value": threshold}


ORDER_RULES = [
    _rule("Order Key Not Null", "o_orderkey", "completeness", "critical", "o_orderkey IS NOT NULL", 0.0),
    _rule("Order Key Unique", "o_orderkey", "uniqueness", "critical", UNIQUENESS, 0.0),
    _rule("Customer Unique", "o_custkey", "uniqueness", "critical", UNIQUENESS, 0.0),
    _rule("Price Positive", "o_totalprice", "validity", "high", "o_totalprice > 0", 0.0),
    _rule("Price In Range", "o_totalprice", "validity", "medium", "o_totalprice BETWEEN 100 AND 450000", 0.05),
    _rule("Known Status", "o_orderstatus", "accuracy", "medium", "o_orderstatus IN ('O','F')", 0.02),
    _rule("Price And Date", "o_orderdate", "consistency", "high", "o_orderdate >= TIMESTAMP_NTZ'1995-01-01'", 0.01),
]
LINE_RULES = [
    _rule("Quantity Positive", "l_quantity", "validity", "high", "l_quantity > 0", 0.0),
    _rule("Discount In Range", "l_discount", "validity", "medium", "l_discount BETWEEN 0 AND 0.05", 0.05),
    _rule("Ship After Epoch", "l_shipdate", "consistency", "high", "l_shipdate >= TIMESTAMP_NTZ'1996-01-01'", 0.01),
]
ORDER_SQL = [
    ("Order Key Not Null", "o_orderkey", "completeness", "critical", "count(*) FILTER (WHERE o_orderkey IS NULL)", 0.0),
    ("Order Key Unique", "o_orderkey", "uniqueness", "critical", "count(*) - count(DISTINCT o_orderkey)", 0.0),
    ("Customer Unique", "o_custkey", "uniqueness", "critical", "count(*) - count(DISTINCT o_custkey)", 0.0),
    ("Price Positive", "o_totalprice", "validity", "high", "count(*) FILTER (WHERE NOT (o_totalprice > 0))", 0.0),
    ("Price In Range", "o_totalprice", "validity", "medium", "count(*) FILTER (WHERE NOT (o_totalprice BETWEEN 100 AND 450000))", 0.05),
    ("Known Status", "o_orderstatus", "accuracy", "medium", "count(*) FILTER (WHERE NOT (o_orderstatus IN ('O','F')))", 0.02),
    ("Price And Date", "o_orderdate", "consistency", "high", "count(*) FILTER (WHERE NOT (o_orderdate >= TIMESTAMP '1995-01-01'))", 0.01),
]
LINE_SQL = [
    ("Quantity Positive", "l_quantity", "validity", "high", "count(*) FILTER (WHERE NOT (l_quantity > 0))", 0.0),
    ("Discount In Range", "l_discount", "validity", "medium", "count(*) FILTER (WHERE NOT (l_discount BETWEEN 0 AND 0.05))", 0.05),
    ("Ship After Epoch", "l_shipdate", "consistency", "high", "count(*) FILTER (WHERE NOT (l_shipdate >= TIMESTAMP '1996-01-01'))", 0.01),
]


@query("quality_rule_engine", _result_sql("orders", ORDER_SQL))
def quality_rule_engine(spark, sf):
    return quality.run_rules(table(spark, sf, "orders"), "orders", ORDER_RULES)


@query("quality_scorecard", "WITH results AS (SELECT * FROM (" + _result_sql("orders", ORDER_SQL) + ") UNION ALL SELECT * FROM (" + _result_sql("lineitem", LINE_SQL) + """))
SELECT table_name, count(*) AS total_rules, count(*) FILTER (WHERE check_passed) AS passed_rules, count(*) FILTER (WHERE NOT check_passed) AS failed_rules,
  100.0::DOUBLE * count(*) FILTER (WHERE check_passed) / count(*) AS overall_score,
  round(avg(CASE WHEN rule_type = 'completeness' THEN quality_score END), 6) AS completeness_score, round(avg(CASE WHEN rule_type = 'uniqueness' THEN quality_score END), 6) AS uniqueness_score,
  round(avg(CASE WHEN rule_type = 'validity' THEN quality_score END), 6) AS validity_score, round(avg(CASE WHEN rule_type = 'consistency' THEN quality_score END), 6) AS consistency_score,
  round(avg(CASE WHEN rule_type = 'accuracy' THEN quality_score END), 6) AS accuracy_score
FROM results GROUP BY table_name""")
def quality_scorecard(spark, sf):
    tables = {n: table(spark, sf, n) for n in ("orders", "lineitem")}
    card = quality.scorecard(quality.run_rules_for_tables(tables, {"orders": ORDER_RULES, "lineitem": LINE_RULES}))
    return card.withColumns({c: F.round(c, 6) for c in card.columns if c.endswith("_score") and c != "overall_score"})


@query("quality_trend", """
WITH d AS (SELECT 'type_' || event_type AS table_name, CAST(ts AS DATE) AS date,
    CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS overall_score FROM events
    WHERE CAST(ts AS DATE) >= DATE '2024-01-30' - 10 GROUP BY ALL),
 l AS (SELECT *, overall_score - lag(overall_score) OVER (PARTITION BY table_name ORDER BY date) AS change FROM d)
SELECT table_name, date, overall_score, change, CASE WHEN change > 0 THEN 'improving' WHEN change < 0 THEN 'degrading' WHEN change = 0 THEN 'stable' END AS direction FROM l""")
def quality_trend(spark, sf):
    scores = table(spark, sf, "events").select(
        F.concat(F.lit("type_"), "event_type").alias("table_name"), F.col("ts").alias("snapshot_date"), F.col("value").cast("decimal(18,2)").alias("overall_score")
    )
    return plain(quality.quality_trend(scores, at(b.EVENTS_AS_OF), 10))


@query("completeness_validity", """
SELECT event_type, 100.0::DOUBLE * count(*) FILTER (WHERE CASE WHEN value > 20 THEN value END IS NOT NULL) / count(*) AS completeness,
  100.0::DOUBLE * count(*) FILTER (WHERE coalesce(value BETWEEN 10 AND 200, false)) / count(*) AS validity FROM events GROUP BY event_type""")
def completeness_validity(spark, sf):
    ev = table(spark, sf, "events")
    return ev.groupBy("event_type").agg(
        quality.completeness_pct(F.when(F.col("value") > 20, F.col("value"))).alias("completeness"),
        quality.validity_pct(F.col("value").between(10, 200)).alias("validity"),
    )


@query("violation_flags", """
SELECT o_orderkey, concat_ws(',', CASE WHEN NOT (o_totalprice BETWEEN 100 AND 450000) THEN 'Price In Range' END,
  CASE WHEN NOT (o_orderstatus IN ('O','F')) THEN 'Known Status' END) AS failed FROM orders
WHERE NOT (o_totalprice BETWEEN 100 AND 450000) OR NOT (o_orderstatus IN ('O','F'))""")
def violation_flags(spark, sf):
    _, bad = quality.quarantine(table(spark, sf, "orders"), ORDER_RULES)
    return bad.select("o_orderkey", F.array_join("_dq_failed", ",").alias("failed"))


@query("referential_rule", """
SELECT (SELECT count(*) FROM lineitem) AS total_rows, count(*) AS failed_rows, count(DISTINCT l_orderkey) AS failed_keys FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def referential_rule(spark, sf):
    parent = table(spark, sf, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return quality.orphans(table(spark, sf, "lineitem"), parent, "l_orderkey")


@query("volume_rule", "SELECT count(*) AS row_count, count(*) BETWEEN 1 AND 1000000000 AS check_passed FROM lineitem")
def volume_rule(spark, sf):
    return quality.volume_check(table(spark, sf, "lineitem"), 1, 1_000_000_000)


@query("table_freshness", """
SELECT event_type, max(ts) AS last_update, CAST(floor((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 60000000) AS BIGINT) AS staleness_minutes,
  floor((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 60000000) > 30 AS is_stale FROM events GROUP BY event_type""")
def table_freshness(spark, sf):
    return quality.freshness_check(table(spark, sf, "events"), "ts", at("2024-01-31"), 30, ["event_type"])


@query("failure_sample", "SELECT o_orderkey, o_totalprice FROM orders WHERE NOT (o_totalprice <= 450000) ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def failure_sample(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return quality.failure_sample(df, "o_totalprice <= 450000", [F.col("o_totalprice").desc(), F.col("o_orderkey")])


# ---- profiling -----------------------------------------------------------------------

PROFILED = {"customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], "events": ["event_id", "user_id", "event_type", "value", "props"]}
NUMERIC = {"c_custkey", "c_nationkey", "c_acctbal", "event_id", "user_id", "value"}


def _profile_sql(names):
    parts = []
    for t, columns in names.items():
        for c in columns:
            stats = (
                f"min({c})::DOUBLE AS min_value, max({c})::DOUBLE AS max_value, round(avg({c}::DOUBLE), 6) AS avg_value, round(stddev_samp({c}::DOUBLE), 6) AS std_dev"
                if c in NUMERIC else "NULL::DOUBLE AS min_value, NULL::DOUBLE AS max_value, NULL::DOUBLE AS avg_value, NULL::DOUBLE AS std_dev"
            )
            parts.append(
                f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS total_rows, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
                f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS distinct_count, {stats} FROM {t}"
            )
    return (
        "SELECT *, 100.0::DOUBLE * null_count / total_rows AS null_percentage, CASE WHEN distinct_count / total_rows > 0.95 THEN 'high' "
        "WHEN distinct_count / total_rows > 0.5 THEN 'medium' ELSE 'low' END AS cardinality FROM (" + "\nUNION ALL ".join(parts) + ")"
    )


def _profiles(spark, sf, approximate=False):
    return profile.profile_tables({t: table(spark, sf, t).select(*c) for t, c in PROFILED.items()}, approximate)


@query("column_profiles", _profile_sql(PROFILED))
def column_profiles(spark, sf):
    return _profiles(spark, sf).withColumns({"avg_value": F.round("avg_value", 6), "std_dev": F.round("std_dev", 6)})


@query("column_profiles_approximate")
def column_profiles_approximate(spark, sf):
    return _profiles(spark, sf, True)


PROFILE_COLUMNS = {"o_orderstatus": False, "o_orderpriority": False, "o_custkey": True, "o_totalprice": True}


def _stored_sql(c, numeric):
    number = f"CAST({c} AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"
    most = f"(SELECT CAST({c} AS VARCHAR) || '=' || n FROM (SELECT {c}, count(*) AS n FROM orders GROUP BY {c}) ORDER BY n DESC, {c} LIMIT 1)"
    return f"""SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) - count({c}) AS null_count, min({number}) AS min_value, max({number}) AS max_value, round(avg({number}), 4) AS avg_value,
  round(stddev_samp({number}), 4) AS std_dev, true AS distinct_close, true AS median_close, {'NULL' if numeric else most} AS most_frequent FROM orders"""


@query("stored_profiles", " UNION ALL ".join(_stored_sql(c, n) for c, n in PROFILE_COLUMNS.items()))
def stored_profiles(spark, sf):
    """Profiles of two loads stored apart and merged: exact where they can be, estimates within their bounds of the exact values."""
    orders, folder = table(spark, sf, "orders"), f"{shared_folder(spark)}/profiles-{uuid.uuid4().hex}"
    for load, part in (("1995", orders.filter("o_orderdate < DATE'1996-01-01'")), ("later", orders.filter("o_orderdate >= DATE'1996-01-01' OR o_orderdate IS NULL"))):
        mergeable.profile_load(part, list(PROFILE_COLUMNS), load).write.mode("append").parquet(folder)
    merged = mergeable.merge_profiles(spark.read.parquet(folder), 100)
    # distinct values are grouped and ranks selected digit by digit, so no task holds the values of a column
    counts = [orders.select(F.col(c).alias("v")).filter("v IS NOT NULL").distinct().agg(F.lit(c).alias("column_name"), F.count("*").alias("d")) for c in PROFILE_COLUMNS]
    numbers = orders.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c, numeric in PROFILE_COLUMNS.items() if numeric])))
    facts = agg.union_all(counts)
    for p, name in ((0.48, "lo"), (0.52, "hi")):
        facts = facts.join(agg.exact_percentile(numbers, ["column_name"], "v", p, name), "column_name", "left")
    facts = facts.select("column_name", F.struct("d", "lo", "hi").alias("_m"))
    both = merged.join(facts, "column_name")
    median = F.col("quartiles")[1]
    best = F.array_sort(F.transform("top_values", lambda x: F.struct((-x["count"]).alias("n"), x["item"].alias("v"))))[0]
    return both.select(
        "column_name", "total_rows", "null_count", "min_value", "max_value", F.round("avg_value", 4).alias("avg_value"), F.round("std_dev", 4).alias("std_dev"),
        (F.abs(F.col("distinct_count") - F.col("_m.d")) <= mergeable.DISTINCT_BOUND * F.col("_m.d")).alias("distinct_close"),
        F.coalesce(median.between(F.col("_m.lo"), F.col("_m.hi")), F.lit(True)).alias("median_close"), F.when(F.col("quartiles").isNull(), F.concat(best["v"], F.lit("="), (-best["n"]).cast("string"))).alias("most_frequent"),
    )


@query("column_top_values", """
WITH v AS (SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY ALL
  UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY ALL
  UNION ALL SELECT 'o_custkey', CAST(o_custkey AS VARCHAR), count(*) FROM orders GROUP BY ALL)
SELECT column_name, value, n, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS r FROM v) WHERE r <= 5""")
def column_top_values(spark, sf):
    return profile.top_values(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority", "o_custkey"]).withColumnRenamed("_rank", "rank")


@query("semantic_types", """
WITH n AS (SELECT DISTINCT p_name || '_' || CASE p_size % 8 WHEN 0 THEN 'email' WHEN 1 THEN 'mobile_no' WHEN 2 THEN 'postal' WHEN 3 THEN 'home_address' WHEN 4 THEN 'premium' WHEN 5 THEN 'id' WHEN 6 THEN 'date' ELSE 'x' END AS column_name FROM part)
SELECT column_name, CASE WHEN column_name LIKE '%email%' THEN 'email' WHEN column_name LIKE '%phone%' THEN 'phone' WHEN column_name LIKE '%mobile%' THEN 'phone' WHEN column_name LIKE '%ssn%' THEN 'ssn'
 WHEN column_name LIKE '%zip%' THEN 'postal_code' WHEN column_name LIKE '%postal%' THEN 'postal_code' WHEN column_name LIKE '%address%' THEN 'address' WHEN column_name LIKE '%name%' THEN 'person_name'
 WHEN column_name LIKE '%amount%' OR column_name LIKE '%premium%' OR column_name LIKE '%price%' THEN 'currency' WHEN column_name LIKE '%id%' THEN 'identifier'
 WHEN column_name LIKE '%date%' OR column_name LIKE '%time%' THEN 'datetime' ELSE 'unknown' END AS semantic_type FROM n""")
def semantic_types(spark, sf):
    ending = (
        F.when(F.col("p_size") % 8 == 0, "email").when(F.col("p_size") % 8 == 1, "mobile_no").when(F.col("p_size") % 8 == 2, "postal")
        .when(F.col("p_size") % 8 == 3, "home_address").when(F.col("p_size") % 8 == 4, "premium").when(F.col("p_size") % 8 == 5, "id")
        .when(F.col("p_size") % 8 == 6, "date").otherwise("x")
    )
    names = table(spark, sf, "part").select(F.concat("p_name", F.lit("_"), ending).alias("column_name")).distinct()
    return names.withColumn("semantic_type", profile.semantic_type(F.col("column_name")))


@query("format_consistency", """
WITH s AS (SELECT regexp_replace(regexp_replace(p_name, '[A-Za-z]+', 'A', 'g'), '[0-9]+', '9', 'g') AS shape, 'p_name' AS column_name FROM part
  UNION ALL SELECT regexp_replace(regexp_replace(p_brand, '[A-Za-z]+', 'A', 'g'), '[0-9]+', '9', 'g'), 'p_brand' FROM part),
 c AS (SELECT column_name, shape, count(*) AS n FROM s GROUP BY ALL)
SELECT column_name, 100.0::DOUBLE * max(n) / CAST(sum(n) AS BIGINT) AS consistency FROM c GROUP BY column_name""")
def format_consistency(spark, sf):
    return profile.consistency_pct(table(spark, sf, "part"), ["p_name", "p_brand"])


def _dimensions(spark, sf):
    from lodestrata.operators.aggregates import union_all

    out = []
    for name, columns in PROFILED.items():
        p = profile.profile_columns(table(spark, sf, name).select(*columns))
        out.append(profile.quality_dimensions(p, name, F.lit(95.0), F.lit(90.0), F.lit(92.0), F.lit(3)))
    return union_all(out)


DIMENSION_SQL = "WITH p AS (" + _profile_sql(PROFILED) + """), d AS (
  SELECT table_name, avg(100.0 - null_percentage) AS completeness, 95.0::DOUBLE AS accuracy, 90.0::DOUBLE AS consistency, 85.0::DOUBLE AS timeliness, 92.0::DOUBLE AS validity,
   coalesce(avg(CASE WHEN column_name LIKE '%id%' THEN CASE WHEN cardinality = 'high' THEN 100.0 ELSE 50.0 END END), 100.0)::DOUBLE AS uniqueness FROM p GROUP BY table_name)
"""


@query("quality_dimensions", DIMENSION_SQL + """
SELECT table_name, round(completeness * 0.25 + accuracy * 0.25 + consistency * 0.15 + timeliness * 0.10 + validity * 0.15 + uniqueness * 0.10, 6) AS overall_score,
  completeness, accuracy, consistency, timeliness, validity, uniqueness FROM d""")
def quality_dimensions(spark, sf):
    return _dimensions(spark, sf).withColumn("overall_score", F.round("overall_score", 6))


ISSUE_SQL = "WITH p AS (" + _profile_sql(PROFILED) + """), i AS (
  SELECT table_name, column_name, CASE WHEN null_percentage > 50 THEN 'high' ELSE 'medium' END AS severity, 'high_null_percentage' AS issue FROM p WHERE null_percentage > 20
  UNION ALL SELECT table_name, column_name, 'high', 'id_not_unique' FROM p WHERE column_name LIKE '%id%' AND cardinality <> 'high'
  UNION ALL SELECT table_name, column_name, 'medium', 'pii_detected' FROM p WHERE column_name LIKE '%email%' OR column_name LIKE '%phone%' OR column_name LIKE '%mobile%' OR column_name LIKE '%ssn%')
"""


def _issues(spark, sf):
    from lodestrata.operators.aggregates import union_all

    return union_all([
        profile.quality_issues(profile.profile_columns(table(spark, sf, n).select(*c))).withColumn("table_name", F.lit(n)) for n, c in PROFILED.items()
    ])


@query("quality_issues", ISSUE_SQL + "SELECT * FROM i")
def quality_issues(spark, sf):
    return _issues(spark, sf)


@query("quality_recommendations", ISSUE_SQL + """, c AS (SELECT table_name, count(*) FILTER (WHERE severity = 'high') AS high_issues, count(*) FILTER (WHERE issue = 'high_null_percentage') AS null_issues,
   count(*) FILTER (WHERE issue = 'pii_detected') AS pii_issues FROM i GROUP BY table_name)
SELECT table_name, high_issues, null_issues, pii_issues, CASE WHEN high_issues = 0 AND null_issues <= 3 AND pii_issues = 0 THEN 'continue_monitoring' ELSE
 concat_ws(',', CASE WHEN high_issues > 0 THEN 'address_high_severity_issues' END, CASE WHEN null_issues > 3 THEN 'investigate_data_collection' END, CASE WHEN pii_issues > 0 THEN 'mask_pii_columns' END) END AS actions FROM c""")
def quality_recommendations(spark, sf):
    return profile.recommendations(_issues(spark, sf), ["table_name"]).withColumn("actions", F.array_join("actions", ","))


@query("workspace_summary", ISSUE_SQL + """, d AS (SELECT table_name, avg(100.0 - null_percentage) * 0.25 + 95.0 * 0.25 + 90.0 * 0.15 + 85.0 * 0.10 + 92.0 * 0.15 +
   coalesce(avg(CASE WHEN column_name LIKE '%id%' THEN CASE WHEN cardinality = 'high' THEN 100.0 ELSE 50.0 END END), 100.0) * 0.10 AS s FROM p GROUP BY table_name)
SELECT count(*) AS assets_profiled, round(avg(s), 6)::DOUBLE AS avg_quality_score, (SELECT count(*) FROM p) AS columns_analyzed, (SELECT count(*) FILTER (WHERE severity = 'high') FROM i) AS critical_issues FROM d""")
def workspace_summary(spark, sf):
    out = profile.workspace_summary(_dimensions(spark, sf), _issues(spark, sf), _profiles(spark, sf))
    return out.withColumn("avg_quality_score", F.round("avg_quality_score", 6))


@query("asset_criticality_impact", """
WITH a AS (SELECT user_id, CASE user_id % 5 WHEN 0 THEN 'gold_policy' WHEN 1 THEN 'silver_billing' WHEN 2 THEN 'bronze_feed' WHEN 3 THEN 'fact_claims' ELSE 'misc' END || '_' || user_id AS name,
   count(*) FILTER (WHERE event_type <> 'error') * 100.0::DOUBLE / count(*) AS score FROM events GROUP BY user_id),
 c AS (SELECT *, CASE WHEN regexp_matches(name, 'gold|fact|dim') THEN 'critical' WHEN name LIKE '%silver%' THEN 'high' WHEN name LIKE '%bronze%' THEN 'medium' ELSE 'unknown' END AS criticality FROM a)
SELECT user_id, name, score, criticality, CASE WHEN criticality = 'critical' AND score < 80 THEN 'HIGH' WHEN criticality = 'high' AND score < 70 THEN 'MEDIUM' ELSE 'LOW' END AS business_impact,
  CASE WHEN score >= 90 THEN 'excellent' WHEN score >= 75 THEN 'good' ELSE 'needs_improvement' END AS insight FROM c""")
def asset_criticality_impact(spark, sf):
    u = F.col("user_id") % 5
    prefix = F.when(u == 0, "gold_policy").when(u == 1, "silver_billing").when(u == 2, "bronze_feed").when(u == 3, "fact_claims").otherwise("misc")
    scored = table(spark, sf, "events").groupBy("user_id").agg((F.count_if(F.col("event_type") != "error") * 100.0 / F.count("*")).alias("score"))
    named = scored.withColumn("name", F.concat(prefix, F.lit("_"), "user_id")).withColumn("criticality", profile.layer_criticality(F.col("name")))
    return named.withColumns({"business_impact": profile.business_impact(F.col("criticality"), F.col("score")), "insight": profile.insight(F.col("score"))})


@query("seeded_rules", """
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'nobody' ELSE 'u' || c_custkey || '@mail.com' END AS email,
  CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN '12-3' ELSE '123-45-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') END AS ssn FROM customer)
SELECT 'Email Format Valid' AS rule_name, count(*) FILTER (WHERE c_custkey % 7 = 0)::BIGINT AS failed_rows FROM c
UNION ALL SELECT 'SSN Format Valid', count(*) FILTER (WHERE c_custkey % 5 <> 0 AND c_custkey % 11 = 0) FROM c""")
def seeded_rules(spark, sf):
    """Of the seeded rules those whose columns a table has."""
    k = F.col("c_custkey")
    ssn = F.when(k % 5 == 0, None).when(k % 11 == 0, "12-3").otherwise(F.concat(F.lit("123-45-"), F.lpad((k % 10000).cast("string"), 4, "0")))
    people = table(spark, sf, "customer").select(k, F.when(k % 7 == 0, "nobody").otherwise(F.concat(F.lit("u"), k, F.lit("@mail.com"))).alias("email"), ssn.alias("ssn"))
    return quality.run_rules(people, "people", quality.seed_rules(people.columns)).select("rule_name", F.col("failed_rows").cast("bigint").alias("failed_rows"))
