"""External-data enrichment, pricing, risk, exchange statistics and the fraud model."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrata.operators import aggregates as agg
from lodestrata.operators import enrich, scoring
from lodestrata.plans import bindings as b
from lodestrata.plans.registry import at, plain, query, table


@query("demographics_enrichment", "SELECT c_custkey, c_nationkey, n_name, n_regionkey FROM customer LEFT JOIN (SELECT n_nationkey + 5 AS c_nationkey, n_name, n_regionkey FROM nation) USING (c_nationkey)")
def demographics_enrichment(spark, sf):
    # shifted keys leave the first customers' nations without a match
    nation = table(spark, sf, "nation").select((F.col("n_nationkey") + 5).alias("c_nationkey"), "n_name", "n_regionkey")
    return enrich.enrich(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), nation, ["c_nationkey"])


STORM_SQL = """storm AS (SELECT l_partkey AS area, count(*) AS storm_count_10yr, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS td, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_damage,
  CASE WHEN sum(CAST(l_extendedprice AS DECIMAL(18,2))) > 50000000 THEN 'Critical' WHEN sum(CAST(l_extendedprice AS DECIMAL(18,2))) > 10000000 THEN 'High' WHEN sum(CAST(l_extendedprice AS DECIMAL(18,2))) > 1000000 THEN 'Medium' ELSE 'Low' END AS catastrophe_tier
  FROM lineitem WHERE CAST(l_shipdate AS DATE) >= DATE '2001-08-02' - 3650 GROUP BY l_partkey)"""


def _storms(spark, sf):
    return table(spark, sf, "lineitem").select(F.col("l_partkey").alias("area"), F.col("l_extendedprice").cast("decimal(18,2)").alias("damage_property"), F.col("l_shipdate").alias("event_date"))


@query("storm_risk_by_area", "WITH " + STORM_SQL + " SELECT area, storm_count_10yr, CAST(td AS DOUBLE) AS total_damage, avg_damage, catastrophe_tier FROM storm")
def storm_risk_by_area(spark, sf):
    return plain(enrich.storm_risk(_storms(spark, sf), at(b.ORDERS_AS_OF), "area"))


@query("catastrophe_adjusted_premium", "WITH " + STORM_SQL + """
SELECT p_partkey AS area, p_retailprice AS base_premium, catastrophe_tier, CASE catastrophe_tier WHEN 'Critical' THEN 1.50 WHEN 'High' THEN 1.25 WHEN 'Medium' THEN 1.10 ELSE 1.00 END::DOUBLE AS catastrophe_loading,
 p_retailprice * CASE catastrophe_tier WHEN 'Critical' THEN 1.50 WHEN 'High' THEN 1.25 WHEN 'Medium' THEN 1.10 ELSE 1.00 END::DOUBLE AS adjusted_premium FROM part LEFT JOIN storm ON area = p_partkey""")
def catastrophe_adjusted_premium(spark, sf):
    policies = table(spark, sf, "part").select(F.col("p_partkey").alias("area"), F.col("p_retailprice").alias("base_premium"))
    return enrich.adjusted_premium(policies, enrich.storm_risk(_storms(spark, sf), at(b.ORDERS_AS_OF), "area"), "area")


@query("life_pricing", """
WITH m AS (SELECT CAST(o_custkey % 60 + 25 AS INTEGER) AS age, CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, count(*) / 1000000.0::DOUBLE AS mortality_rate, CAST(90 - min(o_custkey % 15) AS INTEGER) AS life_expectancy FROM orders GROUP BY ALL),
 a AS (SELECT c_custkey, CAST(c_custkey % 60 + 20 AS INTEGER) AS age, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, c_acctbal AS face_amount FROM customer)
SELECT c_custkey, age, gender, face_amount * mortality_rate * 1.30::DOUBLE AS annual_premium, life_expectancy - age AS expected_payout_year, round(face_amount * pow(1.03::DOUBLE, -(life_expectancy - age)), 6) AS present_value_benefits FROM a LEFT JOIN m USING (age, gender)""")
def life_pricing(spark, sf):
    def person(key, youngest):
        return (F.col(key) % 60 + youngest).cast("int").alias("age"), F.when(F.col(key) % 2 == 0, "F").otherwise("M").alias("gender")

    # the tables begin at 25, so that younger applicants have no rate
    mortality = table(spark, sf, "orders").select("o_custkey", *person("o_custkey", 25)).groupBy("age", "gender").agg(
        (F.count("*") / 1000000.0).alias("mortality_rate"), (F.lit(90) - F.min(F.col("o_custkey") % 15)).cast("int").alias("life_expectancy")
    )
    applications = table(spark, sf, "customer").select("c_custkey", *person("c_custkey", 20), F.col("c_acctbal").alias("face_amount"))
    return enrich.life_pricing(applications, mortality).select(
        "c_custkey", "age", "gender", "annual_premium", "expected_payout_year", F.round("present_value_benefits", 6).alias("present_value_benefits")
    )


@query("area_penetration", "SELECT l_suppkey AS area, count(DISTINCT l_orderkey) AS current_policies FROM lineitem WHERE l_returnflag = 'A' GROUP BY l_suppkey")
def area_penetration(spark, sf):
    return enrich.penetration(table(spark, sf, "lineitem").filter("l_returnflag = 'A'").select(F.col("l_suppkey").alias("area"), F.col("l_orderkey").alias("policy_id")), "area")


@query("market_opportunity", """
WITH c AS (SELECT l_suppkey AS area, count(DISTINCT l_orderkey) AS current_policies FROM lineitem WHERE l_returnflag = 'A' GROUP BY l_suppkey),
 m AS (SELECT s_suppkey AS area, CAST(floor(abs(s_acctbal) * 100) AS BIGINT) AS population, CAST(s_acctbal AS DECIMAL(18,2)) + 50000 AS mi FROM supplier),
 x AS (SELECT area, population, CAST(mi AS DOUBLE) AS median_income, coalesce(current_policies, 0) AS current_policies, CAST(floor(population / 2.5::DOUBLE) AS INTEGER) AS estimated_households FROM m LEFT JOIN c USING (area)),
 y AS (SELECT *, current_policies * 100.0::DOUBLE / nullif(estimated_households, 0) AS penetration_rate FROM x)
SELECT area, current_policies, estimated_households, round(penetration_rate, 6) AS penetration_rate, round(median_income / 50000 * 30 + estimated_households / 10000 * 40 + (100 - penetration_rate) * 30, 4) AS opportunity_score FROM y ORDER BY opportunity_score DESC, area LIMIT 20""")
def market_opportunity(spark, sf):
    markets = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("area"), F.floor(F.abs("s_acctbal") * 100).alias("population"), (F.col("s_acctbal").cast("decimal(18,2)") + 50000).alias("median_income")
    )
    out = enrich.market_opportunity(markets, area_penetration(spark, sf), "area")
    return out.select("area", "current_policies", "estimated_households", F.round("penetration_rate", 6).alias("penetration_rate"), F.round("opportunity_score", 4).alias("opportunity_score"))


LATE_SQL = """late AS (SELECT o_orderkey AS policy_id, o_custkey % 40 AS policy_duration_months, late_payments_12mo, last_payment_date FROM orders JOIN (
   SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'R') AS late_payments_12mo, max(l_shipdate) AS last_payment_date FROM lineitem WHERE CAST(l_shipdate AS DATE) >= DATE '2001-08-02' - 365 GROUP BY l_orderkey) ON l_orderkey = o_orderkey
   WHERE o_orderstatus = 'O' AND CAST(last_payment_date AS DATE) < DATE '2001-08-02' - 30)"""


def _late(spark, sf):
    policies = table(spark, sf, "orders").filter("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("policy_id"), (F.col("o_custkey") % 40).alias("policy_duration_months"))
    payments = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("policy_id"), F.col("l_shipdate").alias("payment_date"), F.when(F.col("l_returnflag") == "R", "Late").otherwise("Paid").alias("payment_status")
    )
    return enrich.late_payments(policies, payments, at(b.ORDERS_AS_OF))


@query("late_payments", "WITH " + LATE_SQL + " SELECT * FROM late")
def late_payments(spark, sf):
    return _late(spark, sf)


@query("lapse_risk", "WITH " + LATE_SQL + """, eco AS (SELECT CAST(max_by(CASE WHEN event_type = 'view' THEN value END, CASE WHEN event_type = 'view' THEN ts END) AS DECIMAL(18,2)) AS unemployment_rate FROM events),
 s AS (SELECT policy_id, late_payments_12mo * 15 + CAST(unemployment_rate AS DOUBLE) * 5 / 10 + CASE WHEN policy_duration_months < 12 THEN 20 ELSE 0 END + CASE WHEN date_diff('day', CAST(last_payment_date AS DATE), DATE '2001-08-02') > 60 THEN 30 ELSE 0 END AS v FROM late, eco)
SELECT policy_id, round(v, 6) AS lapse_risk_score, CASE WHEN v > 50 THEN 'high' WHEN v >= 30 THEN 'medium' ELSE 'low' END AS lapse_band FROM s""")
def lapse_risk(spark, sf):
    economy = agg.latest_values(table(spark, sf, "events"), "event_type", "value", "ts", {"view": "unemployment_rate"})
    scaled = economy.select((F.col("unemployment_rate") / 10).alias("unemployment_rate"))
    return enrich.lapse_risk(_late(spark, sf), scaled, at(b.ORDERS_AS_OF)).select("policy_id", F.round("lapse_risk_score", 6).alias("lapse_risk_score"), "lapse_band")


@query("external_dataset_issues", """
SELECT event_id, 'dataset_' || user_id AS dataset_name, CAST(json_extract_string(props, '$.k') AS BIGINT) * 2 AS freshness_days, event_type <> 'error' AS is_accessible FROM events
WHERE CAST(ts AS DATE) >= DATE '2024-01-29' AND (event_type = 'error' OR CAST(json_extract_string(props, '$.k') AS BIGINT) * 2 > 90)""")
def external_dataset_issues(spark, sf):
    log = table(spark, sf, "events").select(
        "event_id", F.col("user_id").alias("dataset_id"), F.col("ts").alias("check_timestamp"), (F.get_json_object("props", "$.k").cast("bigint") * 2).alias("freshness_days"), (F.col("event_type") != "error").alias("is_accessible")
    )
    catalogue = table(spark, sf, "events").select(F.col("user_id").alias("dataset_id")).distinct().withColumn("dataset_name", F.concat(F.lit("dataset_"), "dataset_id"))
    return enrich.dataset_issues(log, catalogue, at(b.EVENTS_AS_OF)).select("event_id", "dataset_name", "freshness_days", "is_accessible")


@query("dataset_ranking", """
SELECT p_partkey AS dataset_id, p_size / 50.0::DOUBLE AS relevance_score, CASE WHEN p_size / 50.0::DOUBLE >= 0.8 THEN 'ingest' WHEN p_size / 50.0::DOUBLE >= 0.6 THEN 'investigate' ELSE 'reject' END AS decision,
  CASE WHEN p_size / 50.0::DOUBLE >= 0.8 THEN 0 WHEN p_size / 50.0::DOUBLE >= 0.6 THEN 1 ELSE 2 END AS decision_order FROM part""")
def dataset_ranking(spark, sf):
    return enrich.rank_datasets(table(spark, sf, "part").select(F.col("p_partkey").alias("dataset_id"), (F.col("p_size") / 50.0).alias("relevance_score")))


@query("exchange_volume", """
SELECT l_returnflag AS vendor_name, l_linestatus AS direction, count(*) AS transfer_count, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_rows, round(CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) / count(*), 6) AS avg_duration_sec,
  count(*) FILTER (WHERE l_discount < 0.05) AS successful_transfers, count(*) FILTER (WHERE l_discount >= 0.05) AS failed_transfers, count(DISTINCT CAST(l_shipdate AS DATE)) AS days_active FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-08-02' - INTERVAL 365 DAYS GROUP BY ALL""")
def exchange_volume(spark, sf):
    log = table(spark, sf, "lineitem").filter(F.col("l_shipdate") >= at(b.ORDERS_AS_OF) - F.expr("INTERVAL 365 DAYS"))
    return log.groupBy(F.col("l_returnflag").alias("vendor_name"), F.col("l_linestatus").alias("direction")).agg(
        F.count("*").alias("transfer_count"), F.sum(F.col("l_quantity").cast("bigint")).alias("total_rows"), F.round(agg.mean(F.col("l_tax").cast("decimal(18,2)")), 6).alias("avg_duration_sec"),
        F.count_if(F.col("l_discount") < 0.05).alias("successful_transfers"), F.count_if(F.col("l_discount") >= 0.05).alias("failed_transfers"),
        F.countDistinct(F.col("l_shipdate").cast("date")).alias("days_active"),
    )


@query("vendor_sla_percentile", """
SELECT l_shipmode AS vendor, count(*) AS total_transfers, round(quantile_cont(v, 0.95), 6) AS p95_duration, CASE WHEN CAST(sum(CAST(v AS DECIMAL(18,2))) AS DOUBLE) / count(*) < 20 THEN 'excellent' WHEN CAST(sum(CAST(v AS DECIMAL(18,2))) AS DOUBLE) / count(*) < 26 THEN 'acceptable' ELSE 'slow' END AS sla_status
FROM (SELECT l_suppkey AS l_shipmode, l_quantity AS v FROM lineitem WHERE l_discount < 0.05) GROUP BY l_shipmode""")
def vendor_sla_percentile(spark, sf):
    ok = table(spark, sf, "lineitem").filter("l_discount < 0.05").select(F.col("l_suppkey").alias("vendor"), F.col("l_quantity").alias("v"))
    mean = agg.mean(F.col("v").cast("decimal(18,2)"))
    base = ok.groupBy("vendor").agg(F.count("*").alias("total_transfers"), agg.band(mean, ((20, "excellent"), (26, "acceptable")), "slow", below=True).alias("sla_status"))
    p95 = agg.exact_percentile(ok, ["vendor"], "v", 0.95, "p95_duration").withColumn("p95_duration", F.round("p95_duration", 6))
    return base.join(p95, "vendor")


FRAUD_FEATURES = ["loss_amount", "report_lag_days", "num_prior_claims", "policy_age_months", "litigation_flag"]


def fraud_rows(spark, sf):
    """Claims with the model's features; the label follows from them, as in the demonstration model."""
    li = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("claim_id"), F.col("l_extendedprice").alias("loss_amount"), (F.col("l_partkey") % 60).cast("int").alias("report_lag_days"),
        (F.col("l_suppkey") % 10).cast("int").alias("num_prior_claims"), (F.col("l_orderkey") % 120).cast("int").alias("policy_age_months"), F.when(F.col("l_tax") > 0.07, 1).otherwise(0).alias("litigation_flag"),
    )
    label = (F.col("loss_amount") > 50000) & (F.col("report_lag_days") > 20) & (F.col("num_prior_claims") > 3)
    return li.withColumn("is_fraud", F.when(label, 1).otherwise(0))


@query("fraud_model_scores")
def fraud_model_scores(spark, sf):
    """Train on a random 80 %, score every claim (20 trees of depth 6 keep the check short)."""
    rows = fraud_rows(spark, sf)
    train, _ = scoring.split_rows(rows)
    model = scoring.train_fraud_model(train, FRAUD_FEATURES, "is_fraud", trees=20, depth=6)
    return scoring.score_rows(model, rows, ["claim_id", "is_fraud"])


FRAUD_SQL = """WITH c AS (SELECT l_orderkey * 8 + l_linenumber AS claim_id, (l_extendedprice > 50000 AND l_partkey % 60 > 20 AND l_suppkey % 10 > 3)::INT AS is_fraud,
  CASE WHEN ('0x' || substr(md5((l_orderkey * 8 + l_linenumber)::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.8 THEN 'train' ELSE 'test' END AS part FROM lineitem)
"""


@query("split_by_key", FRAUD_SQL + "SELECT part, count(*) AS n, sum(is_fraud)::BIGINT AS frauds, sum(claim_id)::BIGINT AS key_sum FROM c GROUP BY part")
def split_by_key(spark, sf):
    parts = scoring.split_by_key(fraud_rows(spark, sf), ["claim_id"])
    sums = [F.count("*").alias("n"), F.sum("is_fraud").alias("frauds"), F.sum("claim_id").alias("key_sum")]
    return agg.union_all([p.agg(F.lit(name).alias("part"), *sums) for name, p in zip(("train", "test"), parts)])


@query("fraud_model_quality", FRAUD_SQL + "SELECT count(*) AS scored, sum(is_fraud)::BIGINT AS frauds, true AS in_range, true AS good_area FROM c WHERE part = 'test'")
def fraud_model_quality(spark, sf):
    """Every claim that was held out is scored, between 0 and 1, and the area under the curve is over 0.95."""
    train, test = scoring.split_by_key(fraud_rows(spark, sf), ["claim_id"])
    model = scoring.train_fraud_model(train, FRAUD_FEATURES, "is_fraud", trees=20, depth=6)
    scored = scoring.score_rows(model, test, ["claim_id", "is_fraud"])
    area = scoring.area_under_roc(model.transform(test), "is_fraud")
    return scored.agg(F.count("*").alias("scored"), F.sum("is_fraud").alias("frauds"), F.bool_and(F.col("fraud_probability").between(0, 1)).alias("in_range")).withColumn("good_area", F.lit(area > 0.95))


@query("train_test_split")
def train_test_split(spark, sf):
    train, test = scoring.split_rows(fraud_rows(spark, sf).select("claim_id"))
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test"))).groupBy("part").agg(F.count("*").alias("n"))
