"""The supplied tables in the roles of policies, claims, logs and so on.

Each binding exists twice, as a Spark projection and as the SQL the checks use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.plans.registry import table

ORDERS_AS_OF = "2001-08-02 00:00:00"
EVENTS_AS_OF = "2024-01-30 12:00:00"


def with_sql(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


POLICY = """policy AS (
  SELECT o_orderkey AS policy_id, o_custkey AS customer_id, o_orderpriority AS policy_type,
         o_orderstatus AS policy_status, CAST(o_totalprice AS DECIMAL(18,2)) AS premium,
         o_orderdate AS effective_date FROM orders)"""
CLAIM = """claim AS (
  SELECT l_orderkey AS policy_id, l_orderkey * 8 + l_linenumber AS claim_id, l_suppkey AS agent_id,
         l_returnflag AS claim_type, l_linestatus AS claim_status,
         CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS claim_amount,
         l_shipdate AS claim_date FROM lineitem)"""
HOLDER = """holder AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment,
         c_nationkey AS state, CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM customer)"""
RUNS = """runs AS (
  SELECT event_id AS execution_id, user_id AS asset_id, 'asset_' || user_id AS asset_name,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'succeeded' END AS status,
         ts AS start_time, value AS duration_seconds,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS records_written,
         CASE WHEN event_type = 'error' THEN
           CASE CAST(json_extract_string(props, '$.k') AS BIGINT) % 5
             WHEN 0 THEN 'Request timeout after 30s' WHEN 1 THEN 'HTTP 403 permission denied'
             WHEN 2 THEN 'schema drift in column x' WHEN 3 THEN 'table not found' ELSE 'boom' END
         END AS error_message FROM events)"""
ASSETS = """assets AS (
  SELECT user_id AS asset_id, 'asset_' || user_id AS asset_name,
         'domain_' || (user_id % 7) AS domain, 0.15 + (user_id % 3) / 10.0 AS sla_max_failure_rate,
         user_id % 4 <> 0 AS monitoring_enabled, (user_id % 3 + 1) AS sla_completion_minutes
  FROM (SELECT DISTINCT user_id FROM events))"""
ACCESS = """access AS (
  SELECT event_id, ts, user_id,
         CASE event_type WHEN 'view' THEN 'read' WHEN 'click' THEN 'read' WHEN 'signup' THEN 'create'
           WHEN 'purchase' THEN 'write' ELSE 'grant' END AS operation,
         'table_' || (k % 20) AS table_name, k * 100 AS row_count, k * 100000000 AS bytes_scanned,
         k % 5 = 0 AS pii_accessed, event_type = 'error' AND k % 2 = 0 AS flagged,
         CASE WHEN event_type = 'error' AND k % 2 = 0 THEN 'review' END AS flag_reason,
         CASE WHEN k > 50 THEN 'high' ELSE 'low' END AS severity,
         CASE k % 3 WHEN 0 THEN 'role' WHEN 1 THEN 'permission' ELSE 'workspace' END AS resource_type,
         'resource_' || (k % 10) AS resource_name, user_id * 100 + extract(day FROM ts) AS session_id
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""
PAYMENTS = """payments AS (
  SELECT event_id AS transaction_id, user_id AS customer_id,
         CASE event_type WHEN 'error' THEN 'decline' WHEN 'signup' THEN 'chargeback' ELSE event_type END AS event_type,
         CASE WHEN event_type = 'error' THEN 'declined' ELSE 'approved' END AS status,
         CAST(value * 1000 - 500 AS DECIMAL(18,2)) AS amount, ts AS event_timestamp FROM events)"""
CLICKS = """clicks AS (
  SELECT event_id, user_id, user_id * 10 + k % 3 AS session_id,
         CASE event_type WHEN 'purchase' THEN 'quote_request' WHEN 'signup' THEN 'form_submit'
           WHEN 'error' THEN 'form_start' ELSE event_type END AS event_type,
         'product_' || (k % 6) AS product_interest, k AS time_on_page_sec, ts AS event_timestamp
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""


def policies(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("policy_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("policy_type"),
        F.col("o_orderstatus").alias("policy_status"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("premium"),
        F.col("o_orderdate").alias("effective_date"),
    )


def claims(spark: SparkSession, sf: str) -> DataFrame:
    amount = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("policy_id"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("claim_id"),
        F.col("l_suppkey").alias("agent_id"),
        F.col("l_returnflag").alias("claim_type"),
        F.col("l_linestatus").alias("claim_status"),
        amount.cast("decimal(18,4)").alias("claim_amount"),
        F.col("l_shipdate").alias("claim_date"),
    )


def holders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("state"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("balance"),
    )


def _k(kind: str = "bigint"):
    return F.get_json_object("props", "$.k").cast(kind)


def runs(spark: SparkSession, sf: str) -> DataFrame:
    failed = F.col("event_type") == "error"
    message = (
        F.when(_k() % 5 == 0, "Request timeout after 30s")
        .when(_k() % 5 == 1, "HTTP 403 permission denied")
        .when(_k() % 5 == 2, "schema drift in column x")
        .when(_k() % 5 == 3, "table not found")
        .otherwise("boom")
    )
    return table(spark, sf, "events").select(
        F.col("event_id").alias("execution_id"),
        F.col("user_id").alias("asset_id"),
        F.concat(F.lit("asset_"), "user_id").alias("asset_name"),
        F.when(failed, "failed").otherwise("succeeded").alias("status"),
        F.col("ts").alias("start_time"),
        F.col("value").alias("duration_seconds"),
        _k().alias("records_written"),
        F.when(failed, message).alias("error_message"),
    )


def assets(spark: SparkSession, sf: str) -> DataFrame:
    u = F.col("user_id")
    return table(spark, sf, "events").select("user_id").distinct().select(
        u.alias("asset_id"),
        F.concat(F.lit("asset_"), u).alias("asset_name"),
        F.concat(F.lit("domain_"), u % 7).alias("domain"),
        (F.lit(0.15) + (u % 3) / 10.0).alias("sla_max_failure_rate"),
        (u % 4 != 0).alias("monitoring_enabled"),
        (u % 3 + 1).alias("sla_completion_minutes"),
    )


def accesses(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    flagged = (kind == "error") & (F.col("k") % 2 == 0)
    return table(spark, sf, "events").withColumn("k", _k()).select(
        "event_id",
        "ts",
        "user_id",
        F.when(kind.isin("view", "click"), "read").when(kind == "signup", "create").when(kind == "purchase", "write")
        .otherwise("grant").alias("operation"),
        F.concat(F.lit("table_"), F.col("k") % 20).alias("table_name"),
        (F.col("k") * 100).alias("row_count"),
        (F.col("k") * 100000000).alias("bytes_scanned"),
        (F.col("k") % 5 == 0).alias("pii_accessed"),
        flagged.alias("flagged"),
        F.when(flagged, "review").alias("flag_reason"),
        F.when(F.col("k") > 50, "high").otherwise("low").alias("severity"),
        F.when(F.col("k") % 3 == 0, "role").when(F.col("k") % 3 == 1, "permission").otherwise("workspace").alias("resource_type"),
        F.concat(F.lit("resource_"), F.col("k") % 10).alias("resource_name"),
        (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("session_id"),
    )


def payments(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    kind = F.col("event_type")
    events = events if events is not None else table(spark, sf, "events")
    return events.select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        F.when(kind == "error", "decline").when(kind == "signup", "chargeback").otherwise(kind).alias("event_type"),
        F.when(kind == "error", "declined").otherwise("approved").alias("status"),
        (F.col("value") * 1000 - 500).cast("decimal(18,2)").alias("amount"),
        F.col("ts").alias("event_timestamp"),
    )


def clicks(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    kind = F.col("event_type")
    events = events if events is not None else table(spark, sf, "events")
    return events.withColumn("k", _k("int")).select(
        "event_id",
        "user_id",
        (F.col("user_id") * 10 + F.col("k") % 3).alias("session_id"),
        F.when(kind == "purchase", "quote_request").when(kind == "signup", "form_submit").when(kind == "error", "form_start")
        .otherwise(kind).alias("event_type"),
        F.concat(F.lit("product_"), F.col("k") % 6).alias("product_interest"),
        F.col("k").alias("time_on_page_sec"),
        F.col("ts").alias("event_timestamp"),
    )
