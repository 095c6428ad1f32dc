"""Ingest mapping, rules, history, gold models, KPIs and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrata.functions.cleansing import cleanse
from lodestrata.functions.hashing import row_hash
from lodestrata.operators import aggregates as agg
from lodestrata.operators import gold, history, ingest, kpi, profile, rules, windows
from lodestrata.plans import bindings as b
from lodestrata.plans.bindings import CLAIM, HOLDER, POLICY, with_sql
from lodestrata.plans.registry import at, plain, query, table

# ---- ingest and rules ----------------------------------------------------------------

MAPPINGS = [
    {"source_column": "o_orderkey", "target_column": "policy_id", "target_data_type": "string", "transformation_expr": None},
    {"source_column": None, "target_column": "priority", "target_data_type": "string",
     "transformation_expr": "upper(substring(o_orderpriority, 3, 20))"},
    {"source_column": None, "target_column": "order_year", "target_data_type": "int", "transformation_expr": "year(o_orderdate)"},
    {"source_column": "o_custkey", "target_column": "customer_id", "target_data_type": "int", "transformation_expr": None},
]


@query("column_mapping", """
SELECT CAST(o_orderkey AS VARCHAR) AS policy_id, upper(substring(o_orderpriority, 3, 20)) AS priority,
       CAST(year(o_orderdate) AS INTEGER) AS order_year, CAST(o_custkey AS INTEGER) AS customer_id FROM orders""")
def column_mapping(spark, sf):
    return ingest.apply_mapping(table(spark, sf, "orders"), MAPPINGS)


@query("audit_columns_and_hash", """
SELECT o_orderkey, o_custkey, o_orderstatus, TIMESTAMP '2001-08-02 00:00:00' AS _ingestion_timestamp, 'ING001' AS _ingestion_rule_id,
       'run-1' AS _execution_id,
       sha256(coalesce(CAST(o_orderkey AS VARCHAR), '\\N') || '||' || coalesce(CAST(o_custkey AS VARCHAR), '\\N') || '||' ||
              coalesce(o_orderstatus, '\\N')) AS _record_hash
FROM orders""")
def audit_columns_and_hash(spark, sf):
    return ingest.add_audit(
        table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "ING001", "run-1", at(b.ORDERS_AS_OF)
    )


@query("watermark_max", "SELECT max(o_orderdate) AS watermark FROM orders")
def watermark_max(spark, sf):
    return ingest.watermark(table(spark, sf, "orders"), "o_orderdate")


@query("schema_evolution_union", """
SELECT s_suppkey AS party_id, s_name AS party_name, NULL AS segment FROM supplier
UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer""")
def schema_evolution_union(spark, sf):
    old = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("party_id"), F.col("s_name").alias("party_name"))
    new = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("party_id"), F.col("c_name").alias("party_name"), F.col("c_mktsegment").alias("segment")
    )
    return ingest.evolve(old, new)


def _rule(order, name, kind, expression=None, parameters=None, handling="skip_record", until=None, active=True):
    return {
        "rule_id": f"R{order:02d}", "rule_name": name, "domain": "policy", "source_layer": "bronze", "target_layer": "silver",
        "source_table": "orders", "rule_type": kind, "rule_expression": expression, "rule_parameters": parameters,
        "execution_order": order, "error_handling": handling, "effective_to": until, "is_active": active,
    }


RULES = [
    _rule(1, "rename_key", "rename", parameters='{"old_name":"o_orderkey","new_name":"policy_id"}'),
    _rule(2, "status", "standardize", parameters='{"column":"o_orderpriority"}'),
    _rule(3, "net", "sql_expr", "CAST(floor(o_totalprice / 1000) AS BIGINT)", '{"target_column":"price_band"}'),
    _rule(4, "only_big", "filter", "price_band >= 50"),
    _rule(5, "broken", "sql_expr", "no_such_column + 1", '{"target_column":"never"}'),
    _rule(6, "as_text", "cast", parameters='{"column":"o_custkey","type":"string"}'),
    _rule(7, "default_status", "default", parameters='{"column":"o_orderstatus","value":"?"}'),
    _rule(8, "segment", "lookup", parameters='{"lookup_table":"customer","lookup_key":"c_key","lookup_value":"c_mktsegment","join_key":"o_custkey"}'),
    _rule(9, "expired", "filter", "false", until="2000-01-01"),
    _rule(10, "inactive", "filter", "false", active=False),
]
RULE_SCHEMA = (
    "rule_id string, rule_name string, domain string, source_layer string, target_layer string, source_table string, "
    "rule_type string, rule_expression string, rule_parameters string, execution_order int, error_handling string, "
    "effective_to string, is_active boolean"
)


@query("business_rules_fold", """
SELECT o_orderkey AS policy_id, CAST(o_custkey AS VARCHAR) AS o_custkey, coalesce(o_orderstatus, '?') AS o_orderstatus,
       trim(upper(o_orderpriority)) AS o_orderpriority, CAST(floor(o_totalprice / 1000) AS BIGINT) AS price_band,
       c_mktsegment AS _lkp_c_mktsegment
FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE floor(o_totalprice / 1000) >= 50""")
def business_rules_fold(spark, sf):
    stored = spark.createDataFrame([tuple(r.values()) for r in RULES], RULE_SCHEMA)
    wanted = rules.effective_rules(stored, "orders", "bronze", "silver", "policy", F.lit("2001-08-02")).collect()
    lookup = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("c_key"), "c_mktsegment")
    done = rules.apply_rules(table(spark, sf, "orders"), wanted, rules.RuleContext({"customer": lookup}))
    return done.df.select("policy_id", "o_custkey", "o_orderstatus", "o_orderpriority", "price_band", "_lkp_c_mktsegment")


@query("cleansing_map", """
SELECT p_partkey, upper(trim(p_name)) AS p_name, regexp_replace(p_brand, '[^a-zA-Z0-9\\s]', '', 'g') AS p_brand, trim(p_type) AS p_type FROM part""")
def cleansing_map(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return cleanse(parts, {"p_name": "uppercase", "p_brand": "remove_special_chars", "p_type": "trim"})


@query("dynamic_filter", """
SELECT count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '1998-01-01'""")
def dynamic_filter(spark, sf):
    cond = rules.predicate({"o_orderpriority": "1-URGENT", "o_orderstatus": None}, {"o_orderdate": at("1998-01-01")}, {"o_orderdate": None})
    return table(spark, sf, "orders").filter(cond).agg(F.count("*").alias("n"))


@query("time_window_filter", """
SELECT event_type, count(*) AS n FROM events
WHERE ts >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 24 HOURS GROUP BY event_type""")
def time_window_filter(spark, sf):
    ev = table(spark, sf, "events")
    return ev.filter(rules.within(F.col("ts"), at(b.EVENTS_AS_OF), "24 HOURS")).groupBy("event_type").agg(F.count("*").alias("n"))


# ---- de-duplication and history ------------------------------------------------------


@query("latest_order_per_customer", """
SELECT o_custkey, o_orderkey, o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def latest_order_per_customer(spark, sf):
    df = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return history.keep_latest(df, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(spark, sf):
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("keep_max_per_group", """
SELECT user_id, event_type, max(event_id) AS event_id FROM events GROUP BY user_id, event_type""")
def keep_max_per_group(spark, sf):
    df = table(spark, sf, "events").select("user_id", "event_type", "event_id")
    return history.keep_max_per_group(df, ["user_id", "event_type"], "event_id")


#: Two states of the customer table: the second changes every third balance, drops every
#: fifth key and adds keys of the suppliers.
OLD_SQL = "old AS (SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer)"
NEW_SQL = """new AS (
  SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN 'MOVED' ELSE c_mktsegment END AS segment
  FROM customer WHERE c_custkey % 5 <> 0
  UNION ALL SELECT s_suppkey + 1000000000, s_name, 'SUPPLIER' FROM supplier)"""


def old_state(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))


def new_state(spark, sf):
    kept = old_state(spark, sf).filter("id % 5 <> 0").withColumn("segment", F.when(F.col("id") % 3 == 0, "MOVED").otherwise(F.col("segment")))
    added = table(spark, sf, "supplier").select(
        (F.col("s_suppkey") + 1000000000).alias("id"), F.col("s_name").alias("name"), F.lit("SUPPLIER").alias("segment")
    )
    return kept.unionByName(added)


def _hashed(df):
    return history.with_row_hash(df, ["name", "segment"])


@query("scd1_merge", with_sql(OLD_SQL, NEW_SQL) + """
SELECT coalesce(new.id, old.id) AS id, coalesce(new.name, old.name) AS name, coalesce(new.segment, old.segment) AS segment
FROM old FULL JOIN new ON old.id = new.id""")
def scd1_merge(spark, sf):
    return history.scd1_merge(_hashed(old_state(spark, sf)), _hashed(new_state(spark, sf)), ["id"]).drop("_record_hash")


SCD2_SQL = with_sql(OLD_SQL, NEW_SQL) + """
SELECT old.id, old.name, old.segment, TIMESTAMP '2001-01-01' AS valid_from,
       CASE WHEN new.id IS NOT NULL AND new.segment <> old.segment THEN TIMESTAMP '2001-02-01' ELSE TIMESTAMP '9999-12-31' END AS valid_to,
       NOT (new.id IS NOT NULL AND new.segment <> old.segment) AS is_current
FROM old LEFT JOIN new ON old.id = new.id
UNION ALL
SELECT new.id, new.name, new.segment, TIMESTAMP '2001-02-01', TIMESTAMP '9999-12-31', true
FROM new LEFT JOIN old ON old.id = new.id WHERE old.id IS NULL OR old.segment <> new.segment"""


def versioned(spark, sf):
    first = history.open_version(_hashed(old_state(spark, sf)), at("2001-01-01"))
    return history.scd2_merge(first, _hashed(new_state(spark, sf)), ["id"], at("2001-02-01"))


def _shown(df):
    return df.select("id", "name", "segment", F.col("_effective_from").alias("valid_from"), F.col("_effective_to").alias("valid_to"),
                     F.col("_is_current").alias("is_current"))


@query("scd2_merge", SCD2_SQL)
def scd2_merge(spark, sf):
    return _shown(versioned(spark, sf))


@query("scd2_merge_repeated", SCD2_SQL)
def scd2_merge_repeated(spark, sf):
    """The same source merged twice: the second merge must change nothing."""
    again = history.scd2_merge(versioned(spark, sf), _hashed(new_state(spark, sf)), ["id"], at("2001-03-01"))
    return _shown(again)


CDF_SQL = with_sql(OLD_SQL, NEW_SQL, """feed AS (
  SELECT new.id, new.name, new.segment, 'insert' AS _change_type FROM new LEFT JOIN old ON old.id = new.id WHERE old.id IS NULL
  UNION ALL SELECT old.id, old.name, old.segment, 'delete' FROM old LEFT JOIN new ON old.id = new.id WHERE new.id IS NULL
  UNION ALL SELECT old.id, old.name, old.segment, 'update_preimage' FROM old JOIN new ON old.id = new.id WHERE old.segment <> new.segment
  UNION ALL SELECT new.id, new.name, new.segment, 'update_postimage' FROM old JOIN new ON old.id = new.id WHERE old.segment <> new.segment)""")


@query("change_feed", CDF_SQL + "SELECT * FROM feed")
def change_feed(spark, sf):
    return history.change_feed(_hashed(old_state(spark, sf)), _hashed(new_state(spark, sf)), ["id"]).drop("_record_hash")


@query("change_feed_by_buckets", CDF_SQL + "SELECT * FROM feed")
def change_feed_by_buckets(spark, sf):
    """The same feed; only buckets of keys whose digests differ are joined."""
    return history.change_feed_by_buckets(_hashed(old_state(spark, sf)), _hashed(new_state(spark, sf)), ["id"]).drop("_record_hash")


@query("change_feed_counts", CDF_SQL + "SELECT _change_type, count(*) AS change_count FROM feed GROUP BY _change_type")
def change_feed_counts(spark, sf):
    return history.change_counts(history.change_feed(_hashed(old_state(spark, sf)), _hashed(new_state(spark, sf)), ["id"]))


@query("change_feed_replay", with_sql(NEW_SQL) + "SELECT * FROM new")
def change_feed_replay(spark, sf):
    old, new = _hashed(old_state(spark, sf)), _hashed(new_state(spark, sf))
    return history.apply_change_feed(old, history.change_feed(old, new, ["id"]), ["id"]).drop("_record_hash")


@query("rule_type_history", SCD2_SQL)
def rule_type_history(spark, sf):
    """The same merge as a rule of type ``scd2`` among others; a second rule of an unknown function is skipped."""
    first = history.open_version(_hashed(old_state(spark, sf)), at("2001-01-01"))
    wanted = [
        {"rule_name": "hash", "rule_type": "python_func", "rule_parameters": '{"function": "hashed"}'},
        {"rule_name": "unknown", "rule_type": "python_func", "rule_parameters": '{"function": "nowhere"}', "error_handling": "skip"},
        {"rule_name": "versions", "rule_type": "scd2", "rule_parameters": '{"target": "silver", "keys": ["id"], "as_of": "TIMESTAMP_NTZ\'2001-02-01 00:00:00\'"}', "error_handling": "fail_batch"},
    ]
    done = rules.apply_rules(new_state(spark, sf), wanted, rules.RuleContext({"silver": first}, {"hashed": _hashed}))
    assert list(done.skipped) == ["unknown"]
    return _shown(done.df)


@query("rule_type_aggregate", """
SELECT o_orderstatus, o_orderdate >= TIMESTAMP '1995-01-01' AS is_late, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, max(o_custkey) AS last_customer FROM orders GROUP BY ALL""")
def rule_type_aggregate(spark, sf):
    wanted = [
        {"rule_name": "period", "rule_type": "python_func", "rule_parameters": '{"function": "period"}', "error_handling": "fail_batch"},
        {"rule_name": "totals", "rule_type": "aggregate", "error_handling": "fail_batch",
         "rule_parameters": '{"group_by": ["o_orderstatus", "is_late"], "measures": {"orders": "count(*)", "total": "cast(sum(cast(o_totalprice as decimal(18,2))) as double)", "last_customer": "max(o_custkey)"}}'},
    ]
    period = lambda df: df.withColumn("is_late", F.col("o_orderdate") >= at("1995-01-01"))
    return rules.apply_rules(table(spark, sf, "orders"), wanted, rules.RuleContext({}, {"period": period})).df


EXPECTED_COLUMNS = {"region": ["r_regionkey", "r_name"], "nation": ["n_nationkey", "n_name", "n_capital"], "supplier": ["s_suppkey", "s_phone_number"]}


def _column_set_sql(name, expected):
    listed = "[" + ", ".join(f"'{c}'" for c in expected) + "]"
    rest = lambda a, b: f"array_to_string(list_sort(list_filter({a}, lambda x: NOT list_contains({b}, x))), ',')"
    return f"""SELECT '{name}' AS table_name, {rest(listed, 'have')} AS missing, {rest('have', listed)} AS unexpected, n AS table_rows
  FROM (SELECT list(column_name) AS have FROM (DESCRIBE {name})), (SELECT count(*) AS n FROM {name})"""


@query("column_set_validation", " UNION ALL ".join(_column_set_sql(n, c) for n, c in EXPECTED_COLUMNS.items()))
def column_set_validation(spark, sf):
    """Columns that tables lack or have too much against what is expected of them."""
    parts = []
    for name, expected in EXPECTED_COLUMNS.items():
        df = table(spark, sf, name)
        missing, extra = ingest.schema_difference(df, expected)
        parts.append(df.agg(F.lit(name).alias("table_name"), F.lit(",".join(missing)).alias("missing"), F.lit(",".join(extra)).alias("unexpected"), F.count("*").alias("table_rows")))
    return agg.union_all(parts)


@query("conditional_update", """
SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'REVIEW' ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def conditional_update(spark, sf):
    df = table(spark, sf, "orders")
    return history.conditional_update(df, F.col("o_totalprice") > 300000, {"o_orderstatus": F.lit("REVIEW")}).select("o_orderkey", "o_orderstatus")


@query("conditional_delete", "SELECT o_orderkey FROM orders WHERE NOT (o_orderdate < TIMESTAMP '1997-01-01')")
def conditional_delete(spark, sf):
    return history.conditional_delete(table(spark, sf, "orders"), F.col("o_orderdate") < at("1997-01-01")).select("o_orderkey")


CHECKS = {"price_not_negative": "o_totalprice >= 0", "known_status": "o_orderstatus IN ('O','F')", "key_present": "o_orderkey IS NOT NULL"}


@query("check_constraints", """
SELECT 'price_not_negative' AS constraint_name, count(*) FILTER (WHERE NOT (o_totalprice >= 0)) AS violations FROM orders
UNION ALL SELECT 'known_status', count(*) FILTER (WHERE NOT (o_orderstatus IN ('O','F'))) FROM orders
UNION ALL SELECT 'key_present', count(*) FILTER (WHERE o_orderkey IS NULL) FROM orders""")
def check_constraints(spark, sf):
    return history.check_constraints(table(spark, sf, "orders"), CHECKS).select("constraint_name", "violations")


@query("constraint_violations", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('O','F')")
def constraint_violations(spark, sf):
    return history.split_by_constraints(table(spark, sf, "orders"), CHECKS)[1].select("o_orderkey", "o_orderstatus")


@query("archive_expired", """
SELECT year(o_orderdate)::INTEGER AS order_year, count(*) AS n, TIMESTAMP '2001-08-02 00:00:00' AS _archived_at
FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '2001-08-02' - 1000 GROUP BY ALL""")
def archive_expired(spark, sf):
    _, expired = history.split_expired(table(spark, sf, "orders"), "o_orderdate", at(b.ORDERS_AS_OF), 1000)
    return history.archive_rows(expired, at(b.ORDERS_AS_OF)).groupBy(F.year("o_orderdate").alias("order_year"), "_archived_at").agg(F.count("*").alias("n"))


@query("retention_cycle", """
SELECT 'orders' AS table_name, 'archive' AS action, count(*) AS total_rows,
       count(*) FILTER (WHERE CAST(o_orderdate AS DATE) < DATE '2001-08-02' - 365) AS expired_rows,
       CASE WHEN count(*) FILTER (WHERE CAST(o_orderdate AS DATE) < DATE '2001-08-02' - 365) > 0 THEN 'archive' ELSE 'nothing_due' END AS status FROM orders
UNION ALL SELECT 'lineitem', 'delete', count(*), count(*) FILTER (WHERE CAST(l_shipdate AS DATE) < DATE '2001-08-02' - 100000),
       CASE WHEN count(*) FILTER (WHERE CAST(l_shipdate AS DATE) < DATE '2001-08-02' - 100000) > 0 THEN 'delete' ELSE 'nothing_due' END FROM lineitem
UNION ALL SELECT 'customer', 'archive', 0, 0, 'no_date_column'""")
def retention_cycle(spark, sf):
    tables = {n: table(spark, sf, n) for n in ("orders", "lineitem", "customer")}
    policies = [
        {"table_name": "orders", "action": "archive", "retention_days": 365},
        {"table_name": "lineitem", "action": "delete", "retention_days": 100000},
        {"table_name": "customer", "action": "archive", "retention_days": 1},
        {"table_name": "nation", "action": "archive", "retention_days": 1, "is_active": False},
    ]
    return history.retention_report(tables, policies, at(b.ORDERS_AS_OF))


@query("storage_savings", """
SELECT CAST(sum(n) AS BIGINT) AS total_archivable_rows FROM (
  SELECT count(*) FILTER (WHERE CAST(o_orderdate AS DATE) < DATE '2001-08-02' - 365) AS n FROM orders
  UNION ALL SELECT count(*) FILTER (WHERE CAST(l_shipdate AS DATE) < DATE '2001-08-02' - 730) FROM lineitem)""")
def storage_savings(spark, sf):
    tables = {n: table(spark, sf, n) for n in ("orders", "lineitem")}
    policies = [{"table_name": "orders", "action": "archive", "retention_days": 365}, {"table_name": "lineitem", "action": "archive", "retention_days": 730}]
    report = history.retention_report(tables, policies, at(b.ORDERS_AS_OF))
    return report.agg(F.sum("expired_rows").alias("total_archivable_rows"))


# ---- gold ----------------------------------------------------------------------------


@query("grain_aggregate", """
SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS order_year, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_premium,
       CAST(sum(CAST(o_totalprice * 10 AS DECIMAL(18,2))) AS DOUBLE) AS total_coverage, count(*) AS policy_count,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS avg_premium,
       CAST(max(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS max_premium, CAST(min(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS min_premium
FROM orders GROUP BY ALL""")
def grain_aggregate(spark, sf):
    fact = table(spark, sf, "orders").select(
        "o_orderpriority", F.year("o_orderdate").alias("order_year"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("premium"), (F.col("o_totalprice") * 10).cast("decimal(18,2)").alias("coverage"),
    )
    return plain(gold.grain_aggregate(fact, ["o_orderpriority", "order_year"], "premium", "coverage"))


#: Silver tables for the gold models, every model column derived from the supplied tables.
def silver_policy(spark, sf):
    o = table(spark, sf, "orders")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    return o.select(
        key.alias("policy_id"), F.concat(F.lit("POL"), key).alias("policy_number"), F.col("o_orderstatus").alias("product_code"),
        F.concat(F.lit("product "), "o_orderstatus").alias("product_name"), F.substring("o_orderpriority", 3, 20).alias("line_of_business"),
        F.col("o_orderstatus").alias("policy_status"), F.col("o_orderdate").alias("effective_date"),
        F.date_add(F.col("o_orderdate").cast("date"), 365).alias("expiration_date"), F.col("o_orderdate").cast("date").alias("issue_date"),
        F.lit(None).cast("date").alias("cancellation_date"), price.alias("premium_amount"), (price * 10).alias("coverage_amount"),
        F.lit(500.0).alias("deductible_amount"), F.col("o_custkey").alias("customer_id"), (key % 97).alias("agent_id"),
        (key % 13).alias("underwriter_id"), F.substring("o_orderpriority", 1, 1).alias("risk_class"), (key % 50).alias("territory_code"),
        (key % 25).alias("state_code"), at("2001-08-01").alias("_silver_load_ts"), (key % 4 != 0).alias("_is_current"),
    )


@query("gold_dim_policy", """
SELECT o_orderkey AS policy_id, 'POL' || o_orderkey AS policy_number, o_orderstatus AS product_code, 'product ' || o_orderstatus AS product_name,
  substring(o_orderpriority, 3, 20) AS line_of_business, o_orderstatus AS policy_status, o_orderdate AS effective_date,
  CAST(o_orderdate AS DATE) + 365 AS expiration_date, CAST(o_orderdate AS DATE) AS issue_date, CAST(NULL AS DATE) AS cancellation_date,
  o_totalprice AS premium_amount, o_totalprice * 10 AS coverage_amount, CAST(500.0 AS DOUBLE) AS deductible_amount, o_custkey AS customer_id,
  o_orderkey % 97 AS agent_id, o_orderkey % 13 AS underwriter_id, substring(o_orderpriority, 1, 1) AS risk_class, o_orderkey % 50 AS territory_code,
  o_orderkey % 25 AS state_code, TIMESTAMP '2001-08-01' AS last_updated, TIMESTAMP '2001-08-02 00:00:00' AS _gold_load_ts
FROM orders WHERE o_orderkey % 4 <> 0""")
def gold_dim_policy(spark, sf):
    return gold.dim_policy(silver_policy(spark, sf), at(b.ORDERS_AS_OF))


@query("gold_fact_policy_transaction", """
SELECT l_orderkey * 8 + l_linenumber AS transaction_id, l_orderkey AS policy_id, l_returnflag AS transaction_type, l_shipdate AS transaction_date,
  l_shipdate AS effective_date, l_extendedprice AS premium_change, l_extendedprice AS written_premium, l_quantity AS earned_premium,
  l_extendedprice - l_quantity AS unearned_premium, l_discount AS commission_amount, l_tax AS tax_amount, l_quantity AS fees, l_suppkey AS agent_id,
  l_partkey AS underwriter_id, l_linestatus AS approval_status, CAST(l_shipdate AS DATE) AS transaction_date_key,
  TIMESTAMP '2001-08-02 00:00:00' AS _gold_load_ts FROM lineitem""")
def gold_fact_policy_transaction(spark, sf):
    li = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey * 8 + l_linenumber AS transaction_id", "l_orderkey AS policy_id", "l_returnflag AS transaction_type", "l_shipdate AS transaction_date",
        "l_shipdate AS effective_date", "l_extendedprice AS premium_change", "l_extendedprice AS written_premium", "l_quantity AS earned_premium",
        "l_extendedprice - l_quantity AS unearned_premium", "l_discount AS commission_amount", "l_tax AS tax_amount", "l_quantity AS fees",
        "l_suppkey AS agent_id", "l_partkey AS underwriter_id", "l_linestatus AS approval_status",
    )
    return gold.fact_policy_transaction(li, at(b.ORDERS_AS_OF))


CLAIM_COLUMNS = [
    ("claim_id", "l_orderkey * 8 + l_linenumber"), ("claim_number", "'CLM' || l_orderkey"), ("policy_id", "l_orderkey"), ("claimant_id", "l_suppkey"),
    ("loss_date", "l_shipdate"), ("report_date", "l_shipdate"), ("claim_status", "l_linestatus"), ("claim_type", "l_returnflag"),
    ("loss_type", "l_returnflag"), ("cause_of_loss", "l_linestatus"), ("loss_description", "'line ' || l_linenumber"),
    ("loss_location_state", "l_suppkey % 25"), ("loss_location_zip", "l_partkey"), ("assigned_adjuster_id", "l_suppkey"),
    ("litigation_flag", "l_tax > 0.05"), ("fraud_score", "l_discount"), ("fraud_flag", "l_discount > 0.08"), ("total_incurred", "l_extendedprice"),
    ("total_paid", "l_quantity"), ("total_reserved", "l_extendedprice - l_quantity"), ("salvage_amount", "l_tax"), ("subrogation_amount", "l_tax"),
    ("deductible_applied", "l_discount"),
]


@query("gold_dim_claim", "SELECT " + ", ".join(f"{e} AS {n}" for n, e in CLAIM_COLUMNS) + """,
  TIMESTAMP '2001-08-02 00:00:00' AS _gold_load_ts FROM lineitem WHERE l_linenumber <> 7""")
def gold_dim_claim(spark, sf):
    silver = table(spark, sf, "lineitem").selectExpr(*[f"{e} AS {n}" for n, e in CLAIM_COLUMNS], "l_linenumber <> 7 AS _is_current")
    return gold.dim_claim(silver, at(b.ORDERS_AS_OF))


CUSTOMER_COLUMNS = [
    ("customer_id", "c_custkey"), ("customer_type", "'individual'"), ("first_name", "substring(c_name, 1, 8)"), ("last_name", "substring(c_name, 10, 9)"),
    ("full_name", "c_name"), ("date_of_birth", "DATE '1970-01-01'"), ("gender", "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END"),
    ("ssn", "'123-45-' || substring(c_name, 15, 4)"), ("email", "lower(substring(c_name, 1, 8)) || c_custkey || '@mail.example'"),
    ("phone", "'555-010-' || substring(c_name, 15, 4)"), ("preferred_language", "'en'"), ("preferred_channel", "c_mktsegment"),
    ("customer_since_date", "DATE '1995-01-01'"), ("customer_segment", "c_mktsegment"), ("lifetime_premium_value", "c_acctbal"),
    ("total_claims_count", "c_custkey % 9"), ("active_policy_count", "c_custkey % 4"), ("risk_score", "c_acctbal / 100"), ("nps_score", "c_custkey % 11"),
    ("churn_risk_score", "c_acctbal / 1000"), ("last_interaction_date", "DATE '2001-08-01'"),
]


def silver_customer(spark, sf):
    return table(spark, sf, "customer").selectExpr(*[f"{e} AS {n}" for n, e in CUSTOMER_COLUMNS], "c_custkey % 6 <> 0 AS _is_current")


@query("gold_dim_customer_master", "SELECT " + ", ".join(f"{e} AS {n}" for n, e in CUSTOMER_COLUMNS) + """,
  TIMESTAMP '2001-08-02 00:00:00' AS _gold_load_ts FROM customer WHERE c_custkey % 6 <> 0""")
def gold_dim_customer_master(spark, sf):
    return gold.dim_customer_master(silver_customer(spark, sf), at(b.ORDERS_AS_OF))


JOURNAL_COLUMNS = [
    ("entry_id", "l_orderkey * 8 + l_linenumber"), ("journal_id", "l_orderkey"), ("posting_date", "l_shipdate"),
    ("fiscal_year", "CAST(year(l_shipdate) AS INT)"), ("fiscal_period", "CAST(month(l_shipdate) AS INT)"), ("account_code", "l_returnflag || l_linestatus"),
    ("account_name", "'account ' || l_returnflag"), ("account_category", "l_linestatus"), ("department_code", "l_suppkey % 10"), ("cost_center", "l_partkey % 10"),
    ("debit_amount", "l_extendedprice"), ("credit_amount", "l_quantity"), ("net_amount", "l_extendedprice - l_quantity"), ("currency_code", "'USD'"),
    ("description", "'entry'"), ("source_module", "'premium'"), ("reference_id", "l_partkey"), ("reversal_flag", "l_returnflag = 'R'"), ("approved_by", "l_suppkey"),
]


@query("gold_fact_journal_entry", "SELECT " + ", ".join(f"{e} AS {n}" for n, e in JOURNAL_COLUMNS) + ", TIMESTAMP '2001-08-02 00:00:00' AS _gold_load_ts FROM lineitem")
def gold_fact_journal_entry(spark, sf):
    silver = table(spark, sf, "lineitem").selectExpr(*[f"{e} AS {n}" for n, e in JOURNAL_COLUMNS])
    return gold.fact_journal_entry(silver, at(b.ORDERS_AS_OF))


INVOICE_COLUMNS = [
    ("invoice_id", "o_orderkey"), ("policy_id", "o_orderkey"), ("customer_id", "o_custkey"), ("billing_period_start", "o_orderdate"),
    ("billing_period_end", "o_orderdate"), ("due_date", "CAST(o_orderdate AS DATE)"), ("invoice_amount", "o_totalprice"), ("paid_amount", "o_totalprice / 2"),
    ("outstanding_amount", "o_totalprice / 2"), ("payment_status", "o_orderstatus"), ("billing_frequency", "'monthly'"), ("payment_method", "o_orderpriority"),
    ("last_payment_date", "CAST(o_orderdate AS DATE)"), ("days_overdue", "o_orderkey % 40"), ("dunning_level", "o_orderkey % 4"),
]


@query("gold_fact_premium_invoice", "SELECT " + ", ".join(f"{e} AS {n}" for n, e in INVOICE_COLUMNS) + ", TIMESTAMP '2001-08-02 00:00:00' AS _gold_load_ts FROM orders")
def gold_fact_premium_invoice(spark, sf):
    silver = table(spark, sf, "orders").selectExpr(*[f"{e} AS {n}" for n, e in INVOICE_COLUMNS])
    return gold.fact_premium_invoice(silver, at(b.ORDERS_AS_OF))


@query("gold_keyed_dimension", """
SELECT md5('POL' || o_orderkey) AS dim_policy_key, 'POL' || o_orderkey AS policy_number, o_orderstatus AS policy_status,
       o_totalprice AS premium_amount FROM orders WHERE o_orderkey % 4 <> 0""")
def gold_keyed_dimension(spark, sf):
    return gold.keyed_dimension(silver_policy(spark, sf), ["policy_number"], ["policy_number", "policy_status", "premium_amount"], "dim_policy_key")


@query("gold_version_fact", SCD2_SQL.replace("SELECT old.id, old.name", "SELECT sha256(CAST(id AS VARCHAR)) AS fact_key, id, valid_from AS transaction_date, segment AS transaction_type, 1 AS transaction_count, TIMESTAMP '2001-08-02 00:00:00' AS fact_created_at FROM (SELECT old.id, old.name", 1) + ")")
def gold_version_fact(spark, sf):
    return gold.version_fact(versioned(spark, sf), "id", "segment", [], at(b.ORDERS_AS_OF))


# ---- KPIs ----------------------------------------------------------------------------

LOSS_SQL = with_sql(POLICY, CLAIM, """per AS (
  SELECT policy_id, sum(claim_amount) AS claim_amount, count(*) AS claim_count FROM claim GROUP BY policy_id)""", """sums AS (
  SELECT policy_type, sum(claim_amount) AS tc, sum(premium) AS tp, sum(coalesce(claim_count, 0)) AS cc, count(*) AS pc
  FROM policy LEFT JOIN per USING (policy_id) GROUP BY policy_type)""", """ratios AS (
  SELECT policy_type, CAST(tc AS DOUBLE) AS total_claims, CAST(tp AS DOUBLE) AS total_premiums, CAST(cc AS BIGINT) AS claim_count, pc AS policy_count,
         CAST(tc AS DOUBLE) / CAST(tp AS DOUBLE) * 100 AS loss_ratio FROM sums)""") + """
SELECT *, CASE WHEN loss_ratio < 70 THEN 'green' WHEN loss_ratio < 80 THEN 'yellow' WHEN loss_ratio < 100 THEN 'orange' ELSE 'red' END AS status FROM ratios"""


@query("loss_ratio_by_type", LOSS_SQL)
def loss_ratio_by_type(spark, sf):
    return plain(kpi.loss_ratio(b.policies(spark, sf), b.claims(spark, sf), by=["policy_type"]))


@query("loss_ratio_as_joined", with_sql(POLICY, CLAIM, """sums AS (
  SELECT sum(claim_amount) AS tc, sum(premium) AS tp, count(DISTINCT claim_id) AS cc, count(DISTINCT policy_id) AS pc
  FROM policy JOIN claim USING (policy_id) WHERE policy_type = '1-URGENT' AND claim_date >= TIMESTAMP '1998-01-01')""") + """
SELECT CAST(tc AS DOUBLE) AS total_claims, CAST(tp AS DOUBLE) AS total_premiums, cc AS claim_count, pc AS policy_count,
  CAST(tc AS DOUBLE) / CAST(tp AS DOUBLE) * 100 AS loss_ratio,
  CASE WHEN CAST(tc AS DOUBLE) / CAST(tp AS DOUBLE) * 100 < 70 THEN 'green' WHEN CAST(tc AS DOUBLE) / CAST(tp AS DOUBLE) * 100 < 80 THEN 'yellow'
       WHEN CAST(tc AS DOUBLE) / CAST(tp AS DOUBLE) * 100 < 100 THEN 'orange' ELSE 'red' END AS status FROM sums""")
def loss_ratio_as_joined(spark, sf):
    cond = rules.predicate({"policy_type": "1-URGENT"}, {"claim_date": at("1998-01-01")})
    return plain(kpi.loss_ratio(b.policies(spark, sf), b.claims(spark, sf), where=cond, as_joined=True))


@query("high_risk_policies", with_sql(POLICY, CLAIM, HOLDER, """per AS (
  SELECT policy_id, sum(claim_amount) AS ca, count(*) AS cc, max(claim_date) AS last_claim_date FROM claim GROUP BY policy_id)""") + """
SELECT policy_id, policy_type, customer_id, customer_name, CAST(premium AS DOUBLE) AS premium, CAST(ca AS DOUBLE) AS total_claims, cc AS claim_count,
       CAST(ca AS DOUBLE) / CAST(premium AS DOUBLE) * 100 AS loss_ratio, last_claim_date,
       CASE WHEN CAST(ca AS DOUBLE) / CAST(premium AS DOUBLE) * 100 > 200 THEN 'cancel'
            WHEN CAST(ca AS DOUBLE) / CAST(premium AS DOUBLE) * 100 > 175 THEN 'non_renew' ELSE 'increase_premium' END AS action
FROM policy JOIN per USING (policy_id) JOIN holder USING (customer_id)
WHERE policy_status = 'O' AND CAST(ca AS DOUBLE) / CAST(premium AS DOUBLE) * 100 >= 150 AND cc >= 2
ORDER BY loss_ratio DESC, policy_id LIMIT 20""")
def high_risk_policies(spark, sf):
    active = b.policies(spark, sf).filter("policy_status = 'O'")
    return plain(kpi.high_risk_policies(active, b.holders(spark, sf), b.claims(spark, sf)))


@query("recent_claims", with_sql(CLAIM) + """
SELECT count(*) AS total_claims, CAST(sum(claim_amount) AS DOUBLE) AS total_amount FROM claim WHERE claim_date >= TIMESTAMP '2001-08-02' - INTERVAL 30 DAYS""")
def recent_claims(spark, sf):
    return plain(kpi.recent_claims(b.claims(spark, sf), at(b.ORDERS_AS_OF)))


@query("premium_statistics", with_sql(POLICY) + """
SELECT CAST(sum(premium) AS DOUBLE) / count(premium) AS avg_premium, CAST(min(premium) AS DOUBLE) AS min_premium, CAST(max(premium) AS DOUBLE) AS max_premium
FROM policy WHERE policy_status = 'O'""")
def premium_statistics(spark, sf):
    return plain(kpi.premium_statistics(b.policies(spark, sf).filter("policy_status = 'O'")))


@query("top_customers", with_sql(POLICY, HOLDER) + """
SELECT customer_name, count(DISTINCT policy_id) AS policy_count, CAST(sum(premium) AS DOUBLE) AS total_premium
FROM policy JOIN holder USING (customer_id) WHERE policy_status = 'O' GROUP BY customer_name ORDER BY total_premium DESC, customer_name LIMIT 5""")
def top_customers(spark, sf):
    return plain(kpi.top_customers(b.policies(spark, sf).filter("policy_status = 'O'"), b.holders(spark, sf)))


@query("customer_360", with_sql(POLICY, CLAIM, HOLDER, """p AS (
  SELECT customer_id, count(*) AS total_policies, CAST(sum(premium) AS DOUBLE) AS total_premium FROM policy GROUP BY customer_id)""", """c AS (
  SELECT agent_id AS customer_id, count(*) AS total_claims, CAST(sum(claim_amount) AS DOUBLE) AS total_claim_amount FROM claim GROUP BY agent_id)""") + """
SELECT customer_id, customer_name, coalesce(total_policies, 0) AS total_policies, total_premium, coalesce(total_claims, 0) AS total_claims, total_claim_amount
FROM holder LEFT JOIN p USING (customer_id) LEFT JOIN c USING (customer_id)""")
def customer_360(spark, sf):
    claims = b.claims(spark, sf).withColumn("customer_id", F.col("agent_id"))
    return plain(kpi.customer_360(b.holders(spark, sf), b.policies(spark, sf), claims))


KPIS = [
    {"kpi_name": "Loss Ratio", "calculation_formula": "CAST(SUM(claim_amount) AS DOUBLE) / CAST(SUM(premium) AS DOUBLE) * 100", "target_value": 70.0, "threshold_red": 85.0, "threshold_green": 70.0},
    {"kpi_name": "Combined Ratio", "calculation_formula": "(CAST(SUM(claim_amount) AS DOUBLE) + CAST(SUM(expenses) AS DOUBLE)) / CAST(SUM(premium) AS DOUBLE) * 100", "target_value": 95.0, "threshold_red": 105.0, "threshold_green": 95.0},
    {"kpi_name": "Customer Retention Rate", "calculation_formula": "CAST(COUNT(DISTINCT renewed) * 100 AS DOUBLE) / COUNT(DISTINCT customer_id)", "target_value": 85.0, "threshold_red": 75.0, "threshold_green": 85.0},
]


@query("kpi_status", with_sql(POLICY, CLAIM, """per AS (SELECT policy_id, CAST(sum(claim_amount) AS DOUBLE) AS claim_amount FROM claim GROUP BY policy_id)""", """j AS (
  SELECT sum(CAST(coalesce(claim_amount, 0) AS DECIMAL(18,4))) AS ca, sum(CAST(premium AS DECIMAL(18,4))) AS pr, sum(CAST(premium * 0.25 AS DECIMAL(18,4))) AS ex,
         count(DISTINCT CASE WHEN policy_status = 'O' THEN customer_id END) AS ren, count(DISTINCT customer_id) AS cu FROM policy LEFT JOIN per USING (policy_id))""", """v AS (
  SELECT 'Loss Ratio' AS kpi_name, CAST(ca AS DOUBLE) / CAST(pr AS DOUBLE) * 100 AS kpi_value, 70.0::DOUBLE AS target_value, 85.0 AS red, 70.0 AS green FROM j
  UNION ALL SELECT 'Combined Ratio', (CAST(ca AS DOUBLE) + CAST(ex AS DOUBLE)) / CAST(pr AS DOUBLE) * 100, 95.0, 105.0, 95.0 FROM j
  UNION ALL SELECT 'Customer Retention Rate', CAST(ren * 100 AS DOUBLE) / cu, 85.0, 75.0, 85.0 FROM j)""") + """
SELECT kpi_name, kpi_value, target_value, CASE WHEN red > green THEN CASE WHEN kpi_value <= green THEN 'green' WHEN kpi_value < red THEN 'yellow' ELSE 'red' END
  ELSE CASE WHEN kpi_value >= green THEN 'green' WHEN kpi_value > red THEN 'yellow' ELSE 'red' END END AS status FROM v""")
def kpi_status(spark, sf):
    per = b.claims(spark, sf).groupBy("policy_id").agg(F.sum("claim_amount").alias("claim_amount"))
    joined = b.policies(spark, sf).join(per, "policy_id", "left").select(
        "customer_id", F.coalesce(F.col("claim_amount"), F.lit(0)).cast("decimal(18,4)").alias("claim_amount"), "premium",
        (F.col("premium") * F.lit("0.25").cast("decimal(4,2)")).cast("decimal(18,4)").alias("expenses"),
        F.when(F.col("policy_status") == "O", F.col("customer_id")).alias("renewed"),
    )
    return kpi.kpi_status(joined, KPIS)


@query("semantic_measures", with_sql(POLICY, CLAIM) + """
SELECT p.*, c.*, total_claims / total_premium AS loss_ratio FROM
 (SELECT CAST(sum(premium) AS DOUBLE) AS total_premium, count(policy_id) AS policy_count, count(DISTINCT customer_id) AS customer_count FROM policy) p,
 (SELECT CAST(sum(claim_amount) AS DOUBLE) AS total_claims, count(claim_id) AS claim_count FROM claim) c""")
def semantic_measures(spark, sf):
    return plain(kpi.semantic_measures(b.policies(spark, sf), b.claims(spark, sf)))


# ---- joins, sets, windows ------------------------------------------------------------


@query("ontology_join_path", """
SELECT c_custkey AS customer_id, count(*) AS claims FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey GROUP BY c_custkey""")
def ontology_join_path(spark, sf):
    entities = {"Customer": b.holders(spark, sf), "Policy": b.policies(spark, sf), "Claim": b.claims(spark, sf)}
    relations = [
        {"source_entity": "Customer", "target_entity": "Policy", "join_condition": "customer.customer_id = policy.customer_id"},
        {"source_entity": "Policy", "target_entity": "Claim", "join_condition": "policy.policy_id = claim.policy_id"},
    ]
    joined = kpi.join_path(entities, relations, ["Customer", "Policy", "Claim"])
    return joined.groupBy(F.col("customer.customer_id").alias("customer_id")).agg(F.count("*").alias("claims"))


@query("inner_join_aggregate", """
SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def inner_join_aggregate(spark, sf):
    return (
        table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name").agg(F.count("*").alias("customers"))
    )


@query("anti_join_customers", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O')")
def anti_join_customers(spark, sf):
    opened = table(spark, sf, "orders").filter("o_orderstatus = 'O'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").select("c_custkey").join(opened, "c_custkey", "left_anti")


@query("tagged_union_distinct", """
SELECT source_system, count(*) AS n, count(DISTINCT nation) AS nations FROM (
  SELECT 'CRM' AS source_system, c_nationkey AS nation FROM customer UNION ALL SELECT 'POLICY_SYSTEM', s_nationkey FROM supplier) GROUP BY source_system""")
def tagged_union_distinct(spark, sf):
    from lodestrata.sources.readers import tagged_union

    both = tagged_union({
        "CRM": table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation")),
        "POLICY_SYSTEM": table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation")),
    })
    return both.groupBy("source_system").agg(F.count("*").alias("n"), F.countDistinct("nation").alias("nations"))


@query("rolling_average", """
WITH i AS (SELECT user_id, ts, sum(value) AS s, count(*) AS n, max(value) AS v FROM events GROUP BY user_id, ts)
SELECT user_id, ts, v AS value, round(sum(s) OVER w / CAST(sum(n) OVER w AS BIGINT), 6) AS rolling_avg FROM i
WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 360 MINUTES PRECEDING AND CURRENT ROW)""")
def rolling_average(spark, sf):
    rolled = windows.rolling_mean(table(spark, sf, "events"), ["user_id"], "ts", "value", 360)
    return rolled.withColumn("rolling_avg", F.round("rolling_avg", 6))


@query("smoothed_usage", """
WITH i AS (SELECT user_id, ts, sum(value) AS s, count(*) AS n, max(value) AS v FROM events GROUP BY user_id, ts)
SELECT user_id, ts, v AS value, round(sum(s) OVER w / CAST(sum(n) OVER w AS BIGINT) * 0.7::DOUBLE + v * 0.3::DOUBLE, 6) AS smoothed FROM i
WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 60 MINUTES PRECEDING AND CURRENT ROW)""")
def smoothed_usage(spark, sf):
    return windows.smoothed(table(spark, sf, "events"), ["user_id"], "ts", "value").withColumn("smoothed", F.round("smoothed", 6))


@query("dense_surrogate_key", "SELECT c_custkey, row_number() OVER (ORDER BY c_name, c_custkey) AS customer_sk FROM customer")
def dense_surrogate_key(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_name")
    return windows.dense_key(df, ["c_name", "c_custkey"], "customer_sk").select("c_custkey", "customer_sk")


@query("top_values_per_group", """
SELECT l_returnflag, l_suppkey, n FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY n DESC, l_suppkey) AS r FROM
  (SELECT l_returnflag, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL)) WHERE r <= 5""")
def top_values_per_group(spark, sf):
    counted = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_suppkey").agg(F.count("*").alias("n"))
    return agg.top_per_group(counted, ["l_returnflag"], [F.col("n").desc(), F.col("l_suppkey")], 5).drop("_rank")


@query("exact_p95_by_type", """
SELECT event_type, round(quantile_cont(value, 0.95), 6) AS p95_duration FROM events GROUP BY event_type""")
def exact_p95_by_type(spark, sf):
    out = agg.exact_percentile(table(spark, sf, "events"), ["event_type"], "value", 0.95, "p95_duration")
    return out.withColumn("p95_duration", F.round("p95_duration", 6))


@query("latest_series_pivot", """
SELECT max_by(CASE WHEN event_type = 'view' THEN value END, CASE WHEN event_type = 'view' THEN ts END) AS view_value,
       max_by(CASE WHEN event_type = 'click' THEN value END, CASE WHEN event_type = 'click' THEN ts END) AS click_value FROM events""")
def latest_series_pivot(spark, sf):
    return agg.latest_values(table(spark, sf, "events"), "event_type", "value", "ts", {"view": "view_value", "click": "click_value"})


@query("bernoulli_sample", """
SELECT l_orderkey, l_linenumber FROM lineitem WHERE ('0x' || substr(md5(l_orderkey || '||' || l_linenumber), 1, 8))::BIGINT < 0.1 * 4294967296""")
def bernoulli_sample(spark, sf):
    return profile.sample_rows(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"], 0.1)


@query("preview_rows", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT 1000")
def preview_rows(spark, sf):
    """The first thousand rows in the order of the key."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return profile.first_rows(lines, ["l_orderkey", "l_linenumber"], 1000)


@query("row_hash_columns", """
SELECT c_custkey, sha256(CAST(c_custkey AS VARCHAR) || '|' || c_name || '|' || c_mktsegment) AS h FROM customer""")
def row_hash_columns(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", row_hash(["c_custkey", "c_name", "c_mktsegment"], "|").alias("h"))
