"""Glossary, documentation policies and data products over the part table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrata.operators import governance as g
from lodestrata.operators.aggregates import union_all
from lodestrata.plans import bindings as b
from lodestrata.plans.bindings import with_sql
from lodestrata.plans.registry import at, query, table

#: Inventory with one column per part: type = database, brand = table.
COLUMNS_EXPR = {
    "database_name": "p_type",
    "table_name": "p_brand",
    "column_name": "CASE WHEN p_partkey % 10 = 0 THEN replace(p_name, ' ', '_') ELSE replace(p_name, ' ', '_') || '_' || p_partkey END",
    "column_comment": "CASE WHEN p_size % 3 = 0 THEN NULL WHEN p_size % 3 = 1 THEN ' ' ELSE 'about ' || p_name END",
    "table_comment": "CASE WHEN p_brand LIKE '%5' THEN NULL ELSE 'table ' || p_brand END",
    "p_partkey": "p_partkey",
}
COLUMNS_SQL = "cols AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in COLUMNS_EXPR.items()) + " FROM part)"
TERMS_SQL = """terms AS (SELECT md5(term_name) AS term_id, term_name, 'meaning of ' || term_name AS definition, CASE WHEN length(term_name) % 3 = 0 THEN 'draft' ELSE 'published' END AS status,
   split_part(term_name, '_', 1) AS tag FROM (SELECT DISTINCT replace(p_name, ' ', '_') AS term_name FROM part))"""
LINKS_SQL = """links AS (SELECT md5(replace(split_part(column_comment, 'about ', 2), ' ', '_')) AS term_id, database_name, table_name, column_name, database_name || '.' || table_name || '.' || column_name AS full_path, p_partkey,
   CASE WHEN p_partkey % 4 = 0 THEN 'manual' WHEN p_partkey % 4 = 1 THEN 'auto_approved' ELSE 'auto_suggested' END AS linkage_type, p_partkey % 4 = 0 AS verified, CASE WHEN p_partkey % 4 < 2 THEN 1.0 ELSE 0.7 END::DOUBLE AS confidence_score
   FROM cols WHERE column_comment LIKE 'about %')"""
GOOD_LINKS_SQL = "good AS (SELECT * FROM links WHERE verified OR linkage_type IN ('manual', 'auto_approved'))"
VIOLATIONS_SQL = """vio AS (
  SELECT 'DDL Comments Required' AS policy_name, 'high' AS severity, 'table' AS object_type, database_name, table_name, CAST(NULL AS VARCHAR) AS column_name, database_name || '.' || table_name AS full_path
    FROM cols GROUP BY database_name, table_name HAVING max(table_comment) IS NULL
  UNION ALL SELECT 'DDL Comments Required', 'medium', 'column', database_name, table_name, column_name, database_name || '.' || table_name || '.' || column_name FROM cols WHERE coalesce(trim(column_comment), '') = ''
  UNION ALL SELECT 'Business Definitions Required', 'medium', 'column', database_name, table_name, column_name, database_name || '.' || table_name || '.' || column_name FROM cols
    WHERE database_name || '.' || table_name || '.' || column_name NOT IN (SELECT full_path FROM good))"""
SCORE_SQL = """score AS (SELECT database_name, table_name, total_columns, columns_with_comments, coalesce(l, 0) AS columns_with_glossary_terms, 0 AS violations_critical, coalesce(vh, 0) AS violations_high, coalesce(vm, 0) AS violations_medium, 0 AS violations_low,
   round(columns_with_comments / total_columns * 40 + coalesce(l, 0) / total_columns * 60, 2) AS compliance_score
  FROM (SELECT database_name, table_name, count(*) AS total_columns, count(*) FILTER (WHERE coalesce(trim(column_comment), '') <> '') AS columns_with_comments FROM cols GROUP BY ALL)
  LEFT JOIN (SELECT database_name, table_name, count(DISTINCT full_path) AS l FROM good GROUP BY ALL) USING (database_name, table_name)
  LEFT JOIN (SELECT database_name, table_name, count(*) FILTER (WHERE severity = 'high') AS vh, count(*) FILTER (WHERE severity = 'medium') AS vm FROM vio GROUP BY ALL) USING (database_name, table_name))"""
ALL = with_sql(COLUMNS_SQL, TERMS_SQL, LINKS_SQL, GOOD_LINKS_SQL, VIOLATIONS_SQL, SCORE_SQL)


def columns(spark, sf):
    return table(spark, sf, "part").selectExpr(*[f"{e} AS {n}" for n, e in COLUMNS_EXPR.items()])


def terms(spark, sf):
    names = table(spark, sf, "part").select(F.replace("p_name", F.lit(" "), F.lit("_")).alias("term_name")).distinct()
    return names.select(
        F.md5("term_name").alias("term_id"), "term_name", F.concat(F.lit("meaning of "), "term_name").alias("definition"), F.lit(None).cast("string").alias("business_definition"),
        F.when(F.length("term_name") % 3 == 0, "draft").otherwise("published").alias("status"), F.array(F.split_part("term_name", F.lit("_"), F.lit(1))).alias("tags"),
    )


def links(spark, sf):
    m = F.col("p_partkey") % 4
    about = columns(spark, sf).filter("column_comment LIKE 'about %'")
    return about.select(
        F.md5(F.replace(F.substring("column_comment", 7, 1000), F.lit(" "), F.lit("_"))).alias("term_id"), "database_name", "table_name", "column_name",
        g.full_path("database_name", "table_name", "column_name").alias("full_path"), F.when(m == 0, "manual").when(m == 1, "auto_approved").otherwise("auto_suggested").alias("linkage_type"),
        (m == 0).alias("verified"), F.when(m < 2, 1.0).otherwise(0.7).alias("confidence_score"), "p_partkey",
    )


def violations(spark, sf):
    return g.run_policies(columns(spark, sf), links(spark, sf))


def scorecard(spark, sf):
    return g.compliance_scorecard(columns(spark, sf), links(spark, sf), violations(spark, sf))


@query("comment_policy_scan", ALL + "SELECT severity, object_type, database_name, table_name, column_name, full_path FROM vio WHERE policy_name = 'DDL Comments Required'")
def comment_policy_scan(spark, sf):
    return g.comment_violations(columns(spark, sf)).select("severity", "object_type", "database_name", "table_name", "column_name", "full_path")


@query("definition_policy_scan", ALL + "SELECT severity, full_path FROM vio WHERE policy_name = 'Business Definitions Required'")
def definition_policy_scan(spark, sf):
    return g.definition_violations(columns(spark, sf), links(spark, sf)).select("severity", "full_path")


@query("all_policy_violations", ALL + """
SELECT DISTINCT policy_name, 'VIO_' || md5(policy_name || '|' || full_path) AS violation_id, severity, full_path FROM vio""")
def all_policy_violations(spark, sf):
    return violations(spark, sf).select("policy_name", "violation_id", "severity", "full_path")


DEDUP = ALL.replace("vio AS (\n  SELECT", "vio AS (SELECT DISTINCT * FROM (\n  SELECT").replace("NOT IN (SELECT full_path FROM good))", "NOT IN (SELECT full_path FROM good)))")


@query("compliance_scorecard", DEDUP + "SELECT * FROM score")
def compliance_scorecard(spark, sf):
    out = scorecard(spark, sf)
    return out.withColumns({"violations_critical": F.col("violations_critical").cast("int"), "violations_low": F.col("violations_low").cast("int")})


@query("term_rows", """
WITH t AS (SELECT 'TERM_' || md5(lower(n_name)) AS term_id, n_name AS term_name, n_nationkey FROM nation)
SELECT term_id, term_name, CASE WHEN n_nationkey = 0 THEN 'published' ELSE 'draft' END AS status, CASE WHEN n_nationkey = 0 THEN 2 ELSE 1 END AS version, 'LINK_' || md5(term_id || '|gold.dim.' || term_name) AS linkage_id,
  'gold.dim.' || term_name AS full_path, n_nationkey % 2 = 0 AS verified, 'POLICY_' || md5('covers ' || term_name) AS policy_id, true AS enabled FROM t""")
def term_rows(spark, sf):
    """A term, a link and a policy for each nation; the first term is approved."""
    rows = table(spark, sf, "nation").select("n_nationkey", "n_name").orderBy("n_nationkey").collect()
    terms_ = g.create_terms(spark, [{"term_name": r.n_name, "definition": "a nation", "tags": ["nation"]} for r in rows], at("2024-01-01"))
    ids = {r.term_name: r.term_id for r in terms_.collect()}
    terms_ = g.approve_term(terms_, ids[rows[0].n_name], at("2024-01-02"))
    links = [g.link_term(terms_, ids[r.n_name], "gold", "dim", r.n_name, "manual" if r.n_nationkey % 2 == 0 else "auto_suggested") for r in rows]
    policies = [g.create_policy(spark, f"covers {r.n_name}", "coverage", "each nation is covered").withColumn("term_name", F.lit(r.n_name)) for r in rows]
    linked = union_all(links).select("linkage_id", "term_id", "full_path", "verified")
    owned = union_all(policies).select("policy_id", "enabled", "term_name")
    return terms_.join(linked, "term_id").join(owned, "term_name").select("term_id", "term_name", "status", "version", "linkage_id", "full_path", "verified", "policy_id", "enabled")


@query("glossary_auto_links", ALL + """
SELECT term_id, database_name || '.' || table_name || '.' || column_name AS full_path, CASE WHEN lower(column_name) = lower(term_name) THEN 1.0 ELSE 0.7 END::DOUBLE AS confidence_score,
  CASE WHEN lower(column_name) = lower(term_name) THEN 'auto_approved' ELSE 'auto_suggested' END AS linkage_type, lower(column_name) = lower(term_name) AS verified
FROM terms JOIN cols ON contains(lower(column_name), lower(term_name)) OR contains(lower(term_name), lower(column_name)) WHERE status = 'published'""")
def glossary_auto_links(spark, sf):
    return g.auto_links(terms(spark, sf), columns(spark, sf)).select("term_id", "full_path", "confidence_score", "linkage_type", "verified")


@query("glossary_search", ALL + "SELECT term_name FROM terms WHERE status = 'published' AND (lower(term_name) LIKE '%ring%' OR lower(definition) LIKE '%ring%' OR tag = 'ring')")
def glossary_search(spark, sf):
    return g.search_terms(terms(spark, sf), "ring").select("term_name")


@query("term_lineage", ALL + "SELECT term_name, full_path, confidence_score, linkage_type, verified FROM links JOIN terms USING (term_id)")
def term_lineage(spark, sf):
    return g.term_lineage(links(spark, sf), terms(spark, sf)).select("term_name", "full_path", "confidence_score", "linkage_type", "verified")


@query("links_pending_review", ALL + "SELECT term_name, full_path, confidence_score FROM links JOIN terms USING (term_id) WHERE linkage_type = 'auto_suggested' AND NOT verified")
def links_pending_review(spark, sf):
    return g.pending_review(links(spark, sf), terms(spark, sf)).select("term_name", "full_path", "confidence_score")


@query("term_approval", ALL + "SELECT term_name, CASE WHEN term_name = (SELECT min(term_name) FROM terms) THEN 'published' ELSE status END AS status FROM terms")
def term_approval(spark, sf):
    from hashlib import md5

    every = terms(spark, sf).withColumns({"version": F.lit(1), "created_at": at(b.EVENTS_AS_OF)})
    first = every.agg(F.min("term_name")).first()[0]
    return g.approve_term(every, md5(first.encode()).hexdigest(), at(b.EVENTS_AS_OF)).select("term_name", "status")


@query("columns_by_name_token", ALL + "SELECT column_name FROM cols WHERE list_contains(string_split_regex(lower(column_name), '[_ ]'), 'small')")
def columns_by_name_token(spark, sf):
    return g.similar_columns(columns(spark, sf), "small").select("column_name")


@query("name_token_overlap", """
WITH x AS (SELECT p_partkey, p_name, p_brand || ' ' || p_name AS q FROM part)
SELECT p_partkey, len(list_intersect(list_distinct(string_split_regex(lower(p_name), '[_ ]')), string_split_regex(lower(q), '[_ ]')))::DOUBLE / len(list_distinct(list_concat(string_split_regex(lower(p_name), '[_ ]'), string_split_regex(lower(q), '[_ ]')))) AS overlap FROM x""")
def name_token_overlap(spark, sf):
    return table(spark, sf, "part").select("p_partkey", g.token_overlap(F.col("p_name"), F.concat_ws(" ", "p_brand", "p_name")).alias("overlap"))


@query("policy_exceptions", ALL + """
SELECT policy_name, full_path FROM (SELECT DISTINCT * FROM vio) WHERE full_path NOT IN (SELECT database_name || '.' || table_name || '.' || column_name FROM cols WHERE p_partkey % 6 = 0 AND DATE '2024-01-01' + CAST(p_partkey % 60 AS INTEGER) >= DATE '2024-01-30')""")
def policy_exceptions(spark, sf):
    exceptions = columns(spark, sf).filter("p_partkey % 6 = 0").withColumn("expiration_date", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("p_partkey") % 60).cast("int")))
    return g.without_exceptions(violations(spark, sf), exceptions, at(b.EVENTS_AS_OF)).select("policy_name", "full_path")


@query("custom_policy_query", """
SELECT 'Fact Table Primary Keys' AS policy_name, 'high' AS severity, p_type AS database_name, p_brand AS table_name, 'no key column' AS violation_details FROM part GROUP BY p_type, p_brand HAVING min(p_size) > 3""")
def custom_policy_query(spark, sf):
    table(spark, sf, "part").createOrReplaceTempView("lodestrata_part")
    sql = "SELECT p_type AS database_name, p_brand AS table_name, 'no key column' AS violation_details FROM lodestrata_part GROUP BY p_type, p_brand HAVING min(p_size) > 3"
    return g.custom_violations(spark, [{"policy_name": "Fact Table Primary Keys", "severity": "high", "validation_query": sql}])


@query("lineage_with_terms", ALL + """, tgt AS (SELECT DISTINCT database_name || '.' || table_name AS target_table, term_id FROM links)
SELECT source_table, target_table, term_name FROM (SELECT DISTINCT 'raw.' || p_brand AS source_table, p_type || '.' || p_brand AS target_table FROM part) JOIN tgt USING (target_table) JOIN terms USING (term_id) WHERE status = 'published'""")
def lineage_with_terms(spark, sf):
    lineage = table(spark, sf, "part").select(F.concat(F.lit("raw."), "p_brand").alias("source_table"), g.full_path("p_type", "p_brand").alias("target_table")).distinct()
    return g.lineage_with_terms(lineage, links(spark, sf), terms(spark, sf)).select("source_table", "target_table", "term_name")


@query("violations_by_severity", DEDUP + """
SELECT severity, count(*) AS violation_count, count(DISTINCT database_name) AS affected_databases, count(DISTINCT table_name) AS affected_tables, CASE severity WHEN 'critical' THEN 1 WHEN 'high' THEN 2 WHEN 'medium' THEN 3 ELSE 4 END AS severity_order FROM vio GROUP BY severity""")
def violations_by_severity(spark, sf):
    return g.violations_by_severity(violations(spark, sf))


@query("tables_with_most_violations", DEDUP + """
SELECT database_name, table_name, count(*) AS violation_count, 0::BIGINT AS critical_count, count(*) FILTER (WHERE severity = 'high') AS high_count, count(*) FILTER (WHERE severity = 'medium') AS medium_count FROM vio
GROUP BY ALL ORDER BY violation_count DESC, database_name, table_name LIMIT 10""")
def tables_with_most_violations(spark, sf):
    return g.worst_tables(violations(spark, sf))


@query("glossary_coverage", DEDUP + """
SELECT database_name, count(DISTINCT table_name) AS total_tables, count(DISTINCT CASE WHEN columns_with_glossary_terms > 0 THEN table_name END) AS tables_with_glossary,
  round(CAST(sum(CAST(compliance_score AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2) AS avg_compliance_score, CAST(sum(total_columns) AS BIGINT) AS total_columns, CAST(sum(columns_with_comments) AS BIGINT) AS columns_with_comments,
  CAST(sum(columns_with_glossary_terms) AS BIGINT) AS columns_with_glossary FROM score GROUP BY database_name""")
def glossary_coverage(spark, sf):
    return g.glossary_coverage(scorecard(spark, sf))


@query("compliance_summary", DEDUP + """
SELECT count(DISTINCT database_name) AS databases_scanned, count(*) AS total_tables, CAST(sum(total_columns) AS BIGINT) AS total_columns, CAST(sum(columns_with_comments) AS BIGINT) AS columns_documented,
  CAST(sum(columns_with_glossary_terms) AS BIGINT) AS columns_with_glossary, round(CAST(sum(CAST(compliance_score AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2) AS avg_compliance_score, 0::BIGINT AS critical_violations, CAST(sum(violations_high) AS BIGINT) AS high_violations FROM score""")
def compliance_summary(spark, sf):
    return g.compliance_summary(scorecard(spark, sf))


@query("compliance_by_day", DEDUP + """
SELECT DATE '2024-01-01' + CAST(total_columns % 5 AS INTEGER) AS scan_date, count(*) AS tables_scanned, round(CAST(sum(CAST(compliance_score AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2) AS avg_compliance_score, CAST(sum(violations_high) AS BIGINT) AS total_violations
FROM score GROUP BY 1 ORDER BY 1 DESC LIMIT 30""")
def compliance_by_day(spark, sf):
    dated = scorecard(spark, sf).withColumn("scanned_at", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("total_columns") % 5).cast("int")))
    return g.compliance_by_day(dated, "scanned_at")


@query("governance_alerts", DEDUP + """
SELECT count(*) FILTER (WHERE compliance_score < 60) AS low_compliance_tables, CAST(sum(CAST(compliance_score AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_compliance, 0::BIGINT AS critical_violations, (SELECT count(*) FROM vio) AS open_violations, 'healthy' AS status FROM score""")
def governance_alerts(spark, sf):
    return g.governance_alerts(scorecard(spark, sf), violations(spark, sf))


@query("governance_tile", DEDUP + """
SELECT (SELECT count(*) FROM terms) AS total_terms, (SELECT count(*) FILTER (WHERE status = 'published') FROM terms) AS published_terms, (SELECT count(*) FROM links) AS total_linkages, count(*) AS tables_scanned,
  round(CAST(sum(CAST(compliance_score AS DECIMAL(18,2))) AS DOUBLE) / count(*), 1) AS avg_compliance FROM score""")
def governance_tile(spark, sf):
    return g.governance_tile(terms(spark, sf), links(spark, sf), scorecard(spark, sf))


@query("data_product_build", """
SELECT c_mktsegment AS segment, c_nationkey AS nation, count(*) AS customers, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance FROM customer GROUP BY ALL""")
def data_product_build(spark, sf):
    source = table(spark, sf, "customer").selectExpr("c_mktsegment AS segment", "c_nationkey AS nation", "c_name AS email", "CAST(c_acctbal AS DECIMAL(18,2)) AS amount")
    product = {
        "product_id": "DP002", "pii_removed": True, "columns": ["segment", "nation", "email", "amount"], "group_by": ["segment", "nation"],
        "measures": {"customers": "count(*)", "balance": "CAST(sum(amount) AS DOUBLE)"},
    }
    return g.build_product(source, product)


@query("data_product_usage", """
WITH u AS (SELECT event_type AS product_id, user_id % 5 AS consumer, date_trunc('month', ts)::DATE AS usage_month, count(*) AS query_count, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS rows_accessed FROM events GROUP BY ALL)
SELECT product_id, consumer, usage_month, query_count, rows_accessed, query_count * CASE WHEN product_id IN ('view', 'click') THEN 0.5 ELSE 0 END::DOUBLE AS billing_amount FROM u""")
def data_product_usage(spark, sf):
    usage = table(spark, sf, "events").select(
        F.col("event_type").alias("product_id"), (F.col("user_id") % 5).alias("consumer"), F.col("ts").alias("usage_date"), F.lit(1).alias("query_count"),
        F.get_json_object("props", "$.k").cast("bigint").alias("rows_accessed"), F.lit(0).alias("data_volume_bytes"),
    )
    prices = spark.createDataFrame([("view", 0.5), ("click", 0.5)], "product_id string, price_per_query double")
    return g.product_usage(usage, prices).select("product_id", "consumer", "usage_month", "query_count", "rows_accessed", "billing_amount")
