"""Masking, sensitive-data scans, compliance and access analytics."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lodestrata.functions import masks
from lodestrata.operators import access, mergeable, security
from lodestrata.operators.aggregates import union_all, with_one_row
from lodestrata.plans import bindings as b
from lodestrata.plans.bindings import ACCESS, with_sql
from lodestrata.plans.core import silver_customer
from lodestrata.plans.registry import at, query, table
from lodestrata.session import shared_folder
from lodestrata.sources.writers import write_load

NOW = b.EVENTS_AS_OF
NOW_SQL = f"TIMESTAMP '{NOW}'"

#: A person per customer, with the personal columns the masks work on.
PERSON_SQL = """person AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE '123-45-' || substring(c_name, 15, 4) END AS ssn,
  lower(substring(c_name, 1, 8)) || c_custkey || '@mail.example' AS email, '(555) 010-' || substring(c_name, 15, 4) AS phone, c_name AS name,
  '4111-2222-3333-' || substring(c_name, 15, 4) AS card, substring(c_name, 15, 4) || ' Main St, Town' || (c_custkey % 9) || ', ST' AS address,
  DATE '1960-01-01' + CAST(c_custkey % 9000 AS INTEGER) AS born FROM customer)"""


def _person(spark, sf):
    tail = F.substring("c_name", 15, 4)
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        key.alias("id"), F.when(key % 10 != 0, F.concat(F.lit("123-45-"), tail)).alias("ssn"),
        F.concat(F.lower(F.substring("c_name", 1, 8)), key, F.lit("@mail.example")).alias("email"), F.concat(F.lit("(555) 010-"), tail).alias("phone"),
        F.col("c_name").alias("name"), F.concat(F.lit("4111-2222-3333-"), tail).alias("card"),
        F.concat(tail, F.lit(" Main St, Town"), key % 9, F.lit(", ST")).alias("address"),
        F.date_add(F.lit("1960-01-01").cast("date"), (key % 9000).cast("int")).alias("born"),
    )


def _entry(column, strategy, parameters="{}", roles="[]"):
    return {"table_name": "person", "column_name": column, "layer": "all", "masking_strategy": strategy, "masking_parameters": parameters, "unmasked_roles": roles}


REGISTRY = [
    _entry("ssn", "partial_mask", '{"visible_last":4,"mask_char":"X"}', '["compliance_admin"]'),
    _entry("email", "email_mask", roles='["marketing"]'),
    _entry("phone", "phone_mask", roles='["service"]'),
    _entry("name", "pseudonymize", '{"prefix":"FN"}', '["claims_admin"]'),
    _entry("card", "hash_sha256", '{"salt":"of this query"}'),
    _entry("address", "generalize", '{"keep_chars":4}'),
    _entry("born", "date_shift", '{"shift_days_range":30,"entity_column":"id"}'),
]
OFFSET_SQL = "CAST(('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8))::BIGINT % 60 - 30 AS INTEGER)"
MASK_SQL = {
    "ssn": "CASE WHEN ssn IS NOT NULL THEN repeat('X', greatest(length(ssn) - 4, 0)) || right(ssn, 4) END",
    "email": "substring(email, 1, 2) || '***@' || split_part(email, '@', 2)",
    "phone": "'***-***-' || right(phone, 4)",
    "name": "'FN_' || substr(md5(name), 1, 8)",
    "card": "sha256(card || '||of this query')",
    "address": "substring(address, 1, 4)",
    "born": f"born + {OFFSET_SQL}",
}


@query("static_masking", with_sql(PERSON_SQL) + "SELECT id, " + ", ".join(f"{e} AS {c}" for c, e in MASK_SQL.items()) + " FROM person")
def static_masking(spark, sf):
    return security.mask_table(_person(spark, sf), REGISTRY, "person", "silver")


@query("mask_strategies", with_sql(PERSON_SQL) + """
SELECT id, '***REDACTED***' AS redacted, CAST(NULL AS VARCHAR) AS nulled, 'TKN_' || substr(sha256(ssn || '||of this query'), 1, 16) AS token,
  translate(substr(sha256(ssn || 'of this query'), 1, length(ssn)), 'abcdef', '012345') AS preserved, regexp_replace(ssn, '[0-9]', '9', 'g') AS shape FROM person""")
def mask_strategies(spark, sf):
    ssn = F.col("ssn")
    kept = masks.format_keeping(ssn, {"key": "of this query"})
    return _person(spark, sf).select(
        "id", masks.full_redact(ssn, {}).alias("redacted"), masks.null_out(ssn, {}).alias("nulled"), masks.tokenize(ssn, {"salt": "of this query"}).alias("token"),
        masks.format_preserving(ssn, {"key": "of this query"}).alias("preserved"), F.regexp_replace(kept, "[0-9]", "9").alias("shape"),
    )


@query("display_masks", with_sql(PERSON_SQL) + """
SELECT id, regexp_replace(ssn, '([0-9]{3})-([0-9]{2})-([0-9]{4})', 'XXX-XX-\\3', 'g') AS ssn, substring(email, 1, 1) || '***@' || split_part(email, '@', 2) AS email,
  'XXX-XXX-' || right(regexp_replace(phone, '[^0-9]', '', 'g'), 4) AS phone, 'XXXX-XXXX-XXXX-' || right(card, 4) AS card, '*****, Town' || (id % 9) || ', ST' AS address FROM person""")
def display_masks(spark, sf):
    shown = {"ssn": masks.show_ssn, "email": masks.show_email, "phone": masks.show_phone, "card": masks.show_card, "address": masks.show_address}
    return _person(spark, sf).select("id", *[fn(F.col(c)).alias(c) for c, fn in shown.items()])


@query("sql_display_masks", with_sql(PERSON_SQL) + """
SELECT id, regexp_replace(ssn, '([0-9]{3})-([0-9]{2})-([0-9]{4})', 'XXX-XX-\\3', 'g') AS ssn, substring(email, 1, 1) || '***@' || split_part(email, '@', 2) AS email,
  'XXX-XXX-' || right(regexp_replace(phone, '[^0-9]', '', 'g'), 4) AS phone, 'XXXX-XXXX-XXXX-' || right(card, 4) AS card, '*****, Town' || (id % 9) || ', ST' AS address FROM person""")
def sql_display_masks(spark, sf):
    """The same masks called as SQL functions."""
    masks.register_sql_masks(spark)
    _person(spark, sf).createOrReplaceTempView("lodestrata_person")
    return spark.sql(
        "SELECT id, mask_ssn(ssn) AS ssn, mask_email(email) AS email, mask_phone(phone) AS phone, mask_credit_card(card) AS card, "
        "mask_address(address) AS address FROM lodestrata_person"
    )


@query("role_aware_masking", with_sql(PERSON_SQL) + f"""
SELECT id, {MASK_SQL['ssn']} AS ssn, email, {MASK_SQL['phone']} AS phone, name, {MASK_SQL['card']} AS card, {MASK_SQL['address']} AS address, CAST({MASK_SQL['born']} AS VARCHAR) AS born FROM person""")
def role_aware_masking(spark, sf):
    return security.mask_for_role(_person(spark, sf), REGISTRY, "person", ["marketing", "claims_admin"])


@query("masked_view", with_sql(PERSON_SQL) + f"SELECT id, {MASK_SQL['email']} AS email FROM person")
def masked_view(spark, sf):
    security.create_masked_view(_person(spark, sf), REGISTRY, "person", [], "lodestrata_masked_person")
    return spark.table("lodestrata_masked_person").select("id", "email")


@query("sensitive_column_scan", with_sql(PERSON_SQL) + """
SELECT 'person' AS table_name, c AS column_name, kind AS data_element_type, m::DOUBLE / n AS match_rate FROM (
  SELECT 'ssn' AS c, 'ssn' AS kind, count(*) FILTER (WHERE regexp_matches(ssn, '^[0-9]{3}-?[0-9]{2}-?[0-9]{4}$')) AS m, count(*) AS n FROM person
  UNION ALL SELECT 'email', 'email', count(*) FILTER (WHERE regexp_matches(email, '^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\\.[a-zA-Z0-9-.]+$')), count(*) FROM person
  UNION ALL SELECT 'phone', 'phone', count(*) FILTER (WHERE regexp_matches(phone, '^\\+?1?\\s*\\(?[0-9]{3}\\)?[\\s.-]?[0-9]{3}[\\s.-]?[0-9]{4}$')), count(*) FROM person
  UNION ALL SELECT 'card', 'credit_card', count(*) FILTER (WHERE regexp_matches(card, '^[0-9]{4}[\\s-]?[0-9]{4}[\\s-]?[0-9]{4}[\\s-]?[0-9]{4}$')), count(*) FROM person) WHERE m::DOUBLE / n > 0.1""")
def sensitive_column_scan(spark, sf):
    return security.scan_values(_person(spark, sf), "person").select("table_name", "column_name", "data_element_type", "match_rate")


@query("sensitive_text_scan", """
WITH m AS (SELECT 'text' AS column_name, count(*) AS n, count(*) FILTER (WHERE regexp_matches(text, '\\b\\d{3}-\\d{2}-\\d{4}\\b')) AS ssn, count(*) FILTER (WHERE regexp_matches(text, '\\b\\d{4}[\\s-]?\\d{4}[\\s-]?\\d{4}[\\s-]?\\d{4}\\b')) AS card,
  count(*) FILTER (WHERE regexp_matches(text, '\\b[\\w\\._%+-]+@[\\w\\.-]+\\.[A-Za-z]{2,}\\b')) AS email, count(*) FILTER (WHERE regexp_matches(text, '\\b\\d{3}[-.\\s]?\\d{3}[-.\\s]?\\d{4}\\b')) AS phone,
  count(*) FILTER (WHERE regexp_matches(text, '\\b(?:\\d{1,3}\\.){3}\\d{1,3}\\b')) AS ip FROM documents)
SELECT 'documents' AS table_name, column_name, CASE WHEN ssn > 0 THEN 'ssn' WHEN card > 0 THEN 'credit_card' WHEN email > 0 THEN 'email' WHEN phone > 0 THEN 'phone' ELSE 'ip_address' END AS data_element_type,
  CASE WHEN ssn > 0 THEN ssn WHEN card > 0 THEN card WHEN email > 0 THEN email WHEN phone > 0 THEN phone ELSE ip END AS matches FROM m WHERE ssn + card + email + phone + ip > 0""")
def sensitive_text_scan(spark, sf):
    docs = table(spark, sf, "documents").select("text", "lang", "source")
    return security.scan_text(docs, "documents").select("table_name", "column_name", "data_element_type", "matches")


@query("text_pattern_rates", """
SELECT 'email' AS data_element_type, count(*) FILTER (WHERE regexp_matches(text, '\\b[\\w\\._%+-]+@[\\w\\.-]+\\.[A-Za-z]{2,}\\b')) AS matches, count(*) AS rows_read FROM documents
UNION ALL SELECT 'phone', count(*) FILTER (WHERE regexp_matches(text, '\\b\\d{3}[-.\\s]?\\d{3}[-.\\s]?\\d{4}\\b')), count(*) FROM documents
UNION ALL SELECT 'ssn', count(*) FILTER (WHERE regexp_matches(text, '\\b\\d{3}-\\d{2}-\\d{4}\\b')), count(*) FROM documents
UNION ALL SELECT 'credit_card', count(*) FILTER (WHERE regexp_matches(text, '\\b\\d{4}[\\s-]?\\d{4}[\\s-]?\\d{4}[\\s-]?\\d{4}\\b')), count(*) FROM documents
UNION ALL SELECT 'ip_address', count(*) FILTER (WHERE regexp_matches(text, '\\b(?:\\d{1,3}\\.){3}\\d{1,3}\\b')), count(*) FROM documents""")
def text_pattern_rates(spark, sf):
    rates = security.pattern_rates(table(spark, sf, "documents").select("text"), "documents", security.TEXT_PATTERNS)
    return rates.select("data_element_type", "matches", "rows_read")


@query("new_scan_findings", with_sql(PERSON_SQL) + """
SELECT column_name FROM (VALUES ('ssn'), ('phone'), ('card')) v(column_name) WHERE (SELECT count(*) FROM person) > 0""")
def new_scan_findings(spark, sf):
    found = security.scan_values(_person(spark, sf), "person")
    known = found.filter("column_name = 'email'").select("table_name", "column_name")
    return security.new_findings(found, known).select("column_name")


#: Registry, catalogue and policies with one row per part.
PART_REGISTRY_SQL = """reg AS (SELECT p_partkey, p_brand AS table_name, p_name AS column_name, CASE WHEN p_size % 3 = 0 THEN 'PCI' ELSE 'PII_HIGH' END AS sensitivity_class,
  CASE WHEN p_size % 7 = 0 THEN 'null_out' ELSE 'partial_mask' END AS masking_strategy, p_size % 5 <> 0 AS static_mask_enabled, repeat('role,', p_size) AS unmasked_roles FROM part)"""


def _part_registry(spark, sf):
    size = F.col("p_size")
    return table(spark, sf, "part").select(
        "p_partkey", F.col("p_brand").alias("table_name"), F.col("p_name").alias("column_name"), F.when(size % 3 == 0, "PCI").otherwise("PII_HIGH").alias("sensitivity_class"),
        F.when(size % 7 == 0, "null_out").otherwise("partial_mask").alias("masking_strategy"), (size % 5 != 0).alias("static_mask_enabled"),
        F.repeat(F.lit("role,"), size).alias("unmasked_roles"),
    )


AUDIT_SQL = with_sql(PART_REGISTRY_SQL, f"""c AS (SELECT count(*) FILTER (WHERE NOT static_mask_enabled OR masking_strategy = 'null_out') AS unmasked, count(*) FILTER (WHERE length(unmasked_roles) > 100) AS broad,
   (SELECT count(*) FROM events WHERE ts >= {NOW_SQL} - INTERVAL 24 HOURS) AS audited FROM reg WHERE sensitivity_class = 'PCI')""", """a AS (
 SELECT 'requirement_3' AS requirement, CASE WHEN unmasked = 0 THEN 'compliant' ELSE 'non_compliant' END AS status, unmasked AS findings FROM c
 UNION ALL SELECT 'requirement_7', CASE WHEN broad = 0 THEN 'compliant' ELSE 'review_needed' END, broad FROM c
 UNION ALL SELECT 'requirement_8', 'compliant', 0 FROM c UNION ALL SELECT 'requirement_10', CASE WHEN audited > 0 THEN 'compliant' ELSE 'non_compliant' END, audited FROM c)""")


def _audit_log(spark, sf):
    return table(spark, sf, "events").select(F.col("ts").alias("created_at"))


@query("card_data_audit", AUDIT_SQL + "SELECT * FROM a")
def card_data_audit(spark, sf):
    return security.card_audit(_part_registry(spark, sf), _audit_log(spark, sf), at(NOW))


CATALOGUE_SQL = """cat AS (SELECT p_partkey, p_brand AS table_name, p_size % 5 <> 0 AS masking_required, p_size % 4 <> 0 AS encryption_required,
  CASE p_size % 3 WHEN 0 THEN 'pci_dss' WHEN 1 THEN 'gdpr' ELSE 'ccpa' END AS tag FROM part)"""


@query("compliance_report", with_sql(CATALOGUE_SQL, f"""f AS (SELECT count(DISTINCT table_name) AS total_tables, count(*) AS total_sensitive_fields, count(*) FILTER (WHERE masking_required) AS masked_fields,
   count(*) FILTER (WHERE NOT masking_required) AS unmasked_fields, count(*) FILTER (WHERE encryption_required) AS encrypted_fields, (SELECT count(*) FROM events WHERE event_type = 'error' AND CAST(ts AS DATE) >= DATE '2024-01-30' - 30) AS access_violations FROM cat WHERE tag = 'pci_dss')""") + """
SELECT *, encrypted_fields * 100.0::DOUBLE / total_sensitive_fields AS encryption_coverage_pct, masked_fields * 100.0::DOUBLE / total_sensitive_fields AS compliance_score, 'pci_dss' AS report_type,
 concat_ws(',', CASE WHEN masked_fields < total_sensitive_fields THEN 'fields_not_masked' END, CASE WHEN encrypted_fields < total_sensitive_fields THEN 'encryption_incomplete' END, CASE WHEN access_violations > 0 THEN 'access_violations' END) AS findings FROM f""")
def compliance_report(spark, sf):
    size = F.col("p_size")
    catalogue = table(spark, sf, "part").select(
        F.col("p_brand").alias("table_name"), (size % 5 != 0).alias("masking_required"), (size % 4 != 0).alias("encryption_required"),
        F.array(F.when(size % 3 == 0, "pci_dss").when(size % 3 == 1, "gdpr").otherwise("ccpa")).alias("compliance_tags"),
    )
    accesses = table(spark, sf, "events").select((F.col("event_type") != "error").alias("access_granted"), F.col("ts").alias("access_timestamp"))
    return security.compliance_report(catalogue, accesses, "pci_dss", at(NOW)).withColumn("findings", F.array_join("findings", ","))


def _retention(spark, sf):
    policies = table(spark, sf, "orders").select(F.col("o_orderdate").alias("last_purge_date"), (F.col("o_orderstatus") != "P").alias("is_active"))
    return security.retention_compliance(policies, at(b.ORDERS_AS_OF))


OVERDUE_SQL = "SELECT count(*) FILTER (WHERE CAST(o_orderdate AS DATE) < DATE '2001-08-02' - 30) AS overdue_policies FROM orders WHERE o_orderstatus <> 'P'"


@query("retention_compliance", f"SELECT *, CASE WHEN overdue_policies = 0 THEN 'compliant' ELSE 'attention_needed' END AS status FROM ({OVERDUE_SQL})")
def retention_compliance(spark, sf):
    return _retention(spark, sf)


@query("compliance_rollup", AUDIT_SQL + f"""
SELECT CASE WHEN overdue_policies = 0 THEN 'compliant' ELSE 'attention_needed' END AS data_retention, overdue_policies,
 (SELECT CASE WHEN bool_and(status = 'compliant') THEN 'compliant' ELSE 'non_compliant' END FROM a) AS pii_masking, (SELECT CASE WHEN audited > 0 THEN 'compliant' ELSE 'non_compliant' END FROM c) AS access_audit FROM ({OVERDUE_SQL})""")
def compliance_rollup(spark, sf):
    audit = security.card_audit(_part_registry(spark, sf), _audit_log(spark, sf), at(NOW))
    return security.compliance_rollup(_retention(spark, sf), audit, _audit_log(spark, sf), at(NOW))


@query("valid_consents", f"""
WITH c AS (SELECT event_id, user_id AS customer_id, event_type AS consent_type, k, ts, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))
SELECT event_id AS consent_id, customer_id, consent_type FROM c WHERE rn = 1 AND k % 3 <> 0 AND (k % 2 = 0 OR ts + INTERVAL 5 DAYS > {NOW_SQL})""")
def valid_consents(spark, sf):
    k = F.get_json_object("props", "$.k").cast("bigint")
    consents = table(spark, sf, "events").select(
        F.col("event_id").alias("consent_id"), F.col("user_id").alias("customer_id"), F.col("event_type").alias("consent_type"), F.col("ts").alias("created_at"),
        F.when(k % 3 == 0, "withdrawn").otherwise("granted").alias("consent_status"), F.when(k % 2 != 0, F.col("ts") + F.expr("INTERVAL 5 DAYS")).alias("expires_at"),
    )
    return security.valid_consents(consents, at(NOW)).select("consent_id", "customer_id", "consent_type")


@query("personal_column_names", """
SELECT count(*) AS n, 'date_of_birth,email,phone,ssn' AS names FROM customer WHERE c_custkey % 6 <> 0""")
def personal_column_names(spark, sf):
    df = silver_customer(spark, sf).filter("_is_current")
    found = sorted(security.personal_columns(df.columns))
    return df.agg(F.count("*").alias("n")).withColumn("names", F.lit(",".join(found)))


# ---- access analytics ----------------------------------------------------------------

BASE_SQL = f"""base AS (SELECT user_id, list_sort(list_distinct(list(CAST(extract(hour FROM ts) AS INTEGER)))) AS hours, list_sort(list_distinct(list(table_name))) AS tables, list_sort(list_distinct(list(operation))) AS ops,
   count(*) / 30.0::DOUBLE AS avg_daily_queries, CAST(sum(bytes_scanned) AS DOUBLE) / 1073741824.0::DOUBLE / 30 AS avg_daily_data_gb FROM access WHERE CAST(ts AS DATE) >= DATE '2024-01-30' - 30 GROUP BY user_id)"""


@query("access_baseline", with_sql(ACCESS, BASE_SQL) + """
SELECT user_id, array_to_string(hours, ',') AS typical_hours, array_to_string(tables, ',') AS typical_resources, array_to_string(ops, ',') AS typical_operations, avg_daily_queries, avg_daily_data_gb FROM base""")
def access_baseline(spark, sf):
    base = access.access_baseline(b.accesses(spark, sf), at(NOW))
    return base.withColumns({c: F.array_join(F.col(c).cast("array<string>"), ",") for c in ("typical_hours", "typical_resources", "typical_operations")})


@query("stored_access_baseline", with_sql(ACCESS, BASE_SQL) + """
SELECT user_id, array_to_string(hours, ',') AS typical_hours, array_to_string(tables, ',') AS typical_resources, array_to_string(ops, ',') AS typical_operations, avg_daily_queries, avg_daily_data_gb FROM base""")
def stored_access_baseline(spark, sf):
    """The same from small rows that were stored for each day."""
    folder = f"{shared_folder(spark)}/access-days-{uuid.uuid4().hex}"
    write_load(mergeable.access_days(b.accesses(spark, sf)), folder, "partitions", ["day"])
    base = mergeable.access_baseline(spark.read.parquet(folder), at(NOW))
    return base.withColumns({c: F.array_join(F.col(c).cast("array<string>"), ",") for c in ("typical_hours", "typical_resources", "typical_operations")})


def _old_baseline(spark, sf):
    """Baseline from the first half of the month, kept under shifted numbers: the first users have none."""
    early = b.accesses(spark, sf).filter(F.col("ts") < at("2024-01-15"))
    return access.access_baseline(early.withColumn("user_id", F.col("user_id") + 3), at("2024-01-15"))


OLD_BASE_SQL = "ob AS (SELECT user_id + 3 AS user_id, list_distinct(list(CAST(extract(hour FROM ts) AS INTEGER))) AS hours FROM access WHERE ts < TIMESTAMP '2024-01-15' AND CAST(ts AS DATE) >= DATE '2024-01-15' - 30 GROUP BY user_id)"
UNUSUAL_SQL = f"""un AS (SELECT event_id, user_id, ts, CAST(extract(hour FROM ts) AS INTEGER) AS access_hour, operation, table_name FROM access LEFT JOIN ob USING (user_id)
   WHERE ts >= {NOW_SQL} - INTERVAL 24 HOURS AND (hours IS NULL OR NOT list_contains(hours, CAST(extract(hour FROM ts) AS INTEGER))))"""


@query("unusual_hour_access", with_sql(ACCESS, OLD_BASE_SQL, UNUSUAL_SQL) + "SELECT *, 'unusual_time' AS anomaly_type, 0.75::DOUBLE AS anomaly_score FROM un")
def unusual_hour_access(spark, sf):
    return access.unusual_hours(b.accesses(spark, sf), _old_baseline(spark, sf), at(NOW), "24 HOURS")


VOLUME_SQL = f"""vo AS (SELECT user_id, count(*) AS query_count, CAST(sum(bytes_scanned) AS DOUBLE) / 1073741824.0::DOUBLE AS total_gb_scanned, list_sort(list_distinct(list(table_name))) AS tables_accessed FROM access
   WHERE ts >= {NOW_SQL} - INTERVAL 24 HOURS GROUP BY user_id HAVING CAST(sum(bytes_scanned) AS DOUBLE) / 1073741824.0::DOUBLE > 15)"""


@query("excessive_access_volume", with_sql(ACCESS, VOLUME_SQL) + """
SELECT user_id, query_count, total_gb_scanned, array_to_string(tables_accessed, ',') AS tables_accessed, 'excessive_data_access' AS anomaly_type, total_gb_scanned / 15.0::DOUBLE AS anomaly_score FROM vo""")
def excessive_access_volume(spark, sf):
    return access.excessive_volume(b.accesses(spark, sf), at(NOW), 15.0, "24 HOURS").withColumn("tables_accessed", F.array_join("tables_accessed", ","))


PRIVILEGE_SQL = f"pr AS (SELECT * FROM access WHERE ts >= {NOW_SQL} - INTERVAL 24 HOURS AND operation IN ('grant', 'create') AND resource_type IN ('role', 'permission') AND severity = 'high')"


@query("privilege_escalation", with_sql(ACCESS, PRIVILEGE_SQL) + "SELECT event_id, user_id, operation, resource_name, ts, 0.95::DOUBLE AS anomaly_score FROM pr")
def privilege_escalation(spark, sf):
    found = access.privilege_escalation(b.accesses(spark, sf), at(NOW), "24 HOURS")
    return found.select("event_id", "user_id", "operation", "resource_name", "ts", F.col("anomaly_score").cast("double").alias("anomaly_score"))


EXPORT_SQL = f"""ex AS (SELECT user_id, count(*) AS pii_queries, CAST(sum(row_count) AS BIGINT) AS total_pii_rows, list_sort(list_distinct(list(table_name))) AS pii_tables FROM access
   WHERE ts >= {NOW_SQL} - INTERVAL 24 HOURS AND pii_accessed GROUP BY user_id HAVING sum(row_count) > 5000)"""


@query("personal_mass_export", with_sql(ACCESS, EXPORT_SQL) + "SELECT user_id, pii_queries, total_pii_rows, array_to_string(pii_tables, ',') AS pii_tables, 0.90::DOUBLE AS anomaly_score FROM ex")
def personal_mass_export(spark, sf):
    found = access.personal_mass_export(b.accesses(spark, sf), at(NOW), 5000, "24 HOURS")
    return found.select("user_id", "pii_queries", "total_pii_rows", F.array_join("pii_tables", ",").alias("pii_tables"), F.col("anomaly_score").cast("double").alias("anomaly_score"))


ALL_SQL = with_sql(ACCESS, OLD_BASE_SQL, UNUSUAL_SQL, VOLUME_SQL, PRIVILEGE_SQL, EXPORT_SQL, """anomalies AS (
  SELECT user_id, 'unusual_time' AS anomaly_type, 0.75::DOUBLE AS anomaly_score FROM un UNION ALL SELECT user_id, 'excessive_data_access', total_gb_scanned / 15.0::DOUBLE FROM vo
  UNION ALL SELECT user_id, 'privilege_escalation', 0.95 FROM pr UNION ALL SELECT user_id, 'pii_mass_export', 0.90 FROM ex)""")


def _anomalies(spark, sf):
    log = b.accesses(spark, sf)
    return access.all_anomalies(log, log, _old_baseline(spark, sf), at(NOW), at(NOW), 15.0, 5000, "24 HOURS")


@query("all_access_anomalies", ALL_SQL + "SELECT *, 'new' AS resolution_status FROM anomalies")
def all_access_anomalies(spark, sf):
    return _anomalies(spark, sf).select("user_id", "anomaly_type", "anomaly_score", "resolution_status")


@query("automatic_user_flags", ALL_SQL[:-1] + f""", who AS (SELECT user_id, min('Automatic flag: ' || anomaly_type) AS reason FROM anomalies WHERE anomaly_score >= 0.9 GROUP BY user_id)
SELECT event_id, user_id, flagged OR (reason IS NOT NULL AND ts >= {NOW_SQL} - INTERVAL 24 HOURS) AS flagged,
  CASE WHEN reason IS NOT NULL AND ts >= {NOW_SQL} - INTERVAL 24 HOURS THEN reason ELSE flag_reason END AS flag_reason FROM access LEFT JOIN who USING (user_id)""")
def automatic_user_flags(spark, sf):
    users = access.users_to_flag(_anomalies(spark, sf))
    return access.flag_users(b.accesses(spark, sf), users, at(NOW), "24 HOURS").select("event_id", "user_id", "flagged", "flag_reason")


@query("cleared_flags", with_sql(ACCESS) + """
SELECT event_id, CASE WHEN user_id = 7 AND flagged THEN false ELSE flagged END AS flagged, CASE WHEN user_id = 7 AND flagged THEN 'Cleared: checked' ELSE flag_reason END AS flag_reason FROM access""")
def cleared_flags(spark, sf):
    return access.clear_flags(b.accesses(spark, sf), 7, "checked").select("event_id", "flagged", "flag_reason")


@query("flagged_accesses", with_sql(ACCESS) + """
SELECT 'compute' AS access_type, event_id, user_id, resource_name, operation, ts, flag_reason, NULL AS severity FROM access WHERE flagged AND operation = 'read'
UNION ALL SELECT 'data', event_id, user_id, table_name, operation, ts, flag_reason, NULL FROM access WHERE flagged
UNION ALL SELECT 'control', event_id, user_id, resource_name, operation, ts, flag_reason, severity FROM access WHERE flagged AND operation = 'grant'""")
def flagged_accesses(spark, sf):
    log = b.accesses(spark, sf)
    return access.flagged_accesses(log.filter("operation = 'read'").drop("severity"), log.drop("severity"), log.filter("operation = 'grant'"))


@query("active_access_sessions", with_sql(ACCESS) + f"""
SELECT user_id, count(DISTINCT session_id) AS active_sessions, count(*) AS total_operations, max(ts) AS last_activity FROM access WHERE ts >= {NOW_SQL} - INTERVAL 48 HOURS GROUP BY user_id""")
def active_access_sessions(spark, sf):
    return access.active_sessions(b.accesses(spark, sf), at(NOW), "48 HOURS")


@query("data_access_summary", with_sql(ACCESS) + f"""
SELECT user_id, operation, count(*) AS operation_count, CAST(sum(row_count) AS BIGINT) AS total_rows, CAST(sum(bytes_scanned) AS DOUBLE) / 1073741824.0::DOUBLE AS total_gb_scanned, count(DISTINCT table_name) AS tables_accessed
FROM access WHERE ts >= {NOW_SQL} - INTERVAL 24 HOURS GROUP BY ALL""")
def data_access_summary(spark, sf):
    return access.data_access_summary(b.accesses(spark, sf), at(NOW), "24 HOURS")


@query("recent_personal_access", with_sql(ACCESS) + f"""
SELECT event_id, user_id, table_name, row_count, ts FROM access WHERE pii_accessed AND ts >= {NOW_SQL} - INTERVAL 24 HOURS ORDER BY ts DESC, event_id DESC LIMIT 20""")
def recent_personal_access(spark, sf):
    return access.recent_events(b.accesses(spark, sf), F.col("pii_accessed"), at(NOW), "24 HOURS", 20).select("event_id", "user_id", "table_name", "row_count", "ts")


@query("access_logging_health", with_sql(ACCESS) + f"""
SELECT 'data' AS log_type, count(*) AS event_count, max(ts) AS last_event, CASE WHEN count(*) = 0 THEN 'warning' ELSE 'healthy' END AS status FROM access WHERE ts >= {NOW_SQL} - INTERVAL 1 HOUR
UNION ALL SELECT 'control', count(*), max(ts), CASE WHEN count(*) = 0 THEN 'warning' ELSE 'healthy' END FROM access WHERE ts >= {NOW_SQL} - INTERVAL 1 HOUR AND operation = 'grant'""")
def access_logging_health(spark, sf):
    log = b.accesses(spark, sf)
    return access.logging_health({"data": log, "control": log.filter("operation = 'grant'")}, at(NOW))


@query("access_compliance_by_user", with_sql(ACCESS) + """
SELECT user_id, count(DISTINCT CAST(ts AS DATE)) AS days_active, count(*) AS total_operations, count(*) FILTER (WHERE operation = 'read') AS read_operations, count(*) FILTER (WHERE operation = 'write') AS write_operations,
  count(*) FILTER (WHERE pii_accessed) AS pii_access_count, count(*) FILTER (WHERE flagged) AS flagged_operations, count(DISTINCT table_name) AS unique_tables_accessed, CAST(sum(row_count) AS BIGINT) AS total_rows_accessed,
  CAST(sum(bytes_scanned) AS DOUBLE) / 1073741824.0::DOUBLE AS total_gb_scanned FROM access WHERE CAST(ts AS DATE) >= DATE '2024-01-30' - 30 GROUP BY user_id""")
def access_compliance_by_user(spark, sf):
    return access.compliance_by_user(b.accesses(spark, sf), at(NOW))


@query("personal_access_list", with_sql(ACCESS) + "SELECT event_id, user_id, table_name, row_count, ts, flagged, flag_reason FROM access WHERE pii_accessed AND CAST(ts AS DATE) >= DATE '2024-01-30' - 365")
def personal_access_list(spark, sf):
    return access.personal_access_list(b.accesses(spark, sf), at(NOW))


@query("classified_accesses", with_sql(ACCESS, "cat AS (SELECT DISTINCT 'table_' || (p_size % 20 + 11) AS table_name, 'c' || (p_size % 3) AS column_name, 'pii' AS cls FROM part)", """
  rows_ AS (SELECT event_id, table_name, unnest(['c0', 'c1', 'c2', 'c9']) AS column_name FROM access)""") + """
SELECT coalesce(cls, 'public') AS data_classification, column_name, count(*) AS n FROM rows_ LEFT JOIN cat USING (table_name, column_name) GROUP BY ALL""")
def classified_accesses(spark, sf):
    size = F.col("p_size")
    # numbers go beyond those of the tables that are read, and the first tables are not in the catalogue
    catalogue = table(spark, sf, "part").select(
        F.concat(F.lit("table_"), size % 20 + 11).alias("table_name"), F.concat(F.lit("c"), size % 3).alias("column_name"), F.lit("pii").alias("data_classification")
    )
    rows = b.accesses(spark, sf).select("event_id", "table_name", F.array(*[F.lit(c) for c in ("c0", "c1", "c2", "c9")]).alias("columns"))
    return access.classify_accesses(rows, catalogue).groupBy("data_classification", "column_name").agg(F.count("*").alias("n"))


@query("role_assignment_audit", """
SELECT sha256(s_nationkey || '|' || s_suppkey || '|' || r) AS audit_id, s_nationkey AS workspace_id, s_suppkey AS principal_id, 'User' AS principal_type, r AS role, lower(r) IN ('admin', 'owner') AS is_privileged,
  TIMESTAMP '2024-01-30 12:00:00' AS audited_at FROM (SELECT *, CASE s_suppkey % 3 WHEN 0 THEN 'Admin' WHEN 1 THEN 'Member' ELSE 'Viewer' END AS r FROM supplier)""")
def role_assignment_audit(spark, sf):
    k = F.col("s_suppkey")
    rows = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("workspace_id"), k.alias("principal_id"), F.lit("User").alias("principal_type"), F.when(k % 3 == 0, "Admin").when(k % 3 == 1, "Member").otherwise("Viewer").alias("role")
    )
    return access.assignment_audit(rows, at(NOW))


@query("tracked_reads", """
SELECT 'u1' AS user_id, 'read' AS operation, 'customer' AS table_name, 'c_phone' AS columns, true AS pii_accessed, (SELECT count(*) FROM customer) AS row_count
UNION ALL SELECT 'u1', 'read', 'lineitem', '', false, (SELECT count(*) FROM lineitem)""")
def tracked_reads(spark, sf):
    """Two tables read with a log row each; one holds a personal column."""
    logs = []
    for name, columns in (("customer", ["c_custkey", "c_phone"]), ("lineitem", ["l_orderkey", "l_quantity"])):
        data = table(spark, sf, name)
        data = data.select(*[c for c in columns if c in data.columns], *([F.lit("555").alias("c_phone")] if "c_phone" in columns and "c_phone" not in data.columns else []))
        rows, log = access.tracked_read(spark, name, data, "u1", at("2024-01-01"))
        logs.append(with_one_row(log.drop("ts"), rows.agg(F.count("*").alias("row_count"))))
    both = union_all(logs)
    return both.select("user_id", "operation", "table_name", F.array_join("sensitive_columns", ",").alias("columns"), "pii_accessed", "row_count")
