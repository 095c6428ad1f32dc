"""Masking from a registry, sensitive-data scans, compliance checks, consent."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.functions import masks
from lodestrata.operators.aggregates import with_one_row
from lodestrata.operators.history import keep_latest
from lodestrata.operators.rules import within

Rule = Mapping[str, Any]

# Whole-value patterns with class, masking strategy and regulations.
VALUE_PATTERNS = {
    "ssn": (r"^\d{3}-?\d{2}-?\d{4}$", "PII_HIGH", "partial_mask", ("CCPA", "state_privacy_laws")),
    "credit_card": (r"^\d{4}[\s-]?\d{4}[\s-]?\d{4}[\s-]?\d{4}$", "PCI", "partial_mask", ("PCI_DSS",)),
    "email": (r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$", "PII_MEDIUM", "email_mask", ("GDPR", "CCPA")),
    "phone": (r"^\+?1?\s*\(?\d{3}\)?[\s.-]?\d{3}[\s.-]?\d{4}$", "PII_MEDIUM", "phone_mask", ("CCPA",)),
}
# Column-name parts with class, masking strategy and regulations.
NAME_PATTERNS = {
    "dob": (("dob", "date_of_birth", "birth_date", "birthdate"), "PII_MEDIUM", "date_shift", ("HIPAA", "CCPA")),
    "medical_record": (
        ("diagnosis", "icd_code", "medical", "prescription", "procedure_code", "treatment", "prognosis"),
        "PHI",
        "full_redact",
        ("HIPAA",),
    ),
    "bank_account": (("bank_account", "account_number", "routing_number", "iban", "swift"), "FINANCIAL", "partial_mask", ("PCI_DSS", "SOX")),
    "driver_license": (("driver_license", "dl_number", "license_number"), "PII_HIGH", "hash_sha256", ("state_privacy_laws",)),
}
# Patterns looked for inside text.
TEXT_PATTERNS = {
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "credit_card": r"\b\d{4}[\s-]?\d{4}[\s-]?\d{4}[\s-]?\d{4}\b",
    "email": r"\b[\w\._%+-]+@[\w\.-]+\.[A-Za-z]{2,}\b",
    "phone": r"\b\d{3}[-.\s]?\d{3}[-.\s]?\d{4}\b",
    "ip_address": r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
}
# Name parts that mark a column as personal.
PERSONAL_WORDS = (
    "ssn", "social_security", "dob", "birth", "email", "phone", "credit_card", "address", "medical",
    "diagnosis", "prescription",
)


def _params(rule: Rule) -> dict:
    return json.loads(rule.get("masking_parameters") or "{}")


def mask_table(df: DataFrame, registry: Sequence[Rule], table_name: str, layer: str) -> DataFrame:
    """Mask every registered column of a table in one projection."""
    changes = {}
    for r in registry:
        fits = r["table_name"] == table_name and r["layer"] in (layer, "all") and r.get("static_mask_enabled", True)
        name = r["column_name"]
        if fits and r.get("is_active", True) and name in df.columns and r["masking_strategy"] in masks.STRATEGIES:
            changes[name] = masks.STRATEGIES[r["masking_strategy"]](F.col(name), _params(r))
    return df.select(*[changes[c].alias(c) if c in changes else F.col(c) for c in df.columns])


def mask_for_role(df: DataFrame, registry: Sequence[Rule], table_name: str, roles: Sequence[str]) -> DataFrame:
    """What a member of ``roles`` may see: clear where a role allows it, masked elsewhere.

    The caller states the roles, since open-source Spark has no notion of membership.
    """
    held = F.array(*[F.lit(r) for r in roles]) if roles else F.array().cast("array<string>")
    out = []
    rules = {r["column_name"]: r for r in registry if r["table_name"] == table_name and r.get("dynamic_mask_enabled", True)}
    for c in df.columns:
        r = rules.get(c)
        if r is None:
            out.append(F.col(c))
            continue
        strategy = masks.STRATEGIES.get(r["masking_strategy"], lambda col, p: F.lit(masks.MASKED))
        allowed = json.loads(r.get("unmasked_roles") or "[]")
        clear = F.arrays_overlap(held, F.array(*[F.lit(a) for a in allowed])) if allowed else F.lit(False)
        out.append(F.when(clear, F.col(c).cast("string")).otherwise(strategy(F.col(c), _params(r)).cast("string")).alias(c))
    return df.select(*out)


def create_masked_view(df: DataFrame, registry: Sequence[Rule], table_name: str, roles: Sequence[str], view: str) -> None:
    mask_for_role(df, registry, table_name, roles).createOrReplaceTempView(view)


def personal_columns(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if any(word in c.lower() for word in PERSONAL_WORDS)]


def pattern_rates(df: DataFrame, table_name: str, patterns: Mapping[str, str]) -> DataFrame:
    """Rows matching each pattern in each text column, all in one scan over whole values."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    pairs = [(c, kind, i) for i, (c, kind) in enumerate((c, k) for c in texts for k in patterns)]
    counted = df.agg(
        F.count(F.lit(1)).alias("rows_read"),
        *[F.count_if(F.col(c).rlike(patterns[kind])).alias(f"m{i}") for c, kind, i in pairs],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(table_name).alias("table_name"),
                F.lit(c).alias("column_name"),
                F.lit(kind).alias("data_element_type"),
                F.lit(list(patterns).index(kind)).alias("pattern_order"),
                F.col(f"m{i}").alias("matches"),
            )
            for c, kind, i in pairs
        ]
    )
    return counted.select("rows_read", F.inline(lines)).withColumn(
        "match_rate", F.coalesce(F.try_divide(F.col("matches").cast("double"), F.col("rows_read").cast("double")), F.lit(0.0))
    )


def _first_finding(findings: DataFrame) -> DataFrame:
    return keep_latest(findings, ["table_name", "column_name"], [F.col("pattern_order").asc()])


def scan_values(df: DataFrame, table_name: str, min_rate: float = 0.1) -> DataFrame:
    """Sensitive columns by value (share of matching rows above ``min_rate``) or by name."""
    rates = pattern_rates(df, table_name, {k: v[0] for k, v in VALUE_PATTERNS.items()})
    found = _first_finding(rates.filter(F.col("match_rate") > min_rate)).select(
        "table_name", "column_name", "data_element_type", "match_rate", F.lit("regex_pattern").alias("detection_method")
    )
    named = [
        (table_name, c, kind, None, "column_name_pattern")
        for c in df.columns
        for kind in [next((k for k, v in NAME_PATTERNS.items() if any(p in c.lower() for p in v[0])), None)]
        if kind
    ]
    if named:
        by_name = df.sparkSession.createDataFrame(
            named, "table_name string, column_name string, data_element_type string, match_rate double, detection_method string"
        )
        by_value = found.join(by_name.select("column_name"), "column_name", "left_anti").select(*by_name.columns)
        found = by_name.unionByName(by_value)
    return describe_findings(found)


def describe_findings(findings: DataFrame) -> DataFrame:
    """Add class, masking strategy and regulations of each element type."""
    every = {k: v[1:] for k, v in VALUE_PATTERNS.items()} | {k: v[1:] for k, v in NAME_PATTERNS.items()}

    def pick(i: int) -> Column:
        return F.create_map(*[F.lit(x) for k, v in every.items() for x in (k, v[i] if i < 2 else ",".join(v[2]))])

    kind = F.col("data_element_type")
    return findings.withColumns(
        {"sensitivity_class": pick(0)[kind], "masking_strategy": pick(1)[kind], "regulations": F.split(pick(2)[kind], ",")}
    )


def scan_text(df: DataFrame, table_name: str) -> DataFrame:
    """Catalogue rows of text columns in which any row holds a sensitive pattern."""
    found = _first_finding(pattern_rates(df, table_name, TEXT_PATTERNS).filter("matches > 0"))
    kind = F.col("data_element_type")
    card = kind == "credit_card"
    return found.select(
        "table_name",
        "column_name",
        "data_element_type",
        F.when(card, "pci").otherwise("pii").alias("data_classification"),
        F.when(kind.isin("ssn", "credit_card"), "critical").otherwise("high").alias("sensitivity_level"),
        F.lit(True).alias("masking_required"),
        F.concat(F.lit("mask_"), kind).alias("masking_function"),
        F.lit(2555).alias("retention_days"),
        F.when(card, F.array(F.lit("pci_dss"), F.lit("ccpa"))).otherwise(F.array(F.lit("ccpa"), F.lit("gdpr"))).alias("compliance_tags"),
        "matches",
        (F.col("match_rate") * 100.0).alias("match_pct"),
    )


def new_findings(findings: DataFrame, registry: DataFrame) -> DataFrame:
    """Findings whose column is not registered yet."""
    return findings.join(registry.select("table_name", "column_name").distinct(), ["table_name", "column_name"], "left_anti")


def card_audit(registry: DataFrame, audit_log: DataFrame, as_of: Column) -> DataFrame:
    """Four card-data requirements with status and finding count."""
    cards = registry.filter(F.col("sensitivity_class") == "PCI").agg(
        F.count_if(~F.col("static_mask_enabled") | (F.col("masking_strategy") == "null_out")).alias("unmasked"),
        F.count_if(F.length("unmasked_roles") > 100).alias("broad"),
    )
    logged = audit_log.filter(within(F.col("created_at"), as_of, "24 HOURS")).agg(F.count("*").alias("audited"))
    one = with_one_row(cards, logged)

    def line(requirement: str, status: Column, findings: Column) -> Column:
        return F.struct(F.lit(requirement).alias("requirement"), status.alias("status"), findings.cast("bigint").alias("findings"))

    lines = F.array(
        line("requirement_3", F.when(F.col("unmasked") == 0, "compliant").otherwise("non_compliant"), F.col("unmasked")),
        line("requirement_7", F.when(F.col("broad") == 0, "compliant").otherwise("review_needed"), F.col("broad")),
        line("requirement_8", F.lit("compliant"), F.lit(0)),
        line("requirement_10", F.when(F.col("audited") > 0, "compliant").otherwise("non_compliant"), F.col("audited")),
    )
    return one.select(F.inline(lines))


def audit_verdict(audit: DataFrame) -> DataFrame:
    return audit.agg(
        F.when(F.bool_and(F.col("status") == "compliant"), "compliant").otherwise("non_compliant").alias("overall_status")
    )


def compliance_report(catalogue: DataFrame, accesses: DataFrame, tag: str, as_of: Column, days: int = 30) -> DataFrame:
    """Masking and encryption coverage of the fields under one regulation, plus violations."""
    fields = catalogue.filter(F.array_contains("compliance_tags", tag)).agg(
        F.countDistinct("table_name").alias("total_tables"),
        F.count("*").alias("total_sensitive_fields"),
        F.count_if("masking_required").alias("masked_fields"),
        F.count_if(~F.col("masking_required")).alias("unmasked_fields"),
        F.count_if("encryption_required").alias("encrypted_fields"),
    )
    denied = accesses.filter(
        ~F.col("access_granted") & (F.col("access_timestamp").cast("date") >= F.date_sub(as_of.cast("date"), days))
    ).agg(F.count("*").alias("access_violations"))
    total = F.col("total_sensitive_fields").cast("double")

    def pct(c: str) -> Column:
        return F.coalesce(F.try_divide(F.col(c) * 100.0, total), F.lit(100.0))

    out = with_one_row(fields, denied).withColumns(
        {"encryption_coverage_pct": pct("encrypted_fields"), "compliance_score": pct("masked_fields")}
    )
    findings = F.array_compact(
        F.array(
            F.when(F.col("compliance_score") < 100, "fields_not_masked"),
            F.when(F.col("encryption_coverage_pct") < 100, "encryption_incomplete"),
            F.when(F.col("access_violations") > 0, "access_violations"),
        )
    )
    return out.withColumns({"report_type": F.lit(tag), "findings": findings})


def retention_compliance(policies: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    overdue = policies.filter("is_active").agg(
        F.count_if(F.col("last_purge_date").cast("date") < F.date_sub(as_of.cast("date"), days)).alias("overdue_policies")
    )
    return overdue.withColumn("status", F.when(F.col("overdue_policies") == 0, "compliant").otherwise("attention_needed"))


def compliance_rollup(retention: DataFrame, audit: DataFrame, audit_log: DataFrame, as_of: Column) -> DataFrame:
    """Retention, masking and audit verdicts side by side."""
    r = retention.select(F.col("status").alias("data_retention"), "overdue_policies")
    m = audit_verdict(audit).select(F.col("overall_status").alias("pii_masking"))
    a = audit_log.filter(within(F.col("created_at"), as_of, "24 HOURS")).agg(
        F.when(F.count("*") > 0, "compliant").otherwise("non_compliant").alias("access_audit")
    )
    return with_one_row(with_one_row(r, m), a)


def valid_consents(consents: DataFrame, as_of: Column) -> DataFrame:
    """Latest consent per customer and type, if granted and not expired."""
    newest = keep_latest(consents, ["customer_id", "consent_type"], [F.col("created_at").desc(), F.col("consent_id").desc()])
    return newest.filter(
        (F.col("consent_status") == "granted") & (F.col("expires_at").isNull() | (F.col("expires_at") > as_of))
    )
