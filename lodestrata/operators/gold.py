"""Star-schema models, grain aggregates and the definition-driven gold runner."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions.hashing import surrogate_key
from lodestrata.operators.history import check_constraints, split_by_constraints
from lodestrata.sources.writers import write_load

# The columns of each gold model, in order.
DIM_POLICY = (
    "policy_id", "policy_number", "product_code", "product_name", "line_of_business", "policy_status",
    "effective_date", "expiration_date", "issue_date", "cancellation_date", "premium_amount", "coverage_amount",
    "deductible_amount", "customer_id", "agent_id", "underwriter_id", "risk_class", "territory_code",
    "state_code",
)
FACT_POLICY_TRANSACTION = (
    "transaction_id", "policy_id", "transaction_type", "transaction_date", "effective_date", "premium_change",
    "written_premium", "earned_premium", "unearned_premium", "commission_amount", "tax_amount", "fees",
    "agent_id", "underwriter_id", "approval_status",
)
DIM_CLAIM = (
    "claim_id", "claim_number", "policy_id", "claimant_id", "loss_date", "report_date", "claim_status",
    "claim_type", "loss_type", "cause_of_loss", "loss_description", "loss_location_state", "loss_location_zip",
    "assigned_adjuster_id", "litigation_flag", "fraud_score", "fraud_flag", "total_incurred", "total_paid",
    "total_reserved", "salvage_amount", "subrogation_amount", "deductible_applied",
)
DIM_CUSTOMER = (
    "customer_id", "customer_type", "first_name", "last_name", "full_name", "date_of_birth", "gender", "ssn",
    "email", "phone", "preferred_language", "preferred_channel", "customer_since_date", "customer_segment",
    "lifetime_premium_value", "total_claims_count", "active_policy_count", "risk_score", "nps_score",
    "churn_risk_score", "last_interaction_date",
)
FACT_JOURNAL_ENTRY = (
    "entry_id", "journal_id", "posting_date", "fiscal_year", "fiscal_period", "account_code", "account_name",
    "account_category", "department_code", "cost_center", "debit_amount", "credit_amount", "net_amount",
    "currency_code", "description", "source_module", "reference_id", "reversal_flag", "approved_by",
)
FACT_PREMIUM_INVOICE = (
    "invoice_id", "policy_id", "customer_id", "billing_period_start", "billing_period_end", "due_date",
    "invoice_amount", "paid_amount", "outstanding_amount", "payment_status", "billing_frequency",
    "payment_method", "last_payment_date", "days_overdue", "dunning_level",
)


def _model(df: DataFrame, columns: Sequence[str], at: Column, extra: Mapping[str, Column] | None = None) -> DataFrame:
    added = [c.alias(name) for name, c in (extra or {}).items()]
    return df.select(*columns, *added, at.alias("_gold_load_ts"))


def _current(df: DataFrame) -> DataFrame:
    return df.filter(F.col("_is_current"))


def dim_policy(silver: DataFrame, at: Column) -> DataFrame:
    return _model(_current(silver), DIM_POLICY, at, {"last_updated": F.col("_silver_load_ts")})


def fact_policy_transaction(silver: DataFrame, at: Column) -> DataFrame:
    return _model(silver, FACT_POLICY_TRANSACTION, at, {"transaction_date_key": F.to_date("transaction_date")})


def dim_claim(silver: DataFrame, at: Column) -> DataFrame:
    return _model(_current(silver), DIM_CLAIM, at)


def dim_customer_master(silver: DataFrame, at: Column) -> DataFrame:
    """Current customers; personal columns still clear, to be masked by the security step."""
    return _model(_current(silver), DIM_CUSTOMER, at)


def fact_journal_entry(silver: DataFrame, at: Column) -> DataFrame:
    return _model(silver, FACT_JOURNAL_ENTRY, at)


def fact_premium_invoice(silver: DataFrame, at: Column) -> DataFrame:
    return _model(silver, FACT_PREMIUM_INVOICE, at)


def keyed_dimension(silver: DataFrame, business_key: Sequence[str], attributes: Sequence[str], name: str) -> DataFrame:
    """Current rows with a repeatable surrogate key."""
    return _current(silver).select(surrogate_key(business_key).alias(name), *attributes)


def version_fact(
    silver: DataFrame,
    business_key: str,
    transaction_type: str,
    measures: Sequence[str],
    at: Column,
    valid_from: str = "_effective_from",
) -> DataFrame:
    """Every version of a business key as one transaction."""
    return silver.select(
        F.sha2(F.col(business_key).cast("string"), 256).alias("fact_key"),
        F.col(business_key),
        F.col(valid_from).alias("transaction_date"),
        F.col(transaction_type).alias("transaction_type"),
        *measures,
        F.lit(1).alias("transaction_count"),
        at.alias("fact_created_at"),
    )


#: How the models are stored: the columns that part them, and what every row must fulfil.
STORED_MODELS: dict[str, Mapping[str, Any]] = {
    "fact_policy_transaction": {"partition_by": ("transaction_type",)},
    "fact_journal_entry": {"partition_by": ("fiscal_year", "fiscal_period")},
    "fact_premium_invoice": {"constraints": {"chk_invoice_amount": "invoice_amount >= 0"}},
}


def store_model(model: DataFrame, name: str, folder: str) -> DataFrame:
    """Writes a gold model in its partitions and returns what its constraints say (``constraint_name``, ``expression``, ``violations``).

    Rows that break a constraint go to ``<name>_rejected`` beside the table, which holds only rows that fulfil all. Read
    with a filter on the parting columns, only those partitions are opened.
    """
    how = STORED_MODELS.get(name, {})
    constraints = how.get("constraints") or {}
    good, bad = split_by_constraints(model, constraints) if constraints else (model, None)
    write_load(good, f"{folder}/{name}", "full", how.get("partition_by", ()))
    if bad is None:
        return check_constraints(model, {"any_row": "true"}).filter("false")
    write_load(bad, f"{folder}/{name}_rejected", "full")
    return check_constraints(model.sparkSession.read.parquet(f"{folder}/{name}_rejected"), constraints)


def grain_aggregate(fact: DataFrame, grain: Sequence[str], premium: str, coverage: str) -> DataFrame:
    """Totals, count, mean and extremes at a caller-chosen grain (map-side partial sums)."""
    total = F.sum(premium)
    return fact.groupBy(*grain).agg(
        total.alias("total_premium"),
        F.sum(coverage).alias("total_coverage"),
        F.count("*").alias("policy_count"),
        (total.cast("double") / F.count(premium)).alias("avg_premium"),
        F.max(premium).alias("max_premium"),
        F.min(premium).alias("min_premium"),
    )


def run_gold(
    spark: SparkSession,
    definitions: Sequence[Mapping[str, Any]],
    folder: str,
) -> DataFrame:
    """Build every definition from its SQL over registered views and report its constraints.

    A definition gives ``target_table``, ``sql``, ``mode``, ``partition_by`` and
    ``constraints``. Violations are counted on the written table, not by a second run of
    the SQL.
    """
    reports = []
    for d in definitions:
        path = f"{folder}/{d['target_table']}"
        mode = "full" if d.get("mode", "overwrite") == "overwrite" else "incremental"
        write_load(spark.sql(d["sql"]), path, mode, d.get("partition_by", ()))
        written = spark.read.parquet(path)
        constraints = d.get("constraints") or {"any_row": "true"}
        reports.append(
            check_constraints(written, constraints).select(
                F.lit(d["target_table"]).alias("target_table"), "constraint_name", "violations"
            )
        )
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out
