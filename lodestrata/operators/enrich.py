"""External-data enrichment, pricing and risk scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.operators.aggregates import band, mean, top, with_one_row

# Total damage above which a state falls into a tier, and each tier's loading.
DAMAGE_TIERS = ((50_000_000, "Critical"), (10_000_000, "High"), (1_000_000, "Medium"))
TIER_LOADING = {"Critical": 1.50, "High": 1.25, "Medium": 1.10}


def enrich(df: DataFrame, reference: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join with a reference table of one row per key."""
    return df.join(reference, list(on), "left")


def storm_risk(storms: DataFrame, as_of: Column, by: str, days: int = 3650, tiers=DAMAGE_TIERS) -> DataFrame:
    """Damage of the last ten years and the tier it implies."""
    recent = storms.filter(F.col("event_date").cast("date") >= F.date_sub(as_of.cast("date"), days))
    total = F.sum("damage_property")
    return recent.groupBy(by).agg(
        F.count("*").alias("storm_count_10yr"),
        total.alias("total_damage"),
        mean(F.col("damage_property")).alias("avg_damage"),
        band(total, tiers, "Low").alias("catastrophe_tier"),
    )


def adjusted_premium(policies: DataFrame, risk: DataFrame, by: str) -> DataFrame:
    """Premium times the loading of the policy's tier (1.00 where no risk is known)."""
    tier = F.col("catastrophe_tier")
    loading = F.lit(1.0)
    for name, factor in TIER_LOADING.items():
        loading = F.when(tier == name, factor).otherwise(loading)
    joined = policies.join(risk.select(by, "catastrophe_tier"), by, "left").withColumn("catastrophe_loading", loading)
    return joined.withColumn("adjusted_premium", F.col("base_premium").cast("double") * F.col("catastrophe_loading"))


def life_pricing(applications: DataFrame, mortality: DataFrame) -> DataFrame:
    """Annual premium with 30 % expense loading and present value at 3 %, by age and gender."""
    joined = applications.join(mortality, ["age", "gender"], "left")
    years = F.col("life_expectancy") - F.col("age")
    return joined.withColumns(
        {
            "annual_premium": F.col("face_amount").cast("double") * F.col("mortality_rate") * 1.30,
            "expected_payout_year": years,
            "present_value_benefits": F.col("face_amount").cast("double") * F.pow(F.lit(1.03), -years),
        }
    )


def penetration(policies: DataFrame, area: str) -> DataFrame:
    """Distinct policies per area."""
    return policies.groupBy(area).agg(F.countDistinct("policy_id").alias("current_policies"))


def market_opportunity(markets: DataFrame, current: DataFrame, area: str, n: int = 20) -> DataFrame:
    """Areas by affordability, size and untapped potential."""
    joined = markets.join(current, area, "left").fillna(0, ["current_policies"])
    scored = joined.withColumn("estimated_households", F.floor(F.col("population") / 2.5).cast("int")).withColumn(
        "penetration_rate", F.try_divide(F.col("current_policies") * 100.0, F.col("estimated_households").cast("double"))
    )
    score = (
        F.col("median_income").cast("double") / 50000 * 30
        + F.col("estimated_households") / 10000 * 40
        + (F.lit(100) - F.col("penetration_rate")) * 30
    )
    return top(scored.withColumn("opportunity_score", score), [F.col("opportunity_score").desc(), F.col(area)], n)


def late_payments(policies: DataFrame, payments: DataFrame, as_of: Column, days: int = 365, silent_days: int = 30) -> DataFrame:
    """Policies whose last payment of the year is over a month old, with their late payments.

    Payments are filtered to the year and summed per policy before the join.
    """
    today = as_of.cast("date")
    recent = payments.filter(F.col("payment_date").cast("date") >= F.date_sub(today, days))
    per_policy = recent.groupBy("policy_id").agg(
        F.count_if(F.col("payment_status") == "Late").alias("late_payments_12mo"),
        F.max("payment_date").alias("last_payment_date"),
    )
    return policies.join(per_policy, "policy_id", "left").filter(
        F.col("last_payment_date").cast("date") < F.date_sub(today, silent_days)
    )


def lapse_risk(at_risk: DataFrame, economy: DataFrame, as_of: Column) -> DataFrame:
    """Lapse score from payment history, the economy, age of the policy and delinquency."""
    days = F.datediff(as_of.cast("date"), F.col("last_payment_date").cast("date"))
    score = (
        F.col("late_payments_12mo") * 15
        + F.col("unemployment_rate") * 5
        + F.when(F.col("policy_duration_months") < 12, 20).otherwise(0)
        + F.when(days > 60, 30).otherwise(0)
    )
    scored = with_one_row(at_risk, economy).withColumn("lapse_risk_score", score)
    return scored.withColumn(
        "lapse_band", F.when(F.col("lapse_risk_score") > 50, "high").when(F.col("lapse_risk_score") >= 30, "medium").otherwise("low")
    )


def dataset_issues(log: DataFrame, catalogue: DataFrame, as_of: Column, max_age_days: int = 90) -> DataFrame:
    """External datasets that were unreachable or stale at the last checks."""
    return log.filter(
        (F.col("check_timestamp").cast("date") >= F.date_sub(as_of.cast("date"), 1))
        & (~F.col("is_accessible") | (F.col("freshness_days") > max_age_days))
    ).join(catalogue, "dataset_id")


def rank_datasets(candidates: DataFrame) -> DataFrame:
    """Ingest from 0.8, investigate from 0.6, else reject; by decision, then score."""
    score = F.col("relevance_score")
    decision = F.when(score >= 0.8, "ingest").when(score >= 0.6, "investigate").otherwise("reject")
    place = F.when(score >= 0.8, 0).when(score >= 0.6, 1).otherwise(2)
    return candidates.withColumns({"decision": decision, "decision_order": place}).orderBy(
        "decision_order", score.desc(), "dataset_id"
    )
