"""Insurance KPIs: loss ratio, high-risk policies, semantic measures, dashboards, gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.operators.aggregates import band, mean, share_pct, top, union_all, with_one_row

# Loss-ratio bands (percent) and the status colour of each.
LOSS_BANDS = ((70.0, "green"), (80.0, "yellow"), (100.0, "orange"))
# What to do with a policy above a loss ratio (percent).
RISK_ACTIONS = ((200.0, "cancel"), (175.0, "non_renew"))


def claims_per_policy(claims: DataFrame, policy: str, claim: str, amount: str) -> DataFrame:
    """Claim total, claim count and last date per policy, summed map-side before the shuffle."""
    return claims.groupBy(policy).agg(
        F.sum(amount).alias("claim_amount"),
        F.count(claim).alias("claim_count"),
        F.max("claim_date").alias("last_claim_date"),
    )


def loss_ratio(
    policies: DataFrame,
    claims: DataFrame,
    by: Sequence[str] = (),
    where: Column | None = None,
    as_joined: bool = False,
) -> DataFrame:
    """Claims over premiums in percent with counts and status.

    ``policies(policy_id, premium, ...)``, ``claims(policy_id, claim_id, claim_amount,
    claim_date)``. Claims are summed per policy before the join, so a policy's premium
    counts once and a policy without claims counts too. ``as_joined`` reproduces the plain
    join instead, which repeats a premium once per claim.
    """
    if as_joined:
        joined = policies.join(claims, "policy_id")
        if where is not None:
            joined = joined.filter(where)
        out = joined.groupBy(*by).agg(
            F.sum("claim_amount").alias("total_claims"),
            F.sum("premium").alias("total_premiums"),
            F.countDistinct("claim_id").alias("claim_count"),
            F.countDistinct("policy_id").alias("policy_count"),
        )
    else:
        kept = policies if where is None else policies.filter(where)
        per_policy = claims_per_policy(claims, "policy_id", "claim_id", "claim_amount")
        out = (
            kept.join(per_policy, "policy_id", "left")
            .groupBy(*by)
            .agg(
                F.sum("claim_amount").alias("total_claims"),
                F.sum("premium").alias("total_premiums"),
                F.sum(F.coalesce("claim_count", F.lit(0))).alias("claim_count"),
                F.count("policy_id").alias("policy_count"),
            )
        )
    ratio = F.try_divide(F.col("total_claims").cast("double"), F.col("total_premiums").cast("double")) * 100
    return out.withColumn("loss_ratio", F.coalesce(ratio, F.lit(0.0))).withColumn(
        "status", band(F.col("loss_ratio"), LOSS_BANDS, "red", below=True)
    )


def high_risk_policies(
    policies: DataFrame,
    customers: DataFrame,
    claims: DataFrame,
    min_loss_ratio: float = 150.0,
    min_claim_count: int = 2,
    n: int = 20,
) -> DataFrame:
    """Worst policies by loss ratio and what to do with them; names are joined to the top ``n`` only."""
    per_policy = claims_per_policy(claims, "policy_id", "claim_id", "claim_amount")
    ratio = F.col("claim_amount").cast("double") / F.col("premium").cast("double") * 100
    worst = (
        policies.join(per_policy, "policy_id")
        .withColumn("loss_ratio", ratio)
        .filter((F.col("loss_ratio") >= min_loss_ratio) & (F.col("claim_count") >= min_claim_count))
        .join(customers.select("customer_id"), "customer_id", "left_semi")
    )
    ranked = top(worst, [F.col("loss_ratio").desc(), F.col("policy_id")], n)
    return ranked.join(customers, "customer_id").select(
        "policy_id",
        "policy_type",
        "customer_id",
        "customer_name",
        "premium",
        F.col("claim_amount").alias("total_claims"),
        "claim_count",
        "loss_ratio",
        "last_claim_date",
        band(F.col("loss_ratio"), RISK_ACTIONS, "increase_premium").alias("action"),
    )


def recent_claims(claims: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    recent = claims.filter(F.col("claim_date") >= as_of - F.make_interval(days=F.lit(days)))
    return recent.agg(F.count("*").alias("total_claims"), F.sum("claim_amount").alias("total_amount"))


def premium_statistics(policies: DataFrame) -> DataFrame:
    return policies.agg(
        mean(F.col("premium")).alias("avg_premium"),
        F.min("premium").alias("min_premium"),
        F.max("premium").alias("max_premium"),
    )


def top_customers(policies: DataFrame, customers: DataFrame, n: int = 5) -> DataFrame:
    """Customers with the most premium; policies are summed per customer before the join."""
    per_customer = policies.groupBy("customer_id").agg(
        F.countDistinct("policy_id").alias("policy_count"), F.sum("premium").alias("total_premium")
    )
    named = (
        per_customer.join(customers, "customer_id")
        .groupBy("customer_name")
        .agg(F.sum("policy_count").alias("policy_count"), F.sum("total_premium").alias("total_premium"))
    )
    return top(named, [F.col("total_premium").desc(), F.col("customer_name")], n)


def customer_360(customers: DataFrame, policies: DataFrame, claims: DataFrame) -> DataFrame:
    """Totals over two facts per customer; each fact is summed first, so neither multiplies the other."""
    p = policies.groupBy("customer_id").agg(
        F.count("policy_id").alias("total_policies"), F.sum("premium").alias("total_premium")
    )
    c = claims.groupBy("customer_id").agg(
        F.count("claim_id").alias("total_claims"), F.sum("claim_amount").alias("total_claim_amount")
    )
    zero = F.lit(0).cast("bigint")
    return (
        customers.join(p, "customer_id", "left")
        .join(c, "customer_id", "left")
        .select(
            "customer_id",
            "customer_name",
            F.coalesce("total_policies", zero).alias("total_policies"),
            "total_premium",
            F.coalesce("total_claims", zero).alias("total_claims"),
            "total_claim_amount",
        )
    )


def kpi_status(values: DataFrame, kpis: Sequence[Mapping]) -> DataFrame:
    """Evaluate KPI formulas over one prepared join and grade each against its thresholds.

    ``lower_is_better`` follows from the thresholds: red above green means lower is better.
    """
    row = values.agg(*[F.expr(k["calculation_formula"]).cast("double").alias(f"k{i}") for i, k in enumerate(kpis)])

    def grade(k: Mapping, c: Column) -> Column:
        if k["threshold_red"] > k["threshold_green"]:
            return F.when(c <= k["threshold_green"], "green").when(c < k["threshold_red"], "yellow").otherwise("red")
        return F.when(c >= k["threshold_green"], "green").when(c > k["threshold_red"], "yellow").otherwise("red")

    lines = F.array(
        *[
            F.struct(
                F.lit(k["kpi_name"]).alias("kpi_name"),
                F.col(f"k{i}").alias("kpi_value"),
                F.lit(float(k["target_value"])).alias("target_value"),
                grade(k, F.col(f"k{i}")).alias("status"),
            )
            for i, k in enumerate(kpis)
        ]
    )
    return row.select(F.inline(lines))


def semantic_measures(policies: DataFrame, claims: DataFrame) -> DataFrame:
    """The named measures of the reporting model as one row."""
    p = policies.agg(
        F.sum("premium").alias("total_premium"),
        F.count("policy_id").alias("policy_count"),
        F.countDistinct("customer_id").alias("customer_count"),
    )
    c = claims.agg(F.sum("claim_amount").alias("total_claims"), F.count("claim_id").alias("claim_count"))
    ratio = F.try_divide(F.col("total_claims").cast("double"), F.col("total_premium").cast("double"))
    return with_one_row(p, c).withColumn("loss_ratio", ratio)


def metric_row(one: DataFrame, category: str, name: str, value: str, unit: str, target: float | None, status: Column) -> DataFrame:
    """A one-row aggregate as a row of the dashboard's long table."""
    return one.select(
        F.lit(category).alias("metric_category"),
        F.lit(name).alias("metric_name"),
        F.col(value).cast("double").alias("metric_value"),
        F.lit(unit).alias("metric_unit"),
        F.lit(target).cast("double").alias("target_value"),
        status.alias("status"),
    )


def executive_summary(
    claims_joined: DataFrame,
    active_policies: DataFrame,
    runs: DataFrame,
    scores: DataFrame,
    accesses: DataFrame,
) -> DataFrame:
    """Snapshot metrics in long format with target and status.

    ``claims_joined(claim_amount, premium)``, ``active_policies(premium)``,
    ``runs(status)``, ``scores(overall_score)``, ``accesses(data_classification)``, each
    already restricted to its period.
    """

    def falling(c: str, good: float, fair: float) -> Column:
        return band(F.col(c), ((good, "green"), (fair, "yellow")), "red", below=True)

    def rising(c: str, good: float, fair: float) -> Column:
        return F.when(F.col(c) >= good, "green").when(F.col(c) >= fair, "yellow").otherwise("red")

    loss = claims_joined.agg(
        F.coalesce(
            F.try_divide(F.sum("claim_amount").cast("double"), F.sum("premium").cast("double")) * 100, F.lit(0.0)
        ).alias("v")
    )
    premium = active_policies.agg(F.coalesce(F.sum("premium").cast("double"), F.lit(0.0)).alias("v"))
    success = runs.agg(F.coalesce(share_pct(F.col("status") == "succeeded"), F.lit(100.0)).alias("v"))
    quality = scores.agg(F.coalesce(mean(F.col("overall_score")), F.lit(100.0)).alias("v"))
    personal = accesses.agg(F.count_if(F.col("data_classification").isin("pii", "pci")).alias("v"))
    return union_all(
        [
            metric_row(loss, "financial", "Loss Ratio", "v", "percentage", 70.0, falling("v", 70, 85)),
            metric_row(premium, "financial", "Total Premium Volume", "v", "currency", None, F.lit("green")),
            metric_row(success, "operational", "Pipeline Success Rate (24h)", "v", "percentage", 95.0, rising("v", 95, 90)),
            metric_row(quality, "quality", "Average Data Quality Score", "v", "score", 90.0, rising("v", 90, 75)),
            metric_row(personal, "security", "PII/PCI Access Count (24h)", "v", "count", None, F.lit("green")),
        ]
    )


def deployment_gate(tests: DataFrame, scores: DataFrame, runs: DataFrame) -> DataFrame:
    """One row with the three rates and the verdict; a missing rate does not block."""
    t = tests.agg(share_pct(F.col("status") == "passed").alias("test_pass_rate"))
    q = scores.agg(mean(F.col("overall_score")).alias("dq_score"))
    r = runs.agg(share_pct(F.col("status") == "succeeded").alias("run_success_rate"))
    ok = [
        F.coalesce(F.col("test_pass_rate") >= 95, F.lit(True)),
        F.coalesce(F.col("dq_score") >= 90, F.lit(True)),
        F.coalesce(F.col("run_success_rate") >= 95, F.lit(True)),
    ]
    return (
        with_one_row(with_one_row(t, q), r)
        .withColumns({"tests_ok": ok[0], "dq_ok": ok[1], "runs_ok": ok[2]})
        .withColumn("gate_passed", F.col("tests_ok") & F.col("dq_ok") & F.col("runs_ok"))
    )


def test_summary(tests: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return tests.groupBy(*by).agg(
        F.count("*").alias("total_tests"),
        F.count_if(F.col("status") == "passed").alias("passed"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "error").alias("errors"),
        mean(F.col("duration_sec")).alias("avg_duration"),
        share_pct(F.col("status") == "passed").alias("pass_rate"),
    )


# ---- ontology ------------------------------------------------------------------------


def join_path(entities: Mapping[str, DataFrame], relationships: Sequence[Mapping], path: Sequence[str]) -> DataFrame:
    """Join entities along a path using the ``join_condition`` text of each relationship.

    A condition is ``left.column = right.column`` with entity names in lower case.
    """
    by_pair = {frozenset((r["source_entity"], r["target_entity"])): r for r in relationships}
    current = entities[path[0]].alias(path[0].lower())
    for a, b in zip(path, path[1:]):
        relation = by_pair[frozenset((a, b))]
        current = current.join(entities[b].alias(b.lower()), F.expr(relation["join_condition"]))
    return current
