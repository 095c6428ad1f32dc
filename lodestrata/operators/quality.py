"""Data-quality rules, scorecards, trend, referential and freshness checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.operators.aggregates import mean, share_pct, union_all
from lodestrata.operators.windows import trend

Rule = Mapping[str, Any]

# Accepted formats and the keyword that marks a uniqueness rule.
EMAIL_FORMAT = r"^[\w\._%+-]+@[\w\.-]+\.[A-Za-z]{2,}$"
SSN_FORMAT = r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"
UNIQUENESS = "UNIQUENESS"

# The seeded rules (name, column, dimension, category, check, tolerated failure rate).
SEED_RULES = (
    ("Policy Number Not Null", "policy_number", "completeness", "critical", "policy_number IS NOT NULL", 0.0),
    ("Policy Number Unique", "policy_number", "uniqueness", "critical", UNIQUENESS, 0.0),
    ("Premium Amount Positive", "premium_amount", "validity", "high", "premium_amount > 0", 0.0),
    ("Premium Within Expected Range", "premium_amount", "validity", "medium", "premium_amount BETWEEN 100 AND 100000", 0.05),
    ("Claim Reported After Loss", "reported_date", "consistency", "high", "reported_date >= loss_date", 0.01),
    ("Loss Amount Reasonable", "loss_amount", "accuracy", "medium", "loss_amount <= coverage_amount * 1.1", 0.02),
    ("Email Format Valid", "email", "validity", "high", f"email RLIKE r'{EMAIL_FORMAT}'", 0.05),
    ("SSN Format Valid", "ssn", "validity", "critical", f"ssn RLIKE r'{SSN_FORMAT}'", 0.0),
)


def seed_rules(columns: Sequence[str]) -> list[dict]:
    """Seeded rules whose columns all exist in a table with these columns."""
    names = ("rule_name", "column_name", "rule_type", "rule_category", "check_expression", "threshold_value")
    have = set(columns)
    needs = {"Claim Reported After Loss": {"loss_date"}, "Loss Amount Reasonable": {"coverage_amount"}}
    return [
        dict(zip(names, row)) for row in SEED_RULES if row[1] in have and needs.get(row[0], set()) <= have
    ]


def typed_check(rule: Rule) -> dict:
    """A ``column``/``rule`` pair as an expression rule."""
    c = rule["column"]
    checks = {
        "not_null": f"`{c}` IS NOT NULL",
        "positive": f"`{c}` > 0",
        "email_format": f"`{c}` RLIKE r'{EMAIL_FORMAT}'",
        "unique": UNIQUENESS,
    }
    return {
        "rule_name": f"{c}.{rule['rule']}",
        "column_name": c,
        "rule_type": rule["rule"],
        "rule_category": rule.get("category", "high"),
        "check_expression": checks[rule["rule"]],
        "threshold_value": float(rule.get("threshold", 0.0)),
    }


def _passes(expression: str, null_passes: bool) -> Column:
    return F.coalesce(F.expr(expression), F.lit(null_passes))


def _counts(df: DataFrame, rules: Sequence[Rule], null_passes: bool) -> DataFrame:
    """(rule position, total rows, failed rows): one scan for all expression rules.

    A uniqueness rule groups by its own column; NULL counts as one value.
    """
    parts = []
    plain = [(i, r) for i, r in enumerate(rules) if r["check_expression"] != UNIQUENESS]
    if plain:
        one = df.agg(
            F.count(F.lit(1)).alias("total_rows"),
            *[F.count_if(~_passes(r["check_expression"], null_passes)).alias(f"f{i}") for i, r in plain],
        )
        rows = F.array(*[F.struct(F.lit(i).alias("pos"), F.col(f"f{i}").alias("failed_rows")) for i, _ in plain])
        parts.append(one.select("total_rows", F.inline(rows)).select("pos", "total_rows", "failed_rows"))
    for i, r in enumerate(rules):
        if r["check_expression"] == UNIQUENESS:
            grouped = df.groupBy(r["column_name"]).agg(F.count(F.lit(1)).alias("n"))
            total = F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows")
            parts.append(
                grouped.agg(total, F.count(F.lit(1)).alias("d")).select(
                    F.lit(i).alias("pos"), "total_rows", (F.col("total_rows") - F.col("d")).alias("failed_rows")
                )
            )
    return union_all(parts)


def run_rules(df: DataFrame, table_name: str, rules: Sequence[Rule], null_passes: bool = True) -> DataFrame:
    """One result row per rule: failed rows, rate, verdict and score.

    ``null_passes`` states the NULL policy: a check that evaluates to NULL passes by default.
    """
    labels = df.sparkSession.createDataFrame(
        [
            (i, r["rule_name"], r["column_name"], r["rule_type"], r["rule_category"], float(r["threshold_value"]))
            for i, r in enumerate(rules)
        ],
        "pos int, rule_name string, column_name string, rule_type string, rule_category string, threshold_value double",
    )
    rate = F.coalesce(F.try_divide(F.col("failed_rows").cast("double"), F.col("total_rows").cast("double")), F.lit(0.0))
    return (
        _counts(df, rules, null_passes)
        .join(labels, "pos")
        .select(
            F.lit(table_name).alias("table_name"),
            "rule_name",
            "column_name",
            "rule_type",
            "rule_category",
            "total_rows",
            "failed_rows",
            rate.alias("failure_rate"),
            "threshold_value",
            (rate <= F.col("threshold_value")).alias("check_passed"),
            ((1.0 - rate) * 100.0).alias("quality_score"),
        )
    )


def scorecard(results: DataFrame, by: Sequence[str] = ("table_name",)) -> DataFrame:
    """Passed share and the mean score of each quality dimension per table."""
    dimensions = ("completeness", "uniqueness", "validity", "consistency", "accuracy")
    return results.groupBy(*by).agg(
        F.count("*").alias("total_rules"),
        F.count_if("check_passed").alias("passed_rules"),
        F.count_if(~F.col("check_passed")).alias("failed_rules"),
        share_pct(F.col("check_passed")).alias("overall_score"),
        *[
            F.avg(F.when(F.col("rule_type") == d, F.col("quality_score"))).alias(f"{d}_score")
            for d in dimensions
        ],
    )


def run_rules_for_tables(tables: Mapping[str, DataFrame], rules: Mapping[str, Sequence[Rule]]) -> DataFrame:
    return union_all([run_rules(tables[name], name, rules[name]) for name in rules if name in tables])


def quality_trend(scores: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Daily score per table over the last days with its direction; log rows are averaged per day first."""
    daily = (
        scores.filter(F.col("snapshot_date").cast("date") >= F.date_sub(as_of.cast("date"), days))
        .groupBy("table_name", F.col("snapshot_date").cast("date").alias("date"))
        .agg(mean(F.col("overall_score")).alias("overall_score"))
    )
    return trend(daily, ["table_name"], "date", "overall_score")


def completeness_pct(c: Column) -> Column:
    return share_pct(c.isNotNull())


def validity_pct(cond: Column) -> Column:
    return share_pct(F.coalesce(cond, F.lit(False)))


def flag_violations(df: DataFrame, rules: Sequence[Rule], null_passes: bool = True) -> DataFrame:
    """Add ``_dq_failed``, the names of the rules a row breaks."""
    names = F.array(
        *[F.when(~_passes(r["check_expression"], null_passes), r["rule_name"]) for r in rules if r["check_expression"] != UNIQUENESS]
    )
    return df.withColumn("_dq_failed", F.array_compact(names))


def quarantine(df: DataFrame, rules: Sequence[Rule], null_passes: bool = True) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rows to quarantine with the rules they broke)."""
    flagged = flag_violations(df, rules, null_passes)
    return flagged.filter(F.size("_dq_failed") == 0).drop("_dq_failed"), flagged.filter(F.size("_dq_failed") > 0)


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Referential rule: child rows and failures per table; a NULL key is no orphan.

    Children are counted per key before the join, so a hot key crosses it as one row.
    """
    per_key = child.groupBy(key).agg(F.count("*").alias("n"))
    missing = per_key.filter(F.col(key).isNotNull()).join(parent.select(key).distinct(), key, "left_anti")
    lost = missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failed_rows"), F.count("*").alias("failed_keys"))
    totals = per_key.agg(F.sum("n").alias("total_rows"))
    return totals.withColumns({c: lost.select(c).scalar() for c in lost.columns})


def volume_check(df: DataFrame, low: int, high: int) -> DataFrame:
    return df.agg(F.count("*").alias("row_count")).withColumn(
        "check_passed", (F.col("row_count") >= low) & (F.col("row_count") <= high)
    )


def freshness_check(df: DataFrame, ts: str, as_of: Column, max_minutes: int, by: Sequence[str] = ()) -> DataFrame:
    """Minutes since the newest row and whether that is within the limit."""
    newest = df.groupBy(*by).agg(F.max(ts).alias("last_update"))
    age = F.floor((F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("last_update").cast("timestamp"))) / 60000000)
    return newest.withColumn("staleness_minutes", age).withColumn("is_stale", F.col("staleness_minutes") > max_minutes)


def failure_sample(df: DataFrame, expression: str, order: Sequence[Column], n: int = 10) -> DataFrame:
    """The first failing rows of a rule, as a report for its owner."""
    return df.filter(~F.expr(expression)).orderBy(*order).limit(n)
