"""Access analytics: baselines, anomalies, flags, dashboards, audit rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.operators.aggregates import union_all
from lodestrata.operators.history import conditional_update
from lodestrata.operators.rules import within
from lodestrata.operators.security import personal_columns

GB = 1024.0 * 1024.0 * 1024.0


def gigabytes(c: Column) -> Column:
    return F.sum(c).cast("double") / GB


def access_baseline(log: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Usual hours, tables and operations of each user and their daily means.

    The sets are bounded by the number of hours, tables and operations, not by events.
    """
    recent = log.filter(F.col("ts").cast("date") >= F.date_sub(as_of.cast("date"), days))
    return recent.groupBy("user_id").agg(
        F.sort_array(F.collect_set(F.hour("ts"))).alias("typical_hours"),
        F.sort_array(F.collect_set("table_name")).alias("typical_resources"),
        F.sort_array(F.collect_set("operation")).alias("typical_operations"),
        (F.count("*") / F.lit(float(days))).alias("avg_daily_queries"),
        (gigabytes(F.col("bytes_scanned")) / days).alias("avg_daily_data_gb"),
    )


def unusual_hours(log: DataFrame, baseline: DataFrame, as_of: Column, period: str = "1 HOUR") -> DataFrame:
    """Accesses at an hour outside the user's baseline, or by a user without one."""
    hour = F.hour("ts")
    return (
        log.filter(within(F.col("ts"), as_of, period))
        .join(baseline.select("user_id", "typical_hours"), "user_id", "left")
        .filter(F.col("typical_hours").isNull() | ~F.array_contains("typical_hours", hour))
        .select(
            "event_id", "user_id", "ts", hour.alias("access_hour"), "operation", "table_name",
            F.lit("unusual_time").alias("anomaly_type"), F.lit(0.75).alias("anomaly_score"),
        )
    )


def excessive_volume(log: DataFrame, as_of: Column, threshold_gb: float = 100.0, period: str = "1 HOUR") -> DataFrame:
    """Users who scanned more than the threshold; the score is how many times over."""
    return (
        log.filter(within(F.col("ts"), as_of, period))
        .groupBy("user_id")
        .agg(
            F.count("*").alias("query_count"),
            gigabytes(F.col("bytes_scanned")).alias("total_gb_scanned"),
            F.sort_array(F.collect_set("table_name")).alias("tables_accessed"),
        )
        .filter(F.col("total_gb_scanned") > threshold_gb)
        .withColumns(
            {"anomaly_type": F.lit("excessive_data_access"), "anomaly_score": F.col("total_gb_scanned") / threshold_gb}
        )
    )


def privilege_escalation(control_log: DataFrame, as_of: Column, period: str = "1 HOUR") -> DataFrame:
    """Grants and creations of roles or permissions with high severity."""
    return control_log.filter(
        within(F.col("ts"), as_of, period)
        & F.col("operation").isin("grant", "create")
        & F.col("resource_type").isin("role", "permission")
        & (F.col("severity") == "high")
    ).withColumns({"anomaly_type": F.lit("privilege_escalation"), "anomaly_score": F.lit(0.95)})


def personal_mass_export(log: DataFrame, as_of: Column, row_threshold: int = 10000, period: str = "1 HOUR") -> DataFrame:
    """Users who read more rows of personal data than the threshold."""
    return (
        log.filter(within(F.col("ts"), as_of, period) & F.col("pii_accessed"))
        .groupBy("user_id")
        .agg(
            F.count("*").alias("pii_queries"),
            F.sum("row_count").alias("total_pii_rows"),
            F.sort_array(F.collect_set("table_name")).alias("pii_tables"),
        )
        .filter(F.col("total_pii_rows") > row_threshold)
        .withColumns({"anomaly_type": F.lit("pii_mass_export"), "anomaly_score": F.lit(0.90)})
    )


def anomaly_rows(anomalies: DataFrame, at: Column) -> DataFrame:
    """Anomalies in the shape of the tracking table; the id is unique to its content."""
    details = F.to_json(F.struct("*"))
    return anomalies.select(
        F.concat(F.col("anomaly_type"), F.lit("_"), F.substring(F.sha2(details, 256), 1, 16)).alias("anomaly_id"),
        at.alias("detected_timestamp"),
        F.lit("data").alias("access_type"),
        "user_id",
        "anomaly_type",
        F.col("anomaly_score").cast("double").alias("anomaly_score"),
        details.alias("details"),
        F.lit("new").alias("resolution_status"),
    )


def all_anomalies(log: DataFrame, control_log: DataFrame, baseline: DataFrame, as_of: Column, at: Column,
                  threshold_gb: float = 100.0, row_threshold: int = 10000, period: str = "1 HOUR") -> DataFrame:
    """Every check in one table."""
    return union_all(
        [
            anomaly_rows(unusual_hours(log, baseline, as_of, period), at),
            anomaly_rows(excessive_volume(log, as_of, threshold_gb, period), at),
            anomaly_rows(privilege_escalation(control_log, as_of, period), at),
            anomaly_rows(personal_mass_export(log, as_of, row_threshold, period), at),
        ]
    )


def flag_users(log: DataFrame, users: DataFrame, as_of: Column, period: str = "1 HOUR") -> DataFrame:
    """Set the flag and its reason on recent accesses of the given users.

    ``users(user_id, reason)`` is reduced to one reason per user before the join.
    """
    reasons = users.groupBy("user_id").agg(F.min("reason").alias("_reason"))
    joined = log.join(reasons, "user_id", "left")
    hit = F.col("_reason").isNotNull() & within(F.col("ts"), as_of, period)
    return conditional_update(joined, hit, {"flagged": F.lit(True), "flag_reason": F.col("_reason")}).select(*log.columns)


def users_to_flag(anomalies: DataFrame, min_score: float = 0.9) -> DataFrame:
    """Users whose new anomalies are severe enough to flag without a person looking first."""
    severe = anomalies.filter((F.col("anomaly_score") >= min_score) & (F.col("resolution_status") == "new"))
    return severe.select("user_id", F.concat(F.lit("Automatic flag: "), "anomaly_type").alias("reason")).distinct()


def clear_flags(log: DataFrame, user_id, notes: str) -> DataFrame:
    hit = (F.col("user_id") == user_id) & F.col("flagged")
    return conditional_update(log, hit, {"flagged": F.lit(False), "flag_reason": F.lit(f"Cleared: {notes}")})


def revocation_row(spark: SparkSession, user_id: str, reason: str, at: Column) -> DataFrame:
    """Log row of a revocation (the grant itself lives outside Spark)."""
    return spark.createDataFrame([(user_id, "revoke", reason)], "user_id string, operation string, reason string").withColumn("ts", at)


def flagged_accesses(compute: DataFrame, data: DataFrame, control: DataFrame, severity: str | None = None) -> DataFrame:
    """Flagged events of the three logs; a severity filter applies to all of them.

    Only the control log records severities, so the other two have none to match.
    """

    def part(df: DataFrame, kind: str, resource: str) -> DataFrame:
        level = F.col("severity") if "severity" in df.columns else F.lit(None).cast("string")
        return df.filter("flagged").select(
            F.lit(kind).alias("access_type"), "event_id", "user_id", F.col(resource).alias("resource_name"),
            "operation", "ts", "flag_reason", level.alias("severity"),
        )

    every = union_all([part(compute, "compute", "resource_name"), part(data, "data", "table_name"), part(control, "control", "resource_name")])
    return every.filter(F.col("severity") == severity) if severity else every


def active_sessions(compute: DataFrame, as_of: Column, period: str = "1 HOUR") -> DataFrame:
    return compute.filter(within(F.col("ts"), as_of, period)).groupBy("user_id").agg(
        F.countDistinct("session_id").alias("active_sessions"),
        F.count("*").alias("total_operations"),
        F.max("ts").alias("last_activity"),
    )


def data_access_summary(log: DataFrame, as_of: Column, period: str = "1 HOUR") -> DataFrame:
    return log.filter(within(F.col("ts"), as_of, period)).groupBy("user_id", "operation").agg(
        F.count("*").alias("operation_count"),
        F.sum("row_count").alias("total_rows"),
        gigabytes(F.col("bytes_scanned")).alias("total_gb_scanned"),
        F.countDistinct("table_name").alias("tables_accessed"),
    )


def recent_events(log: DataFrame, condition: Column, as_of: Column, period: str, n: int) -> DataFrame:
    """Newest events meeting a condition (a top-n report)."""
    return log.filter(condition & within(F.col("ts"), as_of, period)).orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(n)


def logging_health(logs: Mapping[str, DataFrame], as_of: Column, period: str = "1 HOUR") -> DataFrame:
    """Events and last event per log; a silent log is a warning."""
    return union_all(
        [
            df.filter(within(F.col("ts"), as_of, period))
            .agg(F.count("*").alias("event_count"), F.max("ts").alias("last_event"))
            .select(
                F.lit(name).alias("log_type"), "event_count", "last_event",
                F.when(F.col("event_count") == 0, "warning").otherwise("healthy").alias("status"),
            )
            for name, df in logs.items()
        ]
    )


def compliance_by_user(log: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """What each user did in the period, for auditors."""
    recent = log.filter(F.col("ts").cast("date") >= F.date_sub(as_of.cast("date"), days))
    return recent.groupBy("user_id").agg(
        F.countDistinct(F.col("ts").cast("date")).alias("days_active"),
        F.count("*").alias("total_operations"),
        F.count_if(F.col("operation") == "read").alias("read_operations"),
        F.count_if(F.col("operation") == "write").alias("write_operations"),
        F.count_if("pii_accessed").alias("pii_access_count"),
        F.count_if("flagged").alias("flagged_operations"),
        F.countDistinct("table_name").alias("unique_tables_accessed"),
        F.sum("row_count").alias("total_rows_accessed"),
        gigabytes(F.col("bytes_scanned")).alias("total_gb_scanned"),
    )


def personal_access_list(log: DataFrame, as_of: Column, days: int = 365) -> DataFrame:
    return log.filter(F.col("pii_accessed") & (F.col("ts").cast("date") >= F.date_sub(as_of.cast("date"), days))).select(
        "event_id", "user_id", "table_name", "row_count", "ts", "flagged", "flag_reason"
    )


ACCESS_LOG = (
    "user_id string, operation string, table_name string, sensitive_columns array<string>, pii_accessed boolean"
)


def tracked_read(spark: SparkSession, name: str, df: DataFrame, user_id: str, at: Column) -> tuple[DataFrame, DataFrame]:
    """A table together with the log row that records its reading."""
    personal = personal_columns(df.columns)
    row = spark.createDataFrame([(user_id, "read", name, personal, bool(personal))], ACCESS_LOG).withColumn("ts", at)
    return df, row


def classify_accesses(accesses: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Log rows per accessed column with its classification (public when not catalogued)."""
    columns = accesses.withColumn("column_name", F.explode("columns")).drop("columns")
    labels = catalogue.groupBy("table_name", "column_name").agg(F.min("data_classification").alias("data_classification"))
    return columns.join(labels, ["table_name", "column_name"], "left").withColumn(
        "data_classification", F.coalesce("data_classification", F.lit("public"))
    )


def assignment_audit(assignments: DataFrame, at: Column) -> DataFrame:
    """Landed role assignments as audit rows."""
    return assignments.select(
        F.sha2(F.concat_ws("|", "workspace_id", "principal_id", "role"), 256).alias("audit_id"),
        "workspace_id", "principal_id", "principal_type", "role",
        F.lower("role").isin("admin", "owner").alias("is_privileged"),
        at.alias("audited_at"),
    )
