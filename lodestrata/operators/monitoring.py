"""Run tracking, error classes, anomalies, health scores, incidents, routing, capacity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.operators.aggregates import (
    mean,
    rank_of,
    share_or_full,
    share_pct,
    union_all,
    with_one_row,
)
from lodestrata.operators.cooldown import firings_with_cooldown
from lodestrata.operators.profile import asset_criticality
from lodestrata.operators.rules import within
from lodestrata.operators.history import keep_latest
from lodestrata.operators.windows import best_at, latest_per_key, micros, rolling_mean

# Words in an error message and the class they point to, in the order tried.
ERROR_CLASSES = (
    ("transient", ("timeout", "throttl", "429", "503", "connection reset", "temporary", "retry", "capacity", "busy")),
    ("auth", ("auth", "401", "403", "permission")),
    ("data", ("schema", "column", "type mismatch", "parse")),
    ("config", ("not found", "missing", "config")),
)
# The coarser classes of the run tracker.
RUN_ERROR_CLASSES = (
    ("timeout", ("timeout",)),
    ("infrastructure", ("connection", "network")),
    ("data", ("schema", "column")),
)
SEVERITY_OF = {"critical": "P1_critical", "high": "P2_high", "medium": "P3_medium", "low": "P4_low"}
ROLE_ORDER = ("on_call_primary", "on_call_secondary", "team_lead")


def error_class(message: Column, classes=ERROR_CLASSES) -> Column:
    """Class of an error message by the first word list that matches."""
    lowered, out = F.lower(message), None
    for name, words in classes:
        hit = lowered.rlike("|".join(words))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("unknown")


def severity_of(criticality: Column) -> Column:
    mapping = F.create_map(*[F.lit(x) for kv in SEVERITY_OF.items() for x in kv])
    return F.coalesce(mapping[criticality], F.lit("P3_medium"))


def track_runs(runs: DataFrame, registry: DataFrame) -> DataFrame:
    """Runs with error class and SLA verdict; no SLA on record means met."""
    joined = runs.join(registry.select("asset_id", "sla_completion_minutes"), "asset_id", "left")
    return joined.withColumns(
        {
            "error_category": F.when(F.col("error_message").isNotNull(), error_class(F.col("error_message"), RUN_ERROR_CLASSES)),
            "sla_met": F.coalesce(F.col("duration_seconds") <= F.col("sla_completion_minutes") * 60, F.lit(True)),
        }
    )


def execution_anomalies(
    runs: DataFrame,
    as_of: Column,
    recent: str = "4 HOURS",
    history: str = "30 DAYS",
    sigmas: float = 3.0,
    recent_in_baseline: bool = False,
) -> DataFrame:
    """Recent successful runs far from their asset's history in duration or volume.

    One pass gives the history statistics (one row per asset), which meet the recent runs.
    Recent runs stay out of their own baseline unless asked for.
    """
    ok = runs.filter(F.col("status") == "succeeded")
    start = F.col("start_time")
    past = within(start, as_of, history) & (F.lit(True) if recent_in_baseline else ~within(start, as_of, recent))
    base = ok.filter(past).groupBy("asset_id").agg(
        F.avg("duration_seconds").alias("avg_duration"),
        F.stddev("duration_seconds").alias("std_duration"),
        F.avg("records_written").alias("avg_records"),
        F.stddev("records_written").alias("std_records"),
    )
    spread_d = sigmas * F.coalesce(F.col("std_duration"), F.lit(0.0))
    spread_r = sigmas * F.coalesce(F.col("std_records"), F.lit(0.0))
    kind = (
        F.when(F.col("duration_seconds") > F.col("avg_duration") + spread_d, "duration_spike")
        .when(F.col("records_written") < F.col("avg_records") - spread_r, "low_volume")
        .when(F.col("records_written") > F.col("avg_records") + spread_r, "high_volume")
    )
    return (
        ok.filter(within(start, as_of, recent))
        .join(base, "asset_id")
        .withColumn("anomaly_type", kind)
        .filter(F.col("anomaly_type").isNotNull())
    )


def failure_rates(runs: DataFrame, assets: DataFrame, as_of: Column, period: str = "24 HOURS") -> DataFrame:
    """Monitored assets failing more often than their SLA allows; runs are counted before the join."""
    counted = runs.filter(within(F.col("start_time"), as_of, period)).groupBy("asset_id").agg(
        F.count("*").alias("total_runs"), F.count_if(F.col("status") == "failed").alias("failed_runs")
    )
    rate = F.col("failed_runs").cast("double") / F.col("total_runs")
    return (
        assets.filter("monitoring_enabled")
        .join(counted, "asset_id")
        .withColumn("failure_rate", rate)
        .filter(F.col("failure_rate") > F.col("sla_max_failure_rate"))
        .select("asset_id", "asset_name", "sla_max_failure_rate", "total_runs", "failed_runs", "failure_rate")
    )


def domain_health(
    runs: DataFrame,
    quality: DataFrame,
    sla: DataFrame,
    assets: DataFrame,
    as_of: Column,
    period: str = "24 HOURS",
    freshness: DataFrame | None = None,
) -> DataFrame:
    """Health of each domain: 40 % runs, 30 % quality, 20 % SLA, 10 % freshness (missing = 100).

    Logs are counted per asset before they meet the asset list.
    """

    def per_asset(df: DataFrame, ts: str, good: Column) -> DataFrame:
        return df.filter(within(F.col(ts), as_of, period)).groupBy("asset_id").agg(
            F.count_if(good).alias("good"), F.count("*").alias("n")
        )

    def per_domain(df: DataFrame, name: str) -> DataFrame:
        return (
            df.join(assets.select("asset_id", "domain"), "asset_id")
            .groupBy("domain")
            .agg((F.lit(100.0) * F.sum("good") / F.sum("n")).alias(name))
        )

    p = per_domain(per_asset(runs, "start_time", F.col("status") == "succeeded"), "pipeline_pct")
    s = per_domain(per_asset(sla, "measurement_time", F.col("sla_met")), "sla_pct")
    d = (
        quality.filter(within(F.col("execution_start"), as_of, period))
        .groupBy("domain")
        .agg(mean(F.col("pass_percentage")).alias("dq_pct"))
    )
    out = p.join(d, "domain", "full").join(s, "domain", "full")
    if freshness is not None:
        out = out.join(freshness.groupBy("domain").agg(share_pct(~F.col("is_stale")).alias("fresh_pct")), "domain", "full")
    else:
        out = out.withColumn("fresh_pct", F.lit(100.0))
    full = {c: F.coalesce(F.col(c), F.lit(100.0)) for c in ("pipeline_pct", "dq_pct", "sla_pct", "fresh_pct")}
    out = out.withColumns(full)
    score = F.col("pipeline_pct") * 0.4 + F.col("dq_pct") * 0.3 + F.col("sla_pct") * 0.2 + F.col("fresh_pct") * 0.1
    return out.select("domain", F.round(score, 1).alias("health_score"), "pipeline_pct", "dq_pct", "sla_pct")


def platform_health(runs: DataFrame, scores: DataFrame, freshness: DataFrame, as_of: Column) -> DataFrame:
    """Platform score: 35 % runs, 30 % quality, 20 % freshness, 15 % SLA.

    Quality and freshness use the newest row per table, taken in one aggregation.
    """
    day = runs.filter(within(F.col("start_time"), as_of, "24 HOURS"))
    r = day.agg(
        F.count("*").alias("total_pipelines"),
        F.count_if(F.col("status") == "succeeded").alias("successful_pipelines"),
        F.count_if(F.col("status") == "failed").alias("failed_pipelines"),
        F.count_if("sla_met").alias("pipelines_in_sla"),
        share_or_full(F.col("status") == "succeeded").alias("pipeline_health_score"),
        share_or_full(F.col("sla_met")).alias("sla_compliance_score"),
    )
    q = latest_per_key(scores, ["table_name"], "snapshot_date", ["overall_score"]).agg(
        F.coalesce(mean(F.col("overall_score")), F.lit(100.0)).alias("data_quality_score")
    )
    f = latest_per_key(freshness, ["table_name"], "check_timestamp", ["is_stale"]).agg(
        F.count_if("is_stale").alias("stale_tables"), share_or_full(~F.col("is_stale")).alias("data_freshness_score")
    )
    out = with_one_row(with_one_row(r, q), f)
    score = (
        F.col("pipeline_health_score") * 0.35
        + F.col("data_quality_score") * 0.30
        + F.col("data_freshness_score") * 0.20
        + F.col("sla_compliance_score") * 0.15
    )
    return out.withColumn("overall_health_score", score)


def incidents_from_failures(runs: DataFrame, open_incidents: DataFrame, as_of: Column, period: str = "1 HOUR") -> DataFrame:
    """Distinct recent failures of assets that have no open incident yet."""
    failures = (
        runs.filter((F.col("status") == "failed") & within(F.col("start_time"), as_of, period))
        .select("asset_name", "error_message")
        .distinct()
        .withColumn("error_category", error_class(F.col("error_message")))
    )
    known = open_incidents.filter(F.col("status") == "open").select("asset_name").distinct()
    return failures.join(known, "asset_name", "left_anti").select(
        F.concat(F.lit("INC-"), F.md5(F.concat_ws("|", "asset_name", "error_message"))).alias("incident_id"),
        F.lit("pipeline_failure").alias("incident_type"),
        F.lit("high").alias("severity"),
        F.concat(F.lit("Pipeline Failure: "), "asset_name").alias("title"),
        "asset_name",
        "error_category",
    )


def route_alerts(alerts: DataFrame, shifts: DataFrame, ts: str) -> DataFrame:
    """The on-call member with the highest role at the time of each alert (NULL when nobody is)."""
    active = shifts.filter(F.col("is_on_call") & F.col("is_active"))
    order = [rank_of(F.col("role"), ROLE_ORDER), F.col("team_member")]
    return best_at(alerts, active, ts, "shift_start", "shift_end", order, ["team_member", "role"])


def retry_decision(failures: DataFrame) -> DataFrame:
    """Retry transient failures while the asset allows it, otherwise open an incident."""
    retry = (
        (F.col("error_category") == "transient")
        & F.coalesce(F.col("auto_retry_enabled"), F.lit(False))
        & (F.col("retry_count") < F.col("max_auto_retries"))
    )
    return failures.withColumn("decision", F.when(retry, "retry").otherwise("incident"))


def session_flags(sessions: DataFrame, as_of: Column) -> DataFrame:
    """Idle for over 240 minutes: zombie; busy for over 360 minutes: stuck."""
    minutes = F.floor((micros(as_of) - micros(F.col("start_time"))) / 60_000_000)
    flag = F.when((F.col("state") == "idle") & (F.col("minutes") > 240), "zombie_session").when(
        (F.col("state") == "busy") & (F.col("minutes") > 360), "stuck_session"
    )
    return sessions.withColumn("minutes", minutes).withColumn("flag", flag)


def sla_breaches(runs: DataFrame, assets: DataFrame, as_of: Column) -> DataFrame:
    """Runs still in progress past their SLA."""
    minutes = F.floor((micros(as_of) - micros(F.col("start_time"))) / 60_000_000)
    return (
        runs.filter(F.col("status") == "in_progress")
        .join(assets.select("asset_id", "sla_max_duration_min"), "asset_id")
        .withColumn("running_minutes", minutes)
        .filter(F.col("running_minutes") > F.col("sla_max_duration_min"))
    )


def register_assets(found: DataFrame, known: DataFrame) -> DataFrame:
    """New assets with inferred criticality; known ones are left alone."""
    fresh = keep_latest(found, ["asset_id"], [F.col("asset_name"), F.col("asset_type")]).join(known.select("asset_id"), "asset_id", "left_anti")
    return fresh.withColumn("criticality", asset_criticality(F.col("asset_name"), F.col("asset_type")))


def mirror_issues(health: DataFrame, max_lag_seconds: int = 300) -> DataFrame:
    """Mirrors that are unhealthy, lag or report an error."""
    return health.withColumns(
        {"high_lag": F.col("replication_lag_seconds") > max_lag_seconds, "has_error": F.col("error_message").isNotNull()}
    ).filter((F.col("status") != "Healthy") | F.col("high_lag") | F.col("has_error"))


def mirror_count_difference(source: DataFrame, target: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows in source and target per group and their difference."""
    s = source.groupBy(*by).agg(F.count("*").alias("source_rows"))
    t = target.groupBy(*by).agg(F.count("*").alias("target_rows"))
    both = s.join(t, list(by), "full")
    zero = F.lit(0).cast("bigint")
    return both.select(
        *by,
        F.coalesce("source_rows", zero).alias("source_rows"),
        F.coalesce("target_rows", zero).alias("target_rows"),
        (F.coalesce("source_rows", zero) - F.coalesce("target_rows", zero)).alias("missing_rows"),
    )


def cost_recommendations(files: DataFrame, as_of: Column, max_files: int = 100, max_age_days: int = 90) -> DataFrame:
    """Tables to compact (many files) or to archive (not modified for long)."""
    age = F.datediff(as_of.cast("date"), F.col("last_modified").cast("date"))
    advice = F.array_compact(
        F.array(
            F.when(F.col("num_files") > max_files, F.lit("optimize")),
            F.when(F.col("age_days") > max_age_days, F.lit("archive_candidate")),
        )
    )
    return files.withColumn("age_days", age).select("*", F.explode(advice).alias("recommendation"))


def monitoring_cycle(runs: DataFrame, assets: DataFrame, open_incidents: DataFrame, as_of: Column) -> dict[str, DataFrame]:
    """All checks of one cycle over landed logs; the caller persists ``runs`` if it is costly."""
    return {
        "anomalies": execution_anomalies(runs, as_of),
        "failure_rates": failure_rates(runs, assets, as_of),
        "incidents": incidents_from_failures(runs, open_incidents, as_of),
        "sla_breaches": sla_breaches(runs, assets, as_of),
    }


def cycle_summary(checks: Mapping[str, DataFrame]) -> DataFrame:
    """Finding counts of a cycle, one row per check."""
    return union_all(
        [df.agg(F.count("*").alias("findings")).select(F.lit(name).alias("check_name"), "findings") for name, df in checks.items()]
    )


# ---- alert rules ---------------------------------------------------------------------


def evaluate_alerts(tables: Mapping[str, DataFrame], rules: Sequence[Mapping]) -> DataFrame:
    """Rows meeting each rule's condition, reduced to firings outside the rule's cooldown.

    A rule names ``table``, ``condition``, ``ts``, ``entity`` and ``cooldown_minutes``. Rules
    over one table with one cooldown share a scan. The next firing of an entity comes with the first hit at
    least the cooldown after its last firing, so a lasting failure is reported again and again.
    """
    groups: dict[tuple[str, int], list[Mapping]] = {}
    for r in rules:
        if r.get("is_active", True):
            groups.setdefault((r["table"], int(r.get("cooldown_minutes", 0))), []).append(r)

    def firing(r: Mapping) -> Column:
        row = F.struct(
            F.lit(r["alert_id"]).alias("alert_id"),
            F.lit(r["severity"]).alias("severity"),
            F.col(r["entity"]).cast("string").alias("entity"),
            F.col(r["ts"]).alias("fired_at"),
        )
        return F.when(F.expr(r["condition"]), row)

    parts = []
    for (table, cooldown), members in groups.items():
        fired = F.array_compact(F.array(*[firing(r) for r in members]))
        hits = tables[table].select(F.inline(fired))
        parts.append(firings_with_cooldown(hits, ["alert_id", "severity", "entity"], "fired_at", cooldown))
    return union_all(parts)


# ---- capacity ------------------------------------------------------------------------

# Sizes in order with capacity units and hourly cost.
SIZES = (
    ("F2", 2, 0.36),
    ("F4", 4, 0.72),
    ("F8", 8, 1.44),
    ("F16", 16, 2.88),
    ("F32", 32, 5.76),
    ("F64", 64, 11.52),
    ("F128", 128, 23.04),
    ("F256", 256, 46.08),
    ("F512", 512, 92.16),
    ("F1024", 1024, 184.32),
    ("F2048", 2048, 368.64),
)


def _size_index(c: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s[0]) for s in SIZES]), c).cast("int")


def _size_at(i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s[0]) for s in SIZES]), i)


def size_cost(c: Column) -> Column:
    costs = F.create_map(*[F.lit(x) for name, _, cost in SIZES for x in (name, cost)])
    return costs[c]


def scale_recommendation(usage: DataFrame, config: DataFrame, lookback_minutes: int = 30) -> DataFrame:
    """Next size up or down from the latest rolling use, clamped to the allowed range."""
    rolled = rolling_mean(usage, ["capacity_id"], "ts", "cu_usage_pct", lookback_minutes, "usage_pct")
    now = latest_per_key(rolled, ["capacity_id"], "ts", ["usage_pct"])
    index = _size_index(F.col("current_size"))
    wanted = (
        F.when(F.col("usage_pct") > F.col("scale_up_pct"), index + 1)
        .when(F.col("usage_pct") < F.col("scale_down_pct"), index - 1)
        .otherwise(index)
    )
    clamped = F.least(F.greatest(wanted, _size_index(F.col("min_size"))), _size_index(F.col("max_size")))
    return (
        config.join(now, "capacity_id")
        .withColumn("target_size", _size_at(clamped))
        .withColumn(
            "action",
            F.when(_size_index(F.col("target_size")) > index, "scale_up")
            .when(_size_index(F.col("target_size")) < index, "scale_down")
            .otherwise("no_change"),
        )
        .withColumn("cost_delta", size_cost(F.col("target_size")) - size_cost(F.col("current_size")))
    )


def budget_projection(config: DataFrame, day_of_month: Column) -> DataFrame:
    """Spend projected to 30 days against the budget with 10 % tolerance."""
    projected = F.col("month_spend").cast("double") / F.greatest(day_of_month, F.lit(1)) * 30
    return config.withColumn("projected_spend", projected).withColumn(
        "action",
        F.when(F.col("projected_spend") > F.col("monthly_budget") * 1.1, "budget_scale_down").otherwise("within_budget"),
    )


def idle_capacities(usage: DataFrame, as_of: Column, idle_minutes: int) -> DataFrame:
    """Capacities whose last activity is too long ago."""
    busy = usage.filter((F.col("sessions") > 0) | (F.col("notebooks") > 0) | (F.col("pipelines") > 0))
    return (
        busy.groupBy("capacity_id")
        .agg(F.max("ts").alias("last_activity"))
        .withColumn("idle_minutes", (micros(as_of) - micros(F.col("last_activity"))) / 60_000_000)
        .filter(F.col("idle_minutes") > idle_minutes)
    )


def schedule_decision(config: DataFrame, shifts: DataFrame, as_of: Column) -> DataFrame:
    """Weekend size on weekends; minimum size for dev/test when nobody is on shift."""
    on_shift = shifts.filter(
        F.col("is_active") & (F.col("shift_start") <= as_of) & (F.col("shift_end") >= as_of)
    ).agg(F.count("*").alias("n"))
    weekend = F.weekday(as_of) >= 5
    target = F.when(
        weekend & F.col("weekend_size").isNotNull() & (F.col("weekend_size") != F.col("current_size")), F.col("weekend_size")
    ).when((F.col("on_shift") == 0) & F.col("environment").isin("dev", "test"), F.col("min_size"))
    return config.withColumn("on_shift", on_shift.scalar()).withColumn("target_size", target)


def throttled(usage: DataFrame, limit_pct: float = 10.0) -> DataFrame:
    return usage.withColumn("is_throttled", F.col("throttle_pct") > limit_pct)


def scale_events(events: DataFrame) -> DataFrame:
    """Cost effect of each size change."""
    return events.withColumn("cost_impact", size_cost(F.col("to_size")) - size_cost(F.col("from_size")))
