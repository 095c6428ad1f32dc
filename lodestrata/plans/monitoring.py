"""Run monitoring, health scores, incidents, alerts and capacity."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lodestrata.operators import kpi, mergeable, monitoring, profile
from lodestrata.operators.rules import within
from lodestrata.plans import bindings as b
from lodestrata.plans.bindings import ACCESS, ASSETS, CLAIM, POLICY, RUNS, with_sql
from lodestrata.plans.registry import at, plain, query, table
from lodestrata.session import shared_folder
from lodestrata.sources.writers import write_load

NOW = b.EVENTS_AS_OF
NOW_SQL = f"TIMESTAMP '{NOW}'"


def _class_sql(c, classes):
    whens = " ".join(f"WHEN regexp_matches(lower({c}), '{'|'.join(words)}') THEN '{name}'" for name, words in classes)
    return f"CASE {whens} ELSE 'unknown' END"


@query("run_tracking", with_sql(RUNS, ASSETS) + f"""
SELECT execution_id, asset_id, status, CASE WHEN error_message IS NOT NULL THEN {_class_sql('error_message', monitoring.RUN_ERROR_CLASSES)} END AS error_category,
  coalesce(duration_seconds <= sla_completion_minutes * 60, true) AS sla_met FROM runs LEFT JOIN assets USING (asset_id)""")
def run_tracking(spark, sf):
    return monitoring.track_runs(b.runs(spark, sf), b.assets(spark, sf)).select("execution_id", "asset_id", "status", "error_category", "sla_met")


@query("error_classes", with_sql(RUNS) + f"""
SELECT {_class_sql('error_message', monitoring.ERROR_CLASSES)} AS error_category, count(*) AS n FROM runs WHERE status = 'failed' GROUP BY ALL""")
def error_classes(spark, sf):
    failed = b.runs(spark, sf).filter("status = 'failed'")
    return failed.groupBy(monitoring.error_class(F.col("error_message")).alias("error_category")).agg(F.count("*").alias("n"))


@query("stored_execution_baseline", with_sql(RUNS) + f"""
SELECT asset_id, round(avg(duration_seconds), 6) AS avg_duration_seconds, round(stddev_samp(duration_seconds), 6) AS std_duration_seconds, round(avg(records_written), 6) AS avg_records_written, round(stddev_samp(records_written), 6) AS std_records_written
FROM runs WHERE status = 'succeeded' AND CAST(start_time AS DATE) >= CAST({NOW_SQL} AS DATE) - 30 GROUP BY asset_id""")
def stored_execution_baseline(spark, sf):
    """Baselines of thirty days, put together from one small row an asset and day."""
    values, folder = ["duration_seconds", "records_written"], f"{shared_folder(spark)}/run-days-{uuid.uuid4().hex}"
    days = mergeable.day_moments(b.runs(spark, sf).filter("status = 'succeeded'"), ["asset_id"], "start_time", values)
    write_load(days, folder, "partitions", ["day"])
    stored = spark.read.parquet(folder).filter(F.col("day") >= F.date_sub(at(NOW).cast("date"), 30))
    out = mergeable.combine_days(stored, ["asset_id"], values)
    return out.select("asset_id", *[F.round(c, 6).alias(c) for c in out.columns if c != "asset_id"])


@query("execution_anomalies", with_sql(RUNS, f"""base AS (
  SELECT asset_id, avg(duration_seconds) AS ad, stddev_samp(duration_seconds) AS sd, avg(records_written) AS ar, stddev_samp(records_written) AS sr FROM runs
  WHERE status = 'succeeded' AND start_time >= {NOW_SQL} - INTERVAL 30 DAYS AND NOT start_time >= {NOW_SQL} - INTERVAL 48 HOURS GROUP BY asset_id)""", f"""a AS (
  SELECT execution_id, asset_id, CASE WHEN duration_seconds > ad + 2 * coalesce(sd, 0) THEN 'duration_spike' WHEN records_written < ar - 2 * coalesce(sr, 0) THEN 'low_volume'
    WHEN records_written > ar + 2 * coalesce(sr, 0) THEN 'high_volume' END AS anomaly_type FROM runs JOIN base USING (asset_id)
  WHERE status = 'succeeded' AND start_time >= {NOW_SQL} - INTERVAL 48 HOURS)""") + "SELECT * FROM a WHERE anomaly_type IS NOT NULL")
def execution_anomalies(spark, sf):
    found = monitoring.execution_anomalies(b.runs(spark, sf), at(NOW), recent="48 HOURS", sigmas=2.0)
    return found.select("execution_id", "asset_id", "anomaly_type")


@query("failure_rates", with_sql(RUNS, ASSETS, f"""c AS (SELECT asset_id, count(*) AS total_runs, count(*) FILTER (WHERE status = 'failed') AS failed_runs FROM runs
  WHERE start_time >= {NOW_SQL} - INTERVAL 72 HOURS GROUP BY asset_id)""") + """
SELECT asset_id, asset_name, sla_max_failure_rate::DOUBLE AS sla_max_failure_rate, total_runs, failed_runs, failed_runs::DOUBLE / total_runs AS failure_rate FROM assets JOIN c USING (asset_id)
WHERE monitoring_enabled AND failed_runs::DOUBLE / total_runs > sla_max_failure_rate""")
def failure_rates(spark, sf):
    return monitoring.failure_rates(b.runs(spark, sf), b.assets(spark, sf), at(NOW), "72 HOURS")


@query("domain_health", with_sql(RUNS, ASSETS, f"""p AS (SELECT domain, 100.0::DOUBLE * count(*) FILTER (WHERE status = 'succeeded') / count(*) AS v FROM runs JOIN assets USING (asset_id)
  WHERE start_time >= {NOW_SQL} - INTERVAL 24 HOURS GROUP BY domain)""", f"""s AS (SELECT domain, 100.0::DOUBLE * count(*) FILTER (WHERE duration_seconds <= 60) / count(*) AS v FROM runs JOIN assets USING (asset_id)
  WHERE start_time >= {NOW_SQL} - INTERVAL 24 HOURS GROUP BY domain)""", f"""d AS (SELECT 'domain_' || (asset_id % 9) AS domain, CAST(sum(records_written) AS DOUBLE) / count(*) AS v FROM runs
  WHERE start_time >= {NOW_SQL} - INTERVAL 24 HOURS GROUP BY ALL)""") + """
SELECT coalesce(p.domain, d.domain, s.domain) AS domain, round(coalesce(p.v, 100) * 0.4::DOUBLE + coalesce(d.v, 100) * 0.3::DOUBLE + coalesce(s.v, 100) * 0.2::DOUBLE + 100 * 0.1::DOUBLE, 1) AS health_score,
  coalesce(p.v, 100.0) AS pipeline_pct, coalesce(d.v, 100.0) AS dq_pct, coalesce(s.v, 100.0) AS sla_pct
FROM p FULL JOIN d ON p.domain = d.domain FULL JOIN s ON coalesce(p.domain, d.domain) = s.domain""")
def domain_health(spark, sf):
    runs = b.runs(spark, sf)
    quality = runs.select(F.concat(F.lit("domain_"), F.col("asset_id") % 9).alias("domain"), F.col("start_time").alias("execution_start"), F.col("records_written").alias("pass_percentage"))
    sla = runs.select("asset_id", F.col("start_time").alias("measurement_time"), (F.col("duration_seconds") <= 60).alias("sla_met"))
    return monitoring.domain_health(runs, quality, sla, b.assets(spark, sf), at(NOW))


PLATFORM_SQL = with_sql(RUNS, f"""r AS (SELECT count(*) AS total_pipelines, count(*) FILTER (WHERE status = 'succeeded') AS successful_pipelines, count(*) FILTER (WHERE status = 'failed') AS failed_pipelines,
   count(*) FILTER (WHERE duration_seconds <= 60) AS pipelines_in_sla FROM runs WHERE start_time >= {NOW_SQL} - INTERVAL 24 HOURS)""", """
 sc AS (SELECT 'table_' || asset_id AS table_name, max_by(records_written, start_time) AS overall_score, max_by(duration_seconds > 60, start_time) AS is_stale FROM runs GROUP BY asset_id)""", """
 q AS (SELECT CAST(sum(overall_score) AS DOUBLE) / count(*) AS data_quality_score, count(*) FILTER (WHERE is_stale) AS stale_tables, 100.0::DOUBLE * count(*) FILTER (WHERE NOT is_stale) / count(*) AS data_freshness_score FROM sc)""", """
 v AS (SELECT *, coalesce(100.0::DOUBLE * successful_pipelines / nullif(total_pipelines, 0), 100.0) AS pipeline_health_score, coalesce(100.0::DOUBLE * pipelines_in_sla / nullif(total_pipelines, 0), 100.0) AS sla_compliance_score FROM r, q)""")


@query("platform_health", PLATFORM_SQL + """
SELECT *, round(pipeline_health_score * 0.35::DOUBLE + data_quality_score * 0.30::DOUBLE + data_freshness_score * 0.20::DOUBLE + sla_compliance_score * 0.15::DOUBLE, 6) AS overall_health_score FROM v""")
def platform_health(spark, sf):
    runs = b.runs(spark, sf).withColumn("sla_met", F.col("duration_seconds") <= 60)
    name = F.concat(F.lit("table_"), "asset_id").alias("table_name")
    scores = runs.select(name, F.col("start_time").alias("snapshot_date"), F.col("records_written").alias("overall_score"))
    fresh = runs.select(name, F.col("start_time").alias("check_timestamp"), (F.col("duration_seconds") > 60).alias("is_stale"))
    out = monitoring.platform_health(runs, scores, fresh, at(NOW))
    return out.withColumn("overall_health_score", F.round("overall_health_score", 6))


def _open_incidents(spark, sf):
    return b.assets(spark, sf).filter("asset_id % 3 = 0").select("asset_name", F.lit("open").alias("status"))


@query("incidents_from_failures", with_sql(RUNS, ASSETS, f"""f AS (SELECT DISTINCT asset_name, error_message FROM runs WHERE status = 'failed' AND start_time >= {NOW_SQL} - INTERVAL 48 HOURS
  AND asset_name NOT IN (SELECT asset_name FROM assets WHERE asset_id % 3 = 0))""") + f"""
SELECT 'INC-' || md5(asset_name || '|' || error_message) AS incident_id, 'pipeline_failure' AS incident_type, 'high' AS severity, 'Pipeline Failure: ' || asset_name AS title,
  asset_name, {_class_sql('error_message', monitoring.ERROR_CLASSES)} AS error_category FROM f""")
def incidents_from_failures(spark, sf):
    return monitoring.incidents_from_failures(b.runs(spark, sf), _open_incidents(spark, sf), at(NOW), "48 HOURS")


SHIFTS_SQL = """shifts AS (SELECT 'member_' || s_suppkey AS team_member, CASE s_suppkey % 4 WHEN 0 THEN 'on_call_primary' WHEN 1 THEN 'on_call_secondary' WHEN 2 THEN 'team_lead' ELSE 'analyst' END AS role,
   TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * (s_suppkey * 7 % 700) AS shift_start, TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * (s_suppkey * 7 % 700 + 8) AS shift_end, s_suppkey % 5 <> 0 AS is_on_call, true AS is_active FROM supplier)"""


def _shifts(spark, sf):
    k = F.col("s_suppkey")
    start = k * 7 % 700

    def moment(hours):
        return (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_interval(hours=hours.cast("int"))).cast("timestamp_ntz")

    return table(spark, sf, "supplier").select(
        F.concat(F.lit("member_"), k).alias("team_member"),
        F.when(k % 4 == 0, "on_call_primary").when(k % 4 == 1, "on_call_secondary").when(k % 4 == 2, "team_lead").otherwise("analyst").alias("role"),
        moment(start).alias("shift_start"), moment(start + 8).alias("shift_end"), (k % 5 != 0).alias("is_on_call"), F.lit(True).alias("is_active"),
    )


@query("alert_routing", with_sql(RUNS, SHIFTS_SQL, """m AS (SELECT execution_id, team_member, role, row_number() OVER (PARTITION BY execution_id ORDER BY
   CASE role WHEN 'on_call_primary' THEN 1 WHEN 'on_call_secondary' THEN 2 WHEN 'team_lead' THEN 3 ELSE 4 END, team_member) AS rn
   FROM runs JOIN shifts ON start_time BETWEEN shift_start AND shift_end WHERE status = 'failed' AND is_on_call)""") + """
SELECT execution_id, start_time, team_member, role FROM runs LEFT JOIN (SELECT * FROM m WHERE rn = 1) USING (execution_id) WHERE status = 'failed'""")
def alert_routing(spark, sf):
    alerts = b.runs(spark, sf).filter("status = 'failed'").select("execution_id", "start_time")
    return monitoring.route_alerts(alerts, _shifts(spark, sf), "start_time")


@query("severity_of_assets", with_sql(ASSETS) + """
SELECT asset_id, CASE asset_id % 5 WHEN 0 THEN 'P1_critical' WHEN 1 THEN 'P2_high' WHEN 2 THEN 'P3_medium' WHEN 3 THEN 'P4_low' ELSE 'P3_medium' END AS severity FROM assets""")
def severity_of_assets(spark, sf):
    level = F.col("asset_id") % 5
    name = F.when(level == 0, "critical").when(level == 1, "high").when(level == 2, "medium").when(level == 3, "low").otherwise("none")
    return b.assets(spark, sf).select("asset_id", monitoring.severity_of(name).alias("severity"))


@query("retry_decisions", with_sql(RUNS, ASSETS) + f"""
SELECT execution_id, CASE WHEN {_class_sql('error_message', monitoring.ERROR_CLASSES)} = 'transient' AND asset_id % 2 = 0 AND records_written % 4 < 2 THEN 'retry' ELSE 'incident' END AS decision
FROM runs WHERE status = 'failed'""")
def retry_decisions(spark, sf):
    failed = b.runs(spark, sf).filter("status = 'failed'").withColumns({
        "error_category": monitoring.error_class(F.col("error_message")), "auto_retry_enabled": F.col("asset_id") % 2 == 0,
        "retry_count": F.col("records_written") % 4, "max_auto_retries": F.lit(2),
    })
    return monitoring.retry_decision(failed).select("execution_id", "decision")


@query("session_flags", f"""
WITH s AS (SELECT event_id, CASE WHEN event_type IN ('view','click') THEN 'idle' ELSE 'busy' END AS state, CAST(floor((epoch_us({NOW_SQL}) - epoch_us(ts)) / 60000000) AS BIGINT) AS minutes FROM events)
SELECT event_id, minutes, CASE WHEN state = 'idle' AND minutes > 240 THEN 'zombie_session' WHEN state = 'busy' AND minutes > 360 THEN 'stuck_session' END AS flag FROM s""")
def session_flags(spark, sf):
    state = F.when(F.col("event_type").isin("view", "click"), "idle").otherwise("busy")
    sessions = table(spark, sf, "events").select("event_id", state.alias("state"), F.col("ts").alias("start_time"))
    return monitoring.session_flags(sessions, at(NOW)).select("event_id", "minutes", "flag")


@query("sla_breaches", with_sql(RUNS, ASSETS) + f"""
SELECT execution_id, asset_id, CAST(floor((epoch_us({NOW_SQL}) - epoch_us(start_time)) / 60000000) AS BIGINT) AS running_minutes FROM runs JOIN assets USING (asset_id)
WHERE status = 'failed' AND floor((epoch_us({NOW_SQL}) - epoch_us(start_time)) / 60000000) > sla_completion_minutes * 1000""")
def sla_breaches(spark, sf):
    runs = b.runs(spark, sf).withColumn("status", F.when(F.col("status") == "failed", "in_progress").otherwise(F.col("status")))
    limits = b.assets(spark, sf).select("asset_id", (F.col("sla_completion_minutes") * 1000).alias("sla_max_duration_min"))
    return monitoring.sla_breaches(runs, limits, at(NOW)).select("execution_id", "asset_id", "running_minutes")


@query("register_assets", """
WITH f AS (SELECT s_suppkey AS asset_id, CASE s_suppkey % 4 WHEN 0 THEN 'prod_' WHEN 1 THEN 'silver_' WHEN 2 THEN 'stage_' ELSE 'misc_' END || s_suppkey AS asset_name,
   CASE WHEN s_suppkey % 3 = 0 THEN 'Pipeline' ELSE 'Notebook' END AS asset_type FROM supplier WHERE s_suppkey % 10 <> 0)
SELECT asset_id, asset_name, asset_type, CASE WHEN regexp_matches(asset_name, 'prod|gold|finance|regulatory|claims') THEN 'critical' WHEN regexp_matches(asset_name, 'silver|billing|customer') THEN 'high'
  WHEN asset_type = 'Pipeline' THEN 'high' ELSE 'medium' END AS criticality FROM f""")
def register_assets(spark, sf):
    k = F.col("s_suppkey")
    found = table(spark, sf, "supplier").select(
        k.alias("asset_id"), F.concat(F.when(k % 4 == 0, "prod_").when(k % 4 == 1, "silver_").when(k % 4 == 2, "stage_").otherwise("misc_"), k).alias("asset_name"),
        F.when(k % 3 == 0, "Pipeline").otherwise("Notebook").alias("asset_type"),
    )
    return monitoring.register_assets(found, found.filter("asset_id % 10 = 0"))


@query("mirror_issues", """
WITH h AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) * 10 AS replication_lag_seconds, CASE WHEN event_type = 'error' THEN 'Degraded' ELSE 'Healthy' END AS status FROM events)
SELECT event_id, replication_lag_seconds, status, replication_lag_seconds > 300 AS high_lag FROM h WHERE status <> 'Healthy' OR replication_lag_seconds > 300""")
def mirror_issues(spark, sf):
    health = table(spark, sf, "events").select(
        "event_id", (F.get_json_object("props", "$.k").cast("bigint") * 10).alias("replication_lag_seconds"),
        F.when(F.col("event_type") == "error", "Degraded").otherwise("Healthy").alias("status"), F.lit(None).cast("string").alias("error_message"),
    )
    return monitoring.mirror_issues(health).select("event_id", "replication_lag_seconds", "status", "high_lag")


@query("mirror_count_difference", """
SELECT o_orderpriority, count(*) AS source_rows, count(*) FILTER (WHERE o_orderstatus <> 'P') AS target_rows, count(*) FILTER (WHERE o_orderstatus = 'P') AS missing_rows FROM orders GROUP BY o_orderpriority""")
def mirror_count_difference(spark, sf):
    source = table(spark, sf, "orders")
    return monitoring.mirror_count_difference(source, source.filter("o_orderstatus <> 'P'"), ["o_orderpriority"])


@query("cost_recommendations", """
WITH f AS (SELECT user_id, count(*) AS num_files, max(ts) AS last_modified, CAST(date_diff('day', CAST(max(ts) AS DATE), DATE '2024-01-30') AS INTEGER) AS age_days FROM events GROUP BY user_id)
SELECT user_id, num_files, age_days, 'optimize' AS recommendation FROM f WHERE num_files > 66 UNION ALL SELECT user_id, num_files, age_days, 'archive_candidate' FROM f WHERE age_days > 0""")
def cost_recommendations(spark, sf):
    files = table(spark, sf, "events").groupBy("user_id").agg(F.count("*").alias("num_files"), F.max("ts").alias("last_modified"))
    return monitoring.cost_recommendations(files, at(NOW), 66, 0).select("user_id", "num_files", "age_days", "recommendation")


@query("monitoring_cycle", with_sql(RUNS, ASSETS) + f"""
SELECT 'failure_rates' AS check_name, count(*) AS findings FROM assets JOIN (SELECT asset_id, count(*) AS n, count(*) FILTER (WHERE status = 'failed') AS f FROM runs WHERE start_time >= {NOW_SQL} - INTERVAL 24 HOURS GROUP BY asset_id) USING (asset_id)
  WHERE monitoring_enabled AND f::DOUBLE / n > sla_max_failure_rate
UNION ALL SELECT 'incidents', count(*) FROM (SELECT DISTINCT asset_name, error_message FROM runs WHERE status = 'failed' AND start_time >= {NOW_SQL} - INTERVAL 1 HOUR AND asset_id % 3 <> 0)
UNION ALL SELECT 'sla_breaches', 0
UNION ALL SELECT 'anomalies', count(*) FROM runs JOIN (SELECT asset_id, avg(duration_seconds) AS ad, coalesce(stddev_samp(duration_seconds), 0) AS sd, avg(records_written) AS ar, coalesce(stddev_samp(records_written), 0) AS sr FROM runs
  WHERE status = 'succeeded' AND start_time >= {NOW_SQL} - INTERVAL 30 DAYS AND NOT start_time >= {NOW_SQL} - INTERVAL 4 HOURS GROUP BY asset_id) USING (asset_id)
  WHERE status = 'succeeded' AND start_time >= {NOW_SQL} - INTERVAL 4 HOURS AND (duration_seconds > ad + 3 * sd OR records_written < ar - 3 * sr OR records_written > ar + 3 * sr)""")
def monitoring_cycle(spark, sf):
    assets = b.assets(spark, sf).withColumn("sla_max_duration_min", F.lit(60))
    return monitoring.cycle_summary(monitoring.monitoring_cycle(b.runs(spark, sf), assets, _open_incidents(spark, sf), at(NOW)))


@query("alert_rules_with_cooldown", """
WITH RECURSIVE hits AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS entity, ts AS fired_at FROM events WHERE event_type = 'error'),
 fired AS (SELECT entity, min(fired_at) AS fired_at FROM hits GROUP BY entity
   UNION ALL SELECT h.entity, min(h.fired_at) FROM fired f JOIN hits h ON h.entity = f.entity AND h.fired_at >= f.fired_at + INTERVAL 720 MINUTES GROUP BY h.entity)
SELECT 'ALR001' AS alert_id, 'critical' AS severity, entity, fired_at FROM fired
UNION ALL SELECT DISTINCT 'ALR005', 'high', CAST(user_id AS VARCHAR), ts FROM events WHERE value > 150""")
def alert_rules_with_cooldown(spark, sf):
    rules = [
        {"alert_id": "ALR001", "severity": "critical", "table": "events", "condition": "event_type = 'error'", "ts": "ts", "entity": "user_id", "cooldown_minutes": 720},
        {"alert_id": "ALR005", "severity": "high", "table": "events", "condition": "value > 150", "ts": "ts", "entity": "user_id", "cooldown_minutes": 0},
        {"alert_id": "ALR006", "severity": "high", "table": "events", "condition": "true", "ts": "ts", "entity": "user_id", "is_active": False},
    ]
    return monitoring.evaluate_alerts({"events": table(spark, sf, "events")}, rules)


# ---- capacity ------------------------------------------------------------------------

USAGE_SQL = """usage AS (SELECT user_id AS capacity_id, ts, CAST(least(value, 100) AS DECIMAL(18,2)) AS cu_usage_pct, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type FROM events)"""
CONFIG_SQL = """config AS (SELECT DISTINCT user_id AS capacity_id, CASE user_id % 3 WHEN 0 THEN 'F2' WHEN 1 THEN 'F8' ELSE 'F64' END AS current_size FROM events)"""
SIZE_LIST = "['F2','F4','F8','F16','F32','F64','F128','F256','F512','F1024','F2048']"
COST_LIST = "[0.36,0.72,1.44,2.88,5.76,11.52,23.04,46.08,92.16,184.32,368.64]::DOUBLE[]"


def _usage(spark, sf):
    return table(spark, sf, "events").select(
        F.col("user_id").alias("capacity_id"), "ts", F.least(F.col("value"), F.lit(100.0)).cast("decimal(18,2)").alias("cu_usage_pct"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"), "event_type",
    )


def _config(spark, sf):
    m = F.col("capacity_id") % 3
    return table(spark, sf, "events").select(F.col("user_id").alias("capacity_id")).distinct().withColumns({
        "current_size": F.when(m == 0, "F2").when(m == 1, "F8").otherwise("F64"), "min_size": F.lit("F2"), "max_size": F.lit("F128"),
        "scale_up_pct": F.lit(30.0), "scale_down_pct": F.lit(10.0),
    })


@query("scale_recommendation", with_sql(USAGE_SQL, CONFIG_SQL, """l AS (SELECT capacity_id, max(ts) AS mt FROM usage GROUP BY capacity_id)""", """u AS (
  SELECT capacity_id, CAST(sum(cu_usage_pct) AS DOUBLE) / count(*) AS usage_pct FROM usage JOIN l USING (capacity_id) WHERE ts BETWEEN mt - INTERVAL 600 MINUTES AND mt GROUP BY capacity_id)""", f"""w AS (
  SELECT *, list_position({SIZE_LIST}, current_size) AS i, least(greatest(list_position({SIZE_LIST}, current_size) + CASE WHEN usage_pct > 30 THEN 1 WHEN usage_pct < 10 THEN -1 ELSE 0 END, 1), 7) AS j FROM config JOIN u USING (capacity_id))""") + f"""
SELECT capacity_id, current_size, usage_pct, list_extract({SIZE_LIST}, j) AS target_size, CASE WHEN j > i THEN 'scale_up' WHEN j < i THEN 'scale_down' ELSE 'no_change' END AS action, list_extract({COST_LIST}, j) - list_extract({COST_LIST}, i) AS cost_delta FROM w""")
def scale_recommendation(spark, sf):
    out = monitoring.scale_recommendation(_usage(spark, sf), _config(spark, sf), 600)
    return plain(out.select("capacity_id", "current_size", "usage_pct", "target_size", "action", "cost_delta"))


@query("budget_projection", with_sql(USAGE_SQL) + """
SELECT capacity_id, CAST(sum(cu_usage_pct) AS DOUBLE) AS month_spend, CAST(sum(cu_usage_pct) AS DOUBLE) / 30 * 30 AS projected_spend,
 CASE WHEN CAST(sum(cu_usage_pct) AS DOUBLE) / 30 * 30 > 1300.0::DOUBLE * 1.1::DOUBLE THEN 'budget_scale_down' ELSE 'within_budget' END AS action FROM usage GROUP BY capacity_id""")
def budget_projection(spark, sf):
    spend = _usage(spark, sf).groupBy("capacity_id").agg(F.sum("cu_usage_pct").cast("double").alias("month_spend")).withColumn("monthly_budget", F.lit(1300.0))
    return monitoring.budget_projection(spend, F.lit(30)).drop("monthly_budget")


@query("idle_capacities", with_sql(USAGE_SQL) + f"""
SELECT capacity_id, max(ts) AS last_activity, (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 60000000 AS idle_minutes FROM usage WHERE event_type <> 'error' AND k > 10
GROUP BY capacity_id HAVING (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 60000000 > 600""")
def idle_capacities(spark, sf):
    active = (F.col("event_type") != "error") & (F.col("k") > 10)
    usage = _usage(spark, sf).withColumns({"sessions": F.when(active, 1).otherwise(0), "notebooks": F.lit(0), "pipelines": F.lit(0)})
    return monitoring.idle_capacities(usage, at("2024-01-31"), 600)


@query("schedule_decision", with_sql(CONFIG_SQL, SHIFTS_SQL, """n AS (SELECT count(*) AS on_shift FROM shifts WHERE TIMESTAMP '2024-01-28 03:00:00' BETWEEN shift_start AND shift_end)""") + """
SELECT capacity_id, on_shift, CASE WHEN capacity_id % 2 = 0 AND current_size <> 'F4' THEN 'F4' WHEN on_shift = 0 AND capacity_id % 4 IN (1, 3) THEN 'F2' END AS target_size FROM config, n""")
def schedule_decision(spark, sf):
    config = _config(spark, sf).withColumns({
        "weekend_size": F.when(F.col("capacity_id") % 2 == 0, "F4"), "environment": F.when(F.col("capacity_id") % 4 == 1, "dev").when(F.col("capacity_id") % 4 == 3, "test").otherwise("prod"),
    })
    return monitoring.schedule_decision(config, _shifts(spark, sf), at("2024-01-28 03:00:00")).select("capacity_id", "on_shift", "target_size")


@query("throttle_flags", with_sql(USAGE_SQL) + "SELECT capacity_id, count(*) FILTER (WHERE k > 10.0) AS throttled, count(*) AS readings FROM usage GROUP BY capacity_id")
def throttle_flags(spark, sf):
    flagged = monitoring.throttled(_usage(spark, sf).withColumn("throttle_pct", F.col("k")))
    return flagged.groupBy("capacity_id").agg(F.count_if("is_throttled").alias("throttled"), F.count("*").alias("readings"))


@query("scale_event_costs", f"""
WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) % 11 + 1 AS a, user_id % 11 + 1 AS z FROM events)
SELECT event_id, list_extract({SIZE_LIST}, a) AS from_size, list_extract({SIZE_LIST}, z) AS to_size, list_extract({COST_LIST}, z) - list_extract({COST_LIST}, a) AS cost_impact FROM e""")
def scale_event_costs(spark, sf):
    sizes = F.array(*[F.lit(s[0]) for s in monitoring.SIZES])
    k = F.get_json_object("props", "$.k").cast("bigint")
    events = table(spark, sf, "events").select(
        "event_id", F.element_at(sizes, (k % 11 + 1).cast("int")).alias("from_size"), F.element_at(sizes, (F.col("user_id") % 11 + 1).cast("int")).alias("to_size")
    )
    return monitoring.scale_events(events)


# ---- gates and dashboards ------------------------------------------------------------

TESTS_SQL = """tests AS (SELECT event_type AS category, CASE WHEN k % 25 = 0 THEN 'failed' WHEN k % 40 = 7 THEN 'error' ELSE 'passed' END AS status, CAST(value AS DECIMAL(18,2)) AS duration_sec
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""


def _tests(spark, sf):
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, sf, "events").select(
        F.col("event_type").alias("category"), F.when(k % 25 == 0, "failed").when(k % 40 == 7, "error").otherwise("passed").alias("status"),
        F.col("value").cast("decimal(18,2)").alias("duration_sec"),
    )


@query("test_summary_by_category", with_sql(TESTS_SQL) + """
SELECT category, count(*) AS total_tests, count(*) FILTER (WHERE status = 'passed') AS passed, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'error') AS errors,
 CAST(sum(duration_sec) AS DOUBLE) / count(*) AS avg_duration, 100.0::DOUBLE * count(*) FILTER (WHERE status = 'passed') / count(*) AS pass_rate FROM tests GROUP BY category""")
def test_summary_by_category(spark, sf):
    return plain(kpi.test_summary(_tests(spark, sf), ["category"]))


@query("deployment_gate", with_sql(TESTS_SQL, RUNS, f"""g AS (SELECT (SELECT 100.0::DOUBLE * count(*) FILTER (WHERE status = 'passed') / count(*) FROM tests) AS test_pass_rate,
  (SELECT CAST(sum(records_written) AS DOUBLE) / count(*) FROM runs) AS dq_score, (SELECT 100.0::DOUBLE * count(*) FILTER (WHERE status = 'succeeded') / count(*) FROM runs WHERE start_time >= {NOW_SQL} - INTERVAL 1 DAY) AS run_success_rate)""") + """
SELECT *, test_pass_rate >= 95 AS tests_ok, dq_score >= 90 AS dq_ok, run_success_rate >= 95 AS runs_ok, test_pass_rate >= 95 AND dq_score >= 90 AND run_success_rate >= 95 AS gate_passed FROM g""")
def deployment_gate(spark, sf):
    runs = b.runs(spark, sf)
    scores = runs.select(F.col("records_written").alias("overall_score"))
    return kpi.deployment_gate(_tests(spark, sf), scores, runs.filter(within(F.col("start_time"), at(NOW), "1 DAY")))


@query("executive_summary", with_sql(POLICY, CLAIM, RUNS, ACCESS, f"""m AS (
 SELECT 'financial' AS metric_category, 'Loss Ratio' AS metric_name, coalesce(CAST(sum(claim_amount) AS DOUBLE) / CAST(sum(premium) AS DOUBLE) * 100, 0.0) AS metric_value, 'percentage' AS metric_unit, 70.0::DOUBLE AS target_value FROM claim JOIN policy USING (policy_id) WHERE claim_date >= TIMESTAMP '2001-08-02' - INTERVAL 30 DAYS
 UNION ALL SELECT 'financial', 'Total Premium Volume', CAST(sum(premium) AS DOUBLE), 'currency', NULL FROM policy WHERE policy_status = 'O'
 UNION ALL SELECT 'operational', 'Pipeline Success Rate (24h)', 100.0::DOUBLE * count(*) FILTER (WHERE status = 'succeeded') / count(*), 'percentage', 95.0 FROM runs WHERE start_time >= {NOW_SQL} - INTERVAL 24 HOURS
 UNION ALL SELECT 'quality', 'Average Data Quality Score', CAST(sum(records_written) AS DOUBLE) / count(*), 'score', 90.0 FROM runs
 UNION ALL SELECT 'security', 'PII/PCI Access Count (24h)', CAST(count(*) FILTER (WHERE pii_accessed) AS DOUBLE), 'count', NULL FROM access WHERE ts >= {NOW_SQL} - INTERVAL 24 HOURS)""") + """
SELECT *, CASE metric_name WHEN 'Loss Ratio' THEN CASE WHEN metric_value < 70 THEN 'green' WHEN metric_value < 85 THEN 'yellow' ELSE 'red' END
 WHEN 'Pipeline Success Rate (24h)' THEN CASE WHEN metric_value >= 95 THEN 'green' WHEN metric_value >= 90 THEN 'yellow' ELSE 'red' END
 WHEN 'Average Data Quality Score' THEN CASE WHEN metric_value >= 90 THEN 'green' WHEN metric_value >= 75 THEN 'yellow' ELSE 'red' END ELSE 'green' END AS status FROM m""")
def executive_summary(spark, sf):
    runs = b.runs(spark, sf)
    recent = b.claims(spark, sf).filter(within(F.col("claim_date"), at(b.ORDERS_AS_OF), "30 DAYS")).select("policy_id", "claim_amount")
    joined = recent.join(b.policies(spark, sf).select("policy_id", "premium"), "policy_id")
    access = b.accesses(spark, sf).filter(within(F.col("ts"), at(NOW), "24 HOURS")).select(F.when(F.col("pii_accessed"), "pii").otherwise("public").alias("data_classification"))
    return kpi.executive_summary(
        joined, b.policies(spark, sf).filter("policy_status = 'O'"), runs.filter(within(F.col("start_time"), at(NOW), "24 HOURS")),
        runs.select(F.col("records_written").alias("overall_score")), access,
    )


@query("asset_criticality", with_sql(ASSETS) + """
SELECT domain, count(*) AS assets, 'medium' AS criticality FROM assets GROUP BY domain""")
def asset_criticality(spark, sf):
    named = b.assets(spark, sf).withColumn("criticality", profile.asset_criticality(F.col("asset_name"), F.lit("notebook")))
    return named.groupBy("domain", "criticality").agg(F.count("*").alias("assets"))
