"""Event enrichment and windows: batch twins, and the same functions run as streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.operators import windows as w
from lodestrata.operators.monitoring import evaluate_alerts
from lodestrata.plans import bindings as b
from lodestrata.plans.bindings import CLICKS, PAYMENTS, with_sql
from lodestrata.plans.registry import at, plain, query, table
from lodestrata.session import shared_folder
from lodestrata.sources.readers import read_event_stream
from lodestrata.streaming import enrich, parse, queries, stateful, windows

CLAIM_EVENT_SQL = """ce AS (SELECT l_orderkey * 8 + l_linenumber AS event_id, l_shipdate AS loss_date, l_shipdate + INTERVAL 1 DAY * (l_partkey % 60) AS report_date, l_extendedprice AS loss_amount_estimate,
  CASE WHEN l_linenumber % 2 = 0 THEN 'phone' ELSE 'web' END AS channel, CASE WHEN l_suppkey % 10 = 0 THEN 'catastrophe' ELSE 'normal' END AS priority, l_returnflag AS loss_type FROM lineitem)"""


def _claim_events(spark, sf):
    return table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("event_id"), F.col("l_shipdate").alias("loss_date"),
        (F.col("l_shipdate") + F.make_interval(days=(F.col("l_partkey") % 60).cast("int"))).alias("report_date"), F.col("l_extendedprice").alias("loss_amount_estimate"),
        F.when(F.col("l_linenumber") % 2 == 0, "phone").otherwise("web").alias("channel"), F.when(F.col("l_suppkey") % 10 == 0, "catastrophe").otherwise("normal").alias("priority"), F.col("l_returnflag").alias("loss_type"),
    )


SCORED = """sc AS (SELECT *, priority = 'catastrophe' AS is_catastrophe, CAST(date_diff('day', CAST(loss_date AS DATE), CAST(report_date AS DATE)) AS INTEGER) AS report_lag_days FROM ce),
 s2 AS (SELECT *, CASE WHEN loss_amount_estimate > 100000 THEN 0.7 WHEN report_lag_days > 30 THEN 0.6 WHEN channel = 'phone' THEN 0.3 ELSE 0.1 END::DOUBLE AS fraud_risk_score FROM sc)"""


@query("claim_enrichment", with_sql(CLAIM_EVENT_SQL, SCORED) + """
SELECT event_id, loss_date, is_catastrophe, report_lag_days, fraud_risk_score, loss_amount_estimate < 5000 AND fraud_risk_score < 0.3 AND priority <> 'catastrophe' AS auto_adjudicate_eligible FROM s2""")
def claim_enrichment(spark, sf):
    return enrich.enrich_claims(_claim_events(spark, sf)).select("event_id", "loss_date", "is_catastrophe", "report_lag_days", F.col("fraud_risk_score").cast("double").alias("fraud_risk_score"), "auto_adjudicate_eligible")


@query("loss_notice_scores", """
WITH n AS (SELECT event_id, value * 1000 AS loss_amount, ts AS reported_date, ts - INTERVAL 1 MINUTE * (CAST(json_extract_string(props, '$.k') AS BIGINT) * 2) AS loss_date FROM events),
 h AS (SELECT *, (floor(epoch_us(reported_date) / 1000000) - floor(epoch_us(loss_date) / 1000000)) / 3600 AS hours FROM n)
SELECT event_id, 3600::BIGINT AS processing_delay_seconds, hours::DOUBLE AS reporting_delay_hours, CASE WHEN loss_amount > 50000 AND hours < 1 THEN 0.8 WHEN loss_amount > 50000 THEN 0.6 WHEN hours < 1 THEN 0.4 ELSE 0.1 END::DOUBLE AS fraud_score FROM h""")
def loss_notice_scores(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    notices = table(spark, sf, "events").select(
        "event_id", (F.col("value") * 1000).alias("loss_amount"), F.col("ts").alias("reported_date"), (F.col("ts") - F.make_interval(mins=k * 2)).alias("loss_date"),
        F.col("ts").alias("event_time"), (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("_processing_time"),
    )
    out = enrich.score_loss_notices(notices)
    return out.select("event_id", "processing_delay_seconds", "reporting_delay_hours", F.col("fraud_score").cast("double").alias("fraud_score"))


@query("stream_alert_conditions", """
WITH n AS (SELECT event_id, ts, value * 1000 AS loss_amount, CASE WHEN value * 1000 > 50000 THEN 0.9 ELSE 0.1 END AS fraud_score FROM events)
SELECT DISTINCT 'high_fraud_score' AS alert_id, CAST(event_id AS VARCHAR) AS entity, ts AS fired_at FROM n WHERE fraud_score > 0.8
UNION ALL SELECT DISTINCT 'large_loss', CAST(event_id AS VARCHAR), ts FROM n WHERE loss_amount > 100000""")
def stream_alert_conditions(spark, sf):
    amount = F.col("value") * 1000
    notices = table(spark, sf, "events").select("event_id", "ts", amount.alias("loss_amount"), F.when(amount > 50000, 0.9).otherwise(0.1).alias("fraud_score"))
    alerts = [
        {"alert_id": name, "severity": "high", "table": "notices", "condition": queries.STREAM_ALERTS[name], "ts": "ts", "entity": "event_id"}
        for name in ("high_fraud_score", "large_loss")
    ]
    return evaluate_alerts({"notices": notices}, alerts).select("alert_id", "entity", "fired_at")


@query("payment_anomalies", with_sql(PAYMENTS) + """
SELECT transaction_id, amount > 50000 OR event_type IN ('chargeback', 'decline') OR amount < 0 AS is_anomaly, CASE WHEN amount > 50000 THEN 'high_value' WHEN event_type = 'chargeback' THEN 'chargeback' WHEN amount < 0 THEN 'negative_amount' END AS anomaly_type FROM payments""")
def payment_anomalies(spark, sf):
    return enrich.flag_payments(b.payments(spark, sf)).select("transaction_id", "is_anomaly", "anomaly_type")


WEIGHT = "CASE event_type WHEN 'quote_request' THEN 10 WHEN 'form_submit' THEN 8 WHEN 'form_start' THEN 5 WHEN 'click' THEN 2 ELSE 1 END"


@query("click_engagement", with_sql(CLICKS) + f"SELECT event_id, event_type IN ('form_submit', 'quote_request') AS is_conversion_event, {WEIGHT} AS engagement_score FROM clicks")
def click_engagement(spark, sf):
    return enrich.score_clicks(b.clicks(spark, sf)).select("event_id", "is_conversion_event", "engagement_score")


CALLS_SQL = """calls AS (SELECT event_id, ts AS event_timestamp, 'queue_' || (user_id % 4) AS queue_name, event_type AS intent_detected, CAST(json_extract_string(props, '$.k') AS INTEGER) * 5 AS wait_time_sec, CAST(json_extract_string(props, '$.k') AS INTEGER) * 3 AS talk_time_sec,
  value / 50 - 1 AS sentiment_score, CASE user_id % 3 WHEN 0 THEN 'transferred' WHEN 1 THEN 'abandoned' ELSE 'resolved' END AS call_disposition FROM events)"""


def _calls(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    u = F.col("user_id") % 3
    return table(spark, sf, "events").select(
        "event_id", F.col("ts").alias("event_timestamp"), F.concat(F.lit("queue_"), F.col("user_id") % 4).alias("queue_name"), F.col("event_type").alias("intent_detected"), (k * 5).alias("wait_time_sec"), (k * 3).alias("talk_time_sec"),
        (F.col("value") / 50 - 1).alias("sentiment_score"), F.when(u == 0, "transferred").when(u == 1, "abandoned").otherwise("resolved").alias("call_disposition"),
    )


@query("call_flags", with_sql(CALLS_SQL) + "SELECT event_id, wait_time_sec > 300 AS long_wait_flag, sentiment_score < -0.5 AS negative_sentiment_flag, call_disposition = 'transferred' AND sentiment_score < -0.3 AS escalation_needed FROM calls")
def call_flags(spark, sf):
    return enrich.flag_calls(_calls(spark, sf)).select("event_id", "long_wait_flag", "negative_sentiment_flag", "escalation_needed")


@query("payload_parsing", """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS event_type, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value, event_type = 'error' AS malformed FROM events""")
def payload_parsing(spark, sf):
    """Every error event becomes a broken payload and must end in the reject branch."""
    good = F.to_json(F.struct(F.col("event_id").cast("string").alias("event_id"), "event_type", "value"))
    raw = table(spark, sf, "events").select("event_id", F.when(F.col("event_type") == "error", F.lit("{broken")).otherwise(good).cast("binary").alias("body"))
    parsed = parse.parse_payload(raw.withColumnRenamed("event_id", "source_id"), T.StructType.fromDDL("event_id string, event_type string, value double"), at(b.EVENTS_AS_OF), keep=("source_id",))
    ok, bad = parse.good_and_bad(parsed, ["event_id", "event_type"])
    rows = ok.withColumn("malformed", F.lit(False)).unionByName(bad.drop(parse.CORRUPT).withColumn("malformed", F.lit(True)))
    return rows.select(F.col("source_id").alias("event_id"), "event_type", "value", "malformed")


@query("claim_window_counts", with_sql(CLAIM_EVENT_SQL) + """
SELECT time_bucket(INTERVAL 5 MINUTES, report_date) AS window_start, time_bucket(INTERVAL 5 MINUTES, report_date) + INTERVAL 5 MINUTES AS window_end, loss_type, priority, channel, count(*) AS claim_count,
 CAST(sum(CAST(loss_amount_estimate AS DECIMAL(18,2))) AS DOUBLE) AS total_estimated_loss, CAST(sum(CAST(loss_amount_estimate AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_estimated_loss FROM ce GROUP BY ALL""")
def claim_window_counts(spark, sf):
    money = _claim_events(spark, sf).withColumn("loss_amount_estimate", F.col("loss_amount_estimate").cast("decimal(18,2)"))
    return plain(windows.claim_counts(money, "report_date"))


VELOCITY = """v AS (SELECT time_bucket(INTERVAL 5 MINUTES, event_timestamp) - INTERVAL 5 MINUTES * i AS window_start, customer_id, amount, event_type FROM payments, (VALUES (0), (1)) t(i)),
 c AS (SELECT window_start, window_start + INTERVAL 10 MINUTES AS window_end, customer_id, count(*) AS tx_count, CAST(sum(amount) AS DOUBLE) AS total_amount, CAST(sum(CASE WHEN event_type = 'decline' THEN 1 ELSE 0 END) AS BIGINT) AS decline_count FROM v GROUP BY ALL)"""


@query("payment_velocity", with_sql(PAYMENTS, VELOCITY) + "SELECT * FROM c WHERE tx_count > 5 OR total_amount > 100000 OR decline_count > 2")
def payment_velocity(spark, sf):
    return plain(windows.payment_velocity(b.payments(spark, sf)))


SESSION_KEYS = ["session_id", "user_id"]


@query("session_engagement", with_sql(CLICKS) + f"""
SELECT time_bucket(INTERVAL 30 MINUTES, event_timestamp) AS window_start, time_bucket(INTERVAL 30 MINUTES, event_timestamp) + INTERVAL 30 MINUTES AS window_end, session_id, user_id, count(*) AS event_count,
 CAST(sum({WEIGHT}) AS BIGINT) AS total_engagement, count(*) FILTER (WHERE event_type IN ('form_submit', 'quote_request')) AS conversions, max(time_on_page_sec) AS max_page_time FROM clicks GROUP BY ALL""")
def session_engagement(spark, sf):
    return windows.session_engagement(enrich.score_clicks(b.clicks(spark, sf)), SESSION_KEYS)


INACTIVE = """g AS (SELECT *, CASE WHEN event_timestamp - lag(event_timestamp) OVER (PARTITION BY session_id, user_id ORDER BY event_timestamp) <= INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS st FROM clicks),
 n AS (SELECT *, sum(st) OVER (PARTITION BY session_id, user_id ORDER BY event_timestamp) AS sno FROM g)"""


@query("inactivity_sessions", with_sql(CLICKS, INACTIVE) + f"""
SELECT min(event_timestamp) AS window_start, max(event_timestamp) + INTERVAL 30 MINUTES AS window_end, session_id, user_id, count(*) AS event_count, CAST(sum({WEIGHT}) AS BIGINT) AS total_engagement,
  count(*) FILTER (WHERE event_type IN ('form_submit', 'quote_request')) AS conversions FROM n GROUP BY session_id, user_id, sno""")
def inactivity_sessions(spark, sf):
    return windows.inactivity_sessions(enrich.score_clicks(b.clicks(spark, sf)), SESSION_KEYS)


@query("session_slots", with_sql(CLICKS, INACTIVE) + """
SELECT session_id, user_id, min(event_timestamp) AS session_start, max(event_timestamp) AS session_end, count(*) AS event_count, max(time_on_page_sec) AS max_page_time FROM n GROUP BY session_id, user_id, sno""")
def session_slots(spark, sf):
    """The same sessions from per-slot partial results, for keys too busy to be sorted whole."""
    measures = {"event_count": (F.count("*"), "sum"), "max_page_time": (F.max("time_on_page_sec"), "max")}
    return w.sessions(b.clicks(spark, sf), SESSION_KEYS, "event_timestamp", 30, measures)


@query("web_sessions", with_sql(CLICKS, INACTIVE) + """
SELECT min(event_timestamp) AS window_start, max(event_timestamp) + INTERVAL 30 MINUTES AS window_end, session_id, user_id, count(*) AS event_count, min(event_timestamp) AS session_start, max(event_timestamp) AS session_end,
  array_to_string(list_sort(list_distinct(list(product_interest))), ',') AS products_viewed, count(*) FILTER (WHERE event_type = 'quote_request') AS quote_requests FROM n GROUP BY session_id, user_id, sno""")
def web_sessions(spark, sf):
    out = windows.web_sessions(b.clicks(spark, sf), "session_id", "user_id", "event_timestamp", "event_type", "product_interest")
    return out.withColumn("products_viewed", F.array_join("products_viewed", ","))


@query("session_event_sequences", with_sql(CLICKS, "o AS (SELECT *, row_number() OVER (PARTITION BY session_id, user_id ORDER BY event_timestamp, event_id) - 1 AS n FROM clicks)") + """
SELECT session_id, user_id, n // 8 AS part_no, string_agg(event_type, '>' ORDER BY n) AS event_sequence FROM o GROUP BY ALL""")
def session_event_sequences(spark, sf):
    out = windows.event_sequences(b.clicks(spark, sf), SESSION_KEYS, "event_timestamp", "event_id", "event_type", 8)
    return out.withColumn("event_sequence", F.array_join("event_sequence", ">"))


CENTRE_SQL = with_sql(CALLS_SQL) + """
SELECT time_bucket(INTERVAL 15 MINUTES, event_timestamp) AS window_start, time_bucket(INTERVAL 15 MINUTES, event_timestamp) + INTERVAL 15 MINUTES AS window_end, queue_name, intent_detected, count(*) AS call_count,
 avg(wait_time_sec) AS avg_wait_sec, avg(talk_time_sec) AS avg_talk_sec, round(avg(sentiment_score), 6) AS avg_sentiment, count(*) FILTER (WHERE call_disposition = 'abandoned') AS abandoned_count FROM calls GROUP BY ALL"""


@query("contact_centre_metrics", CENTRE_SQL)
def contact_centre_metrics(spark, sf):
    return windows.contact_centre(_calls(spark, sf)).withColumn("avg_sentiment", F.round("avg_sentiment", 6))


MINUTE_SQL = with_sql(PAYMENTS, """pm AS (
SELECT time_bucket(INTERVAL 1 MINUTE, event_timestamp) AS window_start, time_bucket(INTERVAL 1 MINUTE, event_timestamp) + INTERVAL 1 MINUTE AS window_end, event_type AS payment_type, status, count(*) AS payment_count,
 CAST(sum(amount) AS DOUBLE) AS total_amount, CAST(sum(amount) AS DOUBLE) / count(*) AS avg_amount FROM payments GROUP BY ALL)""")


def _minutes(payments):
    return plain(windows.payment_minutes(payments.withColumnRenamed("event_type", "payment_type"), "event_timestamp"))


@query("payment_minutes", MINUTE_SQL + "SELECT * FROM pm")
def payment_minutes(spark, sf):
    return _minutes(b.payments(spark, sf))


@query("high_value_claims_by_type", with_sql(CLAIM_EVENT_SQL, SCORED) + "SELECT loss_type, count(*) AS claim_count, round(avg(loss_amount_estimate), 4) AS avg_loss_amount FROM s2 WHERE fraud_risk_score > 0.5 GROUP BY loss_type")
def high_value_claims_by_type(spark, sf):
    scored = enrich.enrich_claims(_claim_events(spark, sf))
    return windows.high_value_by_type(scored, "loss_type", "fraud_risk_score", "loss_amount_estimate", 0.5).withColumn("avg_loss_amount", F.round("avg_loss_amount", 4))


@query("approval_rate_by_minute", with_sql(PAYMENTS) + """
SELECT date_trunc('minute', event_timestamp) AS minute, event_type, count(*) AS total_payments, CAST(sum(amount) AS DOUBLE) AS total_amount, count(*) FILTER (WHERE status = 'approved') * 100.0::DOUBLE / count(*) AS approval_rate FROM payments GROUP BY ALL""")
def approval_rate_by_minute(spark, sf):
    return plain(windows.approval_by_minute(b.payments(spark, sf), "event_timestamp", "event_type", F.col("status") == "approved"))


@query("active_users_by_minute", "SELECT date_trunc('minute', ts) AS minute, count(*) AS events, count(DISTINCT user_id) AS unique_users FROM events WHERE ts > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 720 MINUTES GROUP BY ALL")
def active_users_by_minute(spark, sf):
    return windows.active_by_minute(table(spark, sf, "events"), "ts", "user_id", at(b.EVENTS_AS_OF), 720, approximate=False)


# ---- the same as streams -------------------------------------------------------------


def _stream(spark, sf, delay):
    """The events as a stream of files, watermarked."""
    schema = table(spark, sf, "events").schema
    return parse.with_watermark(read_event_stream(spark, sf, schema, pathGlobFilter="events.parquet"), "ts", delay)


def _run(df, name):
    """Run a query over what is there and read back what it wrote."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    q = queries.start(df, f"{folder}/out", f"{folder}/state", f"{name}_{uuid.uuid4().hex[:8]}")
    q.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def _unzoned(df):
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name) for f in df.schema.fields])


@query("stream_payment_minutes", MINUTE_SQL + "SELECT * FROM pm WHERE window_end <= (SELECT max(event_timestamp) FROM payments) - INTERVAL 5 MINUTES")
def stream_payment_minutes(spark, sf):
    """Append mode: a window appears once the watermark has passed it."""
    return _unzoned(_run(_minutes(b.payments(spark, sf, _stream(spark, sf, "5 minutes"))), "payment_minutes"))


@query("stream_late_data", MINUTE_SQL + "SELECT * FROM pm WHERE window_end <= (SELECT max(event_timestamp) FROM payments) - INTERVAL 5 MINUTES")
def stream_late_data(spark, sf):
    """All events, and after them the older half once more: what comes behind the watermark changes no window."""
    events, folder = table(spark, sf, "events"), f"{shared_folder(spark)}/late-{uuid.uuid4().hex}"
    middle = events.agg(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), 0.5)).scalar()
    parts = (events, events.filter(F.unix_micros(F.col("ts").cast("timestamp")) < middle))
    for number, part in enumerate(parts):
        part.write.parquet(f"{folder}/in/{number}")
        stream = parse.with_watermark(read_event_stream(spark, f"{folder}/in", events.schema, recursiveFileLookup="true"), "ts", "5 minutes")
        queries.start(_minutes(b.payments(spark, sf, stream)), f"{folder}/out", f"{folder}/state", f"late_{uuid.uuid4().hex[:8]}").awaitTermination()
    return _unzoned(spark.read.parquet(f"{folder}/out"))


@query("stream_inactivity_sessions", with_sql(CLICKS, INACTIVE) + f"""
SELECT * FROM (SELECT min(event_timestamp) AS window_start, max(event_timestamp) + INTERVAL 30 MINUTES AS window_end, session_id, user_id, count(*) AS event_count, CAST(sum({WEIGHT}) AS BIGINT) AS total_engagement,
  count(*) FILTER (WHERE event_type IN ('form_submit', 'quote_request')) AS conversions FROM n GROUP BY session_id, user_id, sno) WHERE window_end <= (SELECT max(event_timestamp) FROM clicks) - INTERVAL 60 SECONDS""")
def stream_inactivity_sessions(spark, sf):
    scored = enrich.score_clicks(b.clicks(spark, sf, _stream(spark, sf, parse.WATERMARKS["clicks"])))
    return _unzoned(_run(windows.inactivity_sessions(scored, SESSION_KEYS), "sessions"))


@query("stream_session_sequences", with_sql(CLICKS, INACTIVE) + """
SELECT session_id, user_id, min(event_timestamp) AS session_start, max(event_timestamp) AS session_end, 0 AS part_no, true AS is_last, count(*)::INTEGER AS event_count,
  string_agg(event_type, '>' ORDER BY event_timestamp, event_id::VARCHAR) AS event_sequence, coalesce(string_agg(DISTINCT product_interest, ',' ORDER BY product_interest), '') AS products_viewed
FROM n GROUP BY session_id, user_id, sno HAVING max(event_timestamp) + INTERVAL 30 MINUTES <= (SELECT max(event_timestamp) FROM clicks) - INTERVAL 60 SECONDS""")
def stream_session_sequences(spark, sf):
    """Sessions with their events in order, from a running stream with a state and timers of its own."""
    clicks = b.clicks(spark, sf, _stream(spark, sf, parse.WATERMARKS["clicks"]))
    out = _run(stateful.ordered_sessions(clicks, SESSION_KEYS, "event_timestamp", "event_id", "event_type", "product_interest"), "session_sequences")
    return out.withColumns({"event_sequence": F.array_join("event_sequence", ">"), "products_viewed": F.array_join("products_viewed", ",")})


@query("stream_alert_cooldown", """
WITH RECURSIVE hits AS (SELECT DISTINCT user_id, ts AS fired_at FROM events WHERE event_type = 'error' AND ts <= (SELECT max(ts) FROM events WHERE event_type = 'error') - INTERVAL 5 MINUTES),
 fired AS (SELECT user_id, min(fired_at) AS fired_at FROM hits GROUP BY user_id
   UNION ALL SELECT h.user_id, min(h.fired_at) FROM fired f JOIN hits h ON h.user_id = f.user_id AND h.fired_at >= f.fired_at + INTERVAL 720 MINUTES GROUP BY h.user_id)
SELECT * FROM fired""")
def stream_alert_cooldown(spark, sf):
    """Alerts of a running stream, each user's at least twelve hours apart."""
    errors = _stream(spark, sf, "5 minutes").filter("event_type = 'error'")
    return _run(stateful.alerts_with_cooldown(errors, ["user_id"], "ts", 720), "alert_cooldown")


@query("stream_payment_anomalies", with_sql(PAYMENTS) + """
SELECT transaction_id, amount > 50000 OR event_type IN ('chargeback', 'decline') OR amount < 0 AS is_anomaly, CASE WHEN amount > 50000 THEN 'high_value' WHEN event_type = 'chargeback' THEN 'chargeback' WHEN event_type = 'decline' THEN 'decline' WHEN amount < 0 THEN 'negative_amount' END AS anomaly_type FROM payments""")
def stream_payment_anomalies(spark, sf):
    flagged = enrich.flag_payments(b.payments(spark, sf, _stream(spark, sf, parse.WATERMARKS["payments"])), label_declines=True)
    return _run(flagged.select("transaction_id", "is_anomaly", "anomaly_type"), "payment_anomalies")


@query("stream_dimension_join", "SELECT event_id, user_id, coalesce(c_mktsegment, 'none') AS segment FROM events LEFT JOIN customer ON c_custkey = user_id")
def stream_dimension_join(spark, sf):
    dimension = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    joined = enrich.with_dimension(_stream(spark, sf, "1 minute"), dimension, "user_id")
    return _run(joined.select("event_id", "user_id", F.coalesce("segment", F.lit("none")).alias("segment")), "dimension_join")


@query("stream_fan_out", with_sql(PAYMENTS) + "SELECT 'raw' AS branch, count(*) AS n FROM payments UNION ALL SELECT 'anomalies', count(*) FILTER (WHERE amount > 50000 OR event_type IN ('chargeback', 'decline') OR amount < 0) FROM payments")
def stream_fan_out(spark, sf):
    """One read of the source, two outputs per micro-batch."""
    folder = f"{shared_folder(spark)}/fan-{uuid.uuid4().hex}"
    source = b.payments(spark, sf, _stream(spark, sf, "1 minute"))
    branches = {"raw": lambda df: df, "anomalies": lambda df: enrich.flag_payments(df).filter("is_anomaly")}
    queries.fan_out(source, branches, folder, f"{folder}/state").awaitTermination()
    parts = [spark.read.parquet(f"{folder}/{n}").select(F.lit(n).alias("branch")) for n in branches]
    return parts[0].unionByName(parts[1]).groupBy("branch").agg(F.count("*").alias("n"))


@query("query_health", """
WITH p AS (SELECT event_id, event_type <> 'error' AS is_active, CAST(json_extract_string(props, '$.k') AS BIGINT) * 1000 AS batch_duration_ms, value AS processing_rate, 20.0::DOUBLE AS input_rate FROM events)
SELECT event_id, CASE WHEN NOT is_active THEN 'STOPPED' WHEN batch_duration_ms > 60000 THEN 'SLOW' WHEN processing_rate < input_rate * 0.9::DOUBLE THEN 'LAGGING' ELSE 'HEALTHY' END AS health_status FROM p""")
def query_health(spark, sf):
    progress = table(spark, sf, "events").select(
        "event_id", (F.col("event_type") != "error").alias("is_active"), (F.get_json_object("props", "$.k").cast("bigint") * 1000).alias("batch_duration_ms"), F.col("value").alias("processing_rate"), F.lit(20.0).alias("input_rate")
    )
    return queries.query_health(progress).select("event_id", "health_status")
