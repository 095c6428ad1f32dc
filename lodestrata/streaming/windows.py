"""Windowed aggregates, usable on a batch or on a watermarked stream.

On a stream they run in append mode: a window is emitted once, when the watermark has passed
it, and its state is then dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.operators.aggregates import mean
from lodestrata.operators.windows import ordered_lists


def _windowed(df: DataFrame, ts: str, keys: Sequence[str], length: str, slide: str | None = None):
    w = F.window(F.col(ts), length, slide) if slide else F.window(F.col(ts), length)
    return df.groupBy(w, *keys)


def flat(df: DataFrame, name: str = "window") -> DataFrame:
    """Window bounds as two plain columns."""
    rest = [c for c in df.columns if c != name]
    return df.select(F.col(f"{name}.start").alias("window_start"), F.col(f"{name}.end").alias("window_end"), *rest)


def claim_counts(df: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """Five-minute claims by loss type, priority and channel."""
    return flat(
        _windowed(df, ts, ["loss_type", "priority", "channel"], "5 minutes").agg(
            F.count("*").alias("claim_count"),
            F.sum("loss_amount_estimate").alias("total_estimated_loss"),
            mean(F.col("loss_amount_estimate")).alias("avg_estimated_loss"),
        )
    )


def payment_velocity(df: DataFrame, ts: str = "event_timestamp", customer: str = "customer_id", max_count: int = 5,
                     max_amount: float = 100000, max_declines: int = 2) -> DataFrame:
    """Ten-minute windows every five minutes in which a customer pays too often, too much or in vain."""
    counted = flat(
        _windowed(df, ts, [customer], "10 minutes", "5 minutes").agg(
            F.count("*").alias("tx_count"),
            F.sum("amount").alias("total_amount"),
            F.sum(F.when(F.col("event_type") == "decline", 1).otherwise(0)).alias("decline_count"),
        )
    )
    return counted.filter(
        (F.col("tx_count") > max_count) | (F.col("total_amount") > max_amount) | (F.col("decline_count") > max_declines)
    )


def session_engagement(df: DataFrame, keys: Sequence[str], ts: str = "event_timestamp") -> DataFrame:
    """Engagement per session and fixed half hour."""
    return flat(
        _windowed(df, ts, keys, "30 minutes").agg(
            F.count("*").alias("event_count"),
            F.sum("engagement_score").alias("total_engagement"),
            F.sum(F.when(F.col("is_conversion_event"), 1).otherwise(0)).alias("conversions"),
            F.max("time_on_page_sec").alias("max_page_time"),
        )
    )


def inactivity_sessions(df: DataFrame, keys: Sequence[str], ts: str = "event_timestamp", gap: str = "30 minutes") -> DataFrame:
    """Engagement per session ended by inactivity (a true session window)."""
    grouped = df.groupBy(F.session_window(F.col(ts), gap), *keys).agg(
        F.count("*").alias("event_count"),
        F.sum("engagement_score").alias("total_engagement"),
        F.sum(F.when(F.col("is_conversion_event"), 1).otherwise(0)).alias("conversions"),
    )
    return flat(grouped, "session_window")


def contact_centre(df: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """Quarter-hour call metrics by queue and intent."""
    return flat(
        _windowed(df, ts, ["queue_name", "intent_detected"], "15 minutes").agg(
            F.count("*").alias("call_count"),
            mean(F.col("wait_time_sec")).alias("avg_wait_sec"),
            mean(F.col("talk_time_sec")).alias("avg_talk_sec"),
            mean(F.col("sentiment_score")).alias("avg_sentiment"),
            F.sum(F.when(F.col("call_disposition") == "abandoned", 1).otherwise(0)).alias("abandoned_count"),
        )
    )


def payment_minutes(df: DataFrame, ts: str = "payment_timestamp") -> DataFrame:
    """One-minute payment metrics by type and status."""
    return flat(
        _windowed(df, ts, ["payment_type", "status"], "1 minute").agg(
            F.count("*").alias("payment_count"),
            F.sum("amount").alias("total_amount"),
            mean(F.col("amount")).alias("avg_amount"),
        )
    )


def web_sessions(df: DataFrame, session: str, user: str, ts: str, kind: str, product: str, gap: str = "30 minutes") -> DataFrame:
    """Sessions by inactivity with counts and the set of products viewed (bounded by the catalogue)."""
    grouped = df.groupBy(F.session_window(F.col(ts), gap), session, user).agg(
        F.count("*").alias("event_count"),
        F.min(ts).alias("session_start"),
        F.max(ts).alias("session_end"),
        F.sort_array(F.collect_set(product)).alias("products_viewed"),
        F.sum(F.when(F.col(kind) == "quote_request", 1).otherwise(0)).alias("quote_requests"),
    )
    return flat(grouped, "session_window")


def event_sequences(df: DataFrame, keys: Sequence[str], ts: str, event_id: str, kind: str, size: int = 1000) -> DataFrame:
    """Ordered event types of each session, in parts of at most ``size`` events (batch only)."""
    return ordered_lists(df, keys, [ts, event_id], kind, "event_sequence", size)


def high_value_by_type(df: DataFrame, kind: str, score: str, amount: str, min_score: float = 0.7) -> DataFrame:
    """Claims above a fraud score by type."""
    return df.filter(F.col(score) > min_score).groupBy(kind).agg(
        F.count("*").alias("claim_count"), mean(F.col(amount)).alias("avg_loss_amount")
    )


def approval_by_minute(df: DataFrame, ts: str, kind: str, approved: Column) -> DataFrame:
    """Payments, volume and approval rate per minute and type."""
    return df.groupBy(F.date_trunc("minute", F.col(ts)).alias("minute"), kind).agg(
        F.count("*").alias("total_payments"),
        F.sum("amount").alias("total_amount"),
        (F.count_if(approved) * F.lit(100.0) / F.count("*")).alias("approval_rate"),
    )


def active_by_minute(df: DataFrame, ts: str, user: str, as_of: Column, minutes: int = 30, approximate: bool = False) -> DataFrame:
    """Events and distinct users per minute of the last ``minutes``; ``approximate`` counts users by a sketch."""
    distinct = F.approx_count_distinct(user) if approximate else F.countDistinct(user)
    recent = df.filter(F.col(ts) > as_of - F.make_interval(mins=F.lit(minutes)))
    return recent.groupBy(F.date_trunc("minute", F.col(ts)).alias("minute")).agg(
        F.count("*").alias("events"), distinct.alias("unique_users")
    )
