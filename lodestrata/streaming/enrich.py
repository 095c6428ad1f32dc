"""Stateless event enrichment: the same functions for batches and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.hashing import row_hash
from lodestrata.operators.windows import micros


def _flag(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def enrich_claims(df: DataFrame) -> DataFrame:
    """Catastrophe flag, report lag, rule-based fraud score, automatic adjudication."""
    amount = F.col("loss_amount_estimate")
    out = df.withColumns(
        {
            "is_catastrophe": _flag(F.col("priority") == "catastrophe"),
            "report_lag_days": F.datediff(F.col("report_date").cast("date"), F.col("loss_date").cast("date")),
        }
    ).withColumn(
        "fraud_risk_score",
        F.when(amount > 100000, 0.7).when(F.col("report_lag_days") > 30, 0.6).when(F.col("channel") == "phone", 0.3).otherwise(0.1),
    )
    eligible = (amount < 5000) & (F.col("fraud_risk_score") < 0.3) & (F.col("priority") != "catastrophe")
    return out.withColumn("auto_adjudicate_eligible", _flag(eligible))


def score_loss_notices(df: DataFrame, event_time: str = "event_time") -> DataFrame:
    """Processing delay in seconds, reporting delay in hours and the score from amount and haste."""

    def seconds(c: str) -> Column:
        return F.floor(micros(F.col(c)) / 1_000_000)

    hours = (seconds("reported_date") - seconds("loss_date")) / 3600
    return df.withColumns(
        {"processing_delay_seconds": seconds("_processing_time") - seconds(event_time), "reporting_delay_hours": hours}
    ).withColumn(
        "fraud_score",
        F.when((F.col("loss_amount") > 50000) & (F.col("reporting_delay_hours") < 1), 0.8)
        .when(F.col("loss_amount") > 50000, 0.6)
        .when(F.col("reporting_delay_hours") < 1, 0.4)
        .otherwise(0.1),
    )


def flag_payments(df: DataFrame, label_declines: bool = False) -> DataFrame:
    """Anomaly flag and type: high value, chargeback, decline, negative amount.

    Declines are anomalies without a type unless ``label_declines`` is set.
    """
    amount, kind = F.col("amount"), F.col("event_type")
    label = F.when(amount > 50000, "high_value").when(kind == "chargeback", "chargeback")
    if label_declines:
        label = label.when(kind == "decline", "decline")
    return df.withColumns(
        {
            "is_anomaly": _flag((amount > 50000) | kind.isin("chargeback", "decline") | (amount < 0)),
            "anomaly_type": label.when(amount < 0, "negative_amount"),
            "_record_hash": row_hash(["transaction_id", "amount", "event_timestamp"]),
        }
    )


def score_clicks(df: DataFrame) -> DataFrame:
    """Conversion flag and engagement weight of each click."""
    kind = F.col("event_type")
    return df.withColumns(
        {
            "is_conversion_event": _flag(kind.isin("form_submit", "quote_request")),
            "engagement_score": F.when(kind == "quote_request", 10)
            .when(kind == "form_submit", 8)
            .when(kind == "form_start", 5)
            .when(kind == "click", 2)
            .otherwise(1),
        }
    )


def flag_calls(df: DataFrame) -> DataFrame:
    """Long wait, negative sentiment, escalation."""
    mood = F.col("sentiment_score")
    return df.withColumns(
        {
            "long_wait_flag": _flag(F.col("wait_time_sec") > 300),
            "negative_sentiment_flag": _flag(mood < -0.5),
            "escalation_needed": _flag((F.col("call_disposition") == "transferred") & (mood < -0.3)),
        }
    )


def with_dimension(stream: DataFrame, dimension: DataFrame, on: str) -> DataFrame:
    """Stream-static left join with a dimension of one row per key."""
    return stream.join(dimension, on, "left")
