"""Call transcripts and call analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def transcripts(
    segments: DataFrame,
    call: str = "call_id",
    order: str = "segment_index",
    role: str = "speaker_label",
    text: str = "text",
    segments_per_part: int = 1000,
) -> DataFrame:
    """Transcript of each call, ``role: text`` lines in segment order.

    A call is cut into parts of consecutive segment numbers, so that a part is bounded
    whatever the length of a call; calls below the limit have one part. A segment delivered
    twice counts once.
    """
    unique = segments.select(call, order, role, text).distinct()
    part = F.floor(F.col(order) / segments_per_part).cast("int")
    line = F.concat(F.coalesce(F.col(role), F.lit("")), F.lit(": "), F.coalesce(F.col(text), F.lit("")))
    lines = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("l"))))
    return (
        unique.groupBy(call, part.alias("part_no"))
        .agg(lines.alias("_lines"), F.count("*").alias("segment_count"))
        .select(call, "part_no", "segment_count", F.array_join(F.transform("_lines", lambda s: s["l"]), "\n").alias("transcript"))
    )


def call_analytics(events: DataFrame, call: str = "call_id") -> DataFrame:
    """Per call: events, mean sentiment, waits and whether it needed escalation."""
    return events.groupBy(call).agg(
        F.count("*").alias("event_count"),
        F.avg("sentiment_score").alias("avg_sentiment"),
        F.max("wait_time_sec").alias("max_wait_sec"),
        F.bool_or("escalation_needed").alias("escalation_needed"),
    )
