"""Payload parsing and watermarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# How late events of each topic may be, and how often its queries run.
WATERMARKS = {"claims": "30 seconds", "payments": "15 seconds", "clicks": "60 seconds", "calls": "30 seconds"}
TRIGGERS = {"claims": "10 seconds", "payments": "5 seconds", "clicks": "30 seconds", "calls": "15 seconds"}
WEB_SESSION_WATERMARK = "30 minutes"
NOTICE_WATERMARK = "5 minutes"


def parse_payload(raw: DataFrame, schema: T.StructType, at: Column, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """Bytes or text of ``body`` as flat columns, source columns kept, processing time added.

    A payload that is no valid JSON keeps its text in ``_corrupt_record``.
    """
    text = F.col(body).cast("string")
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields] + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(text, loose, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return raw.select(parsed.alias("data"), *keep, at.alias("_processing_time")).select("data.*", *keep, "_processing_time")


def good_and_bad(parsed: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, rows that failed to parse or lack a required field)."""
    ok = F.col(CORRUPT).isNull()
    for name in required:
        ok = ok & F.col(name).isNotNull()
    return parsed.filter(ok).drop(CORRUPT), parsed.filter(~ok)


def with_watermark(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermark on event time; a zone-less timestamp is read as UTC first, as streams require."""
    field = next(f for f in df.schema.fields if f.name == ts)
    if isinstance(field.dataType, T.TimestampNTZType):
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, delay)


def drop_repeated(df: DataFrame, key: str) -> DataFrame:
    """Drop redelivered events within the watermark."""
    return df.dropDuplicatesWithinWatermark([key])
