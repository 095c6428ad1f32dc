"""Starting, fanning out, watching and stopping streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def start(
    df: DataFrame,
    path: str,
    checkpoint: str,
    name: str,
    mode: str = "append",
    every: str | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Start a file sink; without ``every`` it handles what is there and ends."""
    writer = df.writeStream.format(fmt).outputMode(mode).queryName(name)
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def fan_out(
    source: DataFrame,
    branches: Mapping[str, Callable[[DataFrame], DataFrame]],
    folder: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Raw, enriched and further outputs from one read of the source.

    A micro-batch is persisted once and written to every branch. The batch number is part
    of the path and the write replaces it, so a repeated batch leaves no duplicates.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for name, change in branches.items():
                change(batch).write.mode("overwrite").parquet(f"{folder}/{name}/batch={number}")
        finally:
            batch.unpersist()

    writer = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def upsert_sink(merge: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for update mode, skipping empty batches."""

    def write(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            merge(batch, number)

    return write


PROGRESS = (
    "query_name string, query_id string, is_active boolean, batch_id bigint, input_rows bigint, "
    "processing_rate double, input_rate double, batch_duration_ms bigint"
)


def progress_rows(queries: Sequence[StreamingQuery], spark: SparkSession) -> DataFrame:
    """Latest progress of each query as rows (one per query)."""
    rows = []
    for q in queries:
        p = q.lastProgress
        if p:
            rows.append(
                (
                    q.name, str(q.id), q.isActive, p["batchId"], p["numInputRows"],
                    float(p.get("processedRowsPerSecond") or 0.0), float(p.get("inputRowsPerSecond") or 0.0),
                    int((p.get("durationMs") or {}).get("triggerExecution", 0)),
                )
            )
    return spark.createDataFrame(rows, PROGRESS)


def query_health(progress: DataFrame, lag_share: float = 0.9, slow_ms: int = 60000) -> DataFrame:
    """STOPPED before SLOW before LAGGING before HEALTHY."""
    return progress.withColumn(
        "health_status",
        F.when(~F.col("is_active"), "STOPPED")
        .when(F.col("batch_duration_ms") > slow_ms, "SLOW")
        .when(F.col("processing_rate") < F.col("input_rate") * lag_share, "LAGGING")
        .otherwise("HEALTHY"),
    )


def active_queries(spark: SparkSession) -> list[tuple[str | None, str]]:
    return [(q.name, str(q.id)) for q in spark.streams.active]


def stop_queries(spark: SparkSession, wanted: str | None = None) -> list[str]:
    """Stop one query by name or id, or all of them."""
    stopped = []
    for q in spark.streams.active:
        if wanted in (None, q.name, str(q.id)):
            q.stop()
            stopped.append(str(q.id))
    return stopped


# Stream alert conditions.
STREAM_ALERTS = {
    "high_fraud_score": "fraud_score > 0.8",
    "large_loss": "loss_amount > 100000",
    "low_approval": "approval_rate < 90",
}
