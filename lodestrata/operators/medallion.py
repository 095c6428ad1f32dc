"""One batch through all layers: landed rows, versions, checks, dimension and fact, with a row of figures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.operators import gold, history, ingest, quality
from lodestrata.sources.writers import write_load


@dataclass
class Medallion:
    """Where a subject's layers lie, and how its rows are told apart and checked.

    ``checks`` are those of :func:`quality.run_rules`; ``type_column`` is what a version counts as in the fact.
    """

    folder: str
    keys: Sequence[str]
    attributes: Sequence[str]
    type_column: str
    checks: Sequence[Mapping[str, Any]] = field(default_factory=list)
    #: Silver snapshots written so far; each batch reads the last and writes the next, so nothing is overwritten while it is read.
    versions: int = 0

    def silver(self, spark: SparkSession) -> DataFrame | None:
        return spark.read.parquet(f"{self.folder}/silver/{self.versions}") if self.versions else None


def run_batch(spark: SparkSession, subject: Medallion, batch: DataFrame, execution_id: str, at: Column) -> DataFrame:
    """Take one batch through the layers and return its figures as one row.

    Landed rows are appended as they come (a repeated execution replaces its own). Of rows that repeat a key inside the batch the one with
    the largest hash counts. Changed keys get a new version, unchanged ones none. Checks are run on the whole silver
    table and reported, they stop nothing. Dimension and fact are written anew.
    """
    landed = ingest.add_audit(batch, subject.folder, execution_id, at)
    write_load(landed, f"{subject.folder}/bronze", "partitions", ["_execution_id"])
    bronze = spark.read.parquet(f"{subject.folder}/bronze")
    own = bronze.filter(F.col("_execution_id").cast("string") == execution_id).select(*batch.columns)
    hashed = history.with_row_hash(own, list(subject.attributes))
    latest = history.keep_latest(hashed, list(subject.keys), [F.col("_record_hash").desc()])
    before = subject.silver(spark)
    after = history.open_version(latest, at) if before is None else history.scd2_merge(before, latest, list(subject.keys), at)
    write_load(after, f"{subject.folder}/silver/{subject.versions + 1}", "full")
    subject.versions += 1
    silver = subject.silver(spark)
    results = quality.run_rules(silver, "silver", list(subject.checks))
    dimension = gold.keyed_dimension(silver, list(subject.keys), [*subject.keys, *subject.attributes], "dimension_key")
    fact = gold.version_fact(silver, subject.keys[0], subject.type_column, [], at)
    for name, df in (("dimension", dimension), ("fact", fact)):
        write_load(df, f"{subject.folder}/gold/{name}", "full")
    count = lambda df: df.agg(F.count("*").alias("n")).scalar()
    failed = results.agg(F.count_if(~F.col("check_passed")).alias("n")).scalar()
    return own.agg(F.lit(execution_id).alias("execution_id"), F.count("*").alias("landed_rows")).withColumns(
        {
            "bronze_rows": count(bronze), "repeated_rows": F.col("landed_rows") - count(latest), "silver_rows": count(silver), "current_rows": count(spark.read.parquet(f"{subject.folder}/gold/dimension")),
            "fact_rows": count(spark.read.parquet(f"{subject.folder}/gold/fact")), "failed_checks": failed,
        }
    )
