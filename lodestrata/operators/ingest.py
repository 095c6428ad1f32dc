"""Rule-driven ingest: configuration lookups, mapping, audit columns, watermark, log."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions.hashing import business_columns, row_hash
from lodestrata.operators.history import conditional_update, keep_latest
from lodestrata.sources import readers
from lodestrata.sources.writers import write_load

Rule = Mapping[str, Any]


def active_rules(rules: DataFrame, sources: DataFrame, environment: str, domain: str | None = None) -> DataFrame:
    """Active ingestion rules with their source settings, by priority."""
    joined = rules.filter("is_active").join(
        sources.filter(F.col("is_active") & (F.col("environment") == environment)).drop("is_active", "environment"),
        "source_id",
    )
    if domain:
        joined = joined.filter(F.col("domain") == domain)
    return joined.orderBy("priority", "rule_id")


def mappings_of(mappings: DataFrame, rule_id: str) -> DataFrame:
    return mappings.filter(F.col("rule_id") == rule_id).orderBy("column_order")


def config_value(config: DataFrame, key: str, environment: str) -> str | None:
    row = config.filter((F.col("config_key") == key) & (F.col("environment") == environment)).select("config_value").first()
    return row[0] if row else None


def apply_mapping(df: DataFrame, mappings: Sequence[Rule]) -> DataFrame:
    """All mapped columns in one projection; without mappings the input passes through."""
    if not mappings:
        return df

    def target(m: Rule) -> Column:
        source = F.expr(m["transformation_expr"]) if m["transformation_expr"] else F.col(m["source_column"])
        return source.cast(m["target_data_type"]).alias(m["target_column"])

    return df.select(*[target(m) for m in mappings])


def add_audit(df: DataFrame, rule_id: str, execution_id: str, at: Column) -> DataFrame:
    return df.withColumns(
        {
            "_ingestion_timestamp": at,
            "_ingestion_rule_id": F.lit(rule_id),
            "_execution_id": F.lit(execution_id),
            "_record_hash": row_hash(business_columns(df)),
        }
    )


def evolve(*parts: DataFrame) -> DataFrame:
    """Union by name; columns an older part lacks are NULL there."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def schema_difference(df: DataFrame, expected: Sequence[str]) -> tuple[list[str], list[str]]:
    """(missing, unexpected) column names."""
    have = set(df.columns)
    want = set(expected)
    return sorted(want - have), sorted(have - want)


def enforce_schema(df: DataFrame, expected: Sequence[str], mode: str) -> DataFrame:
    """``strict`` raises on any difference, ``evolve`` lets new columns in, ``ignore`` drops them.

    A missing expected column is an error in every mode but ``evolve``.
    """
    missing, extra = schema_difference(df, expected)
    if mode == "strict" and (missing or extra):
        raise ValueError(f"missing columns {missing}, unexpected columns {extra}")
    if mode == "ignore":
        if missing:
            raise ValueError(f"missing columns {missing}")
        return df.select(*expected)
    return df


def watermark(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("watermark"))


def advance_watermark(rules: DataFrame, rule_id: str, value: str) -> DataFrame:
    return conditional_update(rules, F.col("rule_id") == rule_id, {"incremental_value": F.lit(value)})


READERS: dict[str, Callable[[SparkSession, Rule], DataFrame]] = {
    "file": readers.read_file,
    "jdbc": readers.read_jdbc,
    "table": lambda spark, rule: readers.read_table(spark, rule["source_table_or_path"]),
    "events": lambda spark, rule: readers.read_landed_events(spark, rule["source_table_or_path"]),
}

LOG_SCHEMA = (
    "execution_id string, rule_id string, status string, record_count bigint, "
    "watermark string, error_message string"
)


def run_ingestion(
    spark: SparkSession,
    rules: Sequence[Rule],
    mappings: Mapping[str, Sequence[Rule]],
    target_folder: str,
    execution_id: str,
    at: Column,
) -> DataFrame:
    """Run every rule and return the execution log; a failing rule does not stop the rest.

    An incremental load takes up where its target ends, or at the rule's value where nothing is loaded yet. It is a
    partition of its own, named by the execution and by the mark after which it begins, so the ranges that
    executions have read are stored with their rows and neither can be without the other. Running an execution again reads its
    own range again, up to where the next one begins, and replaces its rows: whatever the order of
    repeats and however the source has grown, no row is lost or loaded twice. One Spark job per rule
    writes; the row count and the new mark are observed meanwhile. Of the target only the newest load's marks are read. De-duplication keeps the row with the largest increment (then the largest hash)
    and happens before the write and the count. Only rule rows (tens of them) are on the driver.
    """
    log = []
    for rule in rules:
        rule_id = rule["rule_id"]
        if rule.get("ingestion_mode") == "streaming":
            continue
        try:
            path = f"{target_folder}/{rule['target_table']}"
            mark_col, steps = rule.get("incremental_column"), rule.get("ingestion_mode") == "incremental"
            if mark_col and steps:
                lower, upper = range_to_read(spark, path, mark_col, execution_id, rule.get("incremental_value"))
                rule = {**rule, "incremental_value": lower, "incremental_upto": upper}
            df = READERS[rule["source_type"]](spark, rule)
            df = apply_mapping(df, mappings.get(rule_id, ()))
            if rule.get("schema_enforcement") and rule.get("expected_columns"):
                df = enforce_schema(df, rule["expected_columns"], rule["schema_enforcement"])
            if mark_col and rule["source_type"] != "jdbc":
                df = within(df, mark_col, rule.get("incremental_value"), rule.get("incremental_upto"))
            mark = F.max(mark_col if mark_col else F.lit(None)).cast("string")
            seen = Observation(f"ingest_{rule_id}")
            df = add_audit(df, rule_id, execution_id, at)
            if rule.get("dedup_columns"):
                keys = [c.strip() for c in rule["dedup_columns"].split(",")]
                order = ([F.col(mark_col).desc()] if mark_col else []) + [F.col("_record_hash").desc()]
                df = keep_latest(df, keys, order)
            df = df.observe(seen, F.count(F.lit(1)).alias("n"), mark.alias("mark"))
            parts = [c.strip() for c in (rule.get("partition_columns") or "").split(",") if c.strip()]
            if steps:
                df = df.withColumn(AFTER, F.lit(_after(rule.get("incremental_value"))))
                write_load(df, path, "partitions", ["_execution_id", AFTER, *parts])
            else:
                write_load(df, path, rule["ingestion_mode"], parts)
            got = seen.get
            log.append((execution_id, rule_id, "succeeded", got["n"], got["mark"], None))
        except (PySparkException, KeyError, OSError, ValueError) as problem:
            log.append((execution_id, rule_id, "failed", 0, None, type(problem).__name__))
    return spark.createDataFrame(log, LOG_SCHEMA)


#: Partition of a load that tells where its range begins; the words keep it a string when folders are read.
AFTER = "_after"


def _after(value: Any) -> str:
    return "from the start" if value is None else f"after {value}"


def within(df: DataFrame, column: str, lower: Any, upper: Any) -> DataFrame:
    """Rows whose ``column`` is in (``lower``, ``upper``]; a missing bound is open, and without a lower one NULLs belong to the range."""
    value, kind = F.col(column), df.schema[column].dataType
    if lower is not None:
        df = df.filter(value > F.lit(lower).cast(kind))
    if upper is not None:
        below = value <= F.lit(upper).cast(kind)
        df = df.filter(below if lower is not None else below | value.isNull())
    return df


def range_to_read(spark: SparkSession, path: str, column: str, execution_id: str, start: Any) -> tuple[Any, Any]:
    """The range of ``column`` that an execution reads, as (after, up to); None is open.

    A new execution begins at the target's largest value (``start`` without a target) and has no end. One that has run before
    gets its own range again: up to where the next one begins, or up to its own largest value if it
    was the last. Loads follow each other, so the load that begins last holds the largest value, and no other
    is looked into.
    """
    try:
        target = spark.read.parquet(path)
    except AnalysisException:
        return start, None
    kind = target.schema[column].dataType
    begins = F.when(F.col(AFTER).startswith("after "), F.substring(AFTER, 7, 1 << 20).cast(kind))
    loads = target.select(F.col("_execution_id").cast("string").alias("_run"), F.col(AFTER), begins.alias("_from")).distinct()
    own = F.col("_run") == execution_id
    newest = F.max(F.struct(F.col("_from").isNotNull().alias("a"), F.col("_from").alias("b"), F.col(AFTER).alias("c")))
    known = loads.agg(F.max(F.when(own, F.col(AFTER))).alias("own"), newest.getField("c").alias("newest")).first()
    largest = lambda after: target.filter(F.col(AFTER) == after).agg(F.max(column).cast("string")).first()[0]
    if known["own"] is None:
        done = largest(known["newest"]) if known["newest"] is not None else None
        return (done if done is not None else start), None
    lower = None if known["own"] == _after(None) else known["own"].removeprefix("after ")
    later = F.col("_from").isNotNull() if lower is None else F.col("_from") > F.lit(lower).cast(kind)
    upper = loads.filter(later).agg(F.min("_from").cast("string")).first()[0]
    return lower, upper if upper is not None else largest(known["own"])


def run_rule_tables(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    environment: str,
    target_folder: str,
    execution_id: str,
    at: Column,
    domain: str | None = None,
) -> DataFrame:
    """:func:`run_ingestion` for the active rules of the control tables.

    ``tables`` holds ``ingestion_rules``, ``source_systems`` and ``schema_mapping``.
    """
    rules = [r.asDict() for r in active_rules(tables["ingestion_rules"], tables["source_systems"], environment, domain).collect()]
    mappings = {r["rule_id"]: [m.asDict() for m in mappings_of(tables["schema_mapping"], r["rule_id"]).collect()] for r in rules}
    return run_ingestion(spark, rules, mappings, target_folder, execution_id, at)


def store_marks(rules: DataFrame, log: DataFrame) -> DataFrame:
    """The rules with the marks of a log's successful loads; a rule without a new mark keeps its own."""
    new = log.filter("status = 'succeeded' AND watermark IS NOT NULL").groupBy("rule_id").agg(F.max_by("watermark", "execution_id").alias("_mark"))
    value = F.coalesce("_mark", "incremental_value").alias("incremental_value")
    return rules.join(new, "rule_id", "left").select(*[value if c == "incremental_value" else c for c in rules.columns])
