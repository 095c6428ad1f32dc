"""Readers chosen by a rule row: files, tables, JDBC, landed responses, event logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Rule = Mapping[str, Any]


def csv_options(rule: Rule) -> dict[str, str]:
    """Reader options of a CSV rule.

    ``file_multiline`` defaults to off: only then can Spark split one big file over tasks.
    """
    return {
        "header": str(rule.get("file_header", True)).lower(),
        "sep": rule.get("file_delimiter", ","),
        "encoding": rule.get("file_encoding", "UTF-8"),
        "multiLine": str(rule.get("file_multiline", False)).lower(),
    }


def read_file(spark: SparkSession, rule: Rule, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV, JSON, Parquet, ORC or XML with ``_source_file`` added.

    Give a schema wherever it is known; inference costs one more pass over the files.
    """
    kind = rule.get("file_format", "csv")
    reader = spark.read.format(kind)
    if kind == "csv":
        reader = reader.options(**csv_options(rule))
    if kind == "xml":
        reader = reader.option("rowTag", rule.get("row_tag", "record"))
    if schema is not None:
        reader = reader.schema(schema)
    elif kind == "csv":
        reader = reader.option("inferSchema", "true")
    df = reader.load(rule["source_table_or_path"])
    return df.withColumn("_source_file", F.col("_metadata.file_path"))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def jdbc_options(rule: Rule) -> dict[str, str]:
    """Options of a JDBC read.

    With ``partition_column`` and bounds the read is split into ``num_partitions`` ranges;
    ``source_query`` stands for the table; an increment becomes a subquery around either, which
    the database filters.
    """
    options = {
        "url": rule["url"],
        "dbtable": rule["source_table_or_path"],
        "fetchsize": str(rule.get("batch_size") or 100000),
    }
    auth = {"managed_identity": "ActiveDirectoryMSI", "service_principal": "ActiveDirectoryServicePrincipal"}
    if rule.get("authentication_type") in auth:
        options["authentication"] = auth[rule["authentication_type"]]
    if rule.get("source_query"):
        options["dbtable"] = f"({rule['source_query']}) AS custom_src"
    if rule.get("ingestion_mode") == "incremental":
        column, literal = rule.get("incremental_column"), lambda v: "'" + str(v).replace("'", "''") + "'"
        lower, upper = rule.get("incremental_value"), rule.get("incremental_upto")
        bounds = [f"{column} > {literal(lower)}"] if lower is not None else []
        if upper is not None:
            bounds.append(f"{column} <= {literal(upper)}" if bounds else f"({column} <= {literal(upper)} OR {column} IS NULL)")
        if column and bounds:
            options["dbtable"] = f"(SELECT * FROM {options['dbtable']} WHERE {' AND '.join(bounds)}) AS src"
    if rule.get("partition_column"):
        options.update(
            partitionColumn=rule["partition_column"],
            lowerBound=str(rule["lower_bound"]),
            upperBound=str(rule["upper_bound"]),
            numPartitions=str(rule.get("num_partitions", 8)),
        )
    return options


def read_jdbc(spark: SparkSession, rule: Rule) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(rule)).load()


def read_landed_json(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """Records of landed service responses, one response per line.

    A response may be a bare array, ``{"data": [...]}``, ``{"results": [...]}`` or a single
    object; each is unwrapped to one row per record.
    """
    many = T.ArrayType(record)
    envelope = T.StructType([T.StructField("data", many), T.StructField("results", many)])
    line = F.trim(F.col("value"))
    body = F.from_json(line, envelope)
    bare = F.when(line.startswith("["), F.from_json(line, many))
    records = F.coalesce(bare, body["data"], body["results"], F.array(F.from_json(line, record)))
    raw = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    return raw.select(F.explode(records).alias("r")).select("r.*")


def read_landed_events(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    time_col: str | None = None,
    start: Column | None = None,
    end: Column | None = None,
) -> DataFrame:
    """Batch replay of a landed event log, optionally one time range (pushed to the scan)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    if time_col and start is not None:
        df = df.filter(F.col(time_col) >= start)
    if time_col and end is not None:
        df = df.filter(F.col(time_col) < end)
    return df


def read_event_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Streaming source: files here, ``fmt='kafka'`` with its options in production."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt != "kafka":
        reader = reader.schema(schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return reader.load(path)
    return reader.load()


def read_binary(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files below a folder with name and extension; content is read only if selected."""
    df = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
    )
    return df.withColumns(
        {
            "file_name": F.regexp_extract("path", r"([^/]+)$", 1),
            "file_extension": F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)),
        }
    )


def file_catalogue(spark: SparkSession, path: str, extensions: Sequence[str], type_pattern: str) -> DataFrame:
    """Files awaiting processing, their kind taken from the path; contents are not read."""
    return (
        read_binary(spark, path)
        .filter(F.col("file_extension").isin(*extensions))
        .select(
            "path",
            "file_name",
            "file_extension",
            F.col("length").alias("file_size"),
            F.regexp_extract("path", type_pattern, 1).alias("doc_type"),
            F.lit("pending").alias("status"),
        )
    )


def tagged_union(sources: Mapping[str, DataFrame], tag: str = "source_system") -> DataFrame:
    """All sources in one, matched by column name, each row carrying its source."""
    out = None
    for name, df in sources.items():
        part = df.withColumn(tag, F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def read_vendor_file(spark: SparkSession, vendor: str, rule: Rule, at: Column, schema=None) -> DataFrame:
    return read_file(spark, rule, schema).withColumns(
        {"_source_vendor": F.lit(vendor), "_ingestion_timestamp": at}
    )


def mirror_landing(df: DataFrame, source_system: str, at: Column) -> DataFrame:
    return df.withColumns({"_source_system": F.lit(source_system), "_ingestion_time": at})


def read_fixed_width(spark: SparkSession, path: str, widths: Mapping[str, int]) -> DataFrame:
    """Text lines cut at fixed positions, padding removed, blank fields NULL."""
    columns, start = [], 1
    for name, width in widths.items():
        field = F.trim(F.substring("value", start, width))
        columns.append(F.nullif(field, F.lit("")).alias(name))
        start += width
    return spark.read.text(path).select(*columns)


def file_statistics(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """One row per table folder: files, bytes, last modification; no data column is read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*.{fmt}")
        .load(path)
        .select("path", "length", "modificationTime")
    )
    return files.groupBy(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder")).agg(
        F.count("*").alias("num_files"),
        F.sum("length").alias("size_bytes"),
        F.max("modificationTime").alias("last_modified"),
    )


def catalog_columns(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Databases, tables and columns of the catalogue as rows (metadata only, no table scan)."""
    schema = (
        "database_name string, table_name string, column_name string, data_type string, "
        "column_comment string, table_comment string, is_temporary boolean"
    )
    rows = []
    names = [database] if database else [d.name for d in spark.catalog.listDatabases()]
    for db in names:
        for table in spark.catalog.listTables(db):
            full = table.name if table.isTemporary else f"{db}.{table.name}"
            for c in spark.catalog.listColumns(full):
                rows.append((db, table.name, c.name, c.dataType, c.description, table.description, table.isTemporary))
    return spark.createDataFrame(rows, schema)


def schema_columns(spark: SparkSession, tables: Mapping[str, DataFrame], database: str = "default") -> DataFrame:
    """Column inventory of DataFrames that are not in the catalogue."""
    rows = [
        (database, name, f.name, f.dataType.simpleString(), (f.metadata or {}).get("comment"), position)
        for name, df in tables.items()
        for position, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(
        rows,
        "database_name string, table_name string, column_name string, data_type string, "
        "column_comment string, position int",
    )
