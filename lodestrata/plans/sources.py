"""Readers, writers and rule-driven runs: each writes to the shared folder and reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lodestrata.operators import gold, history, ingest, medallion, quality
from lodestrata.plans import bindings as b
from lodestrata.plans import core
from lodestrata.plans.bindings import with_sql
from lodestrata.plans.core import old_state, new_state
from lodestrata.plans.registry import at, query, table
from lodestrata.operators.aggregates import union_all, with_one_row
from lodestrata.schemas import control_rows
from lodestrata.session import cut_lineage, shared_folder
from lodestrata.sources import readers, writers

SUPPLIERS = "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"
SUPPLIER_SCHEMA = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
WIDTHS = {"s_suppkey": 10, "s_name": 20, "s_nationkey": 4}


def _folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _suppliers(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")


def _read_back(spark, folder, fmt, **rule):
    return readers.read_file(spark, {"file_format": fmt, "source_table_or_path": folder, **rule}, SUPPLIER_SCHEMA).drop("_source_file")


@query("csv_export_and_scan", SUPPLIERS)
def csv_export_and_scan(spark, sf):
    folder = _folder(spark, "csv")
    writers.export(_suppliers(spark, sf), folder, "csv", sep="|", quote_all=True)
    return _read_back(spark, folder, "csv", file_delimiter="|")


@query("compressed_csv_export", SUPPLIERS)
def compressed_csv_export(spark, sf):
    folder = _folder(spark, "csvgz")
    writers.export(_suppliers(spark, sf), folder, "csv", files=4, compression="gzip")
    return _read_back(spark, folder, "csv")


@query("json_lines_export_and_scan", SUPPLIERS)
def json_lines_export_and_scan(spark, sf):
    folder = _folder(spark, "json")
    writers.export(_suppliers(spark, sf), folder, "json")
    return _read_back(spark, folder, "json")


@query("xml_export_and_scan", SUPPLIERS)
def xml_export_and_scan(spark, sf):
    folder = _folder(spark, "xml")
    writers.export(_suppliers(spark, sf), folder, "xml", root_tag="suppliers")
    return _read_back(spark, folder, "xml")


@query("fixed_width_export_and_scan", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier")
def fixed_width_export_and_scan(spark, sf):
    folder = _folder(spark, "fixed")
    writers.export(_suppliers(spark, sf), folder, "fixed_width", widths=WIDTHS)
    return readers.read_fixed_width(spark, folder, WIDTHS)


@query("parquet_scan_with_source_file", "SELECT count(*) AS row_count, 1::BIGINT AS source_files FROM lineitem")
def parquet_scan_with_source_file(spark, sf):
    df = readers.read_file(spark, {"file_format": "parquet", "source_table_or_path": f"{sf}/lineitem.parquet"})
    return df.agg(F.count("*").alias("row_count"), F.countDistinct("_source_file").alias("source_files"))


@query("vendor_file_ingest", "SELECT s_suppkey, s_name, 'vendor-a' AS _source_vendor, TIMESTAMP '2001-08-02 00:00:00' AS _ingestion_timestamp FROM supplier")
def vendor_file_ingest(spark, sf):
    folder = _folder(spark, "vendor")
    writers.export(_suppliers(spark, sf), folder, "csv")
    rule = {"file_format": "csv", "source_table_or_path": folder}
    df = readers.read_vendor_file(spark, "vendor-a", rule, at(b.ORDERS_AS_OF), SUPPLIER_SCHEMA)
    return df.select("s_suppkey", "s_name", "_source_vendor", "_ingestion_timestamp")


@query("mirror_landing", "SELECT c_custkey, 'erp' AS _source_system, TIMESTAMP '2001-08-02 00:00:00' AS _ingestion_time FROM customer")
def mirror_landing(spark, sf):
    return readers.mirror_landing(table(spark, sf, "customer").select("c_custkey"), "erp", at(b.ORDERS_AS_OF))


@query("landed_json_unwrap", "SELECT s_suppkey AS id, s_name AS name FROM supplier")
def landed_json_unwrap(spark, sf):
    """Responses with a data list, a results list, a bare array or one object."""
    from pyspark.sql import types as T

    record = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    one = F.to_json(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))
    kind = F.col("s_suppkey") % 4
    line = (
        F.when(kind == 0, F.concat(F.lit('{"data":['), one, F.lit("]}"))).when(kind == 1, F.concat(F.lit('{"results":['), one, F.lit("]}")))
        .when(kind == 2, F.concat(F.lit("["), one, F.lit("]"))).otherwise(one)
    )
    folder = _folder(spark, "landed")
    _suppliers(spark, sf).select(line.alias("value")).write.text(folder)
    return readers.read_landed_json(spark, folder, record)


@query("glossary_import", """
SELECT term_name, 'published' AS status, array_to_string([split_part(term_name, ' ', 1), 'part'], '|') AS tags FROM (SELECT DISTINCT p_name AS term_name FROM part)""")
def glossary_import(spark, sf):
    """Terms exported as CSV and imported again, tags separated by a bar."""
    from lodestrata.operators import governance

    folder = _folder(spark, "glossary")
    names = table(spark, sf, "part").select(F.col("p_name").alias("term_name")).distinct()
    extra = {c: F.lit("x") for c in ("definition", "business_definition", "category", "domain")}
    writers.export_csv(names.withColumns(extra).withColumn("tags", F.concat(F.split_part("term_name", F.lit(" "), F.lit(1)), F.lit("|part"))), folder)
    rule = {"file_format": "csv", "source_table_or_path": folder}
    schema = "term_name string, definition string, business_definition string, category string, domain string, tags string"
    imported = governance.import_terms(readers.read_file(spark, rule, schema), at(b.EVENTS_AS_OF))
    return imported.select("term_name", "status", F.array_join("tags", "|").alias("tags"))


@query("event_log_replay", "SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' GROUP BY event_type")
def event_log_replay(spark, sf):
    df = readers.read_landed_events(spark, f"{sf}/events.parquet", None, "ts", at("2024-01-10"), at("2024-01-20"))
    return df.groupBy("event_type").agg(F.count("*").alias("n"))


@query("binary_file_catalogue", """
SELECT lang AS doc_type, 'txt' AS file_extension, 'pending' AS status, sum(strlen(replace(text, chr(10), ' ')) + 1)::BIGINT AS bytes, true AS named FROM documents GROUP BY lang""")
def binary_file_catalogue(spark, sf):
    """Documents written as one folder per language, found again as files of a kind with all their bytes."""
    folder = _folder(spark, "files")
    table(spark, sf, "documents").select("lang", F.regexp_replace("text", r"\n", " ").alias("value")).write.partitionBy("lang").text(folder)
    found = readers.file_catalogue(spark, folder, ["txt"], r"lang=([a-z]+)")
    named = F.bool_and(F.expr("endswith(path, file_name) AND endswith(file_name, '.txt')")).alias("named")
    return found.groupBy("doc_type", "file_extension", "status").agg(F.sum("file_size").alias("bytes"), named)


@query("file_statistics", "SELECT DISTINCT 'l_returnflag=' || l_returnflag AS folder, true AS files_match, true AS bytes_match FROM lineitem")
def file_statistics(spark, sf):
    """Files and bytes per partition folder, held against what a scan of the rows reports of its files."""
    folder = _folder(spark, "stats")
    writers.write_load(table(spark, sf, "lineitem"), folder, "full", ["l_returnflag"])
    files = spark.read.parquet(folder).select(F.concat(F.lit("l_returnflag="), "l_returnflag").alias("folder"), "_metadata.file_path", "_metadata.file_size").distinct()
    seen = files.groupBy("folder").agg(F.count("*").alias("n"), F.sum("file_size").alias("bytes"))
    both = readers.file_statistics(spark, folder).join(seen, "folder")
    return both.select("folder", (F.col("num_files") == F.col("n")).alias("files_match"), (F.col("size_bytes") == F.col("bytes")).alias("bytes_match"))


@query("partitioned_overwrite", """
SELECT o_orderstatus, count(*) AS n, sum(o_orderkey)::BIGINT AS key_sum FROM orders WHERE o_orderstatus <> 'O' OR o_orderkey % 2 = 0 GROUP BY o_orderstatus""")
def partitioned_overwrite(spark, sf):
    """A whole load, then one that replaces a single partition; the others stay."""
    folder = _folder(spark, "part")
    orders = table(spark, sf, "orders")
    writers.write_load(orders, folder, "full", ["o_orderstatus"])
    writers.write_load(orders.filter("o_orderstatus = 'O' AND o_orderkey % 2 = 0"), folder, "partitions", ["o_orderstatus"])
    return spark.read.parquet(folder).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("key_sum"))


@query("append_load", "SELECT 2 * count(*) AS n FROM supplier")
def append_load(spark, sf):
    folder = _folder(spark, "append")
    writers.write_load(_suppliers(spark, sf), folder, "full")
    writers.write_load(_suppliers(spark, sf), folder, "incremental")
    return spark.read.parquet(folder).agg(F.count("*").alias("n"))


@query("compaction", "SELECT count(*) AS n, sum(l_orderkey)::BIGINT AS key_sum, true AS fewer_files FROM lineitem")
def compaction(spark, sf):
    """Many small files rewritten into as many as their bytes call for."""
    scattered, folder = _folder(spark, "scattered"), _folder(spark, "compact")
    table(spark, sf, "lineitem").repartition(16).write.parquet(scattered)
    small = spark.read.parquet(scattered)
    files = writers.file_count_for(writers.stored_bytes(small))
    writers.compact(small, folder, files)
    n_files = F.countDistinct(F.col("_metadata.file_path"))
    return spark.read.parquet(folder).agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("key_sum"), ((n_files <= files) & (n_files < 16)).alias("fewer_files"))


@query("clustered_layout", """
SELECT count(*) AS n, 0::BIGINT AS overlapping_files, true AS skips_files FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01'""")
def clustered_layout(spark, sf):
    """Written in ship-date order: the files' date ranges do not overlap, so a date filter skips whole files."""
    folder = _folder(spark, "cluster")
    writers.cluster_by(table(spark, sf, "lineitem").select("l_shipdate", "l_partkey"), ["l_shipdate", "l_partkey"], 8).write.parquet(folder)
    rows = spark.read.parquet(folder)
    early = F.col("l_shipdate") < at("1996-01-01")
    files = rows.groupBy("_metadata.file_path").agg(F.min("l_shipdate").alias("low"), F.max("l_shipdate").alias("high"))
    one, other = files.alias("a"), files.alias("b")
    crossing = one.join(other, F.expr("a.low > b.low AND a.low < b.high AND a.file_path <> b.file_path")).agg(F.count("*"))
    skipped = files.agg(F.count_if(F.col("low") >= at("1996-01-01")) > 0)
    return rows.filter(early).agg(F.count("*").alias("n")).withColumns({"overlapping_files": crossing.scalar(), "skips_files": skipped.scalar()})


@query("z_order_values", """
WITH c AS (SELECT l_orderkey, l_linenumber, least(greatest(floor(l_quantity / 50.0 * 256), 0), 255)::BIGINT AS q, least(greatest(floor(l_extendedprice / 100000.0 * 256), 0), 255)::BIGINT AS e FROM lineitem)
SELECT l_orderkey, l_linenumber, list_sum(list_transform(range(8), lambda i: ((q >> i) & 1) * (1 << (2 * i)) + ((e >> i) & 1) * (1 << (2 * i + 1))))::BIGINT AS z FROM c""")
def z_order_values(spark, sf):
    z = writers.z_value({"l_quantity": (0.0, 50.0), "l_extendedprice": (0.0, 100000.0)})
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", z.alias("z"))


@query("snapshot_versions", "SELECT 1 AS _version, (SELECT count(*) FROM customer) AS row_count UNION ALL SELECT 2, (SELECT count(*) FROM customer WHERE c_custkey % 5 <> 0) + (SELECT count(*) FROM supplier) UNION ALL SELECT 3, (SELECT count(*) FROM customer)")
def snapshot_versions(spark, sf):
    """Two versions, then the first restored as the third."""
    folder = _folder(spark, "snap")
    history.write_snapshot(old_state(spark, sf), folder, 1, at("2001-01-01"))
    history.write_snapshot(new_state(spark, sf), folder, 2, at("2001-02-01"))
    history.restore_version(spark, folder, at("2001-03-01"), at=at("2001-01-15"))
    return history.snapshot_history(spark.read.parquet(folder)).select("_version", "row_count")


@query("versioned_read", "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer")
def versioned_read(spark, sf):
    folder = _folder(spark, "ver")
    history.write_snapshot(old_state(spark, sf), folder, 1, at("2001-01-01"))
    history.write_snapshot(new_state(spark, sf), folder, 2, at("2001-02-01"))
    return history.read_version(spark, folder, 1)


@query("multi_table_restore", "SELECT 'customers' AS name, count(*) AS n FROM customer UNION ALL SELECT 'suppliers', count(*) FROM supplier")
def multi_table_restore(spark, sf):
    """Both tables brought back to just before a deployment that emptied them."""
    root = _folder(spark, "multi")
    sources = {"customers": old_state(spark, sf), "suppliers": _suppliers(spark, sf)}
    for name, df in sources.items():
        history.write_snapshot(df, f"{root}/{name}", 1, at("2001-01-01"))
        history.write_snapshot(df.filter(df.columns[0] + " < 10"), f"{root}/{name}", 2, at("2001-02-01"))
    done = history.restore_tables(spark, [f"{root}/{n}" for n in sources], at("2001-02-01"), at("2001-02-02"))
    parts = [
        history.read_version(spark, path, version).agg(F.count("*").alias("n")).select(F.lit(path.rsplit("/", 1)[1]).alias("name"), "n") for path, version in done.items()
    ]
    return parts[0].unionByName(parts[1])


@query("regulatory_snapshot", "SELECT c_custkey AS id, 'GDPR' AS _regulation, 1 AS _source_version, TIMESTAMP '2001-08-02 00:00:00' AS _snapshot_timestamp FROM customer")
def regulatory_snapshot(spark, sf):
    folder = _folder(spark, "reg")
    history.write_snapshot(old_state(spark, sf), folder, 1, at("2001-01-01"))
    copy = history.regulatory_copy(history.read_version(spark, folder, 1), "GDPR", 1, at(b.ORDERS_AS_OF))
    return copy.select("id", "_regulation", "_source_version", "_snapshot_timestamp")


@query("pattern_exchange_run", """
SELECT 'open_orders' AS pattern_name, 'acme' AS vendor_name, 'success' AS status, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS row_count, NULL AS error
UNION ALL SELECT 'all_suppliers', 'acme', 'success', (SELECT count(*) FROM supplier), NULL UNION ALL SELECT 'missing', 'acme', 'failed', 0, 'KeyError'""")
def pattern_exchange_run(spark, sf):
    patterns = [
        {"pattern_name": "open_orders", "vendor_name": "acme", "source_table": "orders", "filter_condition": "o_orderstatus = 'O'", "file_format": "csv", "schedule_type": "daily"},
        {"pattern_name": "missing", "vendor_name": "acme", "source_table": "nowhere", "file_format": "csv", "schedule_type": "daily"},
        {"pattern_name": "all_suppliers", "vendor_name": "acme", "source_table": "supplier", "file_format": "json", "schedule_type": "daily"},
        {"pattern_name": "weekly", "vendor_name": "acme", "source_table": "supplier", "file_format": "json", "schedule_type": "weekly"},
    ]
    tables = {n: table(spark, sf, n) for n in ("orders", "supplier")}
    return writers.run_exchanges(spark, patterns, tables, "daily", _folder(spark, "exchange"))


@query("rule_driven_ingest", """
SELECT 'run-1' AS execution_id, 'ING001' AS rule_id, 'succeeded' AS status, (SELECT count(*) FROM orders WHERE o_orderkey > 100) AS record_count, (SELECT CAST(max(o_orderkey) AS VARCHAR) FROM orders) AS watermark, NULL AS error_message
UNION ALL SELECT 'run-1', 'ING002', 'succeeded', (SELECT count(DISTINCT s_nationkey) FROM supplier), NULL, NULL UNION ALL SELECT 'run-1', 'ING003', 'failed', 0, NULL, 'AnalysisException'""")
def rule_driven_ingest(spark, sf):
    base = {"source_type": "file", "file_format": "parquet", "ingestion_mode": "incremental"}
    rules = [
        {**base, "rule_id": "ING001", "source_table_or_path": f"{sf}/orders.parquet", "target_table": "orders", "incremental_column": "o_orderkey", "incremental_value": 100},
        {**base, "rule_id": "ING002", "source_table_or_path": f"{sf}/supplier.parquet", "target_table": "supplier", "ingestion_mode": "full", "dedup_columns": "nation"},
        {**base, "rule_id": "ING003", "source_table_or_path": f"{sf}/no_such_table.parquet", "target_table": "x"},
        {**base, "rule_id": "ING004", "source_table_or_path": "-", "target_table": "x", "ingestion_mode": "streaming"},
    ]
    mappings = {"ING002": [{"source_column": "s_nationkey", "target_column": "nation", "target_data_type": "int", "transformation_expr": None}]}
    return ingest.run_ingestion(spark, rules, mappings, _folder(spark, "ingest"), "run-1", at(b.ORDERS_AS_OF))


@query("ingest_from_rule_tables", """
SELECT 'first' AS execution_id, (SELECT count(*) FROM orders WHERE o_orderkey <= 1000)::BIGINT AS loaded, count(*)::BIGINT AS stored, sum(o_orderkey)::BIGINT AS key_sum, max(o_orderkey)::VARCHAR AS mark FROM orders
UNION ALL SELECT 'second', (SELECT count(*) FROM orders WHERE o_orderkey > 1000), count(*), sum(o_orderkey), max(o_orderkey)::VARCHAR FROM orders
UNION ALL SELECT 'second', (SELECT count(*) FROM orders WHERE o_orderkey > 1000), count(*), sum(o_orderkey), max(o_orderkey)::VARCHAR FROM orders""")
def ingest_from_rule_tables(spark, sf):
    """Rules run from their tables, again when the source has grown, and the last run once more: every order is there once."""
    source, target = _folder(spark, "source"), _folder(spark, "target")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    rule = {"rule_id": "R1", "source_id": "S1", "source_table_or_path": source, "target_table": "orders", "ingestion_mode": "incremental", "incremental_column": "order_key", "file_format": "parquet", "domain": "sales", "priority": 1, "is_active": True}
    idle = {**rule, "rule_id": "R2", "source_table_or_path": "nowhere", "is_active": False}
    names = (("o_orderkey", "order_key", "bigint"), ("o_totalprice", "amount", "double"))
    tables = {
        "ingestion_rules": control_rows(spark, "ingestion_rules", [rule, idle]),
        "source_systems": control_rows(spark, "source_systems", [{"source_id": "S1", "source_type": "file", "environment": "prod", "is_active": True}]),
        "schema_mapping": control_rows(spark, "schema_mapping", [{"rule_id": "R1", "source_column": c, "target_column": t, "target_data_type": k, "column_order": i} for i, (c, t, k) in enumerate(names)]),
    }
    logs = []
    for name, part in (("first", orders.filter("o_orderkey <= 1000")), ("second", orders.filter("o_orderkey > 1000")), ("second", None)):
        if part is not None:
            part.write.mode("append").parquet(source)
        log = ingest.run_rule_tables(spark, tables, "prod", target, name, at(b.ORDERS_AS_OF))
        tables["ingestion_rules"] = ingest.store_marks(tables["ingestion_rules"], log)
        logs.append(log.select("execution_id", F.col("record_count").alias("loaded")))
    stored = spark.read.parquet(f"{target}/orders").agg(F.count("*").alias("stored"), F.sum("order_key").alias("key_sum"))
    mark = tables["ingestion_rules"].filter("rule_id = 'R1'").select("incremental_value")
    return with_one_row(union_all(logs), stored).withColumn("mark", mark.scalar())


@query("ingest_ledger", """
WITH o AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey <= 1000 THEN 'first' WHEN o_orderkey <= 3000 THEN 'second' ELSE 'third' END AS run FROM orders)
SELECT run AS execution_id, count(*) AS n, sum(k)::BIGINT AS key_sum, min(k)::VARCHAR AS low, max(k)::VARCHAR AS high FROM o GROUP BY run""")
def ingest_ledger(spark, sf):
    """A source that grows between executions, each of which is repeated later: every execution keeps exactly its own range."""
    source, target = _folder(spark, "ledger_source"), _folder(spark, "ledger_target")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    rule = {"rule_id": "R1", "source_type": "file", "file_format": "parquet", "source_table_or_path": source, "target_table": "orders", "ingestion_mode": "incremental", "incremental_column": "o_orderkey"}
    grown = {"first": orders.filter("o_orderkey <= 1000"), "second": orders.filter("o_orderkey > 1000 AND o_orderkey <= 3000"), "third": orders.filter("o_orderkey > 3000")}
    for name in ("first", "second", "first", "third", "second", "first"):
        if name in grown:
            grown.pop(name).write.mode("append").parquet(source)
        ingest.run_ingestion(spark, [rule], {}, target, name, at(b.ORDERS_AS_OF))
    key = F.col("o_orderkey")
    stored = spark.read.parquet(f"{target}/orders").groupBy(F.col("_execution_id").alias("execution_id"))
    return stored.agg(F.count("*").alias("n"), F.sum(key).alias("key_sum"), F.min(key).cast("string").alias("low"), F.max(key).cast("string").alias("high"))


CRAWLED = ("region", "nation", "supplier", "events")


@query("catalogue_crawl", " UNION ALL ".join(f"SELECT 'crawled_{n}' AS table_name, column_name, (SELECT count(*) FROM {n}) AS table_rows FROM (DESCRIBE {n})" for n in CRAWLED))
def catalogue_crawl(spark, sf):
    """Tables and columns found in the catalogue, with their row counts."""
    counts = []
    for name in CRAWLED:
        data = table(spark, sf, name)
        data.createOrReplaceTempView(f"crawled_{name}")
        counts.append(data.agg(F.lit(f"crawled_{name}").alias("table_name"), F.count("*").alias("table_rows")))
    found = readers.catalog_columns(spark, "default").filter(F.col("table_name").isin(*[f"crawled_{n}" for n in CRAWLED]))
    return found.select("table_name", "column_name").join(union_all(counts), "table_name")


@query("retention_carried_out", """
WITH o AS (SELECT CAST(o_orderdate AS DATE) < DATE '2001-08-02' - 1000 AS expired, o_orderkey FROM orders)
SELECT 'archived' AS part, count(*) AS n, sum(o_orderkey)::BIGINT AS key_sum FROM o WHERE expired UNION ALL SELECT 'kept', count(*), sum(o_orderkey)::BIGINT FROM o WHERE NOT expired""")
def retention_carried_out(spark, sf):
    """Expired orders moved to the archive, the others written anew; both read back."""
    archive, keep = _folder(spark, "archive"), _folder(spark, "keep")
    policy = {"table_name": "orders", "action": "archive", "retention_days": 1000}
    history.run_retention(table(spark, sf, "orders"), policy, "o_orderdate", at(b.ORDERS_AS_OF), archive, keep)
    count = lambda name, path: spark.read.parquet(path).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("key_sum")).select(F.lit(name).alias("part"), "n", "key_sum")
    return count("archived", archive).unionByName(count("kept", keep))


@query("gold_definitions_run", """
SELECT 'priority_totals' AS target_table, 'positive' AS constraint_name, 0::BIGINT AS violations UNION ALL SELECT 'open_orders', 'cheap', (SELECT count(*) FROM orders WHERE o_orderstatus = 'O' AND NOT (o_totalprice < 100000))""")
def gold_definitions_run(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("lodestrata_orders")
    definitions = [
        {"target_table": "priority_totals", "sql": "SELECT o_orderpriority, sum(o_totalprice) AS total FROM lodestrata_orders GROUP BY o_orderpriority", "constraints": {"positive": "total > 0"}},
        {"target_table": "open_orders", "sql": "SELECT * FROM lodestrata_orders WHERE o_orderstatus = 'O'", "partition_by": ["o_orderpriority"], "constraints": {"cheap": "o_totalprice < 100000"}},
    ]
    return gold.run_gold(spark, definitions, _folder(spark, "gold"))


@query("medallion_run", """
SELECT count(*) AS bronze_rows, count(*) AS silver_rows, count(*) AS current_rows, count(*) AS fact_rows, 1.0::DOUBLE AS quality_score FROM customer""")
def medallion_run(spark, sf):
    """Ingest, type 2 history, validation, dimension and fact in one chain, reported as one row."""
    bronze_folder, silver_folder = _folder(spark, "bronze"), _folder(spark, "silver")
    writers.write_load(ingest.add_audit(old_state(spark, sf), "ING001", "run-1", at("2001-01-01")), bronze_folder, "full")
    bronze = spark.read.parquet(bronze_folder)
    latest = history.keep_latest(bronze, ["id"], [F.col("_ingestion_timestamp").desc(), F.col("_record_hash")])
    writers.write_load(history.open_version(latest, at("2001-01-01")), silver_folder, "full")
    silver = spark.read.parquet(silver_folder)
    checks = [quality.typed_check({"column": "id", "rule": "not_null"}), quality.typed_check({"column": "id", "rule": "unique"})]
    score = quality.run_rules(silver, "silver", checks).agg((F.count_if("check_passed") / F.count("*")).alias("q"))
    dimension = gold.keyed_dimension(silver, ["id"], ["id", "name"], "sk")
    fact = gold.version_fact(silver, "id", "segment", [], at(b.ORDERS_AS_OF))

    def rows(df):
        return df.agg(F.count("*").alias("n")).scalar()

    return bronze.agg(F.count("*").alias("bronze_rows")).withColumns(
        {"silver_rows": rows(silver), "current_rows": rows(dimension), "fact_rows": rows(fact), "quality_score": score.scalar()}
    )


@query("gold_transactions_by_partition", """
SELECT l_returnflag AS transaction_type, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS written FROM lineitem WHERE l_returnflag <> 'N' GROUP BY ALL""")
def gold_transactions_by_partition(spark, sf):
    """The stored fact read back by two of its partitions."""
    folder = _folder(spark, "gold")
    gold.store_model(core.gold_fact_policy_transaction(spark, sf), "fact_policy_transaction", folder)
    stored = spark.read.parquet(f"{folder}/fact_policy_transaction").filter("transaction_type <> 'N'")
    return stored.groupBy("transaction_type").agg(F.count("*").alias("n"), F.sum(F.col("written_premium").cast("decimal(18,2)")).cast("double").alias("written"))


@query("gold_journal_by_period", "SELECT fiscal_year::INTEGER AS fiscal_year, fiscal_period::INTEGER AS fiscal_period, count(*) AS n FROM (SELECT " + ", ".join(f"{e} AS {n}" for n, e in core.JOURNAL_COLUMNS) + " FROM lineitem) GROUP BY ALL")
def gold_journal_by_period(spark, sf):
    folder = _folder(spark, "gold")
    gold.store_model(core.gold_fact_journal_entry(spark, sf), "fact_journal_entry", folder)
    stored = spark.read.parquet(f"{folder}/fact_journal_entry")
    return stored.groupBy(F.col("fiscal_year").cast("int").alias("fiscal_year"), F.col("fiscal_period").cast("int").alias("fiscal_period")).agg(F.count("*").alias("n"))


@query("gold_invoice_checks", """
SELECT 'chk_invoice_amount' AS constraint_name, count(*) FILTER (WHERE o_totalprice < 50000) AS violations, count(*) FILTER (WHERE o_totalprice >= 50000) AS stored_rows FROM orders""")
def gold_invoice_checks(spark, sf):
    """Invoices lowered by 50,000: those below zero break the constraint and stay out of the table."""
    folder = _folder(spark, "gold")
    invoices = core.gold_fact_premium_invoice(spark, sf).withColumn("invoice_amount", F.col("invoice_amount") - 50000)
    report = gold.store_model(invoices, "fact_premium_invoice", folder)
    stored = spark.read.parquet(f"{folder}/fact_premium_invoice").agg(F.count("*").alias("stored_rows"))
    return with_one_row(report.select("constraint_name", "violations"), stored)


@query("medallion_chain", with_sql(core.OLD_SQL, core.NEW_SQL, """v AS (
  SELECT count(*) FILTER (WHERE old.id IS NULL) AS added, count(*) FILTER (WHERE old.segment <> new.segment) AS changed, count(*) AS landed FROM new LEFT JOIN old ON old.id = new.id)""", """o AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE id % 4 = 0) AS repeated FROM old)""") + """
SELECT 'first' AS execution_id, n + repeated AS landed_rows, n + repeated AS bronze_rows, repeated AS repeated_rows, n AS silver_rows, n AS current_rows, n AS fact_rows, 0::BIGINT AS failed_checks FROM o
UNION ALL SELECT 'second', landed, n + repeated + landed, 0, n + added + changed, n + added, n + added + changed, 2 FROM o, v
UNION ALL SELECT 'second again', landed, n + repeated + 2 * landed, 0, n + added + changed, n + added, n + added + changed, 2 FROM o, v""")
def medallion_chain(spark, sf):
    """Three batches through all layers: with repeated rows, with changed and new ones, and the same once more; two checks fail on versions and moved segments."""
    checks = [
        quality.typed_check({"column": "id", "rule": "not_null"}), quality.typed_check({"column": "id", "rule": "unique"}),
        {"rule_name": "known segment", "column_name": "segment", "rule_type": "custom", "rule_category": "high", "check_expression": "segment <> 'MOVED'", "threshold_value": 0.0},
    ]
    subject = medallion.Medallion(_folder(spark, "medallion"), ["id"], ["name", "segment"], "segment", checks)
    old, new = old_state(spark, sf), new_state(spark, sf)
    batches = (("first", old.unionAll(old.filter("id % 4 = 0")), "2001-01-01"), ("second", new, "2001-02-01"), ("second again", new, "2001-03-01"))
    return union_all([cut_lineage(medallion.run_batch(spark, subject, batch, name, at(day))) for name, batch, day in batches])
