"""Documents, pages, conversations and stored vectors."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lodestrata.operators import calls, documents
from lodestrata.operators.security import TEXT_PATTERNS
from lodestrata.plans.registry import query, table
from lodestrata.session import shared_folder


@query("register_new_documents", """
SELECT doc_id, sha256(text) AS content_hash, 'pending' AS processing_status FROM documents WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE source IN ('src1', 'src2', 'src3'))
QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""")
def register_new_documents(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    known = docs.filter(F.col("source").isin("src1", "src2", "src3")).select(F.sha2("text", 256).alias("content_hash"))
    return documents.register_new(docs, known, "text", "doc_id").select("doc_id", "content_hash", "processing_status")


@query("word_chunks", """
WITH w AS (SELECT doc_id, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS words FROM documents),
 c AS (SELECT doc_id, words, CAST(unnest(generate_series(0, CAST(ceil(greatest(len(words) - 100, 0) / 80) AS BIGINT))) AS INTEGER) AS chunk_index FROM w WHERE len(words) > 0)
SELECT doc_id, chunk_index, array_to_string(words[chunk_index * 80 + 1 : chunk_index * 80 + 100], ' ') AS chunk_text, CAST(len(words[chunk_index * 80 + 1 : chunk_index * 80 + 100]) AS INTEGER) AS word_count FROM c""")
def word_chunks(spark, sf):
    return documents.chunk_words(table(spark, sf, "documents"), ["doc_id"], "text", 100)


PAYLOAD = """'{"keyValuePairs":[{"key":{"content":"order","boundingRegions":[{"pageNumber":2}]},"value":{"content":"' || o_orderkey || '"},"confidence":0.9},{"key":{"content":""},"value":{"content":"x"},"confidence":0.1}],"documents":[{"fields":{"priority":{"type":"string","valueString":"' || o_orderpriority || '","confidence":0.8}}}],"tables":[{"rowCount":1,"columnCount":2,"cells":[{"rowIndex":0,"columnIndex":0,"content":"' || o_custkey || '","confidence":0.7},{"rowIndex":0,"columnIndex":1,"content":"' || o_orderstatus || '"}]}]}'"""


def _analysed(spark, sf):
    return table(spark, sf, "orders").selectExpr("o_orderkey AS document_id", f"{PAYLOAD} AS payload")


@query("analysis_fields", """
SELECT o_orderkey AS document_id, 'order' AS field_name, CAST(o_orderkey AS VARCHAR) AS field_value, NULL AS field_type, 0.9::DOUBLE AS confidence, 2 AS page_number FROM orders
UNION ALL SELECT o_orderkey, 'priority', o_orderpriority, 'string', 0.8, NULL FROM orders
UNION ALL SELECT o_orderkey, 'table_0_r0_c0', CAST(o_custkey AS VARCHAR), NULL, 0.7, 1 FROM orders UNION ALL SELECT o_orderkey, 'table_0_r0_c1', o_orderstatus, NULL, 0.0, 1 FROM orders""")
def analysis_fields(spark, sf):
    return documents.flatten_analysis(_analysed(spark, sf), "document_id", "payload")


@query("analysis_tables", "SELECT o_orderkey AS document_id, 0 AS table_idx, 1 AS row_count, 2 AS column_count, 2 AS cell_count FROM orders")
def analysis_tables(spark, sf):
    out = documents.analysis_tables(_analysed(spark, sf), ["document_id"], "payload")
    return out.withColumn("cell_count", F.size("cells")).drop("cells")


STATS_SQL = """st AS (SELECT page_id, length(html) AS char_count, CAST((length(html) - length(replace(html, '<p>', ''))) / 3 AS INTEGER) AS page_count, 0 AS table_count,
  CASE WHEN length(url) > 50 THEN 'high' WHEN length(url) > 20 THEN 'medium' ELSE 'low' END AS processing_quality,
  CASE WHEN length(html) <= 100 THEN 'short' WHEN length(html) < 50000 THEN 'usable' ELSE 'long' END AS length_band FROM pages)"""


def _statistics(spark, sf):
    pages = ((F.length("html") - F.length(F.replace("html", F.lit("<p>"), F.lit("")))) / 3).cast("int")
    return documents.document_statistics(table(spark, sf, "pages"), "html", "url", pages, F.lit(0))


@query("document_statistics", "WITH " + STATS_SQL + " SELECT page_id, CAST(char_count AS INTEGER) AS char_count, page_count, table_count, length_band, processing_quality FROM st")
def document_statistics(spark, sf):
    return _statistics(spark, sf).select("page_id", "char_count", "page_count", "table_count", "length_band", "processing_quality")


@query("document_quality_distribution", "WITH " + STATS_SQL + " SELECT processing_quality, count(*) AS document_count FROM st GROUP BY processing_quality")
def document_quality_distribution(spark, sf):
    return documents.quality_distribution(_statistics(spark, sf), [])


@query("document_number_summary", "WITH " + STATS_SQL + """
SELECT 'char_count' AS column_name, count(*) AS row_count, round(avg(char_count), 4) AS mean, round(stddev_samp(char_count), 4) AS stddev, min(char_count)::DOUBLE AS min, max(char_count)::DOUBLE AS max FROM st
UNION ALL SELECT 'page_count', count(*), round(avg(page_count), 4), round(stddev_samp(page_count), 4), min(page_count)::DOUBLE, max(page_count)::DOUBLE FROM st""")
def document_number_summary(spark, sf):
    return documents.describe_numbers(_statistics(spark, sf), ["char_count", "page_count"]).withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


INDEX_SQL = "ix AS (SELECT doc_id, lang, sha256(CAST(doc_id AS VARCHAR)) AS document_id, lower(trim(regexp_replace(text, '[^a-zA-Z0-9\\s]', ' ', 'g'))) AS searchable_text FROM documents)"


def _index(spark, sf):
    return documents.document_index(table(spark, sf, "documents"), "doc_id", "text", keep=["doc_id", "lang"])


@query("document_index", "WITH " + INDEX_SQL + " SELECT document_id, md5(searchable_text) AS text_hash, length(searchable_text)::INTEGER AS text_length FROM ix")
def document_index(spark, sf):
    return _index(spark, sf).select("document_id", F.md5("searchable_text").alias("text_hash"), F.length("searchable_text").alias("text_length"))


@query("document_search_by_index", "WITH " + INDEX_SQL + """
SELECT document_id, doc_id, lang, (length(searchable_text) - length(replace(searchable_text, 'the', '')))::DOUBLE / 3 + (length(searchable_text) - length(replace(searchable_text, 'is', '')))::DOUBLE / 2 AS relevance_score
FROM ix WHERE contains(searchable_text, 'the is') AND lang IN ('en', 'de') ORDER BY relevance_score DESC, document_id LIMIT 10""")
def document_search_by_index(spark, sf):
    """Answered from a stored inverted index; texts are read once to build it."""
    folder = f"{shared_folder(spark)}/postings-{uuid.uuid4().hex}"
    documents.write_postings(_index(spark, sf), folder)
    shown = table(spark, sf, "documents").select(F.sha2(F.col("doc_id").cast("string"), 256).alias("document_id"), "doc_id", "lang")
    return documents.search_postings(spark.read.parquet(folder), shown, "The is", 10, ["en", "de"], "lang")


@query("document_search", "WITH " + INDEX_SQL + """
SELECT document_id, doc_id, lang, (length(searchable_text) - length(replace(searchable_text, 'the', '')))::DOUBLE / 3 + (length(searchable_text) - length(replace(searchable_text, 'is', '')))::DOUBLE / 2 AS relevance_score
FROM ix WHERE contains(searchable_text, 'the is') AND lang IN ('en', 'de') ORDER BY relevance_score DESC, document_id LIMIT 10""")
def document_search(spark, sf):
    return documents.search(_index(spark, sf), "The is", 10, ["en", "de"], "lang")


def _kind_sql(kind):
    return f"CASE WHEN regexp_matches(text, '{TEXT_PATTERNS[kind]}') THEN '{kind}' END"


@query("document_personal_data", f"SELECT doc_id, concat_ws(',', {', '.join(_kind_sql(k) for k in TEXT_PATTERNS)}) AS pii_types, concat_ws(',', {', '.join(_kind_sql(k) for k in TEXT_PATTERNS)}) <> '' AS pii_detected FROM documents")
def document_personal_data(spark, sf):
    found = documents.text_findings(table(spark, sf, "documents").select("doc_id", "text"), "text")
    return found.select("doc_id", F.array_join("pii_types", ",").alias("pii_types"), "pii_detected")


QUEUE_SQL = "q AS (SELECT doc_id, n_chars, CASE WHEN source IN ('src1', 'src2', 'src3', 'src4') THEN 'processed' ELSE 'pending' END AS processing_status FROM documents)"


def _queue(spark, sf):
    status = F.when(F.col("source").isin("src1", "src2", "src3", "src4"), "processed").otherwise("pending")
    return table(spark, sf, "documents").select("doc_id", "n_chars", status.alias("processing_status"))


@query("document_queue_batch", "WITH " + QUEUE_SQL + " SELECT doc_id, n_chars, processing_status FROM q WHERE processing_status = 'pending' ORDER BY n_chars, doc_id LIMIT 50")
def document_queue_batch(spark, sf):
    return documents.next_batch(_queue(spark, sf), "pending", "n_chars", "doc_id", 50)


@query("document_queue_status", "WITH " + QUEUE_SQL + ", t AS (SELECT doc_id FROM q WHERE processing_status = 'pending' ORDER BY n_chars, doc_id LIMIT 50) SELECT doc_id, n_chars, CASE WHEN doc_id IN (SELECT doc_id FROM t) THEN 'extracted' ELSE processing_status END AS processing_status FROM q")
def document_queue_status(spark, sf):
    queue = _queue(spark, sf)
    return documents.set_status(queue, documents.next_batch(queue, "pending", "n_chars", "doc_id", 50), "doc_id", "extracted")


@query("nearest_vectors", """
SELECT vec_id, label, round(list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)), 6) AS similarity FROM embeddings ORDER BY similarity DESC, vec_id LIMIT 10""")
def nearest_vectors(spark, sf):
    vectors = table(spark, sf, "embeddings")
    wanted = vectors.filter("vec_id = 0").select(F.col("embedding").alias("query_vector"))
    return documents.nearest_vectors(vectors, wanted, "embedding", "vec_id", 10).withColumn("similarity", F.round("similarity", 6))


@query("nearest_vectors_by_pivots", """
SELECT vec_id, label, round(list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)), 6) AS similarity FROM embeddings ORDER BY similarity DESC, vec_id LIMIT 10""")
def nearest_vectors_by_pivots(spark, sf):
    """The same from a stored index of angles to pivots, which leaves out what can't be near."""
    vectors = table(spark, sf, "embeddings")
    pivots = documents.choose_pivots(vectors, "embedding", "vec_id")
    folder = f"{shared_folder(spark)}/pivots-{uuid.uuid4().hex}"
    documents.write_pivot_index(vectors, "embedding", pivots, folder)
    query_vector = vectors.filter("vec_id = 0").select(F.col("embedding").cast("array<double>")).first()[0]
    found, _ = documents.nearest_by_pivots(spark.read.parquet(folder), pivots, query_vector, "embedding", "vec_id", 10)
    return found.withColumn("similarity", F.round("similarity", 6))


@query("call_transcripts", """
SELECT conv_id, CAST(floor(turn / 4) AS INTEGER) AS part_no, count(*) AS segment_count, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS transcript FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations) GROUP BY ALL""")
def call_transcripts(spark, sf):
    return calls.transcripts(table(spark, sf, "conversations"), "conv_id", "turn", "role", "text", segments_per_part=4)


@query("call_analytics", """
SELECT user_id AS call_id, count(*) AS event_count, round(avg(value / 100 - 1), 6) AS avg_sentiment, max(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS max_wait_sec, bool_or(event_type = 'error' AND value / 100 - 1 < -0.3) AS escalation_needed FROM events GROUP BY user_id""")
def call_analytics(spark, sf):
    mood = F.col("value") / 100 - 1
    events = table(spark, sf, "events").select(
        F.col("user_id").alias("call_id"), mood.alias("sentiment_score"), F.get_json_object("props", "$.k").cast("bigint").alias("wait_time_sec"), ((F.col("event_type") == "error") & (mood < -0.3)).alias("escalation_needed")
    )
    return calls.call_analytics(events).withColumn("avg_sentiment", F.round("avg_sentiment", 6))
