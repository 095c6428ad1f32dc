"""The registered queries of this subpackage and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import bpe, factors, lines, ngrams, packing, quality, repair, runs, topk, toxicity, trie, vectors, wordpiece

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: The vocabulary file of the queries; its end-of-document id for packing is fixed.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op2_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word pieces of every document."""
    return wordpiece.count_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", VOCABULARY).drop("text")


@query("op8_packing")
def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), "doc_id", "text", VOCABULARY, END_ID)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op9_bpe")
def bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document, as digests."""
    ids = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", VOCABULARY).drop("text")
    both = bpe.decode(ids, "ids", VOCABULARY)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


#: Words of every text with their position, as the contracts define them.
SQL_WORDS = """
words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
)"""


@query(
    "op4_substring_dedup",
    "WITH" + SQL_WORDS + """,
windows AS (SELECT doc_id, i, list_aggregate(w[i : i + 49], 'string_agg', ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words)),
firsts AS (SELECT s, min(doc_id) AS first_doc FROM windows GROUP BY s),
late AS (SELECT doc_id, list(i) AS starts FROM windows JOIN firsts USING (s) WHERE first_doc < doc_id GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM (SELECT doc_id, unnest(starts) AS s FROM late)),
removed AS (SELECT doc_id, count(*) AS n, list(i) AS spots FROM gone GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(array_to_string(CASE WHEN n IS NULL THEN w ELSE list_filter(w, lambda x, k: NOT list_contains(spots, k)) END, ' ')) AS kept_sha256
FROM words LEFT JOIN removed USING (doc_id)""",
)
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words that an earlier document has too, cut from every document."""
    left = factors.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    kept = F.array_join(F.array_remove(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), ""), " ")
    return left.select("doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))


@query(
    "op10_suffix_dedup",
    """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM texts)),
again AS (SELECT s, min((doc_id, i)) AS first_at FROM windows GROUP BY s HAVING count(*) > 1),
late AS (SELECT doc_id, i FROM windows JOIN again USING (s) WHERE (doc_id, i) > first_at),
marked AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER w <= 100 THEN 0 ELSE 1 END AS new FROM late WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM marked),
spans AS (SELECT doc_id, k, min(i) AS a, max(i) + 100 AS b FROM numbered GROUP BY doc_id, k),
pieces AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS since FROM spans),
cut AS (
  SELECT doc_id, count(*) AS n, sum(b - a)::BIGINT AS removed, max(b) AS tail,
         string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS kept
  FROM pieces JOIN texts USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(n, 0) AS n_spans,
       sha256(unhex(CASE WHEN n IS NULL THEN h ELSE kept || substr(h, 2 * tail + 1) END)) AS kept_sha256
FROM texts LEFT JOIN cut USING (doc_id)""",
)
def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte strings of 100 that start earlier somewhere, cut from every document."""
    left = runs.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: Labels of these documents may be learnt from; the others are held out.
def learnable(key: str):
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 != 0


@query("op1_toxicity")
def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a network trained on labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "lang", "toxic", learnable("doc_id"))
    scored = toxicity.score(docs.select("doc_id", "text", "lang"), "text", "lang", model)
    return scored.select(
        "doc_id", (~learnable("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "toxic"
    )


@query(
    "op6_line_dedup",
    """
WITH pages AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
blank AS (SELECT ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) AS b),
totals AS (SELECT source, count(*) AS pages FROM documents WHERE source IS NOT NULL GROUP BY source),
each AS (SELECT source, unnest(list_distinct(lines)) AS line FROM pages WHERE source IS NOT NULL),
high AS (
  SELECT source, line FROM (SELECT source, line, count(*) AS n FROM each, blank WHERE trim(line, b) <> '' GROUP BY source, line)
  JOIN totals USING (source) WHERE n >= 2 AND n > 0.1 * pages
),
drops AS (SELECT source, list(line) AS gone FROM high GROUP BY source),
cut AS (
  SELECT doc_id, text, lines, CASE WHEN gone IS NULL THEN lines ELSE list_filter(lines, lambda x: NOT list_contains(gone, x)) END AS stay
  FROM pages LEFT JOIN drops USING (source)
)
SELECT doc_id, coalesce(len(lines), 0) AS n_lines, coalesce(len(lines) - len(stay), 0) AS n_dropped,
       sha256(CASE WHEN len(stay) < len(lines) THEN coalesce(array_to_string(stay, chr(10)), '') ELSE text END) AS kept_sha256
FROM cut""",
)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines on more than a tenth of their source's documents dropped, the source taken as the site."""
    left = lines.drop_site_lines(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "source", "text")
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op7_quality_rules")
def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and likeness to the documents labelled as good, for every document."""
    trusted = table(spark, sf_dir, "labels").filter("quality = 1")
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", trusted)
    return judged.drop("text")


@query(
    "op5_ngram_join",
    """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
),
grams AS (
  SELECT DISTINCT doc_id, list_aggregate(w[i : i + 4], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM pairs JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y WHERE 100 * shared >= 80 * (s.n + t.n - shared)
),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT x AS node, x AS seen FROM edges UNION SELECT node, y FROM reach JOIN edges ON seen = x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(least(doc_id, low), doc_id) AS component_id
FROM words LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT node AS doc_id, min(seen) AS low FROM reach GROUP BY node) USING (doc_id)""",
)
def ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents grouped by links between sets of five-word shingles with a Jaccard similarity of 0.8 or more."""
    found = ngrams.similar_documents(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select(F.col("_doc").alias("doc_id"), F.col("_n").alias("n_shingles"), F.col("_component").alias("component_id"))


@query(
    "op3_embedding_dedup",
    """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
),
good AS (
  SELECT vec_id, label, e FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND list_sum(list_transform(e, lambda x: x * x)) > 0
),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT x AS node, x AS seen FROM links UNION SELECT node, y FROM reach JOIN links ON seen = x),
low AS (SELECT node, min(seen) AS c FROM reach GROUP BY node),
n AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) = vec_id AS kept
FROM v LEFT JOIN n ON vec_id = n.x LEFT JOIN low ON vec_id = node""",
)
def embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of a label linked at a cosine of 0.98 or more."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label").withColumnRenamed("_vec", "vec_id")


def sql_crc(text: str) -> str:
    """CRC-32 of an ASCII string in DuckDB SQL, bit by bit."""
    codes = f"list_transform(string_split({text}, ''), lambda ch: unicode(ch)::BIGINT)"
    bits = "list_reduce(range(8), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)), xor(c, b))"
    return f"xor(list_reduce({codes}, lambda c, b: {bits}, 4294967295::BIGINT), 4294967295)"


@query(
    "op11_repair",
    f"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {sql_crc("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS how
  FROM conversations
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role, copy,
         CASE how WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN how = 3 THEN [0, 1] ELSE [0] END) AS copy FROM raw WHERE how <> 0)
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(len(role) || ':' || role || text), copy) AS i,
         left(role, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core
  FROM damaged
),
kinds AS (
  SELECT *, core = '' AS blank, core <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS twice FROM placed
),
faults AS (
  SELECT *, NOT blank AND NOT twice AND right(core, 1) NOT IN ('.', '!', '?') AS cut,
         i > 1 AND coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au'), false) AS wrong
  FROM kinds
),
sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank::INT)::BIGINT AS blank,
         sum(twice::INT)::BIGINT AS duplicate, sum(cut::INT)::BIGINT AS truncated, sum(wrong::INT)::BIGINT AS illegal, count(*) AS n
  FROM faults GROUP BY conv_id
),
inserts AS (
  SELECT * FROM (VALUES (0, 0, 0, '', []::VARCHAR[]), (0, 2, 5, 'I', ['user:']), (0, 3, 10, 'II', ['user:', 'assistant:']), (1, 1, 0, '', []::VARCHAR[]),
    (1, 2, 5, 'I', ['user:']), (1, 3, 10, 'II', ['user:', 'assistant:']), (2, 2, 0, '', []::VARCHAR[]), (2, 3, 5, 'I', ['assistant:']),
    (3, 3, 0, '', []::VARCHAR[]), (3, 2, 5, 'I', ['user:'])) v(a, b, paid, said, lines)
),
edits AS (
  SELECT * FROM (VALUES ('K', 's', 0, 1, 0, NULL), ('K', 'u', 0, 2, 0, NULL), ('K', 'u', 1, 2, 0, NULL), ('K', 'u', 3, 2, 0, NULL), ('K', 'a', 2, 3, 0, NULL),
    ('R', NULL, 0, 2, 1, 'user'), ('R', NULL, 1, 2, 1, 'user'), ('R', NULL, 3, 2, 1, 'user'), ('R', NULL, 2, 3, 1, 'assistant'),
    ('D', NULL, 0, 0, 2, NULL), ('D', NULL, 1, 1, 2, NULL), ('D', NULL, 2, 2, 2, NULL), ('D', NULL, 3, 3, 2, NULL)) v(letter, initial, a, b, paid, role)
),
steps AS (
  SELECT p.a, e.b, p.paid + e.paid AS paid, p.said || e.letter AS said, p.lines, e.letter, e.initial, e.role FROM inserts p JOIN edits e ON p.b = e.a
),
best AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, {{'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]}} AS way FROM faults
  UNION ALL
  SELECT w.conv_id, w.i + 1, s.b, min({{
      'cost': way.cost + s.paid + CASE WHEN cut AND letter <> 'D' THEN 5 ELSE 0 END, 'audit': way.audit || s.said,
      'lines': way.lines || s.lines || CASE WHEN letter = 'D' THEN [] ELSE [coalesce(s.role, f.role) || ':' || f.text] END}})
  FROM best w JOIN faults f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = w.i + 1
  JOIN steps s ON s.a = w.state AND (s.initial IS NULL OR s.initial = f.initial) AND (letter = 'D' OR NOT (blank OR twice))
  GROUP BY w.conv_id, w.i, s.b
),
ends AS (
  SELECT w.conv_id, min({{'cost': way.cost + e.paid, 'audit': way.audit || e.said, 'lines': way.lines || e.lines}}) AS way
  FROM best w JOIN sums ON w.conv_id IS NOT DISTINCT FROM sums.conv_id AND w.i = sums.n
  JOIN inserts e ON e.a = w.state AND ((w.state = 0 AND e.b = 0) OR (w.state > 0 AND e.b = 3)) GROUP BY w.conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(way.cost, 0) AS cost, coalesce(way.audit, '') AS audit,
       sha256(coalesce(array_to_string(way.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN sums ON c.conv_id IS NOT DISTINCT FROM sums.conv_id
LEFT JOIN ends ON c.conv_id IS NOT DISTINCT FROM ends.conv_id""",
)
def repair_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by the CRC of its turns, with its faults and cheapest repair."""
    told = table(spark, sf_dir, "conversations")
    fixed = repair.repair(repair.damage(told, "conv_id", "turn", "role", "text"), "conv_id", "turn", "role", "text")
    return repair.with_all_keys(fixed, told, "conv_id")


@query(
    "op12_topk",
    """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.e, v.e)::BIGINT AS score FROM v q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e)
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores) WHERE rank <= 5""",
)
def topk_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest inner products of every fiftieth vector with all others."""
    return topk.best_products(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 50 == 0)


@query(
    "op13_prefix_trie",
    f"""
WITH turns AS (
  SELECT conv_id AS c, sha256(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS x, len(coalesce(text, '')) AS tokens, turn
  FROM conversations WHERE conv_id IS NOT NULL
),
lists AS (
  SELECT c, list(x ORDER BY turn NULLS FIRST, x) AS xs, list(tokens ORDER BY turn NULLS FIRST, x) AS ns, {sql_crc("c::VARCHAR")} % 6 AS h FROM turns GROUP BY c
),
rebuilt AS (
  SELECT a.c, coalesce(b.xs[1:a.h], []) || a.xs[a.h + 1:] AS xs, coalesce(b.ns[1:a.h], []) || a.ns[a.h + 1:] AS ns
  FROM lists a LEFT JOIN lists b ON b.c = a.c - a.c % 100
),
members AS (
  SELECT c, d, array_to_string(xs[1:d], '') AS k, coalesce(ns[d], 0) AS tokens, len(xs) = d AS ends
  FROM (SELECT *, unnest(range(0, len(xs) + 1)) AS d FROM rebuilt)
),
nodes AS (
  SELECT k, d, min(c) AS c, count(*) AS n, any_value(tokens) AS tokens, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '') AS ended
  FROM members GROUP BY k, d
),
kids AS (SELECT p.k, count(v.k) AS n FROM nodes p LEFT JOIN nodes v ON v.d = p.d + 1 AND left(v.k, 64 * p.d) = p.k GROUP BY p.k),
subtrees AS (
  SELECT p.k, sum((kids.n = 0)::INT)::BIGINT AS leaves, sum((v.n - 1) * v.tokens)::BIGINT AS saved
  FROM nodes p JOIN nodes v ON v.d >= p.d AND starts_with(v.k, p.k) JOIN kids ON kids.k = v.k GROUP BY p.k
)
SELECT nodes.c AS conv_id, nodes.d AS depth, p.c AS parent_conv_id, nodes.n AS n_convs, kids.n AS n_children, leaves AS n_leaves,
       saved AS saved_tokens, sha256(nodes.ended) AS ends_sha256
FROM nodes JOIN kids USING (k) JOIN subtrees USING (k) LEFT JOIN nodes p ON p.d = nodes.d - 1 AND p.k = left(nodes.k, 64 * (nodes.d - 1))""",
)
def prefix_trie_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the trie of conversations that begin like the first of their hundred."""
    return trie.prefix_trie(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
