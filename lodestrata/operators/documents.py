"""Documents: registration, chunks, flattening of analysis results, index, search."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.operators.aggregates import top
from lodestrata.operators.history import conditional_update, keep_latest
from lodestrata.operators.security import TEXT_PATTERNS


def register_new(found: DataFrame, registry: DataFrame, content: str, key: str = "path") -> DataFrame:
    """Documents whose content is not registered yet, once each (the first path of a content)."""
    hashed = found.withColumn("content_hash", F.sha2(F.col(content), 256))
    first = keep_latest(hashed, ["content_hash"], [F.col(key).asc()])
    return first.join(registry.select("content_hash").distinct(), "content_hash", "left_anti").withColumn(
        "processing_status", F.lit("pending")
    )


def words_of(text: Column) -> Column:
    """Blank-separated words without empty ones."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def chunk_words(df: DataFrame, key: Sequence[str], text: str, size: int = 1000, overlap: int | None = None) -> DataFrame:
    """Overlapping word chunks of the whole text; no chunk lies inside the one before it."""
    step = size - (size // 5 if overlap is None else overlap)
    if step < 1:
        raise ValueError("overlap must be smaller than the chunk")
    words = df.select(*key, words_of(F.col(text)).alias("_words"))
    n = F.size("_words")
    last = F.ceil(F.greatest(n - size, F.lit(0)) / F.lit(step)).cast("int")
    starts = F.when(n > 0, F.sequence(F.lit(0), last))

    def chunk(i: Column) -> Column:
        piece = F.slice("_words", i * step + 1, F.lit(size))
        return F.struct(i.alias("chunk_index"), F.array_join(piece, " ").alias("chunk_text"), F.size(piece).alias("word_count"))

    # chunks are cut inside the row, so the word list itself is not repeated per chunk
    return words.select(*key, F.inline(F.transform(starts, chunk)))


_REGION = T.ArrayType(T.StructType([T.StructField("pageNumber", T.IntegerType())]))
_PART = T.StructType([T.StructField("content", T.StringType()), T.StructField("boundingRegions", _REGION)])
_FIELD = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("valueString", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
    ]
)
_CELL = T.StructType(
    [
        T.StructField("rowIndex", T.IntegerType()),
        T.StructField("columnIndex", T.IntegerType()),
        T.StructField("content", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("boundingRegions", _REGION),
    ]
)
_TABLE = T.StructType(
    [
        T.StructField("rowCount", T.IntegerType()),
        T.StructField("columnCount", T.IntegerType()),
        T.StructField("cells", T.ArrayType(_CELL)),
    ]
)
#: Shape of a landed document-analysis result.
ANALYSIS = T.StructType(
    [
        T.StructField(
            "keyValuePairs",
            T.ArrayType(
                T.StructType(
                    [T.StructField("key", _PART), T.StructField("value", _PART), T.StructField("confidence", T.DoubleType())]
                )
            ),
        ),
        T.StructField(
            "documents", T.ArrayType(T.StructType([T.StructField("fields", T.MapType(T.StringType(), _FIELD))]))
        ),
        T.StructField("tables", T.ArrayType(_TABLE)),
    ]
)


def _page(regions: Column) -> Column:
    return F.coalesce(F.get(regions, F.lit(0))["pageNumber"], F.lit(1))


def flatten_analysis(df: DataFrame, key: str, payload: str) -> DataFrame:
    """Key-value pairs, document fields and table cells of an analysis result as rows.

    The three lists become one array of row structs per document, exploded once.
    """
    parsed = df.select(key, F.from_json(payload, ANALYSIS).alias("a"))

    def row(name: Column, value: Column, kind: Column, confidence: Column, page: Column) -> Column:
        return F.struct(
            name.alias("field_name"), value.alias("field_value"), kind.alias("field_type"),
            F.coalesce(confidence, F.lit(0.0)).alias("confidence"), page.alias("page_number"),
        )

    no_text, no_page = F.lit(None).cast("string"), F.lit(None).cast("int")
    empty = F.array().cast(
        "array<struct<field_name:string,field_value:string,field_type:string,confidence:double,page_number:int>>"
    )
    pairs = F.transform(
        F.filter(F.col("a.keyValuePairs"), lambda p: (p["key"]["content"] != "") & (p["value"]["content"] != "")),
        lambda p: row(p["key"]["content"], p["value"]["content"], no_text, p["confidence"], _page(p["key"]["boundingRegions"])),
    )
    fields = F.flatten(
        F.transform(
            F.col("a.documents"),
            lambda d: F.transform(
                F.map_entries(d["fields"]),
                lambda e: row(
                    e["key"], F.coalesce(e["value"]["valueString"], e["value"]["content"], F.lit("")),
                    F.coalesce(e["value"]["type"], F.lit("string")), e["value"]["confidence"], no_page,
                ),
            ),
        )
    )
    cells = F.flatten(
        F.transform(
            F.col("a.tables"),
            lambda t, i: F.transform(
                t["cells"],
                lambda c: row(
                    F.concat(F.lit("table_"), i, F.lit("_r"), c["rowIndex"], F.lit("_c"), c["columnIndex"]),
                    F.coalesce(c["content"], F.lit("")), no_text, c["confidence"], _page(c["boundingRegions"]),
                ),
            ),
        )
    )
    rows = F.concat(F.coalesce(pairs, empty), F.coalesce(fields, empty), F.coalesce(cells, empty))
    return parsed.select(key, F.inline(rows))


def analysis_tables(df: DataFrame, key: Sequence[str], payload: str) -> DataFrame:
    """One row per table of an analysis result."""
    tables = F.from_json(payload, ANALYSIS)["tables"]
    return df.select(*key, F.posexplode(tables).alias("table_idx", "t")).select(
        *key, "table_idx", F.col("t.rowCount").alias("row_count"), F.col("t.columnCount").alias("column_count"),
        F.col("t.cells").alias("cells"),
    )


def document_statistics(df: DataFrame, text: str, summary: str, pages: Column, tables: Column) -> DataFrame:
    """Every document with counts, a band of its length and a quality band by summary length."""
    length, summary_length = F.length(text), F.length(summary)
    return df.withColumns(
        {
            "length_band": F.when(length <= 100, "short").when(length < 50000, "usable").otherwise("long"),
            "char_count": length,
            "page_count": pages,
            "table_count": tables,
            "processing_quality": F.when(summary_length > 50, "high").when(summary_length > 20, "medium").otherwise("low"),
        }
    )


def quality_distribution(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by, "processing_quality").agg(F.count("*").alias("document_count"))


def describe_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation and extremes of numeric columns, one row each."""
    one = df.agg(
        *[fn(c).cast("double").alias(f"{tag}_{c}") for c in columns for tag, fn in
          (("n", F.count), ("mean", F.avg), ("sd", F.stddev), ("lo", F.min), ("hi", F.max))]
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"), F.col(f"n_{c}").cast("bigint").alias("row_count"), F.col(f"mean_{c}").alias("mean"),
                F.col(f"sd_{c}").alias("stddev"), F.col(f"lo_{c}").alias("min"), F.col(f"hi_{c}").alias("max"),
            )
            for c in columns
        ]
    )
    return one.select(F.inline(lines))


def searchable(*parts: Column) -> Column:
    """Lower-case letters, digits and blanks of the joined parts."""
    return F.lower(F.trim(F.regexp_replace(F.concat_ws(" ", *parts), r"[^a-zA-Z0-9\s]", " ")))


def document_index(df: DataFrame, path: str, text: str, summary: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    parts = [F.col(text)] + ([F.col(summary)] if summary else [])
    return df.select(F.sha2(F.col(path).cast("string"), 256).alias("document_id"), *keep, searchable(*parts).alias("searchable_text"))


def search(index: DataFrame, phrase: str, n: int = 10, doc_types: Sequence[str] | None = None, type_column: str = "doc_type") -> DataFrame:
    """Documents containing the phrase, by the occurrences of its words (a top-n report)."""
    phrase = phrase.lower()
    text = F.col("searchable_text")
    hits = index.filter(text.contains(phrase))
    if doc_types:
        hits = hits.filter(F.col(type_column).isin(*doc_types))
    score = F.lit(0)
    for word in phrase.split():
        score = score + (F.length(text) - F.length(F.replace(text, F.lit(word), F.lit("")))) / F.lit(len(word))
    scored = hits.withColumn("relevance_score", score.cast("double")).drop("searchable_text")
    return top(scored, [F.col("relevance_score").desc(), F.col("document_id")], n)


def postings(index: DataFrame) -> DataFrame:
    """The inverted index of :func:`document_index`: ``token``, ``document_no`` and ``places``, one row a token and document.

    Tokens are what single blanks separate (two blanks in a row hold an empty one), places count them, so neighbours
    are one apart and a phrase is found by its places alone. They are sorted and grouped inside the row of their
    document, so nothing is shuffled. A document's id is written once: in a row without token, beside its number.
    """
    words = F.transform(F.split("searchable_text", " "), lambda w, i: F.struct(w.alias("token"), i.alias("at")))
    by_token = index.select("document_id", F.monotonically_increasing_id().alias("document_no"), F.sort_array(words).alias("_all"))

    def begins(i: Column) -> Column:
        return (i == 0) | (F.get("_all", i)["token"] != F.get("_all", i - 1)["token"])

    cut = by_token.withColumn("_starts", F.filter(F.sequence(F.lit(0), F.size("_all") - 1), begins))

    def posting(s: Column, k: Column) -> Column:
        end = F.coalesce(F.get("_starts", k + 1), F.size("_all"))
        places = F.transform(F.slice("_all", s + 1, end - s), lambda x: x["at"])
        return F.struct(F.get("_all", s)["token"].alias("token"), places.alias("places"), F.lit(None).cast("string").alias("document_id"))

    name = F.struct(F.lit(None).cast("string").alias("token"), F.lit(None).cast("array<int>").alias("places"), F.col("document_id"))
    return cut.select("document_no", F.inline(F.concat(F.array(name), F.transform("_starts", posting))))


def write_postings(index: DataFrame, path: str, parts: int | None = None) -> None:
    """Stores the inverted index in segments sorted by token, so that a search for a token skips most pages.

    A segment holds the documents that one task has read; with ``parts`` the index is dealt by token hash to as many instead.
    """
    rows = postings(index)
    if parts:
        rows = rows.repartition(parts, F.coalesce("token", "document_id"))
    rows.sortWithinPartitions("token", "document_no").write.mode("overwrite").parquet(path)


def search_postings(
    posted: DataFrame, documents: DataFrame, phrase: str, n: int = 10, doc_types: Sequence[str] | None = None, type_column: str = "doc_type"
) -> DataFrame:
    """:func:`search` answered from the inverted index; ``documents`` has ``document_id`` and the columns to show, no text.

    The words between the first and the last are whole tokens, the first ends one and the last begins one; a single word
    may lie anywhere inside a token. Places of the words that follow each other are intersected. Scores are
    counted from the tokens that hold a word, so no text is read.
    """
    words = phrase.lower().split(" ")
    token, last = F.col("token"), len(words) - 1

    def fits(k: int, word: str) -> Column:
        if not last:
            return token.contains(word)
        return token.endswith(word) if k == 0 else token.startswith(word) if k == last else token == word

    starts = [posted.filter(fits(k, w)).select("document_no", F.explode("places").alias("_at")).select("document_no", (F.col("_at") - k).alias("_at"), F.lit(k).alias("_word")) for k, w in enumerate(words)]
    met = reduce(DataFrame.unionAll, starts).groupBy("document_no", "_at").agg(F.count("*").alias("_n")).filter(F.col("_n") == len(words))
    names = posted.filter(token.isNull()).select("document_no", "document_id")
    found = names.join(met.select("document_no").distinct(), "document_no")
    hits = found.select("document_id").distinct().join(documents, "document_id")
    if doc_types:
        hits = hits.filter(F.col(type_column).isin(*doc_types))
    wanted = phrase.lower().split()
    held = F.lit(0.0)
    for word in wanted:
        held = held + (F.length(token) - F.length(F.replace(token, F.lit(word), F.lit("")))) / F.lit(len(word)) * F.size("places")
    some = F.lit(False)
    for word in wanted:
        some = some | token.contains(word)
    scores = posted.filter(some).select("document_no", held.alias("_held")).join(found, "document_no")
    scores = scores.groupBy("document_id").agg(F.sum("_held").cast("double").alias("relevance_score"))
    scored = hits.join(scores, "document_id", "left").withColumn("relevance_score", F.coalesce("relevance_score", F.lit(0.0)))
    return top(scored, [F.col("relevance_score").desc(), F.col("document_id")], n)


def text_findings(df: DataFrame, text: str, patterns: Mapping[str, str] = TEXT_PATTERNS) -> DataFrame:
    """Kinds of personal data found anywhere in the whole text."""
    kinds = F.array_compact(F.array(*[F.when(F.col(text).rlike(p), kind) for kind, p in patterns.items()]))
    return df.withColumn("pii_types", kinds).withColumn("pii_detected", F.size("pii_types") > 0)


def next_batch(queue: DataFrame, status: str, oldest: str, key: str, n: int) -> DataFrame:
    """The oldest entries in a status, up to the batch size of the worker."""
    return top(queue.filter(F.col("processing_status") == status), [F.col(oldest).asc(), F.col(key).asc()], n)


def set_status(queue: DataFrame, batch: DataFrame, key: str, status: str) -> DataFrame:
    """Queue with the entries of a batch moved to a status."""
    marked = queue.join(batch.select(key, F.lit(True).alias("_hit")), key, "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return conditional_update(marked, hit, {"processing_status": F.lit(status)}).select(*queue.columns)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two equally long vectors, in double precision."""

    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)

    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def nearest_vectors(vectors: DataFrame, query: DataFrame, embedding: str, key: str, n: int = 10) -> DataFrame:
    """Top ``n`` vectors by cosine to one query vector, attached as a scalar.

    ``query`` holds one row with the column ``query_vector``; every partition keeps its own
    best ``n`` before they are merged.
    """
    scored = vectors.withColumn("_q", query.select("query_vector").scalar()).withColumn(
        "similarity", cosine(F.col(embedding), F.col("_q"))
    )
    return top(scored.drop("_q", embedding), [F.col("similarity").desc(), F.col(key)], n)


#: Vectors among which pivots are chosen, pivots, and slack for rounding of angles.
PIVOT_SAMPLE, PIVOTS, ANGLE_SLACK = 256, 8, 1e-6


def angle(a: Column, b: Column) -> Column:
    """Angle between two vectors in radians; NULL where one has no length."""
    return F.acos(F.least(F.greatest(cosine(a, b), F.lit(-1.0)), F.lit(1.0)))


def choose_pivots(vectors: DataFrame, embedding: str, key: str, count: int = PIVOTS) -> list[list[float]]:
    """Vectors far from each other, out of a fixed sample of ``PIVOT_SAMPLE``; any choice gives right results."""
    length = F.aggregate(embedding, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = vectors.filter((length > 0) & (length < F.lit(float("inf")))).orderBy(F.xxhash64(key), key).limit(PIVOT_SAMPLE).select(F.col(embedding).cast("array<double>")).collect()
    units = [[x / math.sqrt(sum(y * y for y in v)) for x in v] for (v,) in rows]
    chosen: list[list[float]] = units[:1]
    while units and len(chosen) < min(count, len(units)):
        near = [max(sum(x * y for x, y in zip(u, p)) if len(u) == len(p) else 1.0 for p in chosen) for u in units]
        chosen.append(units[near.index(min(near))])
    return chosen


def pivot_index(vectors: DataFrame, embedding: str, pivots: Sequence[Sequence[float]]) -> DataFrame:
    """``vectors`` with the angle to each pivot as a column ``_p0``, ``_p1``, ..."""
    point = lambda p: F.array(*[F.lit(float(x)) for x in p])
    return vectors.withColumns({f"_p{k}": angle(F.col(embedding), point(p)) for k, p in enumerate(pivots)})


def write_pivot_index(vectors: DataFrame, embedding: str, pivots: Sequence[Sequence[float]], path: str) -> None:
    """Stores the index sorted by the first angles, so that ranges of angles skip row groups."""
    indexed = pivot_index(vectors, embedding, pivots)
    order = [f"_p{k}" for k in range(min(2, len(pivots)))]
    indexed = indexed.repartitionByRange(*order).sortWithinPartitions(*order) if order else indexed
    indexed.write.mode("overwrite").parquet(path)


def nearest_by_pivots(indexed: DataFrame, pivots: Sequence[Sequence[float]], query: Sequence[float], embedding: str, key: str, n: int = 10) -> tuple[DataFrame, DataFrame]:
    """The top ``n`` by cosine to ``query``, exactly, and the rows of the index that had to be looked into.

    Angles obey the triangle rule: a vector within an angle t of the query differs from it by at most t in its angle to any
    pivot. The vectors that look nearest by their angles to the pivots give a first t from their own angles; then
    ranges of angles, pushed to the scan, leave out all vectors that can't be nearer.
    """
    wanted = F.array(*[F.lit(float(x)) for x in query])
    norm = math.sqrt(sum(x * x for x in query))
    to_pivots = [math.acos(min(1.0, max(-1.0, sum(x * y for x, y in zip(query, p)) / (norm * math.sqrt(sum(y * y for y in p)))))) if norm else 0.0 for p in pivots]
    differs = [F.abs(F.col(f"_p{k}") - F.lit(a)) for k, a in enumerate(to_pivots)]
    similarity = cosine(F.col(embedding), wanted)
    reach = None
    if differs and norm:
        guess = F.greatest(*differs) if len(differs) > 1 else differs[0]
        first = indexed.select(key, guess.alias("_guess")).filter("_guess IS NOT NULL").orderBy("_guess", key).limit(4 * n)
        best = indexed.join(F.broadcast(first.select(key)), key, "left_semi").select(F.acos(F.least(F.greatest(similarity, F.lit(-1.0)), F.lit(1.0))).alias("t"))
        angles = [r.t for r in best.filter("t IS NOT NULL").orderBy("t").limit(n).collect()]
        reach = angles[-1] + ANGLE_SLACK if len(angles) == n else None
    read = indexed
    if reach is not None:
        for k, a in enumerate(to_pivots):
            read = read.filter((F.col(f"_p{k}") >= F.lit(a - reach)) & (F.col(f"_p{k}") <= F.lit(a + reach)))
    plain = [c for c in indexed.columns if c not in {f"_p{k}" for k in range(len(pivots))} and c != embedding]
    found = top(read.select(*plain, similarity.alias("similarity")), [F.col("similarity").desc(), F.col(key)], n)
    return found, read
