"""From raw documents to packed training sequences, in five stages.

Every stage takes all rows that the one before has kept; stages are written as Parquet in the shared
folder and read again, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import factors, lines, ngrams, packing, toxicity
from lodestrata.llm.queries import END_ID, VOCABULARY, learnable, table
from lodestrata.session import cut_lineage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def as_documents(df: DataFrame) -> DataFrame:
    """The columns of ``documents``, with ``n_chars`` of the text as it is now."""
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below their language's threshold."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "lang", "toxic", learnable("doc_id"))
    return toxicity.score(docs, "text", "lang", model).filter(~F.col("toxic")).select(*COLUMNS)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many documents of their source have; no document goes."""
    return as_documents(lines.drop_site_lines(docs, "source", "text"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of similar ones."""
    return ngrams.one_of_each(docs, "doc_id", "text").select(*COLUMNS)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 words that an earlier one has; no document goes."""
    return as_documents(factors.without_repeats(docs, "doc_id", "text"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of at most 4096, one row per piece of a document."""
    return packing.pack(docs, "doc_id", "text", VOCABULARY, END_ID)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("ngram_join", drop_near_copies),
    ("substring_dedup", drop_passages),
    ("packing", pack_sequences),
]

#: The classifier and the tokenizer can't be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
