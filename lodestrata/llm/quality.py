"""Quality of documents: countable rules, and likeness to a trusted corpus by n-gram likelihood."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import SPACE_CLASS, packed, unpacked
from lodestrata.llm.lines import solid

SYMBOLS = "#*$%&|<>"
WORDS_IN_WINDOW = 5


def with_words(df: DataFrame, text: str) -> DataFrame:
    """Add ``_w``, the words, and ``_h``, a 64-bit hash of each; NULL texts have none."""
    words = F.array_remove(F.split(F.coalesce(F.col(f"`{text}`"), F.lit("")), SPACE_CLASS + "+"), "")
    return df.withColumn("__w", words).withColumn("__h", F.transform("__w", lambda x: F.xxhash64(x)))


def next_of(name: str, step: int) -> Column:
    """The array without its first ``step`` items (one or more)."""
    return F.slice(name, F.lit(step + 1), F.greatest(F.size(name), F.lit(1)))


def with_pairs(df: DataFrame) -> DataFrame:
    """Add ``_two``: the hash of each word with the next (the last item is of no use)."""
    return df.withColumn("__two", F.zip_with("__h", next_of("__h", 1), lambda a, b: F.xxhash64(a, b)))


def rule_counts(df: DataFrame, text: str) -> DataFrame:
    """Add ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words`` (long).

    Every step is an expression over arrays of one row; nothing is shuffled. A window's five word
    hashes are folded into one; only texts where some window occurs twice are sorted.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    out = with_pairs(with_words(df, text)).withColumn("__lines", F.filter(F.split(whole, "\n"), solid))
    out = out.withColumn("__four", F.zip_with("__two", next_of("__two", 2), lambda a, b: F.xxhash64(a, b)))
    windows = F.greatest(F.size("__h") - (WORDS_IN_WINDOW - 1), F.lit(0))
    out = out.withColumn("__five", F.slice(F.zip_with("__four", next_of("__h", 4), lambda a, b: F.xxhash64(a, b)), F.lit(1), windows))
    repeated = F.size(F.array_distinct("__five")) < F.size("__five")
    places = F.sequence(F.lit(0), F.size("__five") - 1)
    in_order = F.sort_array(F.zip_with("__five", places, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("__sorted", F.when(repeated, in_order))
    # a window occurs again if its neighbour in the sorted order has the same hash
    same = F.zip_with("__sorted", next_of("__sorted", 1), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
    out = out.withColumn("__twice", F.when(F.col("__sorted").isNotNull(), same))
    flagged = F.zip_with(
        "__sorted", F.zip_with("__twice", F.concat(F.array(F.lit(False)), "__twice"), lambda a, b: a | b), lambda s, f: F.when(f, s["i"])
    )
    out = out.withColumn("__at", F.when(F.size("__twice") > 0, F.sort_array(F.array_compact(flagged))))
    reach = F.zip_with("__at", next_of("__at", 1), lambda a, b: F.least(F.coalesce(b - a, F.lit(WORDS_IN_WINDOW)), F.lit(WORDS_IN_WINDOW)))
    return out.withColumns(
        {
            "n_words": F.size("__w").cast("long"),
            "word_chars": F.length(F.array_join("__w", "")).cast("long"),
            "n_symbols": (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "n_repeat_words": F.when(F.size("__at") > 0, F.aggregate(reach, F.lit(0), lambda a, x: a + x)).otherwise(0).cast("long"),
        }
    )


def grams(buckets: int) -> Column:
    """Hash buckets of all words and of all pairs of neighbours."""
    one = F.transform("__h", lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    two = F.transform(F.slice("__two", F.lit(1), F.greatest(F.size("__h") - 1, F.lit(0))), lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    return F.concat(one, two)


def log_ratios(docs: DataFrame, text: str, trusted: DataFrame, key: str, buckets: int, smoothing: float) -> DataFrame:
    """One row, ``_ratios``: for each bucket the log of its share in the trusted texts over that in all texts.

    All documents are counted. Documents meet the trusted keys in a join that is shuffled; bucket counts are summed
    in each task first, so at most ``buckets`` rows a task are shuffled.
    """
    marked = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    marked = marked.join(trusted.select(F.col(f"`{key}`").alias("_key")).distinct().withColumn("_good", F.lit(1)).hint("shuffle_hash"), "_key", "left")
    counted = with_pairs(with_words(marked, "_text")).select(F.explode(grams(buckets)).alias("_gram"), F.coalesce("_good", F.lit(0)).alias("_good"))
    counts = counted.groupBy("_gram").agg(F.count("*").alias("_raw"), F.sum("_good").alias("_target"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("_gram")).join(counts, "_gram", "left")
    pairs = F.sort_array(F.collect_list(F.struct("_gram", F.coalesce("_raw", F.lit(0)).alias("r"), F.coalesce("_target", F.lit(0)).alias("t"))))
    one = every.agg(pairs.alias("_all"), F.coalesce(F.sum("_raw"), F.lit(0)).alias("_n"), F.coalesce(F.sum("_target"), F.lit(0)).alias("_m"))
    room = smoothing * buckets
    share = lambda n, total: F.log((n + F.lit(smoothing)) / (total + F.lit(room)))
    return one.select(F.transform("_all", lambda x: share(x["t"], F.col("_m")) - share(x["r"], F.col("_n"))).alias("_ratios"))


def judge(
    df: DataFrame, key: str, text: str, trusted: DataFrame, least: float = -0.1, buckets: int = 1 << 14, smoothing: float = 1.0
) -> DataFrame:
    """``df`` with the counts of :func:`rule_counts`, ``base_failed``, ``likeness`` (double) and ``kept`` (boolean).

    ``trusted`` holds the keys of documents known to be good. ``likeness`` is the mean, over a text's words
    and pairs of neighbouring words, of the log ratio between the trusted corpus' and the raw
    corpus' hashed n-gram frequencies. ``base_failed``: fewer than 10 words, or more than 20 % of the words in
    repeated five-word windows. ``kept``: not ``base_failed``, and likeness at least ``least``.

    Every row is judged by the same fixed threshold. NULL and empty texts have likeness 0 and fail for want of words;
    equal texts get equal verdicts; NULL keys are never trusted; without trusted documents, smoothing makes all
    buckets nearly alike; columns of these names are replaced, others may have any name. An empty table gives an empty
    one. A text of any length is one row of arrays.
    """
    added = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "likeness", "kept")
    plain = df.drop(*added)
    # a fixed number of values, so they may pass through the driver; as one literal that Spark folds into an array
    values = log_ratios(plain, text, trusted, key, buckets, smoothing).first()["_ratios"]
    ratios = F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")
    counted = rule_counts(packed(plain, _text=text), "_text").withColumn("__grams", grams(buckets))
    total = F.aggregate("__grams", F.lit(0.0), lambda a, g: a + F.get(ratios, g))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    scored = counted.withColumns({"base_failed": failed, "likeness": F.when(F.size("__grams") > 0, total / F.size("__grams")).otherwise(F.lit(0.0))})
    scored = scored.withColumn("kept", ~F.col("base_failed") & (F.col("likeness") >= least))
    return unpacked(scored, plain, {c: F.col(c) for c in added}, _text=text)
