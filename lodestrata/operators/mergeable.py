"""Results that are stored load by load, or day by day, and put together without reading their rows again.

A part holds counts, means with squared deviations, sets of bounded size and sketches. Parts are small rows, so a
baseline over thirty days reads thirty rows a key, and a table's profile is the profiles of its loads.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: log2 of the registers of a distinct-count sketch (relative error about 1.04 / sqrt(2^12)), the size of a
#: quantile sketch (rank error below 1 %), and the values that a sketch of frequent ones tracks.
REGISTERS, QUANTILES, TRACKED = 12, 400, 10_000
#: Three standard errors of a distinct count.
DISTINCT_BOUND = 3 * 1.04 / 2 ** (REGISTERS / 2)


def moments(value: Column) -> Column:
    """Count, mean and sum of squared deviations of a numeric column, as one aggregate."""
    v = value.cast("double")
    n = F.count(v)
    return F.struct(n.alias("n"), F.coalesce(F.avg(v), F.lit(0.0)).alias("mean"), F.coalesce(F.var_pop(v) * n, F.lit(0.0)).alias("m2"))


def combined(parts: Column) -> Column:
    """The moments of all values of an array of parts, two by two; large means lose no digits of the deviation."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def both(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        share = F.when(n > 0, b["n"] / n).otherwise(0.0)
        apart = b["mean"] - a["mean"]
        return F.struct(n.alias("n"), (a["mean"] + apart * share).alias("mean"), (a["m2"] + b["m2"] + apart * apart * a["n"] * share).alias("m2"))

    return F.aggregate(F.filter(parts, lambda p: p["n"] > 0), zero, both)


def deviation(m: Column) -> Column:
    """Sample standard deviation; NULL under two values."""
    return F.when(m["n"] > 1, F.sqrt(m["m2"] / (m["n"] - 1)))


def day_moments(df: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str]) -> DataFrame:
    """One row a key and day with the moments of each value under its name."""
    return df.groupBy(*keys, F.col(ts).cast("date").alias("day")).agg(*[moments(F.col(v)).alias(v) for v in values])


def combine_days(days: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``avg_`` and ``std_`` of each value over all days given, the days in order so that a repeat gives the same digits."""

    def in_day_order(v: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.struct("day", v))), lambda x: x[v])

    parts = days.groupBy(*keys).agg(*[in_day_order(v).alias(v) for v in values])
    whole = parts.select(*keys, *[combined(F.col(v)).alias(v) for v in values])
    return whole.select(*keys, *[c for v in values for c in (F.when(F.col(v)["n"] > 0, F.col(v)["mean"]).alias(f"avg_{v}"), deviation(F.col(v)).alias(f"std_{v}"))])


def access_days(log: DataFrame) -> DataFrame:
    """What each user did on each day: counts, bytes, and the sets of hours, tables and operations."""
    sets = {"hours": F.hour("ts"), "resources": F.col("table_name"), "operations": F.col("operation")}
    return log.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(
        F.count("*").alias("queries"), F.sum("bytes_scanned").alias("bytes"), *[F.collect_set(c).alias(n) for n, c in sets.items()]
    )


def access_baseline(days: DataFrame, as_of: Column, over: int = 30) -> DataFrame:
    """The users' baseline from their stored days."""
    recent = days.filter(F.col("day") >= F.date_sub(as_of.cast("date"), over))
    union = lambda c: F.sort_array(F.array_distinct(F.flatten(F.collect_list(c))))
    return recent.groupBy("user_id").agg(
        union("hours").alias("typical_hours"), union("resources").alias("typical_resources"), union("operations").alias("typical_operations"),
        (F.sum("queries") / F.lit(float(over))).alias("avg_daily_queries"), (F.sum("bytes").cast("double") / F.lit(2.0**30) / over).alias("avg_daily_data_gb"),
    )


def profile_load(df: DataFrame, columns: Sequence[str], load: str) -> DataFrame:
    """One row a column of one load: counts, extremes, moments, and sketches of distinct, of numeric and of frequent values."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    text = lambda c: F.col(f"`{c}`").cast("string")
    number = lambda c: F.col(f"`{c}`").cast("double") if c in numeric else F.lit(None).cast("double")
    measures: Mapping[str, object] = {
        "total_rows": lambda c: F.count(F.lit(1)), "null_count": lambda c: F.count_if(F.col(f"`{c}`").isNull()),
        "low": lambda c: F.min(number(c)), "high": lambda c: F.max(number(c)), "spread": lambda c: moments(number(c)),
        "distinct": lambda c: F.hll_sketch_agg(text(c), REGISTERS), "quantiles": lambda c: F.kll_sketch_agg_double(number(c), QUANTILES),
        "frequent": lambda c: F.call_function("approx_top_k_accumulate", text(c), F.lit(TRACKED)),
    }
    one = df.agg(*[make(c).alias(f"{name}_{k}") for k, c in enumerate(columns) for name, make in measures.items()])
    rows = [F.struct(F.lit(load).alias("load"), F.lit(c).alias("column_name"), F.lit(c in numeric).alias("is_numeric"), *[F.col(f"{name}_{k}").alias(name) for name in measures]) for k, c in enumerate(columns)]
    return one.select(F.inline(F.array(*rows)))


def merge_profiles(profiles: DataFrame, top: int = 5) -> DataFrame:
    """The profile of all loads together, one row a column; distinct counts, quartiles and frequent values are estimates."""
    whole = profiles.groupBy("column_name").agg(
        F.max("is_numeric").alias("is_numeric"), F.sum("total_rows").alias("total_rows"), F.sum("null_count").alias("null_count"), F.min("low").alias("min_value"), F.max("high").alias("max_value"),
        combined(F.transform(F.array_sort(F.collect_list(F.struct("load", "spread"))), lambda x: x["spread"])).alias("_m"),
        F.hll_union_agg("distinct").alias("_distinct"), F.kll_merge_agg_double("quantiles").alias("_quantiles"), F.call_function("approx_top_k_combine", "frequent", F.lit(TRACKED)).alias("_frequent"),
    )
    quartiles = F.kll_sketch_get_quantile_double("_quantiles", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return whole.select(
        "column_name", "total_rows", "null_count", "min_value", "max_value", F.when(F.col("_m.n") > 0, F.col("_m.mean")).alias("avg_value"), deviation(F.col("_m")).alias("std_dev"),
        F.hll_sketch_estimate("_distinct").alias("distinct_count"), F.when(F.col("is_numeric") & (F.col("_m.n") > 0), quartiles).alias("quartiles"),
        F.call_function("approx_top_k_estimate", "_frequent", F.lit(top)).alias("top_values"),
    )
