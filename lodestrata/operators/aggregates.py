"""Shared aggregation helpers: exact means, shares, percentiles, top lists, bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.session import cut_lineage


def mean(c: Column) -> Column:
    """Mean as exact sum over count: for decimals independent of the order of partial sums."""
    return F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0))


def share_pct(cond: Column) -> Column:
    """Percentage of rows meeting ``cond``; NULL for an empty group."""
    return F.try_divide(F.lit(100.0) * F.count_if(cond), F.count(F.lit(1)).cast("double"))


def share_or_full(cond: Column) -> Column:
    """As :func:`share_pct`, but an empty group counts as fully compliant."""
    return F.coalesce(share_pct(cond), F.lit(100.0))


def band(c: Column, steps: Sequence[tuple[float, str]], otherwise: str, below: bool = False) -> Column:
    """First band whose bound ``c`` exceeds (or stays below)."""
    out = None
    for bound, name in steps:
        hit = c < bound if below else c > bound
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(otherwise)


def rank_of(c: Column, order: Sequence[str]) -> Column:
    """Position of a value in a custom order, unknown values last."""
    out = None
    for i, value in enumerate(order, start=1):
        out = F.when(c == value, i) if out is None else out.when(c == value, i)
    return out.otherwise(len(order) + 1)


SEVERITIES = ("critical", "high", "medium", "low")


def top(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows: each partition keeps its own ``n``, only those are merged."""
    return df.orderBy(*order).limit(n)


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows per group; planned with a rank limit before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n)


def order_bits(value: Column) -> Column:
    """A double as a 64-bit number of the same order: sign, exponent and fraction; NaN comes last, both zeros are equal."""
    a, two = F.abs(value), F.lit(2.0)
    guess = F.floor(F.log2(a)).cast("double")
    exponent = F.when(F.pow(two, guess) > a, guess - 1).when(F.pow(two, guess + 1) <= a, guess + 1).otherwise(guess)
    fraction = ((a / F.pow(two, exponent) - 1) * F.lit(2.0**52)).cast("long")
    normal = F.shiftleft((exponent + 1023).cast("long"), 52) + fraction
    tiny = (a * F.lit(2.0**537) * F.lit(2.0**537)).cast("long")
    endless = F.lit(2047 << 52).cast("long")
    size = F.when(F.isnan(a), endless + 1).when(a == F.lit(float("inf")), endless).when(a >= F.lit(2.0**-1022), normal).otherwise(tiny)
    return F.when(value < 0, -1 - size).otherwise(size)


#: Bits of a value that one round of :func:`exact_percentile` settles.
DIGIT = 16


def exact_percentile(df: DataFrame, keys: Sequence[str], value: str, p: float, name: str) -> DataFrame:
    """Exact interpolated percentile per group, by radix selection.

    Values are read as 64-bit numbers of the same order. A round counts, for each group, how many values have each of the next
    16 bits behind those known so far, and picks the bits that hold the ranks wanted; four rounds settle every bit, and groups in which
    one value is left stop before. Counts are summed in each task first, so that of a group of any size at
    most 65,536 rows a task are shuffled, and no task holds its values. NULL values do not count; NULL keys are a group.
    """
    data = df.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v IS NOT NULL").withColumn("_bits", order_bits(F.col("_v")))
    measures = [F.count("*").alias("_c"), F.min("_v").alias("_low"), F.max("_v").alias("_high")]

    def chosen(counts: DataFrame, *by: str) -> DataFrame:
        """The rows whose values hold the rank wanted, with the rank inside them."""
        upto = F.sum("_c").over(Window.partitionBy(*keys, *by).orderBy("_digit").rowsBetween(Window.unboundedPreceding, 0))
        held = counts.withColumn("_below", upto - F.col("_c")).filter((F.col("_rank") >= F.col("_below")) & (F.col("_rank") < F.col("_below") + F.col("_c")))
        return held.withColumn("_rank", F.col("_rank") - F.col("_below")).drop("_c", "_below")

    counts = data.groupBy(*keys, F.shiftright("_bits", 64 - DIGIT).alias("_digit")).agg(*measures)
    position = (F.sum("_c").over(Window.partitionBy(*keys)) - 1) * F.lit(p)
    upto = F.sum("_c").over(Window.partitionBy(*keys).orderBy("_digit").rowsBetween(Window.unboundedPreceding, 0))
    ranks = F.array(F.struct(F.lit(0).alias("_end"), F.floor(position).alias("_rank")), F.struct(F.lit(1).alias("_end"), F.ceil(position).alias("_rank")))
    first = counts.withColumns({"_below": upto - F.col("_c"), "_part": position - F.floor(position), "_ranks": ranks}).select("*", F.inline("_ranks"))
    first = first.filter((F.col("_rank") >= F.col("_below")) & (F.col("_rank") < F.col("_below") + F.col("_c")))
    state = cut_lineage(first.select(*keys, "_end", "_part", (F.col("_rank") - F.col("_below")).alias("_rank"), F.col("_digit").alias("_prefix"), "_low", "_high"))
    settled = [state.filter("_low = _high")]
    for known in range(DIGIT, 64, DIGIT):
        open_ = state.filter("_low <> _high")
        if not open_.limit(1).count():
            break
        wanted = open_.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_end", "_part", "_rank", "_prefix")
        same = F.shiftright("_bits", 64 - known) == F.col("_prefix")
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
        digit = F.shiftright("_bits", 64 - known - DIGIT).alias("_digit")
        counts = data.join(wanted, same).groupBy(*keys, "_end", "_part", "_rank", digit).agg(*measures)
        state = cut_lineage(chosen(counts, "_end").withColumnRenamed("_digit", "_prefix"))
        settled.append(state.filter("_low = _high"))
    both = union_all([s.select(*keys, "_end", "_part", "_low") for s in settled]).groupBy(*keys).agg(
        F.max("_part").alias("_part"), F.max(F.when(F.col("_end") == 0, F.col("_low"))).alias("_low"), F.max(F.when(F.col("_end") == 1, F.col("_low"))).alias("_high")
    )
    between = F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")
    return both.select(*keys, F.when((F.col("_part") == 0) | (F.col("_low") == F.col("_high")), F.col("_low")).otherwise(between).alias(name))


def latest_values(df: DataFrame, series: str, value: str, at: str, wanted: Mapping[str, str]) -> DataFrame:
    """One row holding the latest value of each wanted series as its own column."""
    return df.agg(
        *[
            F.max_by(F.when(F.col(series) == s, F.col(value)), F.when(F.col(series) == s, F.col(at))).alias(name)
            for s, name in wanted.items()
        ]
    )


def with_one_row(df: DataFrame, one: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row, as scalar subqueries."""
    return df.withColumns({name: one.select(name).scalar() for name in one.columns})


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
