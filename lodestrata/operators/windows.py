"""Rolling averages, trends, sessions, interval joins and dense keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.session import cut_lineage


#: Rows that are sorted together in one task.
ROWS_TOGETHER = 5_000_000


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def rolling_mean(df: DataFrame, keys: Sequence[str], ts: str, value: str, minutes: int, name: str = "rolling_avg") -> DataFrame:
    """Mean of ``value`` over the last ``minutes`` up to each instant of a key.

    Readings are summed per key and instant first. A key's time line is cut into buckets as
    long as the window, so a busy key is spread over many tasks. A window ends in its own bucket
    and begins in the one before: its sum is the running sum of the own bucket plus the sum
    from the window's start to the end of the bucket before. Nothing is ever subtracted, so no large
    or undefined reading leaves a trace in windows that do not hold it.
    """
    span = minutes * 60 * 1_000_000
    instants = (
        df.groupBy(*keys, ts)
        .agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"), F.max(value).alias("_last"))
        .withColumn("_us", micros(F.col(ts)))
        .withColumn("_own", F.floor(F.col("_us") / span))
    )
    up = Window.partitionBy(*keys, "_own").orderBy("_us").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*keys, "_own").orderBy(F.col("_us").desc()).rowsBetween(Window.unboundedPreceding, 0)
    sums = instants.withColumns(
        {"_head": F.sum("_sum").over(up), "_head_n": F.sum("_n").over(up), "_tail": F.sum("_sum").over(down), "_tail_n": F.sum("_n").over(down)}
    )
    # an instant serves its own bucket, and from the next one it is last seen one window later
    seen = F.struct(F.col("_tail").alias("s"), F.col("_tail_n").alias("n"))
    own = F.struct(F.col("_own").alias("_bucket"), F.col("_us").alias("_at"), F.lit(True).alias("_mine"), F.nullif(seen, seen).alias("_rest"))
    later = F.struct((F.col("_own") + 1).alias("_bucket"), (F.col("_us") + span).alias("_at"), F.lit(False).alias("_mine"), seen.alias("_rest"))
    back = Window.partitionBy(*keys, "_bucket").orderBy(F.col("_at").desc(), "_mine").rowsBetween(Window.unboundedPreceding, 0)
    both = sums.select(*keys, ts, "_last", "_head", "_head_n", F.inline(F.array(own, later)))
    met = both.withColumn("_before", F.last("_rest", ignorenulls=True).over(back)).filter("_mine")
    rest, rest_n = F.col("_before.s"), F.coalesce(F.col("_before.n"), F.lit(0))
    total = F.when(F.col("_head").isNull(), rest).when(rest.isNull(), F.col("_head")).otherwise(F.col("_head") + rest)
    return met.select(*keys, ts, F.col("_last").alias(value), (total.cast("double") / F.nullif(F.col("_head_n") + rest_n, F.lit(0))).alias(name))


def smoothed(df: DataFrame, keys: Sequence[str], ts: str, value: str, name: str = "smoothed") -> DataFrame:
    """0.7 times the mean of the last 60 minutes plus 0.3 times the current reading."""
    rolled = rolling_mean(df, keys, ts, value, 60, "_mean")
    return rolled.withColumn(
        name, F.coalesce(F.col("_mean") * 0.7 + F.col(value).cast("double") * 0.3, F.col(value).cast("double"))
    ).drop("_mean")


def trend(df: DataFrame, keys: Sequence[str], at: str, score: str) -> DataFrame:
    """Change against the previous point of a series and its direction.

    Meant for series already aggregated per period: a key then holds one row per period.
    """
    w = Window.partitionBy(*keys).orderBy(at)
    change = F.col(score) - F.lag(score).over(w)
    return df.withColumn("change", change).withColumn(
        "direction",
        F.when(F.col("change") > 0, "improving").when(F.col("change") < 0, "degrading").when(F.col("change") == 0, "stable"),
    )


def sessions(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    gap_minutes: int,
    measures: Mapping[str, tuple[Column, str]],
) -> DataFrame:
    """Sessions split where a key is silent for longer than the gap.

    ``measures`` maps a name to (aggregate, how partial results combine: sum, min or max).
    Events are first reduced to one row per key and slot of the gap's length; inside a slot
    no silence can exceed the gap, so only slots are ordered per key, never events.
    """
    gap = gap_minutes * 60 * 1_000_000
    slots = df.groupBy(*keys, F.floor(micros(F.col(ts)) / gap).alias("_slot")).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), *[agg.alias(name) for name, (agg, _) in measures.items()]
    )
    w = Window.partitionBy(*keys).orderBy("_slot")
    silence = micros(F.col("_first")) - F.lag(micros(F.col("_last"))).over(w)
    starts = F.when(silence.isNull() | (silence > gap), 1).otherwise(0)
    numbered = slots.withColumn("_start", starts).withColumn("_session", F.sum("_start").over(w))
    combine = {"sum": F.sum, "min": F.min, "max": F.max}
    return (
        numbered.groupBy(*keys, "_session")
        .agg(
            F.min("_first").alias("session_start"),
            F.max("_last").alias("session_end"),
            *[combine[how](name).alias(name) for name, (_, how) in measures.items()],
        )
        .drop("_session")
    )


def interval_join(points: DataFrame, intervals: DataFrame, ts: str, start: str, end: str, bucket_minutes: int = 60, on: Sequence[str] = ()) -> DataFrame:
    """Points in ``[start, end]``: an equi-join on time buckets plus the exact check.

    A NULL start or end is open. Intervals are cut to the time of the points; a longer interval
    uses wider buckets (a power of two of ``bucket_minutes``), so that none touches more than three, and a point is
    looked up once for each width that occurs (a few dozen at most).
    """
    width = bucket_minutes * 60 * 1_000_000
    low, high = points.agg(F.min(micros(F.col(ts))), F.max(micros(F.col(ts)))).first()
    if low is None:
        low = high = 0
    since = F.greatest(F.coalesce(micros(F.col(start)), F.lit(low)), F.lit(low))
    until = F.least(F.coalesce(micros(F.col(end)), F.lit(high)), F.lit(high))
    kept = intervals.withColumns({"_since": since, "_until": until}).filter("_since <= _until")
    level = F.ceil(F.log2(F.greatest((F.col("_until") - F.col("_since")) / width, F.lit(1.0)))).cast("int")
    kept = kept.withColumn("_level", level)
    levels = sorted(r[0] for r in kept.select("_level").distinct().collect())
    wide = lambda c, n: F.floor(c / (F.lit(float(width)) * F.pow(F.lit(2.0), n)))
    spread = kept.withColumn("_b", F.explode(F.sequence(wide(F.col("_since"), F.col("_level")), wide(F.col("_until"), F.col("_level")))))
    left = points.withColumn("_at", micros(F.col(ts))).withColumn("_pl", F.explode(F.array(*[F.lit(n) for n in levels or [0]])))
    left = left.withColumn("_pb", wide(F.col("_at"), F.col("_pl")))
    cond = (F.col("_pb") == F.col("_b")) & (F.col("_pl") == F.col("_level")) & (F.col("_at") >= F.col("_since")) & (F.col("_at") <= F.col("_until"))
    for name in on:
        spread = spread.withColumnRenamed(name, f"_i_{name}")
        cond = cond & (F.col(name) == F.col(f"_i_{name}"))
    return left.join(spread, cond).drop("_at", "_pl", "_pb", "_b", "_level", "_since", "_until", *[f"_i_{n}" for n in on])


#: Turns among which the rows of one slice of time are dealt.
TURNS = 8


def best_segments(intervals: DataFrame, since: Column, until: Column, best: Column, top: int) -> DataFrame:
    """Disjoint segments of 0..``top``: ``_x``, where one begins, and ``_best``, the least of the intervals there (NULL for none).

    Intervals are ``[since, until)``. Each is cut into the blocks of a binary tree over time that make it up, a few for each
    doubling of its length; blocks keep their least. The least at a point is the least of the blocks that hold it, so
    intervals that overlap are never paired with each other. Equal intervals are one from the start.
    """
    levels = top.bit_length()
    once = intervals.select(since.alias("_a"), until.alias("_b"), best.alias("_best")).filter("_a < _b").groupBy("_a", "_b").agg(F.min("_best").alias("_best"))

    def half(c: Column, times: Column) -> Column:
        return F.call_function("shiftright", c, times)

    def blocks(k: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), k)
        a, b = half(F.col("_a") + size - 1, k), half(F.col("_b"), k)
        block = lambda odd, at: F.when((a < b) & (odd % 2 == 1), F.struct(k.alias("_k"), at.alias("_n")))
        return F.array(block(a, a), block(b, b - 1))

    cut = F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), blocks)))
    nodes = once.select(F.inline(cut), "_best").groupBy("_k", "_n").agg(F.min("_best").alias("_best"))
    bounds = once.select(F.explode(F.array("_a", "_b")).alias("_x")).distinct()
    above = F.transform(F.sequence(F.lit(0), F.lit(levels)), lambda k: F.struct(k.alias("_k"), half(F.col("_x"), k).alias("_n")))
    return bounds.select("_x", F.inline(above)).join(nodes, ["_k", "_n"], "left").groupBy("_x").agg(F.min("_best").alias("_best"))


def best_at(points: DataFrame, intervals: DataFrame, ts: str, start: str, end: str, order: Sequence[Column], keep: Sequence[str]) -> DataFrame:
    """``points`` with the columns ``keep`` of the first interval by ``order`` that holds their ``ts`` (NULL where none does).

    Both ends belong to an interval, a NULL end is open. Intervals become disjoint segments with the best one
    (:func:`best_segments`); points and the beginnings of segments meet in slices of time, where each point takes the last
    segment that begins before it. A segment that lasts into later slices is carried on to each of them. A point
    is moved once, whatever the lengths of intervals; points of one instant are dealt to several turns.
    """
    low, high = intervals.agg(F.least(F.min(micros(F.col(start))), F.min(micros(F.col(end)))), F.greatest(F.max(micros(F.col(start))), F.max(micros(F.col(end))))).first()
    low, high = (0, 0) if low is None else (low, high)
    # 0 lies before every interval that begins somewhere, the last number behind every one that ends
    top = high - low + 3
    best = F.struct(*[c.alias(f"_o{k}") for k, c in enumerate(order)], *[F.col(c) for c in keep])
    since = F.coalesce(micros(F.col(start)) - F.lit(low) + 1, F.lit(0).cast("long"))
    until = F.coalesce(micros(F.col(end)) - F.lit(low) + 2, F.lit(top).cast("long"))
    segments = best_segments(intervals, since, until, best, top)

    slices = 4 * int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slice_of = lambda c: F.floor(F.coalesce(c, F.lit(0)) / (-(-(top + 1) // slices)))
    marks = segments.select(slice_of(F.col("_x")).alias("_slice"), F.lit(1).alias("_kind"), "_x", F.struct(F.col("_best").alias("best")).alias("_mark"))
    # what each slice begins with: one row a slice, so these can be ordered as a whole
    ends = marks.groupBy("_slice").agg(F.max_by("_mark", "_x").alias("_mark"))
    grid = points.sparkSession.range(slices + 1).select(F.col("id").alias("_slice")).join(ends, "_slice", "left")
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    begins = grid.select("_slice", F.lit(0).alias("_kind"), F.lit(-1).cast("long").alias("_x"), F.last("_mark", ignorenulls=True).over(before).alias("_mark"))
    marks = marks.unionAll(begins).withColumn("_turn", F.explode(F.sequence(F.lit(0), F.lit(TURNS - 1))))
    x = F.least(F.greatest(micros(F.col(ts)) - F.lit(low) + 1, F.lit(0)), F.lit(top - 1)).cast("long")
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(points.columns)])
    timed = points.select(F.when(F.col(ts).isNotNull(), x).alias("_x"), row.alias("_row"))
    dealt = timed.select(slice_of(F.col("_x")).alias("_slice"), F.lit(2).alias("_kind"), "_x", "_row", F.pmod(F.xxhash64("_row"), F.lit(TURNS)).cast("int").alias("_turn"))
    both = dealt.unionByName(marks, allowMissingColumns=True)
    by_time = Window.partitionBy("_slice", "_turn").orderBy(F.col("_x").asc_nulls_first(), "_kind").rowsBetween(Window.unboundedPreceding, 0)
    met = both.withColumn("_found", F.last("_mark", ignorenulls=True).over(by_time)).filter("_kind = 2")
    known = F.when(F.col("_x").isNotNull(), F.col("_found.best"))
    old = [F.col(f"_row.c{k}").alias(c) for k, c in enumerate(points.columns)]
    return met.withColumn("_known", known).select(*old, *[F.col(f"_known.{c}").alias(c) for c in keep])


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Position 1..n of each row within its key, for keys of any size.

    Rows are range-partitioned and sorted by key and order, so a busy key spans many tasks,
    and then fixed by a checkpoint. A second pass adds what a key has in the partitions
    before: one small row per key and partition, never the rows of a key.
    """
    columns = [*keys, *order]
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_TOGETHER))
    ordered = df.repartitionByRange(parts, *columns).sortWithinPartitions(*columns)
    placed = cut_lineage(ordered.withColumn("_mid", F.monotonically_increasing_id())).withColumns(
        {"_part": F.shiftright("_mid", 33), "_pos": F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))}
    )
    pieces = placed.groupBy(*keys, "_part").agg(F.count("*").alias("_size"), F.min("_pos").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.withColumn("_offset", F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first"))
    same = F.col("p._part") == F.col("o._part")
    for k in keys:
        same = same & F.col(f"p.{k}").eqNullSafe(F.col(f"o.{k}"))
    joined = placed.alias("p").join(offsets.alias("o"), same)
    return joined.select("p.*", (F.col("p._pos") + F.col("o._offset") + 1).alias(name)).drop("_mid", "_part", "_pos")


def dense_key(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Gap-free key 1..n in the given order."""
    return number_rows(df, [], order, name)


def ordered_lists(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, size: int = 1000) -> DataFrame:
    """Values of each key in order, as lists of at most ``size`` with a ``part_no``.

    The parts of a key in order are its whole sequence; short keys have one part.
    """
    numbered = number_rows(df.select(*keys, *order, F.col(value).alias("_value")), keys, order, "_n")
    part = F.floor((F.col("_n") - 1) / size)
    items = F.sort_array(F.collect_list(F.struct("_n", "_value")))
    return (
        numbered.groupBy(*keys, part.alias("part_no"))
        .agg(items.alias("_items"))
        .select(*keys, "part_no", F.transform("_items", lambda i: i["_value"]).alias(name))
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], at: str, columns: Sequence[str]) -> DataFrame:
    """Newest values per key in one aggregation (instead of joining back on the maximum)."""
    newest = F.max_by(F.struct(*columns), F.col(at)).alias("r")
    return df.groupBy(*keys).agg(F.max(at).alias(at), newest).select(*keys, at, "r.*")
