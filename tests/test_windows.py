import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestrata.operators import aggregates as agg
from lodestrata.operators import cooldown
from lodestrata.operators import windows as w
from lodestrata.streaming import windows as sw

T0 = dt.datetime(2024, 1, 1)


def minutes(spark, pairs):
    return spark.createDataFrame([(k, T0 + dt.timedelta(minutes=m), float(v)) for k, m, v in pairs], "k string, ts timestamp_ntz, v double")


def test_rolling_mean_across_buckets(spark):
    random.seed(1)
    data = [("hot" if random.random() < 0.7 else "b", random.randrange(400), random.randrange(100)) for _ in range(300)]
    got = {(r.k, r.ts): r.rolling_avg for r in w.rolling_mean(minutes(spark, data), ["k"], "ts", "v", 30).collect()}
    for k, m, _ in data:
        near = [v for kk, mm, v in data if kk == k and m - 30 <= mm <= m]
        assert got[(k, T0 + dt.timedelta(minutes=m))] == pytest.approx(sum(near) / len(near))


@pytest.mark.parametrize("gap, want", [(30, 1), (31, 2)])
def test_session_boundary_equals_session_window(spark, gap, want):
    df = minutes(spark, [("a", 0, 1), ("a", gap, 1)])
    slots = w.sessions(df, ["k"], "ts", 30, {"n": (F.count("*"), "sum")})
    native = df.groupBy(F.session_window("ts", "30 minutes"), "k").count()
    assert slots.count() == native.count() == want


def test_cooldown(spark):
    df = minutes(spark, [("a", m, 1) for m in (0, 3, 6, 20, 29, 45)])
    fired = sorted(r.ts for r in cooldown.firings_with_cooldown(df, ["k"], "ts", 10).collect())
    assert fired == [T0 + dt.timedelta(minutes=m) for m in (0, 20, 45)]


def test_a_lasting_failure_fires_after_each_cooldown(spark):
    every_minute = minutes(spark, [("a", m, 1) for m in range(180)])
    assert cooldown.firings_with_cooldown(every_minute, ["k"], "ts", 5).count() == 36
    random.seed(4)
    data = [(k, m) for k in (None, "x", "y") for m in sorted(random.sample(range(3000), 250))]
    expected = []
    for key in (None, "x", "y"):
        last = None
        for k, m in data:
            if k == key and (last is None or m >= last + 37):
                expected.append((str(key), T0 + dt.timedelta(minutes=m)))
                last = m
    got = cooldown.firings_with_cooldown(minutes(spark, [(k, m, 1) for k, m in data]), ["k"], "ts", 37).collect()
    assert sorted((str(r.k), r.ts) for r in got) == sorted(expected)


@pytest.mark.parametrize("rows_together", [1, 7, 10000])
def test_cooldown_over_many_pieces(spark, rows_together):
    r = random.Random(rows_together)
    data = [(k, r.randrange(400)) for k in ["x"] * 300 + ["y"] * 30 + [None] * 40] + [("same", 5)] * 50 + [("dense", m) for m in range(150)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows_together))
    try:
        for gap in (1, 13, 1000):
            expected = []
            for key in {k for k, _ in data}:
                last = None
                for m in sorted({m for k, m in data if k == key}):
                    if last is None or m >= last + gap:
                        expected.append((str(key), T0 + dt.timedelta(minutes=m)))
                        last = m
            df = minutes(spark, [(k, m, 1) for k, m in data]).repartition(6)
            got = cooldown.firings_with_cooldown(df.unionAll(df.limit(1).withColumn("ts", F.lit(None).cast("timestamp_ntz"))), ["k"], "ts", gap)
            assert sorted((str(x.k), x.ts) for x in got.collect()) == sorted(expected)
        assert cooldown.firings_with_cooldown(df.limit(0), ["k"], "ts", 5).count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_exits_follow_the_chain():
    r = random.Random(3)
    for _ in range(300):
        times = np.array(sorted(r.sample(range(200), r.randrange(1, 40))), np.int64)
        gap = r.randrange(1, 60)
        until, out = cooldown.exits(times, gap)
        for e in range(int(times[0]), int(times[0]) + gap):
            fired = cooldown.chain(times, gap, int(np.searchsorted(times, e)))
            step = int(np.searchsorted(until, e))
            assert (int(out[step]) if step < len(out) else None) == (int(fired[-1]) if len(fired) else None)


def test_large_and_undefined_readings_leave_no_trace(spark):
    df = minutes(spark, [("a", 1, 1e17), ("a", 59, 3), ("a", 75, 1), ("b", 1, float("nan")), ("b", 59, 3), ("b", 75, 1), ("b", 30, float("inf"))])
    got = {(r.k, r.ts.hour * 60 + r.ts.minute): r.rolling_avg for r in w.rolling_mean(df, ["k"], "ts", "v", 60).collect()}
    assert got["a", 75] == 2.0 and np.isnan(got["b", 59]) and np.isinf(got["b", 75])
    after = w.rolling_mean(df, ["k"], "ts", "v", 20).filter("k = 'b'").collect()
    assert sorted(r.rolling_avg for r in after)[:2] == [2.0, 3.0]


def test_interval_join(spark):
    shifts = spark.createDataFrame(
        [("day", T0, T0 + dt.timedelta(hours=9)), ("night", T0 + dt.timedelta(hours=9), T0 + dt.timedelta(hours=30))], "name string, s timestamp_ntz, e timestamp_ntz"
    )
    met = w.interval_join(minutes(spark, [("a", 0, 1), ("b", 540, 1), ("c", 1900, 1)]), shifts, "ts", "s", "e")
    assert sorted((r.k, r.name) for r in met.collect()) == [("a", "day"), ("b", "day"), ("b", "night")]


def test_open_and_far_intervals_give_all_their_rows(spark):
    at = lambda m: T0 + dt.timedelta(minutes=m)
    rows = [("open", at(60), None), ("far", at(500), dt.datetime(9999, 12, 31)), ("since ever", None, at(60)), ("gone", at(-900), at(-800)), ("point", at(540), at(540)), ("always", None, None)]
    intervals = spark.createDataFrame(rows, "name string, s timestamp_ntz, e timestamp_ntz")
    points = [0, 60, 61, 499, 500, 540, 1900]
    met = w.interval_join(minutes(spark, [(str(m), m, 1) for m in points]), intervals, "ts", "s", "e")
    expected = [(str(m), n) for m in points for n, s, e in rows if (s is None or s <= at(m)) and (e is None or at(m) <= e)]
    assert sorted((r.k, r.name) for r in met.collect()) == sorted(expected)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_best_interval_at_each_point(spark, seed):
    r = random.Random(seed)
    at = lambda m: None if m is None else T0 + dt.timedelta(minutes=m)
    rows = []
    for k in range(60):
        s, e = r.choice([None, r.randrange(2000)]), r.choice([None, r.randrange(2000), r.randrange(2000)])
        rows.append((f"n{k}", r.randrange(5), at(s), at(e)))
    rows += [rows[0], ("point", 0, at(540), at(540)), ("far", 9, at(100), dt.datetime(9999, 12, 31)), ("backwards", -1, at(900), at(800))]
    intervals = spark.createDataFrame(rows, "name string, rank int, s timestamp_ntz, e timestamp_ntz")
    moments = [r.randrange(-50, 2100) for _ in range(300)] + [540] * 40
    points = minutes(spark, [(f"{i} {m}", m, 1) for i, m in enumerate(moments)]).unionAll(minutes(spark, [("never", 0, 1)]).withColumn("ts", F.lit(None).cast("timestamp_ntz")))
    for some in (rows, [x for x in rows if x[2] and x[3]], []):
        inside = lambda x, m: (x[2] is None or x[2] <= at(m)) and (x[3] is None or at(m) <= x[3])
        want = {f"{i} {m}": min(((x[1], x[0]) for x in some if inside(x, m)), default=(None, None))[1] for i, m in enumerate(moments)}
        given = intervals if some is rows else spark.createDataFrame(some, intervals.schema)
        got = w.best_at(points, given, "ts", "s", "e", [F.col("rank"), F.col("name")], ["name"])
        assert got.columns == ["k", "ts", "v", "name"]
        assert {x.k: x.name for x in got.collect()} == {**want, "never": None}


def test_positions_within_a_hot_key(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 2).alias("k"), (F.col("id") * 7 % 3001).alias("o"))
    got = w.number_rows(df, ["k"], ["o"], "n").collect()
    for key in (None, 0, 1):
        mine = sorted((r.o, r.n) for r in got if r.k == key)
        assert [n for _, n in mine] == list(range(1, len(mine) + 1))


def test_ordered_lists_are_whole(spark):
    df = spark.range(2500).select(F.lit("s").alias("k"), F.col("id").alias("o"), F.col("id").cast("string").alias("v"))
    parts = sorted((r.part_no, r.items) for r in w.ordered_lists(df, ["k"], ["o"], "v", "items", 1000).collect())
    assert [len(i) for _, i in parts] == [1000, 1000, 500]
    assert [x for _, i in parts for x in i] == [str(n) for n in range(2500)]


def test_exact_percentile(spark):
    random.seed(5)
    close = [1.0 + k * 2.0**-52 for k in range(40)]  # differ in the last bits only
    data = [("hot", random.choice([1.0, 2.5, random.random() * 100, -random.random()])) for _ in range(3000)] + [("small", 4.0), ("small", 8.0), ("one", -3.0)]
    data += [("close", x) for x in close] + [("wide", x) for x in (-1e308, -5e-324, 0.0, -0.0, 5e-324, 1e-310, 3.0, 1e308)] + [(None, x) for x in (1.0, 2.0, 4.0)]
    df = spark.createDataFrame(data, "k string, v double").unionAll(spark.createDataFrame([("hot", None), ("none", None)], "k string, v double"))
    for p in (0.0, 0.5, 0.95, 1.0):
        got = {r.k: r.q for r in agg.exact_percentile(df, ["k"], "v", p, "q").collect()}
        assert got.keys() == {"hot", "small", "one", "close", "wide", None}
        for k in got:
            own = sorted(v for kk, v in data if kk == k)
            at = (len(own) - 1) * p
            low, high = own[int(np.floor(at))], own[int(np.ceil(at))]
            assert got[k] == (low if at == int(at) or low == high else low + (high - low) * (at - int(at)))
    assert agg.exact_percentile(df.filter("k = 'hot'"), [], "v", 1.0, "q").first().q == max(v for k, v in data if k == "hot")


def test_order_bits_keep_the_order(spark):
    random.seed(9)
    import struct

    values = [struct.unpack("<d", random.randbytes(8))[0] for _ in range(500)] + [0.0, -0.0, float("inf"), float("-inf"), float("nan"), 2.0**-1022, 2.0**-1074, 1.0, 2.0, np.nextafter(1.0, 0), np.nextafter(2.0, 3)]
    values += [2.0**k for k in range(-1074, 1024, 13)] + [-(2.0**k) for k in range(-1074, 1024, 17)]
    rows = spark.createDataFrame([(float(v),) for v in values], "v double").select("v", agg.order_bits(F.col("v")).alias("b")).collect()
    rows = sorted(rows, key=lambda r: r.b)
    plain = [r.v for r in rows if not np.isnan(r.v)]
    assert plain == sorted(plain) and all(np.isnan(r.v) for r in rows[len(plain) :])
    for r in rows:
        if r.v > 0 and not np.isnan(r.v):
            assert r.b == struct.unpack("<q", struct.pack("<d", r.v))[0]


def test_mean_of_nothing_is_null(spark):
    assert spark.createDataFrame([], "v double").agg(agg.mean(F.col("v"))).first()[0] is None


def test_web_session_products(spark):
    rows = [("s", "u", T0, "page_view", "p2"), ("s", "u", T0 + dt.timedelta(minutes=5), "quote_request", "p1"), ("s", "u", T0 + dt.timedelta(hours=2), "click", "p1")]
    df = spark.createDataFrame(rows, "session_id string, user_id string, ts timestamp_ntz, kind string, product string")
    got = sorted((r.event_count, r.products_viewed, r.quote_requests) for r in sw.web_sessions(df, "session_id", "user_id", "ts", "kind", "product").collect())
    assert got == [(1, ["p1"], 0), (2, ["p1", "p2"], 1)]
