import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata import schemas
from lodestrata.plans.registry import at
from lodestrata.sources.readers import read_event_stream
from lodestrata.operators import cooldown
from lodestrata.streaming import enrich, parse, queries, stateful, windows

T0 = dt.datetime(2024, 1, 1)


def land(spark, folder, name, rows, schema):
    """One file per micro-batch, in name order."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


SCHEMA = "id string, ts timestamp_ntz, payment_type string, status string, amount double"


def test_late_events_are_dropped_and_windows_closed(spark, tmp_path):
    source = f"{tmp_path}/in"
    batches = [
        [("1", T0, "card", "ok", 1.0), ("2", T0 + dt.timedelta(seconds=30), "card", "ok", 2.0)],
        [("3", T0 + dt.timedelta(minutes=20), "card", "ok", 5.0)],
        [("4", T0 + dt.timedelta(seconds=40), "card", "ok", 100.0)],  # far behind the watermark
        [("5", T0 + dt.timedelta(minutes=40), "card", "ok", 7.0)],
    ]
    for i, rows in enumerate(batches):
        land(spark, source, f"b{i}", rows, SCHEMA)
        stream = read_event_stream(spark, source, spark.read.parquet(f"{source}/b0").schema, max_files_per_trigger=1, recursiveFileLookup="true")
        out = windows.payment_minutes(parse.with_watermark(stream, "ts", "5 minutes"), "ts")
        queries.start(out, f"{tmp_path}/out", f"{tmp_path}/state", f"late_{i}").awaitTermination()
    got = sorted((r.payment_count, r.total_amount) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [(1, 5.0), (2, 3.0)]


def test_repeated_events_count_once(spark, tmp_path):
    source = f"{tmp_path}/in"
    land(spark, source, "a", [("1", T0, "card", "ok", 1.0), ("1", T0, "card", "ok", 1.0), ("2", T0, "card", "ok", 2.0)], SCHEMA)
    stream = read_event_stream(spark, source, spark.read.parquet(f"{source}/a").schema, recursiveFileLookup="true")
    out = parse.drop_repeated(parse.with_watermark(stream, "ts", "5 minutes"), "id")
    queries.start(out, f"{tmp_path}/out", f"{tmp_path}/state", "dedup").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2


def test_malformed_payload_goes_to_rejects(spark):
    good = json.dumps({"transaction_id": "t1", "event_type": "pay", "amount": 5.0, "currency": "USD", "event_timestamp": "2024-01-01T00:00:00Z"})
    raw = spark.createDataFrame([(good.encode(), 1), (b"{oops", 2), (b'{"event_type":"pay"}', 3)], "body binary, offset int")
    parsed = parse.parse_payload(raw, T.StructType.fromDDL(schemas.PAYMENT_EVENT), at("2024-01-01"), keep=("offset",))
    ok, bad = parse.good_and_bad(parsed, ["transaction_id", "amount"])
    assert [r.offset for r in ok.collect()] == [1] and sorted(r.offset for r in bad.collect()) == [2, 3]


@pytest.mark.parametrize("amount, kind, want", [(50000.0, "pay", (False, None)), (50000.01, "pay", (True, "high_value")), (-1.0, "pay", (True, "negative_amount")), (1.0, "decline", (True, None)), (60000.0, "chargeback", (True, "high_value"))])
def test_payment_boundaries(spark, amount, kind, want):
    df = spark.createDataFrame([("t", kind, amount, T0)], "transaction_id string, event_type string, amount double, event_timestamp timestamp_ntz")
    row = enrich.flag_payments(df).first()
    assert (row.is_anomaly, row.anomaly_type) == want


@pytest.mark.parametrize("lag, score", [(30, 0.1), (31, 0.6)])
def test_claim_lag_boundary(spark, lag, score):
    df = spark.createDataFrame([(100.0, T0, T0 + dt.timedelta(days=lag), "web", "low")], "loss_amount_estimate double, loss_date timestamp_ntz, report_date timestamp_ntz, channel string, priority string")
    row = enrich.enrich_claims(df).first()
    assert (row.report_lag_days, float(row.fraud_risk_score)) == (lag, score)


def test_zoneless_time_is_accepted(spark, tmp_path):
    land(spark, f"{tmp_path}/in", "a", [("1", T0, "card", "ok", 1.0)], SCHEMA)
    stream = read_event_stream(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in/a").schema, recursiveFileLookup="true")
    assert dict(parse.with_watermark(stream, "ts", "1 minute").dtypes)["ts"] == "timestamp"


def test_progress_stop_and_upsert(spark, tmp_path):
    land(spark, f"{tmp_path}/in", "a", [("1", T0, "card", "ok", 1.0)], SCHEMA)
    stream = read_event_stream(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in/a").schema, recursiveFileLookup="true")
    q = queries.start(stream, f"{tmp_path}/out", f"{tmp_path}/state", "watched", every="1 second")
    q.processAllAvailable()
    health = queries.query_health(queries.progress_rows([q], spark)).first()
    assert health.query_name == "watched" and health.health_status in ("HEALTHY", "LAGGING", "SLOW")
    assert ("watched", str(q.id)) in queries.active_queries(spark)
    assert queries.stop_queries(spark, "watched") == [str(q.id)]
    seen = []
    write = queries.upsert_sink(lambda df, n: seen.append((n, df.count())))
    write(spark.range(3), 1)
    write(spark.range(0), 2)
    assert seen == [(1, 3)]
    assert spark.range(1).filter(F.expr(queries.STREAM_ALERTS["large_loss"].replace("loss_amount", "200000"))).count() == 1


CLICK = "k string, id string, ts timestamp_ntz, kind string, product string"


def landed_in_order(spark, folder, seed=5):
    """Events of three keys that arrive up to nine minutes late, a file a round; all but those after the last watermark."""
    r = random.Random(seed)
    events = []
    for key in "abc":
        at = 0.0
        for n in range(60):
            at += r.choice([1, 2, 2, 11, 40])
            events.append((key, f"{key}{n:03d}", T0 + dt.timedelta(minutes=at), f"kind{n % 5}", r.choice(["home", "auto", None])))
    arrival = sorted(events, key=lambda e: e[2] + dt.timedelta(minutes=r.uniform(0, 9)))
    for i in range(0, len(arrival), 20):
        land(spark, folder, f"b{i:04d}", arrival[i : i + 20], CLICK)
    land(spark, folder, "z", [("end", "end", T0 + dt.timedelta(days=30), "end", None)], CLICK)
    return events


def two_halves(spark, tmp_path, made, name):
    """The same folder before and after more files have landed: the second run takes up the first one's state."""
    source, later = f"{tmp_path}/{name}-in", f"{tmp_path}/{name}-later"
    events = landed_in_order(spark, later)
    parts = sorted(os.listdir(later))
    schema = T.StructType.fromDDL(CLICK)
    for half in (parts[: len(parts) // 2], parts[len(parts) // 2 :]):
        for part in half:
            spark.read.parquet(f"{later}/{part}").coalesce(1).write.parquet(f"{source}/{part}")
        stream = read_event_stream(spark, source, schema, max_files_per_trigger=1, recursiveFileLookup="true")
        queries.start(made(parse.with_watermark(stream, "ts", "10 minutes")), f"{tmp_path}/{name}", f"{tmp_path}/{name}-state", f"{name}{len(half)}").awaitTermination()
    return events, spark.read.parquet(f"{tmp_path}/{name}")


@pytest.mark.parametrize("size", [1000, 3])
def test_ordered_sessions_of_a_stream_with_late_events_and_a_restart(spark, tmp_path, size):
    made = lambda df: stateful.ordered_sessions(df, ["k"], "ts", "id", "kind", "product", 30, size)
    events, out = two_halves(spark, tmp_path, made, "sessions")
    expected = []
    for key in "abc":
        session: list = []
        for e in [*sorted((x for x in events if x[0] == key), key=lambda x: (x[2], x[1])), None]:
            if session and (e is None or e[2] - session[-1][2] >= dt.timedelta(minutes=30)):
                for n in range(0, len(session), size):
                    part = session[n : n + size]
                    expected.append((key, session[0][2], part[-1][2], n // size, n + size >= len(session), len(part), [x[3] for x in part], sorted({x[4] for x in part if x[4]})))
                session = []
            session.append(e)
    assert sorted(tuple(r) for r in out.filter("k <> 'end'").collect()) == sorted(expected)


def test_alerts_of_a_stream_keep_their_cooldown_over_a_restart(spark, tmp_path):
    events, out = two_halves(spark, tmp_path, lambda df: stateful.alerts_with_cooldown(df, ["k"], "ts", 45), "alerts")
    df = spark.createDataFrame(events, CLICK)
    want = cooldown.firings_with_cooldown(df, ["k"], "ts", 45)
    assert sorted((r.k, r.fired_at) for r in out.filter("k <> 'end'").collect()) == sorted((r.k, r.ts) for r in want.collect())


def test_a_session_of_one_event_costs_few_state_calls():
    """Each call to the state is a round trip between Python and the JVM, and most sessions are short."""
    from lodestrata.streaming import stateful

    calls = []

    class State:
        def __init__(self, several):
            self.several, self.value = several, [] if several else None

        def __getattr__(self, name):
            def call(*given):
                calls.append(name)
                if name == "exists":
                    return self.value not in (None, [])
                if name == "get":
                    return iter(self.value) if self.several else self.value
                self.value = ([] if self.several else None) if name == "clear" else (self.value or []) + given[0] if name == "appendList" else given[0]

            return call

    class Handle:
        def getListState(self, *_):
            return State(True)

        def getValueState(self, *_):
            return State(False)

        def registerTimer(self, ms):
            calls.append(ms)

        def deleteTimer(self, ms):
            calls.append("deleteTimer")

    class Times:
        def __init__(self, ms):
            self.ms = ms

        def getCurrentWatermarkInMs(self):
            return self.ms

    sessions = stateful._Sessions(["k", "start", "end", "part", "last", "n", "kinds", "products"], 1000, 10)
    sessions.init(Handle())
    assert not list(sessions.handleInputRows(("a",), iter([{"_us": 5000, "_id": "1", "_kind": "click", "_extra": None}]), Times(0)))
    assert [tuple(r)[3:] for r in sessions.handleExpiredTimer(("a",), Times(100), None)] == [(0, True, 1, ["click"], [])]
    assert calls.count(5) == 1 and len(calls) <= 8
