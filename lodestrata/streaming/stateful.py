"""Streams that keep a state of their own for each key and wake up by event-time timers.

Both operators wait until the watermark has passed an event before they settle it, so late events within the
watermark take their place in order, and what a stream writes equals the batch result over the same events.
State lives in the RocksDB store and is dropped by timers; a restart goes on from the checkpoint.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENT = T.StructType([T.StructField("us", T.LongType()), T.StructField("id", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("extra", T.StringType())])
OPEN = T.StructType([T.StructField("start", T.LongType()), T.StructField("last", T.LongType()), T.StructField("part", T.IntegerType())])


def _watched(df: DataFrame) -> DataFrame:
    """``df`` after its session has been told to keep state in RocksDB, as these operators need."""
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    return df


class _Waiting(StatefulProcessor):
    """Events of a key that the watermark has not passed yet; the earliest has a timer."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getListState("events", EVENT)
        self.timer = handle.getValueState("timer", T.StructType([T.StructField("ms", T.LongType())]))
        self.begin()

    def begin(self) -> None:
        raise NotImplementedError

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        late = timerValues.getCurrentWatermarkInMs() * 1000
        new = [(r["_us"], r["_id"], r["_kind"], r["_extra"]) for r in rows if r["_us"] > late or not late]
        if new:
            self.events.appendList(new)
            self.wake(_ms(min(e[0] for e in new)))
        return iter(())

    def wake(self, ms: int) -> None:
        """Sets the timer of this key, unless an earlier one is set."""
        known = self.timer.get()
        if known is None or ms < known[0]:
            if known is not None:
                self.handle.deleteTimer(known[0])
            self.handle.registerTimer(ms)
            self.timer.update((ms,))

    def passed(self, watermark: int) -> tuple[list[tuple], int | None]:
        """Takes the events that no later one can come before, in order; the second part is when the next is due.

        The timer that woke the key up is gone by then: the caller ends with :meth:`rest_until`.
        """
        all_events = sorted((tuple(e) for e in self.events.get()), key=lambda e: (e[0], e[1] or ""))
        done = [e for e in all_events if e[0] <= watermark]
        rest = all_events[len(done) :]
        if done:
            self.events.clear()
            if rest:
                self.events.put(rest)
        return done, _ms(rest[0][0]) if rest else None

    def rest_until(self, *due: int | None) -> None:
        """Sets the earliest of the timers given, the only one of this key; each call to the state costs a round trip."""
        first = min((ms for ms in due if ms is not None), default=None)
        if first is None:
            self.timer.clear()
        else:
            self.handle.registerTimer(first)
            self.timer.update((first,))

    def close(self) -> None:
        pass


class _Sessions(_Waiting):
    """Cuts a key's events into sessions by silence and hands them out in order, in parts of bounded length."""

    def __init__(self, names: Sequence[str], gap_us: int, size: int) -> None:
        self.row, self.gap, self.size = Row(*names), gap_us, size

    def begin(self) -> None:
        self.session = self.handle.getValueState("session", OPEN)
        self.held = self.handle.getListState("held", EVENT)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        stored = self.session.get()
        open_ = tuple(stored) if stored is not None else None
        held = [tuple(e) for e in self.held.get()] if open_ else []
        done, due = self.passed(watermark)
        for event in done:
            if open_ and event[0] - open_[1] >= self.gap:
                yield self.part(key, open_, held, True)
                open_, held = None, []
            if open_ and len(held) == self.size:
                yield self.part(key, open_, held, False)
                open_, held = (open_[0], open_[1], open_[2] + 1), []
            open_ = (open_[0], event[0], open_[2]) if open_ else (event[0], event[0], 0)
            held.append(event)
        if open_ and open_[1] + self.gap <= watermark:
            yield self.part(key, open_, held, True)
            open_ = None
        if open_:
            self.session.update(open_)
            self.held.put(held)
            self.rest_until(due, _ms(open_[1] + self.gap))
        else:
            if stored is not None:
                self.held.clear()
                self.session.clear()
            self.rest_until(due)

    def part(self, key: Any, open_: tuple, held: list[tuple], last: bool) -> Row:
        start, end, number = open_
        return self.row(*key, _time(start), _time(end), number, last, len(held), [e[2] for e in held], sorted({e[3] for e in held if e[3] is not None}))


class _Cooldown(_Waiting):
    """Lets an event of a key through if the last one let through is at least the cooldown ago."""

    def __init__(self, names: Sequence[str], cooldown_us: int) -> None:
        self.row, self.cooldown = Row(*names), cooldown_us

    def begin(self) -> None:
        self.last = self.handle.getValueState("last", T.StructType([T.StructField("us", T.LongType())]))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        stored = self.last.get()
        last = before = stored[0] if stored is not None else None
        done, due = self.passed(watermark)
        for event in done:
            if last is None or (event[0] >= last + self.cooldown and event[0] != last):
                last = event[0]
                yield self.row(*key, _time(last))
        if last is not None and last + self.cooldown <= watermark:
            # nothing that is still to come can be held back any more
            if before is not None:
                self.last.clear()
            self.rest_until(due)
        elif last is not None:
            if last != before:
                self.last.update((last,))
            self.rest_until(due, _ms(last + self.cooldown))
        else:
            self.rest_until(due)


def _ms(us: int) -> int:
    """The first millisecond that is not before an instant."""
    return -(-us // 1000)


def _time(us: int) -> dt.datetime:
    return dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=us)


def _keyed(df: DataFrame, keys: Sequence[str], ts: str, event_id: Column, kind: Column, extra: Column) -> DataFrame:
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    text = lambda c: c.cast("string")
    return df.filter(F.col(ts).isNotNull()).select(*keys, ts, us.alias("_us"), text(event_id).alias("_id"), text(kind).alias("_kind"), text(extra).alias("_extra"))


def ordered_sessions(df: DataFrame, keys: Sequence[str], ts: str, event_id: str, kind: str, product: str, gap_minutes: int = 30, size: int = 1000) -> DataFrame:
    """Sessions of a watermarked stream with their events in order.

    A session ends after ``gap_minutes`` of silence, once the watermark is past it. Columns: ``keys``, ``session_start``, ``session_end`` (last
    event so far), ``part_no``, ``is_last``, ``event_count``, ``event_sequence`` (``kind`` by time, then event) and
    ``products_viewed``. A session of more than ``size`` events comes in parts, so its state stays bounded by
    that and by what the watermark has not passed.
    """
    schema = df.schema
    fields = [
        *[schema[k] for k in keys], T.StructField("session_start", T.TimestampNTZType()), T.StructField("session_end", T.TimestampNTZType()), T.StructField("part_no", T.IntegerType()),
        T.StructField("is_last", T.BooleanType()), T.StructField("event_count", T.IntegerType()), T.StructField("event_sequence", T.ArrayType(T.StringType())), T.StructField("products_viewed", T.ArrayType(T.StringType())),
    ]
    rows = _keyed(_watched(df), keys, ts, F.col(event_id), F.col(kind), F.col(product))
    return rows.groupBy(*keys).transformWithState(_Sessions([f.name for f in fields], gap_minutes * 60_000_000, size), T.StructType(fields), "append", "EventTime")


def alerts_with_cooldown(df: DataFrame, keys: Sequence[str], ts: str, cooldown_minutes: int) -> DataFrame:
    """Firings of a watermarked stream: ``keys`` and ``fired_at``, each at least the cooldown after the key's last one."""
    none = F.lit(None)
    fields = [*[df.schema[k] for k in keys], T.StructField("fired_at", T.TimestampNTZType())]
    rows = _keyed(_watched(df), keys, ts, none, none, none)
    return rows.groupBy(*keys).transformWithState(_Cooldown([f.name for f in fields], cooldown_minutes * 60_000_000), T.StructType(fields), "append", "EventTime")
