"""Repair of conversations: the cheapest edits that make roles alternate, by divide and conquer over chunks.

Four states tell what has been put out so far: nothing, a system turn, a user turn last, an assistant turn last. A row is a
4 by 4 table of costs from state to state, and so is a run of rows. Costs from the front and costs to the end meet in the
middle of a conversation; the state to cross there is chosen and both halves are repaired on their own, so no table of
all rows and states is kept. Chunks of a long conversation are the rows of the first such division, so a
conversation of any length is spread over tasks.

Of equally cheap edits the least string of initials is wanted. Strings of equal cost that deal with the same rows
and end with a row's own letter are never beginnings of one another (they would differ by insertions, which cost). So beside a
cost each state needs only its place among the four states' least strings, and these places compose like the costs do.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.llm.chunks import digests, flat, in_order, run_starts, whole_groups
from lodestrata.llm.common import row_slices
from lodestrata.session import cut_lineage

SPACES = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: State after an inserted turn, and insertions that end a conversation well.
INSERTED = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ENDING = np.array([0, 2, 1, 0])
#: More than any conversation costs.
FAR = 1 << 40
#: Kinds of rows: initial s, u, a or another, whether truncated, and rows that must go.
MUST_GO, KINDS = 8, 9
#: Rows that a task divides at a time, and the numbers known of a chunk.
ITEMS = 1 << 15
NUMBERS = ("rows", "blank", "duplicate", "truncated", "illegal", "turns", "first_role", "last_role", "first_turn", "last_turn")


@lru_cache
def edits() -> tuple[np.ndarray, np.ndarray, list]:
    """For each kind of row, state before and state after: cost, place of its string among those from that state, and string."""
    cost, place = np.full((KINDS, 4, 4), FAR, np.int64), np.zeros((KINDS, 4, 4), np.int64)
    strings = [[[""] * 4 for _ in range(4)] for _ in range(KINDS)]
    for kind in range(KINDS):
        for start in range(4):
            ways: dict[int, tuple[int, str]] = {}
            state = start
            for inserts in range(3):
                paid, said = INSERT * inserts, "I" * inserts
                ends = [(state, DELETE, "D")]
                if kind < MUST_GO:
                    extra = TRUNCATED if kind >= 4 else 0
                    kept = {0: SYSTEM if state == NOTHING else None, 1: None if state == USER else USER, 2: ASSISTANT if state == USER else None}.get(kind % 4)
                    ends += [(kept, extra, "K")] if kept is not None else []
                    ends.append((INSERTED[state], extra + REROLE, "R"))
                for end, more, letter in ends:
                    ways[end] = min(ways.get(end, (FAR, "")), (paid + more, said + letter))
                state = INSERTED[state]
            order = sorted(ways, key=lambda end: ways[end][1])
            for end, (paid, said) in ways.items():
                cost[kind, start, end], place[kind, start, end], strings[kind][start][end] = paid, order.index(end), said
    return cost, place, strings


def onward(far: np.ndarray, place: np.ndarray, cost: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Costs and places of the four states after one more row (or chunk) of each conversation."""
    both = (((far[:, :, None] + cost) << 4) + (place[:, :, None] << 2) + order).min(axis=1)
    rest = both & 15
    return np.minimum(both >> 4, FAR), (rest[:, :, None] > rest[:, None, :]).sum(axis=2)


def from_front(cost: np.ndarray, order: np.ndarray, lo: np.ndarray, hi: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Costs and places of the four states after rows lo to hi, from one state before them."""
    far, place = np.full((len(lo), 4), FAR), np.zeros((len(lo), 4), np.int64)
    far[np.arange(len(lo)), start] = 0
    length = hi - lo
    for t in range(int(length.max(initial=0))):
        on = np.flatnonzero(length > t)
        i = lo[on] + t
        far[on], place[on] = onward(far[on], place[on], cost[i], order[i])
    return far, place


def to_end(cost: np.ndarray, lo: np.ndarray, hi: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Costs from each of the four states over rows lo to hi to one state after them."""
    far = np.full((len(lo), 4), FAR)
    far[np.arange(len(lo)), end] = 0
    length = hi - lo
    for t in range(int(length.max(initial=0))):
        on = np.flatnonzero(length > t)
        far[on] = np.minimum((cost[hi[on] - 1 - t] + far[on][:, None, :]).min(axis=2), FAR)
    return far


def crossings(cost: np.ndarray, order: np.ndarray, offsets: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The states before and after each row on the cheapest, least way from ``start`` to ``end`` of each conversation."""
    before, after = np.zeros(len(cost), np.int64), np.zeros(len(cost), np.int64)
    lo, hi = offsets[:-1], offsets[1:]
    some = hi > lo
    lo, hi, start, end = lo[some], hi[some], start[some], end[some]
    while len(lo):
        one = hi - lo == 1
        before[lo[one]], after[lo[one]] = start[one], end[one]
        lo, hi, start, end = lo[~one], hi[~one], start[~one], end[~one]
        middle = (lo + hi) >> 1
        far, place = from_front(cost, order, lo, middle, start)
        cross = (((far + to_end(cost, middle, hi, end)) << 2) + place).argmin(axis=1) if len(lo) else lo
        lo, hi = np.concatenate((lo, middle)), np.concatenate((middle, hi))
        start, end = np.concatenate((start, cross)), np.concatenate((cross, end))
    return before, after


def rows_of(kinds: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kind, costs and places of rows; all but the first of equal rows are deleted at once."""
    cost, order, _ = edits()
    kind = np.where(kinds >= 8, MUST_GO, kinds)
    return kind, np.minimum(cost[kind] + DELETE * (times - 1)[:, None, None], FAR), order[kind]


def starts_legal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether initial b (0 s, 1 u, 2 a, 3 another) may follow initial a."""
    return ((b == 1) & ((a == 0) | (a == 2))) | ((b == 2) & (a == 1))


def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each chunk: its table of costs and places, and its numbers."""
    for whole in batches:
        for batch in row_slices(whole, "_k", ITEMS):
            kinds, offsets = flat(batch.column("_k"))
            kinds, times = kinds.to_numpy(), flat(batch.column("_n"))[0].to_numpy()
            turns = flat(batch.column("_t"))[0]
            known = turns.is_valid().to_numpy(zero_copy_only=False)
            turn = pc.fill_null(turns, 0).to_numpy(zero_copy_only=False)
            lo, hi = offsets[:-1], offsets[1:]
            _, cost, order = rows_of(kinds, times)
            n = len(lo)
            far, place = from_front(cost, order, np.repeat(lo, 4), np.repeat(hi, 4), np.tile(np.arange(4), n))
            role, blank, twice = kinds & 3, kinds & 8 > 0, kinds & 16 > 0
            inner = np.ones(len(kinds), bool)
            inner[lo] = False
            wrong = np.zeros(len(kinds), np.int64)
            wrong[1:] = inner[1:] & ~starts_legal(role[:-1], role[1:])
            new = known.copy()
            new[1:] &= ~(inner[1:] & known[:-1] & (turn[1:] == turn[:-1]))
            sums = lambda x: np.add.reduceat(x.astype(np.int64), lo)
            numbers = {
                "rows": sums(times), "blank": sums(np.where(blank, times, 0)), "duplicate": sums(np.where(blank, 0, times - 1 + twice)),
                "truncated": sums(~blank & ~twice & (kinds & 4 > 0)), "illegal": sums(wrong + times - 1), "turns": sums(new),
                "first_role": role[lo], "last_role": role[hi - 1],
            }
            # turns come in order, NULLs first: the least is the first that is not NULL
            first = np.minimum.reduceat(np.where(known, np.arange(len(kinds)), len(kinds)), lo)
            known_first = first < len(kinds)
            columns = [batch.column("_c"), batch.column("_part"), batch.column("_at")]
            columns += [pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), 16).cast(pa.list_(pa.int64())) for x in (far, place)]
            columns += [pa.array(numbers[k].astype(np.int64)) for k in NUMBERS[:8]]
            columns.append(pa.array(turn[np.minimum(first, len(kinds) - 1)], pa.int64(), mask=~known_first))
            columns.append(pa.array(turn[hi - 1], pa.int64(), mask=~known[hi - 1]))
            yield pa.RecordBatch.from_arrays(columns, ["_c", "_part", "_at", "_cost", "_place", *[f"_{k}" for k in NUMBERS]])


TOTALS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "ending")


def chosen_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """States before and after each chunk; the first chunk of a conversation also has its totals."""
    for batch in whole_groups(batches, "_c"):
        n = batch.num_rows
        lo = run_starts(batch.column("_c"))
        offsets = np.append(lo, n)
        hi = offsets[1:]
        cost, order = (flat(batch.column(c))[0].to_numpy().reshape(-1, 4, 4) for c in ("_cost", "_place"))
        start = np.full(len(lo), NOTHING)
        far, place = from_front(cost, order, lo, hi, start)
        best = ((far + INSERT * ENDING) << 2) + place
        end = best.argmin(axis=1)
        before, after = crossings(cost, order, offsets, start, end)
        of = {k: batch.column(f"_{k}").to_numpy(zero_copy_only=False) for k in NUMBERS[:8]}
        sums = lambda x: np.add.reduceat(x, lo)
        inner = np.ones(n, bool)
        inner[lo] = False
        first, last = batch.column("_first_turn"), batch.column("_last_turn")
        has = first.is_valid().to_numpy(zero_copy_only=False)
        at, to = (pc.fill_null(x, 0).to_numpy(zero_copy_only=False) for x in (first, last))
        # a turn that ends a chunk and begins the next is one turn
        joined, wrong = np.zeros(n, np.int64), np.zeros(n, np.int64)
        joined[1:] = inner[1:] & has[1:] & has[:-1] & (at[1:] == to[:-1])
        wrong[1:] = inner[1:] & ~starts_legal(of["last_role"][:-1], of["first_role"][1:])
        begin = np.minimum.reduceat(np.where(has, np.arange(n), n), lo)
        some = begin < n
        span = np.where(some, to[hi - 1] - at[np.minimum(begin, n - 1)] + 1 - sums(of["turns"] - joined), 0)
        totals = {
            "gaps": span, "blank": sums(of["blank"]), "duplicate": sums(of["duplicate"]), "truncated": sums(of["truncated"]),
            "illegal": sums(of["illegal"] + wrong), "cost": best[np.arange(len(lo)), end] >> 2, "ending": ENDING[end],
        }
        columns = [batch.column("_c"), batch.column("_part"), batch.column("_at"), pa.array(before), pa.array(after)]
        for k in TOTALS:
            spread = np.zeros(n, np.int64)
            spread[lo] = totals[k]
            columns.append(pa.array(spread, mask=inner))
        yield pa.RecordBatch.from_arrays(columns, ["_c", "_part", "_at", "_before", "_after", *[f"_{k}" for k in TOTALS]])


def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of each chunk as a string of initials, and its rows that stay."""
    _, _, strings = edits()
    for whole in batches:
        for batch in row_slices(whole, "_k", ITEMS):
            kinds, offsets = flat(batch.column("_k"))
            times = flat(batch.column("_n"))[0].to_numpy()
            kind, cost, order = rows_of(kinds.to_numpy(), times)
            ends = [batch.column(c).to_numpy() for c in ("_before", "_after")]
            before, after = crossings(cost, order, offsets, *ends)
            said = [strings[k][b][a] for k, b, a in zip(kind.tolist(), before.tolist(), after.tolist())]
            more = times - 1
            letters = [s + "D" * m if m else s for s, m in zip(said, more.tolist())]
            audits = ["".join(letters[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            stay = np.array([not s.endswith("D") for s in said], bool)
            spots = np.flatnonzero(stay)
            inserted, role = [], []
            for i in spots.tolist():
                state, lines = int(before[i]), []
                for _ in said[i][:-1]:
                    state = INSERTED[state]
                    lines.append(ROLES[state])
                inserted.append("".join(f"{r}:\n" for r in lines))
                role.append(ROLES[int(after[i])] if said[i][-1] == "R" else None)
            chunk = np.searchsorted(offsets, spots, side="right") - 1
            item = pa.array(spots)
            kept = pa.StructArray.from_arrays(
                [flat(batch.column("_t"))[0].take(item), flat(batch.column("_d"))[0].take(item), pa.array((spots - offsets[chunk]).astype(np.int32)), pa.array(inserted, pa.string()), pa.array(role, pa.string())],
                ["t", "d", "i", "inserted", "role"],
            )
            counts = np.zeros(len(audits) + 1, np.int32)
            np.cumsum(np.bincount(chunk, minlength=len(audits)), out=counts[1:])
            columns = [batch.column(c) for c in ("_c", "_part", "_at", *[f"_{k}" for k in TOTALS])]
            columns += [pa.array(audits, pa.string()), pa.ListArray.from_arrays(pa.array(counts), kept)]
            yield pa.RecordBatch.from_arrays(columns, ["_c", "_part", "_at", *[f"_{k}" for k in TOTALS], "_audit", "_kept"])


def crc_key(key: Column, turn: Column) -> Column:
    told = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    return F.crc32(F.concat(told(key), F.lit(":"), told(turn)).cast("binary"))


def damage(df: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """The four columns with one row in twenty each dropped, emptied, without its ends of sentences, repeated or said by the user.

    Which, tells the CRC of ``key:turn``. NULLs count as one space, but an absent turn stays absent.
    """
    told = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    how = crc_key(F.col(f"`{key}`"), F.col(f"`{turn}`")) % 20
    said = F.when(how == 1, "").when(how == 2, F.translate(told(text), ".!?", "")).otherwise(told(text))
    rows = df.select(F.col(f"`{key}`").alias(key), F.col(f"`{turn}`").alias(turn), F.when(how == 4, "user").otherwise(told(role)).alias(role), said.alias(text), how.alias("_how"))
    return rows.filter("_how <> 0").withColumn("_copy", F.explode(F.when(F.col("_how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("_how", "_copy")


def repair(df: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """One row a conversation with faults, the cheapest edits and the SHA-256 of the repaired conversation.

    Rows come by turn, those without one first; rows of one turn come by the SHA-256 of role and text. Columns: ``key``, ``gaps`` (numbers absent
    between the least and the largest turn), ``blank``, ``duplicate``, ``truncated`` (the first of these
    that a row has), ``illegal`` (neighbours whose roles' initials are not su, ua or au), ``cost``, ``audit`` (initials of Keep, Rerole,
    Delete, Insert) and ``repaired_sha256`` of the lines ``role:text``. Roles then alternate as ``(s?(ua)+)?``.

    NULL role or text counts as one space, an absent key is a key of its own, an empty role has no legal initial. Repeated rows are
    duplicates of the first. Other columns are ignored, whatever their names. No rows give no conversations. A
    text of any length is moved once, for the digest, which reads a conversation's texts in order in one task and keeps none.
    """
    told = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    rows = df.select(F.col(f"`{key}`").alias("_c"), F.col(f"`{turn}`").cast("long").alias("_t"), told(role).alias("_role"), told(text).alias("_text"))
    core = F.rtrim("_text", F.lit(SPACES))
    initial = F.substring("_role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    kind = kind + F.when(F.substring(core, -1, 1).isin(".", "!", "?"), 0).otherwise(4) + F.when(F.length(core) == 0, 8).otherwise(0)
    rows = rows.withColumns({"_d": F.unhex(F.sha2(F.concat(F.length("_role").cast("string"), F.lit(":"), "_role", "_text"), 256)), "_k": kind})
    slim = rows.groupBy("_c", "_t", "_d", "_k").agg(F.count("*").alias("_n"))
    firsts = slim.groupBy(F.col("_c").alias("_fc"), F.col("_d").alias("_fd")).agg(
        F.count("*").alias("_times"), F.min(F.struct(F.col("_t").isNotNull().alias("a"), F.col("_t").alias("t"))).alias("_first")
    ).filter("_times > 1")
    marked = slim.join(firsts, F.col("_c").eqNullSafe(F.col("_fc")) & (F.col("_d") == F.col("_fd")), "left")
    later = F.col("_times").isNotNull() & ~F.col("_t").eqNullSafe(F.col("_first.t"))
    marked = marked.select("_c", "_t", "_d", (F.col("_k") + F.when(later & (F.col("_k") < 8), 16).otherwise(0)).alias("_k"), "_n")
    chunks = cut_lineage(in_order(marked, "_c", [F.col("_t").asc_nulls_first(), F.col("_d").asc()], ["_t", "_d", "_k", "_n"]))

    name = rows.schema["_c"].dataType
    place = [T.StructField("_c", name), T.StructField("_part", T.IntegerType()), T.StructField("_at", T.LongType())]
    longs = lambda names: [T.StructField(f"_{k}", T.LongType()) for k in names]
    tables = [T.StructField(c, T.ArrayType(T.LongType())) for c in ("_cost", "_place")]
    known = chunks.select("_c", "_part", "_at", "_t", "_k", "_n").mapInArrow(summary, T.StructType([*place, *tables, *longs(NUMBERS)]))
    ends = known.repartition("_c").sortWithinPartitions(F.col("_c").asc_nulls_first(), "_part", "_at")
    ends = ends.mapInArrow(chosen_ends, T.StructType([*place, *longs(("before", "after")), *longs(TOTALS)])).drop("_c")
    stays = "array<struct<t: long, d: binary, i: int, inserted: string, role: string>>"
    made = T.StructType([*place, *longs(TOTALS), T.StructField("_audit", T.StringType()), T.StructField("_kept", T._parse_datatype_string(stays))])
    settled = cut_lineage(chunks.join(ends, ["_part", "_at"]).select("_c", "_part", "_at", "_t", "_d", "_k", "_n", "_before", "_after", *[f"_{k}" for k in TOTALS]).mapInArrow(repaired, made))

    kept = settled.select(F.col("_c").alias("_kc"), "_part", "_at", F.explode("_kept").alias("_s")).select("_kc", "_part", "_at", "_s.*")
    texts = rows.join(kept, F.col("_c").eqNullSafe(F.col("_kc")) & F.col("_t").eqNullSafe(F.col("t")) & (F.col("_d") == F.col("d")))
    lines = texts.select("_c", "_part", "_at", "i", F.concat("inserted", F.coalesce("role", "_role"), F.lit(":"), "_text").alias("_line"))
    closing = F.when(F.col("_ending") == 1, "assistant:").otherwise("user:\nassistant:")
    last = settled.filter("_ending > 0").select("_c", F.lit(2**31 - 1).alias("_part"), F.lit(0).cast("long").alias("_at"), F.lit(0).alias("i"), closing.alias("_line"))
    hashes = digests(lines.unionAll(last), ["_c"], ["_part", "_at", "i"], "_line", "_sha", "\n")

    every = settled.drop("_kept").unionByName(hashes, allowMissingColumns=True)
    strings = F.filter(F.array_sort(F.collect_list(F.struct("_part", "_at", "_audit"))), lambda x: x["_audit"].isNotNull())
    parts = every.groupBy("_c").agg(*[F.max(f"_{k}").alias(f"_{k}") for k in TOTALS], F.concat_ws("", F.transform(strings, lambda x: x["_audit"])).alias("_audit"), F.max("_sha").alias("_sha"))
    number = lambda k: F.coalesce(f"_{k}", F.lit(0).cast("long")).alias(k)
    audit = F.concat("_audit", F.repeat(F.lit("I"), F.coalesce("_ending", F.lit(0)).cast("int")))
    return parts.select(F.col("_c").alias(key), *[number(k) for k in TOTALS[:6]], audit.alias("audit"), F.coalesce("_sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def with_all_keys(fixed: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """``fixed`` and, for keys of ``df`` of which no row was left to repair, a conversation without rows."""
    absent = df.select(F.col(f"`{key}`").alias("_c")).distinct().join(fixed, F.col("_c").eqNullSafe(F.col(key)), "left")
    zeros = [F.coalesce(k, F.lit(0).cast("long")).alias(k) for k in TOTALS[:6]]
    return absent.select(F.col("_c").alias(key), *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
