"""Repair, exact search and prefix trie against brute force, with awkward rows."""

import hashlib
import itertools
import random
import re
import zlib
from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestrata.llm import chunks, repair, topk, trie

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
TALK = "conv_id long, turn long, role string, text string, _c string, _d string, cost string, depth string"
BLANK = re.compile("[^\x20\x09-\x0d]")


def talks(seed: int = 3, convs: int = 60) -> list[tuple]:
    r = random.Random(seed)
    said = ["Yes.", "No!", "Why?", "hm", " ", "", None, "ok \n", "So. \t", "　"]
    roles = ["user", "assistant", "system", "tool", "", None, "usher"]
    out = []
    for c in range(convs):
        for t in range(r.randrange(0, 9)):
            role = ("user", "assistant")[t % 2] if r.random() < 0.7 else r.choice(roles)
            text = r.choice(said) if r.random() < 0.5 else f"{r.randrange(50)}."
            out.append((c, r.choice([t, t, t, t, None, 2 * t]), role, text, "x", "y", "z", "w"))
    out += [out[5], out[5], (None, None, None, None, None, None, None, None), (None, 1, "user", "Hi.", "", "", "", "")]
    out += [(500, t, ("user", "assistant")[t % 2], f"{t}.", "", "", "", "") for t in range(40)]
    r.shuffle(out)
    return out


def tie(role: str, text: str) -> str:
    return sha(f"{len(role)}:{role}{text}")


def faults(rows: list[tuple]) -> list[tuple]:
    """Role, text, must go, truncated and which fault of rows in order."""
    seen, out = set(), []
    for _, role, text in rows:
        blank, twice = not BLANK.search(text), (role, text) in seen
        seen.add((role, text))
        cut = not blank and not twice and text.rstrip(" \t\n\x0b\x0c\r")[-1] not in ".!?"
        out.append((role, text, blank or twice, cut, "blank" if blank else "duplicate" if twice else "truncated" if cut else None))
    return out


def every_edit(rows: list[tuple]) -> tuple[int, str, list[str]]:
    """The cheapest, least edits among all sequences with up to two insertions at each place."""
    spots = []
    for role, text, gone, cut, _ in rows:
        ways = [(2, "D", [])]
        if not gone:
            ways += [(5 * cut, "K", [(role[:1] or "?", f"{role}:{text}")])]
            ways += [(1 + 5 * cut, "R", [(x[0], f"{x}:{text}")]) for x in ("user", "assistant")]
        spots.append(ways)
    some = [(5 * len(p), "I" * len(p), [(x[0], f"{x}:") for x in p]) for n in range(3) for p in itertools.product(("user", "assistant"), repeat=n)]
    best = None
    for way in itertools.product(*[x for ways in spots for x in (some, ways)], some):
        if re.fullmatch("(s?(ua)+)?", "".join(i for w in way for i, _ in w[2])):
            found = (sum(w[0] for w in way), "".join(w[1] for w in way), [t for w in way for _, t in w[2]])
            best = found if best is None or found < best else best
    return best


def step_by_step(rows: list[tuple]) -> tuple[int, str, list[str]]:
    """The same by keeping the least edits to each state."""
    goes = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    states = {"": (0, "", [])}

    def inserted(states: dict) -> dict:
        for _ in range(2):
            for s, (cost, audit, lines) in list(states.items()):
                role = "assistant" if s == "u" else "user"
                states[role[0]] = min(states.get(role[0], (10**9,)), (cost + 5, audit + "I", [*lines, f"{role}:"]))
        return states

    for role, text, gone, cut, _ in rows:
        new: dict = {}
        for s, (cost, audit, lines) in inserted(states).items():
            ways = [(s, cost + 2, audit + "D", lines)]
            if not gone:
                ways += [(goes.get((s, role[:1])), cost + 5 * cut, audit + "K", [*lines, f"{role}:{text}"])]
                ways += [(goes.get((s, x[0])), cost + 1 + 5 * cut, audit + "R", [*lines, f"{x}:{text}"]) for x in ("user", "assistant")]
            for to, *way in ways:
                if to is not None:
                    new[to] = min(new.get(to, (10**9,)), tuple(way))
        states = new
    return min(w for s, w in inserted(states).items() if s in ("", "a"))


def expected_repairs(rows: list[tuple], way=step_by_step) -> dict:
    groups: dict = {}
    for c, t, role, text, *_ in rows:
        groups.setdefault(c, []).append((t, " " if role is None else role, " " if text is None else text))
    out = {}
    for c, own in groups.items():
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, tie(x[1], x[2])))
        kinds = faults(own)
        turns = [t for t, *_ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [k[0][:1] for k in kinds]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = way(kinds)
        out[c] = (gaps, *(sum(k[4] == f for k in kinds) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(lines)))
    return out


def test_repairs_are_the_cheapest_and_least(spark):
    rows = talks()
    got = repair.repair(spark.createDataFrame(rows, TALK).repartition(5), "conv_id", "turn", "role", "text")
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == expected_repairs(rows)
    assert got.count() == len({r[0] for r in rows})


def test_short_repairs_against_every_sequence_of_edits(spark):
    r, rows = random.Random(8), []
    for c in range(250):
        rows += [(c, t, r.choice(["user", "assistant", "system", "tool", "user"]), r.choice(["A.", "B.", "C", "D.", " "]), "", "", "", "") for t in range(r.randrange(1, 4))]
    got = repair.repair(spark.createDataFrame(rows, TALK), "conv_id", "turn", "role", "text")
    assert {x[0]: tuple(x)[1:] for x in got.collect()} == expected_repairs(rows, every_edit)


def test_a_conversation_of_many_chunks(spark, monkeypatch):
    r = random.Random(4)
    rows = [(c, t, r.choice(["user", "assistant", "user", "system"]), f"{r.randrange(150)}" + r.choice([".", ""]), "", "", "", "") for c in (1, 2) for t in range(400)]
    monkeypatch.setattr(repair, "in_order", partial(chunks.in_order, size=7))
    got = repair.repair(spark.createDataFrame(rows, TALK).repartition(9), "conv_id", "turn", "role", "text")
    assert {x[0]: tuple(x)[1:] for x in got.collect()} == expected_repairs(rows)


def test_damage_and_conversations_without_rows(spark):
    rows = talks(9)
    df = spark.createDataFrame(rows, TALK)
    expected = []
    for c, t, role, text, *_ in rows:
        how = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if how:
            text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
            expected += [(c, t, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    damaged = repair.damage(df, "conv_id", "turn", "role", "text")
    assert sorted(map(tuple, damaged.collect()), key=repr) == sorted(expected, key=repr)
    left = repair.with_all_keys(repair.repair(damaged.filter("conv_id > 30"), "conv_id", "turn", "role", "text"), df, "conv_id")
    got = {x[0]: tuple(x)[1:] for x in left.collect()}
    assert got.keys() == {x[0] for x in rows} and got[None] == got[3] == (0, 0, 0, 0, 0, 0, "", sha(""))
    assert repair.repair(df.limit(0), "conv_id", "turn", "role", "text").count() == 0


def expected_trie(rows: list[tuple], shared: int) -> list[tuple]:
    groups: dict = {}
    for c, t, role, text, *_ in rows:
        if c is not None:
            groups.setdefault(c, []).append((t is not None, t or 0, tie(role or "", text or ""), (role or "", text or "")))
    turns = {c: [x[3] for x in sorted(own)] for c, own in groups.items()}
    members: dict = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole = tuple(turns.get(c - c % shared, [])[:h] + own[h:])
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append((c, len(whole) == d))
    kids: dict = {}
    for k in members:
        if k:
            kids.setdefault(k[:-1], []).append(k)

    def under(k: tuple) -> tuple[int, int]:
        parts = [under(x) for x in kids.get(k, [])]
        return sum(p[0] for p in parts) or 1, sum(p[1] for p in parts) + (len(members[k]) - 1) * (len(k[-1][1]) if k else 0)

    low = {k: min(c for c, _ in m) for k, m in members.items()}
    return sorted(
        (low[k], len(k), low[k[:-1]] if k else None, len(m), len(kids.get(k, [])), *under(k), sha(",".join(str(c) for c, e in sorted(m) if e))) for k, m in members.items()
    )


@pytest.mark.parametrize("level,together", [(3, 4), (2, 1), (256, 3), (4, 1000)])
def test_trie_in_shards_and_levels(spark, level, together):
    r = random.Random(level)
    rows = talks(6, 25)
    for c in range(100, 160):  # long shared beginnings, copies and one end inside another
        same = [(c, t, "user", f"{c % 4} {t}", "", "", "", "") for t in range(r.choice([6, 8, 9, 12, 12]))]
        rows += same + ([(c, 50, "user", r.choice("ab"), "", "", "", "")] if c % 3 else [])
    df = spark.createDataFrame(rows, TALK)
    got = trie.prefix_trie(df, "conv_id", "turn", "role", "text", shared=20, level=level, together=together)
    assert sorted(map(tuple, got.collect())) == expected_trie(rows, 20)


def test_trie_of_nothing_and_of_copies(spark):
    df = spark.createDataFrame([(c, t, "user", "a", "", "", "", "") for c in range(900) for t in range(2)], TALK)
    got = trie.prefix_trie(df, "conv_id", "turn", "role", "text", together=50)
    assert sorted(map(tuple, got.collect())) == expected_trie([tuple(x) for x in df.collect()], 100)
    assert trie.prefix_trie(df.limit(0), "conv_id", "turn", "role", "text").count() == 0


VECTORS = "vec_id long, embedding array<double>, label int, score string, rank string"


def expected_best(rows: list[tuple], k: int) -> list[tuple]:
    import math

    good = [(x[0], [math.floor(256 * v) for v in x[1]]) for x in rows if x[0] is not None and x[1] is not None and all(v is not None and math.isfinite(v) for v in x[1])]
    out = []
    for q, a in good:
        if q % 50 == 0:
            found = sorted((-min(max(sum(x * y for x, y in zip(a, b)), -(2**63)), 2**63 - 1), v) for v, b in good if v != q and len(a) == len(b))
            out += [(q, n + 1, v, -s) for n, (s, v) in enumerate(found[:k])]
    return sorted(out)


def vectors(seed: int, count: int, wide: int) -> list[tuple]:
    r = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in np.round(r.normal(0, 0.3, wide), 1)], 1, "s", "r") for i in range(count)]
    odd = [(1000, None), (1050, [0.1, None]), (1100, [float("nan")] * wide), (1150, [float("inf")] * wide), (None, rows[0][1]), (1200, [0.0] * wide), (1250, []), (1251, []), (1300, [1.0, 2.0]), (1301, [-3.0, 4.5])]
    return rows + [(*x, 1, "s", "r") for x in odd] + [rows[7], rows[7], (0, rows[0][1], 2, "", "")] + [(2000 + i, rows[50][1], 1, "s", "r") for i in range(40)]


@pytest.mark.parametrize("lists,held", [(4, 1 << 24), (1, 1 << 24), (3, 200)])
def test_best_products(spark, monkeypatch, lists, held):
    monkeypatch.setattr(topk, "QUERY_BYTES", held)
    monkeypatch.setattr(topk, "ROWS", 60)
    rows = vectors(1, 320, 9)
    got = topk.best_products(spark.createDataFrame(rows, VECTORS), "vec_id", "embedding", F.col("vec_id") % 50 == 0, lists=lists)
    assert sorted(map(tuple, got.collect())) == expected_best(rows, 5)


def test_best_products_of_large_and_few_vectors(spark):
    rows = [(0, [1e20, 3.0], 1, "", ""), (50, [1e14, -1e14], 1, "", ""), (51, [-1e14, 1e14], 1, "", ""), (52, [2.0, 1e15 + 0.25], 1, "", "")]
    df = spark.createDataFrame(rows, VECTORS)
    best = lambda d: topk.best_products(d, "vec_id", "embedding", F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, best(df).collect())) == expected_best(rows, 5)
    assert best(df.limit(0)).count() == 0 and best(df.filter("vec_id = 50")).count() == 0


def test_entries_below_every_share_are_not_collected():
    r = np.random.default_rng(2)
    a, b = np.floor(64 * r.normal(size=(20, 16))), np.floor(64 * r.normal(size=(3000, 16)))
    exact = (a @ b.T).astype(np.int64)
    state = topk.Tile(5, 4, 1.0)
    state.key, state.number, state.cutoff = [np.arange(20) - 100], [np.arange(20)], [np.sort(exact, axis=1)[:, -5]]
    state.vectors = list(a)
    state.begin()
    for lo in range(0, 3000, 1000):
        state.meet(np.arange(20), a, np.arange(lo, lo + 1000), b[lo : lo + 1000], 2)
    assert sorted(zip(state.best.query.tolist(), state.best.score.tolist())) == sorted((q, s) for q in range(20) for s in np.sort(exact[q])[-5:].tolist())
