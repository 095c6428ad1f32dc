"""Largest inner products, by three phases of local lists, a common threshold and exact scores.

A score is a sum over lists: each list holds the products of one slice of the components. First the best few of every list
are gathered and scored, which gives each query a score that its final k-th can't be below. That cutoff is sent out; whatever
reaches it has at least one list with the cutoff divided by the number of lists, so only such entries are collected,
those whose known lists and the bound of the others can't reach it are dropped, and the rest are scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.llm.chunks import flat
from lodestrata.session import cut_lineage

#: Slices of a vector, bytes of the queries that a task holds, their number at most, and rows of a tile at least.
LISTS, QUERY_BYTES, QUERIES, ROWS = 4, 16 << 20, 1 << 15, 1 << 12
#: Queries and rows that are multiplied at a time.
ACROSS, DOWN = 1024, 1024
#: Sums of whole numbers below this are exact as doubles.
EXACT = float(1 << 53)
LEAST = -(1 << 63)


def usable(vector: Column) -> Column:
    """Vectors without NULL or non-finite components."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def whole_numbers(column: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * component) of all vectors one after the other, and offsets."""
    items, offsets = flat(column)
    return np.floor(scale * items.to_numpy(zero_copy_only=False).astype(np.float64)), offsets


def products(queries: np.ndarray, rows: np.ndarray, lists: int) -> list[np.ndarray]:
    """Inner products of whole numbers by slice, exactly; where doubles don't hold them as one slice, which stops at the ends of a long."""
    wide = queries.shape[1]
    if float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, wide) < EXACT:
        cuts = np.linspace(0, wide, lists + 1).astype(int)
        return [(queries[:, a:b] @ rows[:, a:b].T).astype(np.int64) for a, b in zip(cuts, cuts[1:])]
    a, b = (np.array([[int(x) for x in v] for v in m], object).reshape(m.shape) for m in (queries, rows))
    return [np.array([[min(max(v, LEAST), -LEAST - 1) for v in row] for row in (a @ b.T).tolist()], np.int64).reshape(len(a), len(b))]


class Best:
    """The k best entries of each query seen so far: larger scores first, then smaller keys."""

    def __init__(self, count: int, k: int) -> None:
        self.k, self.query, self.score, self.key = k, *(np.zeros(0, np.int64) for _ in range(3))
        self.floor = np.full(count, LEAST)

    def add(self, query: np.ndarray, score: np.ndarray, key: np.ndarray) -> None:
        if not len(query):
            return
        query, score, key = (np.concatenate(x) for x in ((self.query, query), (self.score, score), (self.key, key)))
        order = np.lexsort((key, ~score, query))
        query, score, key = query[order], score[order], key[order]
        first = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1])))
        rank = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
        top = rank < self.k
        self.query, self.score, self.key = query[top], score[top], key[top]
        full = rank == self.k - 1
        self.floor[query[full]] = score[full]


class Tile:
    """The queries of a tile, and what its rows have given them so far."""

    def __init__(self, k: int, lists: int, scale: float) -> None:
        self.k, self.lists, self.scale = k, lists, scale
        self.number, self.key, self.cutoff, self.vectors = ([] for _ in range(4))

    def queries(self, batch: pa.RecordBatch) -> None:
        values, offsets = whole_numbers(batch.column("_vector"), self.scale)
        self.vectors += np.split(values, offsets[1:-1])
        for name, held in (("_query", self.number), ("_key", self.key), ("_cutoff", self.cutoff)):
            held.append(batch.column(name).to_numpy(zero_copy_only=False))

    def begin(self) -> None:
        none = np.zeros(0, np.int64)
        self.number, self.key, self.cutoff = (np.concatenate([none, *x]).astype(np.int64) for x in (self.number, self.key, self.cutoff))
        sizes = np.array([len(v) for v in self.vectors], np.int64)
        self.groups = [(d, np.flatnonzero(sizes == d)) for d in np.unique(sizes)]
        self.arrays = {int(d): np.array([self.vectors[i] for i in at]).reshape(len(at), d) for d, at in self.groups}
        self.vectors = []
        self.best = Best(len(self.key), self.k)
        #: for each list the local score that its k best entries reach
        self.local = np.full((self.lists, len(self.key)), LEAST)

    def rows(self, batch: pa.RecordBatch, phase: int) -> None:
        values, offsets = whole_numbers(batch.column("_vector"), self.scale)
        sizes, keys = np.diff(offsets), batch.column("_key").to_numpy()
        for d, at in self.groups:
            spots = np.flatnonzero(sizes == d)
            for lo in range(0, len(spots), DOWN):
                part = spots[lo : lo + DOWN]
                rows = values[offsets[part][:, None] + np.arange(d)] if d else np.zeros((len(part), 0))
                for q in range(0, len(at), ACROSS):
                    self.meet(at[q : q + ACROSS], self.arrays[int(d)][q : q + ACROSS], keys[part], rows, phase)

    def meet(self, at: np.ndarray, queries: np.ndarray, keys: np.ndarray, rows: np.ndarray, phase: int) -> None:
        lists = products(queries, rows, self.lists)
        other = self.key[at][:, None] != keys
        if phase == 1:
            wanted = np.zeros(other.shape, bool)
            for j, local in enumerate(lists):
                if len(keys) > self.k:
                    low = np.partition(np.where(other, local, LEAST), -self.k, axis=1)[:, -self.k]
                    self.local[j, at] = np.maximum(self.local[j, at], low)
                i, r = np.nonzero((local >= self.local[j, at][:, None]) & other)
                i, r = best_of(i, r, local[i, r], self.k)
                wanted[i, r] = True
        else:
            cutoff = self.cutoff[at][:, None]
            # whole numbers: a sum reaches the cutoff only if one of the lists reaches its share, rounded up
            share = (cutoff + len(lists) - 1) // len(lists)
            known, missing = np.zeros(other.shape, np.int64), np.full(other.shape, len(lists))
            for local in lists:
                has = local >= share
                known += np.where(has, local, 0)
                missing -= has
            # what a list does not hold is below the share there
            wanted = other & ((cutoff == LEAST) | ((missing < len(lists)) & (known + missing * (share - 1) >= cutoff)))
        i, r = np.nonzero(wanted)
        score = sum(local[i, r] for local in lists)
        stays = score >= np.maximum(self.best.floor, self.cutoff)[at[i]]
        self.best.add(at[i[stays]], score[stays], keys[r[stays]])

    def found(self) -> pa.RecordBatch:
        b = self.best
        return pa.RecordBatch.from_arrays([pa.array(self.number[b.query]), pa.array(self.key[b.query]), pa.array(b.key), pa.array(b.score)], ["_query", "_own", "_other", "_score"])


def best_of(i: np.ndarray, r: np.ndarray, local: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k entries of each query with the largest local scores."""
    order = np.lexsort((r, ~local, i))
    i, r = i[order], r[order]
    first = np.flatnonzero(np.concatenate(([True], i[1:] != i[:-1]))) if len(i) else np.zeros(0, int)
    top = np.arange(len(i)) - np.repeat(first, np.diff(np.append(first, len(i)))) < k
    return i[top], r[top]


def tiles(rows: DataFrame, queries: DataFrame, down: int, across: int, phase: int, k: int, lists: int, scale: float) -> DataFrame:
    """``_query``, ``_own``, ``_other``, ``_score``: the k best entries of each query among the rows of each tile.

    Queries are dealt to ``across`` groups, rows to ``down``; each pair of groups is a tile. A task holds the queries of a
    tile and lets its rows pass by.
    """
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    tile = (F.col("_g") * F.lit(down) + F.col("_h")).alias("_tile")
    asks = queries.withColumn("_g", F.pmod(F.col("_query"), F.lit(across))).withColumn("_h", every(down))
    asks = asks.select(tile, F.lit(0).alias("_side"), "_query", "_key", "_cutoff", "_vector")
    # rows of one partition go round the groups: equal keys or vectors don't meet in one group
    answers = rows.withColumn("_h", F.pmod(F.monotonically_increasing_id(), F.lit(down))).withColumn("_g", every(across))
    none = F.lit(None).cast("long")
    answers = answers.select(tile, F.lit(1).alias("_side"), none.alias("_query"), "_key", none.alias("_cutoff"), "_vector")
    dealt = asks.unionAll(answers).repartition("_tile").sortWithinPartitions("_tile", "_side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, open_ = None, None, False
        for batch in batches:
            spot = 0
            mark = pc.add(pc.multiply(batch.column("_tile"), 2), batch.column("_side").cast(pa.int64())).to_numpy()
            for end in [*(np.flatnonzero(np.diff(mark)) + 1), batch.num_rows]:
                part, spot = batch.slice(spot, end - spot), end
                if not part.num_rows:
                    continue
                tile, side = divmod(int(mark[end - 1]), 2)
                if tile != current:
                    if open_:
                        yield state.found()
                    current, state, open_ = tile, Tile(k, lists, scale), False
                if side == 0:
                    state.queries(part)
                else:
                    if not open_:
                        state.begin()
                        open_ = True
                    state.rows(part, phase)
        if open_:
            yield state.found()

    return dealt.mapInArrow(run, "_query long, _own long, _other long, _score long")


def best_products(df: DataFrame, key: str, vector: str, is_query: Column, k: int = 5, scale: float = 256.0, lists: int = LISTS) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``key`` and ``score``: the k largest inner products of each query row with other rows.

    Components count as floor(scale * x). ``is_query`` picks the queries among the columns of ``df``. Ties go to the smaller key.
    Rows with a NULL key, and vectors that are NULL or hold NULL or non-finite components, take no part; vectors are compared with those of their own
    length only, empty ones at a score of 0. A row is not compared with rows of its own key; repeated rows are
    rows of their own, as queries and as answers. Scores beyond a long stop at its ends. Other columns are ignored. No queries or no rows give no
    result. ``df`` should be a scan or a stored table, whose rows come in the same order when a task is repeated. Tasks hold at most ``QUERY_BYTES`` of queries; rows pass by, so no group and no vector set is held whole.
    """
    plain = df.select(F.col(f"`{key}`").cast("long").alias("_key"), F.col(f"`{vector}`").alias("_vector"), is_query.alias("_ask"))
    good = plain.filter(F.col("_key").isNotNull() & usable(F.col("_vector")))
    rows = good.select("_key", "_vector")
    asked = cut_lineage(good.filter("_ask").select(F.monotonically_increasing_id().alias("_query"), "_key", "_vector"))
    n_rows, wide = rows.agg(F.count("*"), F.max(F.size("_vector"))).first()
    n_queries = asked.count()
    held = max(1, min(QUERIES, QUERY_BYTES // (8 * max(1, wide or 1))))
    across = max(1, -(-n_queries // held))
    down = max(1, -(-n_rows // max(ROWS, -(-n_queries // across))))
    no_cutoff = asked.withColumn("_cutoff", F.lit(LEAST).cast("long"))
    order = Window.partitionBy("_query").orderBy(F.col("_score").desc(), "_other")
    first = tiles(rows, no_cutoff, down, across, 1, k, lists, scale)
    kth = first.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k).filter(F.col("_rank") == k).select(F.col("_query").alias("_q"), F.col("_score").alias("_cutoff"))
    sent = cut_lineage(asked.join(kth, F.col("_query") == F.col("_q"), "left").select("_query", "_key", "_vector", F.coalesce("_cutoff", F.lit(LEAST)).alias("_cutoff")))
    second = tiles(rows, sent, down, across, 2, k, lists, scale)
    ranked = second.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("_own").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("_other").alias(key), F.col("_score").alias("score"))
