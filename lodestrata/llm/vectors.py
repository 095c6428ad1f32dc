"""Nearly equal vectors, compared tile by tile along their principal components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.llm.components import components
from lodestrata.session import cut_lineage

#: Vectors of one side of a tile, and vectors to which the components are fitted.
TILE, FITTED = 1024, 4096
#: Leading components after which pairs are dropped if they can't reach the threshold any more.
STOPS = (8, 16, 32)
#: Slack for rounding: pairs this close to the threshold are decided on the vectors as given.
SLACK = 1e-9


def usable(vector: Column) -> Column:
    """A vector with a length, all finite."""
    size = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & (size > 0) & (size < F.lit(float("inf"))), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def principal_axes(vectors: np.ndarray) -> np.ndarray:
    """Orthonormal axes as columns, those along which the vectors vary most first."""
    values, axes = np.linalg.eigh(np.cov(unit(vectors), rowvar=False, bias=True).reshape(vectors.shape[1], vectors.shape[1]))
    return axes[:, np.argsort(-values, kind="stable")]


def linked_pairs(a: np.ndarray, b: np.ndarray, given_a: np.ndarray, given_b: np.ndarray, least: float, inner: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows with cosine ``least`` or more; with ``inner`` only those with the first below the second.

    ``a`` and ``b`` are unit vectors along the principal axes. Products add up axis by axis, the
    leading ones first. What is still to come is at most the product of the two remaining lengths, so a pair
    is dropped as soon as that no longer reaches the threshold.
    """
    stops = [s for s in STOPS if s < a.shape[1]] + [a.shape[1]]
    rest = lambda x, s: np.sqrt((x[:, s:] * x[:, s:]).sum(axis=1))
    first = stops[0]
    product = a[:, :first] @ b[:, :first].T
    i, j = np.nonzero(product + np.outer(rest(a, first), rest(b, first)) >= least - SLACK)
    if inner:
        i, j = i[i < j], j[i < j]
    total = product[i, j]
    for low, high in zip(stops, stops[1:]):
        for at in range(0, len(i), 1 << 16):
            part = slice(at, at + (1 << 16))
            total[part] += (a[i[part], low:high] * b[j[part], low:high]).sum(axis=1)
        stays = total + rest(a, high)[i] * rest(b, high)[j] >= least - SLACK
        i, j, total = i[stays], j[stays], total[stays]
    near = np.flatnonzero(np.abs(total - least) <= SLACK)
    if len(near):
        x, y = given_a[i[near]].astype(np.float64), given_b[j[near]].astype(np.float64)
        total[near] = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
    return i[total >= least], j[total >= least]


def smallest_reachable(count: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``count`` nodes the smallest one that links lead to."""
    label = np.arange(count)
    while True:
        low = label.copy()
        np.minimum.at(low, i, label[j])
        np.minimum.at(low, j, label[i])
        low = low[low]
        if np.array_equal(low, label):
            return label
        label = low


def tiles(vectors: DataFrame, axes: np.ndarray, least: float) -> DataFrame:
    """Rows dealt to tiles: ``_tile`` (of a group), ``_side``, and the vector.

    Vectors that are linked differ by at most sqrt(2 - 2 * least) along any axis. A grid of that width on the first two
    axes leaves each cell to be compared with itself and its neighbours; each neighbourhood is visited once.
    A cell of any size is cut into blocks of about ``TILE`` vectors, and each pair of blocks is a tile.
    """
    width = float(np.sqrt(max(0.0, 2 - 2 * least)) + SLACK)
    sent = vectors.sparkSession.sparkContext.broadcast(axes[:, :2])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.zeros((batch.num_rows, 2), np.int64)
            for k, v in enumerate(batch.column("_vector").to_pylist()):
                if len(v) == len(sent.value):
                    rows[k, : sent.value.shape[1]] = np.floor(unit(np.array([v]))[0] @ sent.value / width)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows[:, 0]), pa.array(rows[:, 1])], [*batch.schema.names, "_x", "_y"])

    schema = T.StructType([*vectors.schema.fields, T.StructField("_x", T.LongType()), T.StructField("_y", T.LongType())])
    placed = cut_lineage(vectors.mapInArrow(place, schema))
    cell = ["_group", "_dims", "_x", "_y"]
    shift = F.array(*[F.struct(F.lit(x).alias("dx"), F.lit(y).alias("dy")) for x, y in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))])
    sizes = placed.groupBy(*cell).agg(F.count("*").alias("_n"))
    goes = sizes.select(*cell, "_n", F.explode(shift).alias("_s")).select(
        "_group", "_dims", (F.col("_x") - F.col("_s.dx")).alias("_x"), (F.col("_y") - F.col("_s.dy")).alias("_y"),
        F.when((F.col("_s.dx") == 0) & (F.col("_s.dy") == 0), F.col("_n")).otherwise(0).alias("_own"),
        F.when((F.col("_s.dx") == 0) & (F.col("_s.dy") == 0), 0).otherwise(F.col("_n")).alias("_other"),
    )
    blocks = lambda c: F.ceil(F.sum(c) / TILE).cast("int")
    cells = goes.groupBy(*cell).agg(blocks("_own").alias("_homes"), blocks("_other").alias("_guests")).filter("_homes > 0")
    copies = placed.withColumn("_s", F.explode(shift)).withColumns(
        {"_x": F.col("_x") - F.col("_s.dx"), "_y": F.col("_y") - F.col("_s.dy"), "_home": (F.col("_s.dx") == 0) & (F.col("_s.dy") == 0)}
    )
    known = copies.join(cells, cell).withColumn("_block", F.pmod(F.xxhash64("_vec"), F.when(F.col("_home"), F.col("_homes")).otherwise(F.col("_guests"))).cast("int"))
    every = lambda n: F.sequence(F.lit(0), n - 1)
    block = F.col("_block")
    tile = lambda kind, a, b, side: F.struct(F.lit(kind).alias("kind"), a.alias("a"), b.alias("b"), side.alias("side"))
    within = F.transform(every(F.col("_homes")), lambda o: tile(0, F.least(block, o), F.greatest(block, o), F.when(block <= o, 0).otherwise(1)))
    meets = F.when(F.col("_guests") > 0, F.transform(every(F.col("_guests")), lambda g: tile(1, block, g, F.lit(0))))
    visits = F.transform(every(F.col("_homes")), lambda h: tile(1, h, block, F.lit(1)))
    home = F.concat(within, F.coalesce(meets, F.filter(within, lambda _: F.lit(False))))
    dealt = known.withColumn("_t", F.explode(F.when(F.col("_home"), home).otherwise(visits)))
    return dealt.select(F.xxhash64(*cell, "_t.kind", "_t.a", "_t.b").alias("_tile"), F.col("_t.side").alias("_side"), "_vec", "_times", "_vector", *cell, "_t.kind", "_t.a", "_t.b")


def tile_links(dealt: DataFrame, axes: np.ndarray, least: float) -> DataFrame:
    """For each vector of a tile with links there: ``_vec``, ``_links`` (of that tile) and ``_root``, the smallest vector reached in it."""
    sent = dealt.sparkSession.sparkContext.broadcast(axes)
    name = ["_group", "_dims", "_x", "_y", "kind", "a", "b"]
    ordered = dealt.repartition("_tile").sortWithinPartitions("_tile", *name, "_side", "_vec")

    def work(rows: list[tuple]) -> pa.RecordBatch:
        side, vec, times = (np.array([r[k] for r in rows], np.int64) for k in (0, 1, 2))
        given = np.array([r[3] for r in rows])
        ready = unit(given)
        if given.shape[1] == len(sent.value):
            ready = ready @ sent.value
        cut = int(np.searchsorted(side, 1))
        if rows[0][4] == 0 and cut == len(rows):  # a block with itself
            i, j = linked_pairs(ready, ready, given, given, least, True)
        else:
            i, j = linked_pairs(ready[:cut], ready[cut:], given[:cut], given[cut:], least, False)
            j = j + cut
        links = np.bincount(i, times[j], len(rows)) + np.bincount(j, times[i], len(rows))
        order = np.argsort(vec, kind="stable")
        back = np.empty(len(rows), np.int64)
        back[order] = np.arange(len(rows))
        root = vec[order][smallest_reachable(len(rows), back[i], back[j])][back]
        some = links > 0
        return pa.RecordBatch.from_arrays([pa.array(vec[some]), pa.array(links[some].astype(np.int64)), pa.array(root[some])], ["_vec", "_links", "_root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        current = None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in name)))
            for key, row in zip(keys, zip(*(batch.column(c).to_pylist() for c in ("_side", "_vec", "_times", "_vector", "kind")))):
                if key != current and held:
                    yield work(held)
                    held = []
                current = key
                held.append(row)
        if held:
            yield work(held)

    return ordered.mapInArrow(run, "_vec long, _links long, _root long")


def near_vectors(df: DataFrame, key: str, vector: str, group: str, least: float = 0.98) -> DataFrame:
    """One row per row of ``df``: ``key`` as ``_vec``, ``n_links``, ``component_id`` and ``kept``.

    Vectors of one group (equal, not NULL) and of one length are linked at a cosine of ``least`` or more. ``n_links`` counts
    other vectors linked directly, ``component_id`` is the smallest key reached over links, itself included,
    ``kept`` tells that it is the own one. Vectors that are NULL, empty or zero or hold NULL or non-finite items, and rows with a
    NULL key or group, have no links. Equal vectors of a group are compared once and count each; repeated
    rows are vectors of their own, linked like equal vectors.
    """
    plain = df.select(F.col(f"`{key}`").cast("long").alias("_vec"), F.col(f"`{group}`").alias("_group"), F.col(f"`{vector}`").alias("_vector"))
    good = plain.filter(F.col("_vec").isNotNull() & F.col("_group").isNotNull() & usable(F.col("_vector")))
    same = ["_group", "_vector"]
    once = cut_lineage(good.groupBy(*same).agg(F.min("_vec").alias("_vec"), F.count("*").alias("_times")).withColumn("_dims", F.size("_vector")))
    sample = once.orderBy(F.xxhash64("_vec"), "_vec").limit(FITTED).select("_vector").toArrow().column("_vector").to_pylist()
    sizes = sorted(len(v) for v in sample)
    common = sizes[len(sizes) // 2] if sizes else 1
    fitted = np.array([v for v in sample if len(v) == common] or [[1.0]])
    axes = principal_axes(fitted)
    found = cut_lineage(tile_links(tiles(once, axes, least), axes, least))
    label = components(found, "_vec", "_root")
    counts = found.groupBy("_vec").agg(F.sum("_links").alias("_links"))
    each = once.join(counts, "_vec", "left").join(label, F.col("_vec") == F.col("_node"), "left")
    each = each.select(*same, (F.coalesce("_links", F.lit(0)) + F.col("_times") - 1).alias("_n"), F.coalesce("_component", "_vec").alias("_c"))
    able = F.col("_vec").isNotNull() & F.col("_group").isNotNull() & usable(F.col("_vector"))
    keyed = plain.select("_vec", F.when(able, F.col("_group")).alias("_group"), F.when(able, F.col("_vector")).alias("_vector"))
    out = keyed.join(each, same, "left").select("_vec", F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("_c", "_vec").alias("component_id"))
    return out.withColumn("kept", F.col("_vec").eqNullSafe(F.col("component_id")))
