"""Bring all equal windows of all texts together without moving every window.

A window is ``width`` consecutive units (words or bytes) of a text. Its anchor is the gram with
the smallest hash among the grams inside it, the first one of equals. Equal windows have equal
anchors, and neighbouring windows mostly share one, so a text has few anchors (about two in
``width - gram + 2`` units). Anchors are counted over all texts; only the windows of those that
occur again are cut out, as one stretch of text for each run of windows with the same anchor, and
sent to the task of that anchor. No window that occurs twice is lost.

An anchor with very many stretches is cut into blocks of bounded size. A block settles the windows that it
holds earlier itself; of each other window only its hash and place leave it, to be compared with those
of the anchor's other blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lodestrata.llm.common import code_of, codes_along, gram_codes, mix, row_slices, sliding_min, spread, text_arrays, tidy, words_of

#: Names of the columns that hold a row's number, its text's hash and its text.
ID, DIGEST, TEXT = "__number", "__digest", "__text"
#: Bytes of stretches that a task compares together (more where one anchor has more).
TOGETHER_BYTES = 2 << 20
#: Stretches of one anchor that are compared in one block; an anchor with more is cut into blocks.
MANY = 8192
#: The low bits of a listed anchor tell its blocks, as a power of two; the anchor itself has zeros there.
BLOCKS_BITS = 63
#: Bytes of text searched for anchors at a time: the arrays for them stay in a core's cache.
PASS_BYTES = 1 << 18
#: Stretches that a task remembers to leave out the bytes of their copies.
SEEN = 100_000


class Windows:
    """Kind of windows: ``words`` or single bytes, their width and the length of their grams."""

    def __init__(self, words: bool, width: int, gram: int):
        self.words, self.width, self.gram = words, width, gram

    def runs(self, data: np.ndarray, offsets: np.ndarray) -> Runs:
        """Runs of windows with the same anchor, in the order of the text."""
        if self.words:
            starts, ends, row = words_of(data, offsets)
            before = np.searchsorted(starts, offsets[:-1])
        else:
            starts = ends = None
            row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
            before = offsets[:-1]
        count, none = len(row) - self.width + 1, np.zeros(0, np.int64)
        if count <= 0:
            return Runs(none, none, none, none, none, none, none)
        if self.words:
            grams = gram_codes(code_of(data, starts, ends), self.gram)
        else:
            grams = codes_along(data, self.gram)
        low = np.uint64(0xFFFFFFFF)
        at = sliding_min((grams & ~low) | np.arange(len(grams), dtype=np.uint64), self.width - self.gram + 1).astype(np.uint32)
        valid = row[:count] == row[self.width - 1 :]
        moved = (at[1:] != at[:-1]) | (valid[1:] != valid[:-1])
        first = np.flatnonzero(valid & np.concatenate(([True], moved)))
        last = np.flatnonzero(valid & np.concatenate((moved, [True])))
        text, until = row[first].astype(np.int64), last + self.width - 1
        lo, hi = (starts[first], ends[until]) if self.words else (first, until + 1)
        anchor = grams[at[first]].view(np.int64) & ~BLOCKS_BITS
        return Runs(text, first - before[text], until + 1 - first, anchor, lo, hi, before)

    def codes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash of every window of the texts, its text, and its first unit in the text."""
        if self.words:
            starts, ends, row = words_of(data, offsets)
            code = gram_codes(code_of(data, starts, ends), self.width)
        else:
            row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            code = codes_along(data, self.width)
        at = np.flatnonzero(row[: len(code)] == row[self.width - 1 :]) if len(code) else np.zeros(0, np.int64)
        return code[at], row[at], at - np.searchsorted(row, row[at])


@dataclass
class Runs:
    """Of each run: text number, first unit in the text, units, anchor hash, first byte and byte after the last."""

    row: np.ndarray
    at: np.ndarray
    units: np.ndarray
    anchor: np.ndarray
    low: np.ndarray
    high: np.ndarray
    before: np.ndarray

    def pick(self, which: np.ndarray) -> Runs:
        return Runs(self.row[which], self.at[which], self.units[which], self.anchor[which], self.low[which], self.high[which], self.before)


def keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    """The rows with their number and the hash of their text; where that hash is NULL the row is not compared.

    Both joins of a query take these rows by number with all their columns, so Spark shuffles the texts
    once and reads that exchange twice. A row without number is dealt by its text. The other columns go along as one.
    """
    number, digest = F.col(f"`{key}`").cast("long"), F.xxhash64(F.col(f"`{text}`"))
    known = number.isNotNull() & F.col(f"`{text}`").isNotNull()
    return df.withColumns({ID: F.coalesce(number, digest), DIGEST: F.when(known, digest)})


def repeated_anchors(df: DataFrame, key: str, text: str, windows: Windows, other_documents: bool) -> DataFrame:
    """For each document number, the anchors of its texts that occur again: in another document, or anywhere.

    An anchor that more than ``MANY`` stretches share comes with the power of two of blocks in its low bits.
    """
    docs = df.select(F.col(f"`{key}`").cast("long").alias(ID), F.col(f"`{text}`").alias(TEXT)).filter(F.col(ID).isNotNull() & F.col(TEXT).isNotNull())
    schema = T.StructType([T.StructField("_anchor", T.LongType()), T.StructField(ID, T.LongType()), T.StructField("_times", T.LongType())])

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, TEXT, PASS_BYTES):
                runs = windows.runs(*text_arrays(part.column(TEXT)))
                _, first, times = np.unique(in_row(runs.anchor, runs.row), return_index=True, return_counts=True)
                number = part.column(ID).take(pa.array(runs.row[first]))
                yield pa.RecordBatch.from_arrays([pa.array(runs.anchor[first]), number, pa.array(times, pa.int64())], ["_anchor", ID, "_times"])

    # counted over the rows of each anchor, so that anchors are found and shuffled once; a row is three numbers
    same = Window.partitionBy("_anchor")
    count = F.sum("_times").over(same)
    again = (F.min(ID).over(same) != F.max(ID).over(same)) if other_documents else (count > 1)
    blocks = F.when(count > MANY, F.ceil(F.log2(count / MANY))).otherwise(0).cast("long")
    live = docs.mapInArrow(tidy(anchors), schema).select(ID, F.col("_anchor").bitwiseOR(blocks).alias("_anchor"), again.alias("_again")).filter("_again")
    return live.groupBy(ID).agg(F.collect_set("_anchor").alias("__anchors"))


def stretches(docs: DataFrame, text: str, anchors: DataFrame, windows: Windows, same_document: bool) -> DataFrame:
    """The texts' stretches around repeated anchors: anchor, block, document, text hash, first unit, units and bytes.

    The block is -1 where the anchor is not cut into blocks.

    A stretch of which a task has seen an earlier copy comes without its bytes: all of it is repeated. With
    ``same_document`` a copy in the same document counts too, else only one in a document with a smaller number.
    """
    fields = [T.StructField(n, T.LongType()) for n in ("_anchor", "_block", ID, DIGEST, "_at", "_units")] + [T.StructField("_bytes", T.BinaryType())]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple[int, int]] = {}
        for batch in batches:
            for part in row_slices(batch, text, PASS_BYTES):
                part = part.filter(pc.and_(part.column("__anchors").is_valid(), part.column(DIGEST).is_valid()))
                data, offsets = text_arrays(part.column(text))
                listed = part.column("__anchors")
                owner = np.repeat(np.arange(part.num_rows), listed.value_lengths().to_numpy(zero_copy_only=False))
                runs = windows.runs(data, offsets)
                anchor = listed.flatten().to_numpy(zero_copy_only=False)
                known, bits = in_row(anchor & ~BLOCKS_BITS, owner), anchor & BLOCKS_BITS
                runs = runs.pick(np.isin(in_row(runs.anchor, runs.row), known))
                raw, pieces = data.tobytes(), []
                number, digest = (part.column(c).to_numpy(zero_copy_only=False)[runs.row] for c in (ID, DIGEST))
                block = np.full(len(runs.row), -1)
                if bits.any():
                    known, bits = known[bits > 0], bits[bits > 0]
                    by = np.argsort(known)
                    mine = in_row(runs.anchor, runs.row)
                    near = by[np.minimum(np.searchsorted(known, mine, sorter=by), len(by) - 1)]
                    place = mix(number.astype(np.uint64) ^ mix(runs.at.astype(np.uint64))).view(np.int64)
                    block = np.where(known[near] == mine, place & ((1 << bits[near]) - 1), -1)
                if len(seen) > SEEN:
                    seen.clear()
                for a, b, place in zip(runs.low.tolist(), runs.high.tolist(), zip(number.tolist(), runs.at.tolist())):
                    piece = raw[a:b]
                    known = seen.setdefault(piece, place)
                    if known < place and (same_document or known[0] < place[0]):
                        pieces.append(None)
                    else:
                        pieces.append(piece)
                        seen[piece] = min(known, place)
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(x) for x in (runs.anchor, block, number, digest, runs.at, runs.units)], pa.array(pieces, pa.binary())],
                    [f.name for f in fields],
                )

    # a left join, as in with_spans, so that both read the same exchange of texts
    joined = docs.join(anchors.hint("shuffle_hash"), ID, "left").select(*docs.columns, "__anchors")
    return joined.mapInArrow(tidy(cut), T.StructType(fields))


def in_row(anchor: np.ndarray, row: np.ndarray) -> np.ndarray:
    """One number for an anchor in a certain row of the block."""
    return mix(anchor.view(np.uint64) ^ mix(row.astype(np.uint64)))


class Stretches:
    """The different stretches of whole anchors that must be compared, and spans that need no comparison.

    Equal stretches of an anchor are kept once, the earliest (by document and first unit); copies
    that are later are spans. A stretch that no other stretch shares its anchor with holds nothing new.
    ``twin`` lists stretches equal in bytes and place to a kept one (rows that share their number).
    With ``alone`` a stretch without company is kept too, because its anchor has other blocks.
    """

    def __init__(self, table: pa.Table, same_document: bool, alone: bool = False):
        columns = {c: table.column(c).combine_chunks() for c in table.column_names}
        held = columns["_bytes"].is_valid()
        anchor, doc, digest, at, units = (columns[c].to_numpy(zero_copy_only=False) for c in ("_anchor", ID, DIGEST, "_at", "_units"))
        number = np.full(len(doc), -1)
        whole = np.flatnonzero(held.to_numpy(zero_copy_only=False))
        number[whole] = columns["_bytes"].filter(held).dictionary_encode().indices.to_numpy()
        order = whole[np.lexsort((at[whole], doc[whole], number[whole]))]
        lead = np.diff(number[order], prepend=-2) != 0
        leader = np.full(len(doc), -1)
        if len(order):
            leader[order] = order[np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))]
        later = (doc > doc[leader]) | ((doc == doc[leader]) & (at > at[leader]) & same_document)
        done = (leader < 0) | later
        self.spans = [doc[done], digest[done], at[done], units[done]]
        lead = order[lead]
        lead = lead[np.lexsort((at[lead], doc[lead], anchor[lead]))]
        shared = np.full(len(lead), alone)
        equal = anchor[lead][1:] == anchor[lead][:-1]
        shared[1:] |= equal
        shared[:-1] |= equal
        lead = lead[shared]
        self.doc, self.digest, self.at = doc[lead], digest[lead], at[lead]
        self.data, self.offsets = text_arrays(columns["_bytes"].take(pa.array(lead)))
        twins = np.flatnonzero(~done & (leader != np.arange(len(doc))))
        index = np.full(len(doc), -1)
        index[lead] = np.arange(len(lead))
        twins = twins[index[leader[twins]] >= 0]
        twins = twins[np.argsort(index[leader[twins]], kind="stable")]
        self.twin_of, self.twin = index[leader[twins]], [doc[twins], digest[twins], at[twins]]

    def all_of(self, stretch: np.ndarray, inside: np.ndarray, units: np.ndarray) -> list[np.ndarray]:
        """Spans of kept stretches (and of their twins) together with those that were known at once."""
        return [np.concatenate(c) for c in zip(self.spans, self.places(stretch, inside, units)[0])]

    def places(self, stretch: np.ndarray, inside: np.ndarray, units: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Spans of kept stretches and of their twins, and which of the given ones each is."""
        lo, hi = np.searchsorted(self.twin_of, stretch), np.searchsorted(self.twin_of, stretch, side="right")
        who, which = spread(lo, hi - lo), np.repeat(np.arange(len(stretch)), hi - lo)
        own = [self.doc[stretch], self.digest[stretch], self.at[stretch] + inside, units]
        twin = [self.twin[0][who], self.twin[1][who], self.twin[2][who] + inside[which], units[which]]
        return [np.concatenate(c) for c in zip(own, twin)], np.concatenate((np.arange(len(stretch)), which))


def compare(
    parts: DataFrame, fields: list[T.StructField], check: Callable[[Stretches], list[np.ndarray]], windows: Windows, same_document: bool
) -> DataFrame:
    """Spans of all anchors, each task streaming over its anchors in order.

    ``check`` gives the spans of whole anchors. In a block of an anchor a window with an earlier equal one is settled. Any other goes
    on with its hash to be compared with the anchor's other blocks: mostly one a block and hash, so that a
    window shared by many texts is as many rows as there are blocks.
    """
    extra = [T.StructField("_anchor", T.LongType()), T.StructField("_code", T.LongType())]
    names = [f.name for f in (*extra, *fields)]

    def settled(spans: list[np.ndarray]) -> pa.RecordBatch:
        none = pa.nulls(len(spans[0]), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, *[pa.array(c, pa.int64()) for c in spans]], names)

    def whole(table: pa.Table) -> Iterator[pa.RecordBatch]:
        yield settled(check(Stretches(table, same_document)))

    def block(table: pa.Table) -> Iterator[pa.RecordBatch]:
        found = Stretches(table, same_document, True)
        code, row, inside = windows.codes(found.data, found.offsets)
        # stretches lie in the order of document and place, so the first of equal windows is the earliest
        _, first, which = np.unique(code, return_index=True, return_inverse=True)
        source, doc, at = first[which], found.doc[row], found.at[row] + inside
        late = (doc[source] < doc) | ((doc[source] == doc) & (at[source] < at) & same_document)
        n = np.flatnonzero(late)
        if len(n):
            head, tail = spans_of(row[n], inside[n], np.zeros(len(n), bool))
            yield settled(found.all_of(row[n][head], inside[n][head], inside[n][tail] - inside[n][head] + windows.width))
        else:
            yield settled(found.spans)
        n = np.flatnonzero(~late)
        going, which = found.places(row[n], inside[n], np.full(len(n), windows.width))
        anchor = np.full(len(which), table.column("_anchor")[0].as_py())
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (anchor, code[n][which].view(np.int64), *going)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            # blocks of an anchor lie apart from each other and from whole anchors
            marks = batch.column("_block").to_numpy()
            edges = np.flatnonzero((np.diff(marks) != 0) | ((marks[1:] >= 0) & (np.diff(batch.column("_anchor").to_numpy()) != 0))) + 1
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                for part in row_slices(batch.slice(lo, hi - lo), "_bytes", TOGETHER_BYTES):
                    of, was = ([x.column(c)[0].as_py() for c in ("_block", "_anchor")] for x in (part, held[0] if held else part))
                    if held and (of[0] != was[0] or (of[0] >= 0 and of[1] != was[1])):
                        yield from (block if was[0] >= 0 else whole)(pa.Table.from_batches(held))
                        held, size = [], 0
                    held.append(part)
                    size += part.nbytes
                    if of[0] >= 0 or size < TOGETHER_BYTES:
                        continue
                    table = pa.Table.from_batches(held)
                    anchor = table.column("_anchor").to_numpy()
                    done = int(np.searchsorted(anchor, anchor[-1]))  # the last anchor may go on
                    if done:
                        yield from whole(table.slice(0, done))
                    held = table.slice(done).combine_chunks().to_batches()
                    size = sum(b.nbytes for b in held)
        if held:
            yield from (block if held[0].column("_block")[0].as_py() >= 0 else whole)(pa.Table.from_batches(held))

    dealt = parts.repartition("_anchor", "_block")
    # both parts read one exchange: a condition that is not deterministic is not pushed below it
    block_of = F.when(F.monotonically_increasing_id() >= 0, F.col("_block"))
    made, cut = (
        dealt.filter(c).sortWithinPartitions("_block", "_anchor").mapInArrow(tidy(run), T.StructType([*extra, *fields])) for c in (block_of < 0, block_of >= 0)
    )
    same = Window.partitionBy("_anchor", F.coalesce("_code", ID))
    place = F.struct(ID, "_start") if same_document else F.col(ID)
    late = cut.withColumn("_late", F.col("_anchor").isNull() | (F.min(place).over(same) < place)).filter("_late")
    spans = [f.name for f in fields]
    return made.select(*spans).unionAll(late.select(*spans))


def spans_of(stretch: np.ndarray, at: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of consecutive positions in one stretch, cut also where ``fresh``."""
    cut = (np.diff(at) != 1) | (np.diff(stretch) != 0) | fresh[1:]
    edge = np.flatnonzero(cut)
    return np.concatenate(([0], edge + 1)), np.concatenate((edge, [len(at) - 1]))


def with_spans(docs: DataFrame, text: str, spans: DataFrame, fields: list[T.StructField], cut) -> DataFrame:
    """Apply each text's spans (columns ``_start`` and ``_length``): ``cut`` gives the new columns of a block.

    ``cut`` gets the bytes and offsets of a block of texts, text number, start and length of its
    spans, and the texts. Rows without number or text have no spans.
    """
    one = F.struct(F.col(DIGEST).alias("digest"), F.col("_start").alias("start"), F.col("_length").alias("length"))
    lists = spans.groupBy(ID).agg(F.collect_list(one).alias("__spans"))
    joined = docs.join(lists.hint("shuffle_hash"), ID, "left").select(*docs.columns, "__spans")
    names = {f.name for f in fields}
    others = [c for c in docs.columns if c not in names and c not in (ID, DIGEST)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, text):
                listed = part.column("__spans")
                row = np.repeat(np.arange(part.num_rows), listed.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                digest, start, length = (x.to_numpy(zero_copy_only=False) for x in listed.flatten().flatten())
                own = digest == part.column(DIGEST).fill_null(0).to_numpy(zero_copy_only=False)[row]
                made = cut(*text_arrays(part.column(text)), row[own], start[own], length[own], part.column(text))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in others], *made], [*others, *[f.name for f in fields]])

    return joined.mapInArrow(tidy(run), T.StructType([*[docs.schema[c] for c in others], *fields]))


def covered(before: np.ndarray, total: int, row: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Which of a block's units lie in a span; ``before`` are the units before each text."""
    depth = np.zeros(total + 1, np.int64)
    np.add.at(depth, before[row] + start, 1)
    np.add.at(depth, before[row] + start + length, -1)
    return np.cumsum(depth[:-1]) > 0
