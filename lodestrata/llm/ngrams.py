"""Documents with similar sets of word n-grams, joined in prefix trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.llm.common import LOWER, code_of, gram_codes, list_array, mix, packed, row_slices, spread, text_arrays, tidy, unpacked, words_of
from lodestrata.llm.components import components
from lodestrata.session import cut_lineage

#: Similarity as a fraction: intersection * BELOW >= union * ABOVE.
ABOVE, BELOW = 4, 5
#: An n-gram counts as common from this share of the documents on.
COMMON = 4096
#: N-grams whose local counts a task holds at a time, partner sets in one tree, partners of one task.
COUNTED, TREE, PARTNERS = 1 << 20, 512, 4096
#: Bytes of text whose n-grams a task holds at a time.
SET_BYTES = 1 << 19
#: Documents of one side of a tile in which the documents of a long list are compared.
TILE = 4096
_COMMON_BIT = np.uint64(1 << 63)


def ngram_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams (63-bit numbers) of each of consecutive texts, ascending; and the text of each.

    A text with fewer than n words has one: the hash of all its words.
    """
    starts, ends, row = words_of(data, offsets)
    words = code_of(LOWER[data], starts, ends)
    grams = gram_codes(words, n)
    whole = row[: len(grams)] == row[n - 1 :] if len(grams) else np.zeros(0, bool)
    owner, value = row[: len(grams)][whole], grams[whole]
    counts = np.bincount(row, minlength=len(offsets) - 1)
    for k in np.flatnonzero((counts > 0) & (counts < n)):
        size = int(counts[k])
        at = int(np.searchsorted(row, k))
        owner = np.append(owner, k)
        value = np.append(value, mix(gram_codes(words[at : at + size], size) + np.uint64(size)))
    value = value >> np.uint64(1)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return value[fresh], owner[fresh]


def ordered_sets(part: pa.RecordBatch, n: int, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sets of a block in the global order: rare n-grams first, common ones with their top bit set after them."""
    value, owner = ngram_sets(*text_arrays(part.column("_text")), n)
    if len(common):
        at = np.minimum(np.searchsorted(common, value), len(common) - 1)
        value = np.where(common[at] == value, value | _COMMON_BIT, value)
        order = np.lexsort((value, owner))
        value = value[order]
    return value, owner


def common_ngrams(docs: DataFrame, n: int) -> np.ndarray:
    """N-grams found in at least one of ``COMMON`` documents, counted where a task meets them more than once.

    At most ``COMMON`` times the mean set size, whatever the number of documents, so the list may be sent to
    all tasks. It only sets the order of the n-grams; any order gives the same result.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            value, times = np.unique(np.concatenate(held), return_counts=True)
            again = times > 1
            return pa.RecordBatch.from_arrays([pa.array(value[again].view(np.int64)), pa.array(times[again], pa.int64())], ["_gram", "_times"])

        for batch in batches:
            for part in row_slices(batch, "_text", SET_BYTES):
                held.append(ngram_sets(*text_arrays(part.column("_text")), n)[0])
                size += len(held[-1])
                if size >= COUNTED:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    least = max(2, docs.count() // COMMON)
    counts = docs.select("_text").mapInArrow(tidy(count), "_gram long, _times long").groupBy("_gram").agg(F.sum("_times").alias("_times"))
    rows = counts.filter(F.col("_times") >= least).select("_gram").toArrow()
    return np.sort(rows.column("_gram").to_numpy().astype(np.uint64))


def least_overlap(size):
    """What a set of this size must at least share with a similar one."""
    return (ABOVE * size + BELOW - 1) // BELOW


def spare(size):
    """N-grams that a start has beyond those that make sure of one shared n-gram."""
    return np.minimum(4 + size // 32, least_overlap(size) - 1)


def signatures(docs: DataFrame, n: int, common) -> DataFrame:
    """Size of each document's set, a 128-bit hash of it, the start of the set in order, and its parity sketch.

    The start is so long that two similar sets share more n-grams of it than the smaller ``spare`` of the two. The sketch has a bit
    for every n-gram or more (a power of two of them): bit b is the parity of the n-grams that fall to b.
    Bits in which two sketches differ are no more than the n-grams in which the sets differ.
    """
    schema = "_doc long, _n long, _d1 long, _d2 long, _start array<long>, _bits array<long>"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, "_text", SET_BYTES):
                value, owner = ordered_sets(part, n, common.value)
                rows = part.num_rows
                size = np.bincount(owner, minlength=rows)
                end = np.cumsum(size)
                sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(value ^ np.uint64(s)), dtype=np.uint64))) for s in (0, 0x5DEECE66D)]
                d1, d2 = (mix(s[end] - s[end - size]).view(np.int64) for s in sums)
                first = np.where(size > 0, size - least_overlap(size) + 1 + spare(size), 0)
                inside = np.arange(len(value)) - (end - size)[owner]
                bits = 64 << np.ceil(np.log2(np.maximum(size, 64) / 64)).astype(np.int64)
                where = (value & ~_COMMON_BIT).astype(np.int64) & (bits[owner] - 1)
                words = bits // 64
                at = (np.cumsum(words) - words)[owner] + where // 64
                sketch = np.zeros(int(words.sum()), np.uint64)
                np.bitwise_xor.at(sketch, at, np.uint64(1) << (where % 64).astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_doc"), pa.array(size, pa.int64()), pa.array(d1), pa.array(d2),
                        list_array(value[inside < first[owner]].view(np.int64), first, pa.int64()), list_array(sketch.view(np.int64), words, pa.int64()),
                    ],
                    ["_doc", "_n", "_d1", "_d2", "_start", "_bits"],
                )

    return docs.mapInArrow(tidy(sign), schema)


def fitting(a: Column, b: Column) -> Column:
    """Whether sets of these sizes can be similar."""
    return (a * BELOW >= b * ABOVE) & (b * BELOW >= a * ABOVE)


def close_sketches(a: str, b: str, n_a: str, n_b: str) -> Column:
    """Whether two sketches leave it open that the sets are similar; the longer one is folded to the shorter."""
    folded = lambda c, other: F.when(
        F.size(c) > F.size(other),
        F.zip_with(F.slice(c, F.lit(1), F.size(c) / 2), F.slice(c, F.size(c) / 2 + 1, F.size(c) / 2), lambda x, y: x.bitwiseXOR(y)),
    ).otherwise(F.col(c))
    apart = F.aggregate(F.zip_with(folded(a, b), folded(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    # sets of sizes x and y with the least intersection differ in (x + y) * (BELOW - ABOVE) / (BELOW + ABOVE)
    return apart * (BELOW + ABOVE) <= (F.col(n_a) + F.col(n_b)) * (BELOW - ABOVE)


def tree_links(query: np.ndarray, partners: list[tuple[int, np.ndarray]]) -> list[int]:
    """Partners similar to the query set, by one walk over the prefix tree of the partners' sets.

    The sets lie in the order of their n-grams, which is the order in which a walk meets the tree's
    leaves; what two neighbours share is their common path. The overlap with the query along the
    path is kept, so shared parts are compared once. Where the overlap so far and all that can still come
    fall short, the whole subtree below is left out.
    """
    found: list[int] = []
    partners = sorted(partners, key=lambda p: p[1].astype(">u8").tobytes())
    path, overlap, dead = np.zeros(0, np.uint64), np.zeros(1, np.int64), -1
    for name, values in partners:
        common = min(len(path), len(values))
        differ = np.flatnonzero(path[:common] != values[:common])
        shared = int(differ[0]) if len(differ) else common
        size, need = len(values), -(-ABOVE * (len(query) + len(values)) // (ABOVE + BELOW))
        if 0 <= dead <= shared and size <= longest:
            continue  # below a node whose bound already failed, for sets of this length or more
        dead, depth = -1, min(shared, len(overlap) - 1)
        overlap = overlap[: depth + 1]
        path = values
        while depth < size:
            piece = values[depth : depth + 64]
            at = np.minimum(np.searchsorted(query, piece), len(query) - 1)
            overlap = np.concatenate((overlap, overlap[-1] + np.cumsum(query[at] == piece)))
            depth += len(piece)
            if overlap[-1] + size - depth < need:
                dead, longest = depth, size
                break
        if dead < 0 and overlap[-1] >= need:
            found.append(name)
    return found


def half(sketch: np.ndarray) -> np.ndarray:
    return sketch[: len(sketch) // 2] ^ sketch[len(sketch) // 2 :]


class Lists:
    """Whole lists (or tiles of long ones) of documents with sizes, components and sketches, as arrays.

    ``one`` holds a row and ``since`` and ``count`` a stretch of rows that it is compared with: none of its own
    component, since on each side the rows stand by component.
    """

    def __init__(self, table: pa.Table):
        by = [table.column(c).to_numpy() for c in ("_component", "_side", "_j", "_i", "_gram")]
        table = table.take(pa.array(np.lexsort(by)))
        get = lambda c: table.column(c).to_numpy()
        self.rep, self.size, self.component, side = get("_rep"), get("_n"), get("_component"), get("_side")
        key = [get(c) for c in ("_gram", "_i", "_j")]
        fresh = np.concatenate(([True], np.any([k[1:] != k[:-1] for k in key], axis=0)))
        begin = np.flatnonzero(fresh)
        end = np.concatenate((begin[1:], [len(self.rep)]))
        group = np.cumsum(fresh) - 1
        seconds = np.bincount(group, side).astype(np.int64)  # rows of the second side stand last
        at = np.arange(len(self.rep))
        inner = key[1] == key[2]
        alike = np.concatenate(([True], fresh[1:] | (side[1:] != side[:-1]) | (self.component[1:] != self.component[:-1])))
        run_end = np.append(np.flatnonzero(alike)[1:], len(at))[np.cumsum(alike) - 1]
        # inside a block: all rows after those of the own component; else the second side before and after them
        second = (end - seconds)[group]
        code = np.unique(self.component, return_inverse=True)[1].astype(np.int64)
        where = group * (code.max(initial=0) + 1) + code
        behind = np.flatnonzero(side == 1)
        lo, hi = (np.append(behind, len(at))[np.searchsorted(where[behind], where, side=s)] for s in ("left", "right"))
        lo, hi = np.clip(lo, second, end[group]), np.clip(hi, second, end[group])
        first = ~inner & (side == 0)
        self.one = np.concatenate((at[inner], at[first], at[first]))
        self.since = np.concatenate((run_end[inner], second[first], hi[first]))
        until = np.concatenate((end[group][inner], lo[first], end[group][first]))
        self.count = np.maximum(until - self.since, 0)
        sketches = [np.asarray(x, np.int64).view(np.uint64) for x in table.column("_bits").to_numpy()]
        self.words = np.array([len(x) for x in sketches], np.int64)
        halves = [half(x) if len(x) > 1 else x[:0] for x in sketches]
        self.flat = np.concatenate([*sketches, *halves])
        sizes = np.concatenate((self.words, [len(x) for x in halves]))
        place = np.cumsum(sizes) - sizes
        self.whole, self.folded = place[: len(sketches)], place[len(sketches) :]

    def open_pairs(self, limit: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of different components that sizes and sketches leave open, some rows at a time."""
        ends, lo = np.cumsum(self.count), 0
        while lo < len(self.count):
            done = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, done + limit, side="right")))
            a = np.repeat(self.one[lo:hi], self.count[lo:hi])
            b = spread(self.since[lo:hi], self.count[lo:hi])
            x, y = self.size[a], self.size[b]
            fits = (x * BELOW >= y * ABOVE) & (y * BELOW >= x * ABOVE)
            a, b = a[fits], b[fits]
            length = np.minimum(self.words[a], self.words[b])
            from_a = np.where(self.words[a] == length, self.whole[a], self.folded[a])
            from_b = np.where(self.words[b] == length, self.whole[b], self.folded[b])
            most = (self.size[a] + self.size[b]) * (BELOW - ABOVE) // (BELOW + ABOVE)
            apart, going = np.zeros(len(a), np.int64), np.arange(len(a))
            step = 0
            while len(going):
                apart[going] += np.bitwise_count(self.flat[from_a[going] + step] ^ self.flat[from_b[going] + step])
                step += 1
                going = going[(length[going] > step) & (apart[going] <= most[going])]
            open_ = apart <= most
            a, b = self.rep[a[open_]], self.rep[b[open_]]
            yield np.minimum(a, b), np.maximum(a, b)
            lo = hi


def tiles(rest: DataFrame, bits: DataFrame) -> DataFrame:
    """The lists' documents, a row for each tile they are compared in: blocks ``_i`` and ``_j`` of about ``TILE`` documents.

    The largest component of a list has blocks of its own, behind those of the other documents. These meet all
    blocks; the largest component meets only them, never itself.
    """
    parts = rest.groupBy("_gram", "_component").agg(F.count("*").alias("_rows"))
    most = F.max(F.struct("_rows", "_component"))
    sizes = parts.groupBy("_gram").agg(most.alias("_most"), F.sum("_rows").alias("_all")).select(
        "_gram", F.col("_most._component").alias("_main"), F.ceil((F.col("_all") - F.col("_most._rows")) / TILE).cast("int").alias("_few"),
        F.ceil(F.col("_most._rows") / TILE).cast("int").alias("_many"),
    )
    dealt = lambda n: F.pmod(F.xxhash64("_rep"), F.col(n)).cast("int")
    main = F.col("_component") == F.col("_main")
    block = F.when(main, F.col("_few") + dealt("_many")).otherwise(dealt("_few"))
    known = rest.join(sizes, "_gram").join(bits, "_rep").withColumn("_block", block)
    last = F.when(main, F.col("_few") - 1).otherwise(F.col("_few") + F.col("_many") - 1)
    each = known.withColumn("_o", F.explode(F.sequence(F.lit(0), last)))
    columns = ["_gram", "_i", "_j", "_side", "_rep", "_n", "_component", "_bits"]
    return each.withColumns(
        {"_i": F.least("_block", "_o"), "_j": F.greatest("_block", "_o"), "_side": F.when(F.col("_block") <= F.col("_o"), 0).otherwise(1)}
    ).select(*columns)


def pairs_across(rest: DataFrame, bits: DataFrame) -> DataFrame:
    """Pairs (``_a`` < ``_b``) of one list and of different components that sizes and sketches leave open.

    ``rest`` holds lists of two components or more. Only open pairs leave a task; lists of any length are
    spread over many tasks by their :func:`tiles`.
    """
    tiled = tiles(rest, bits)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(table: pa.Table) -> pa.RecordBatch:
            pairs = [np.stack(p, axis=1) for p in Lists(table).open_pairs()]
            once = np.unique(np.concatenate([np.zeros((0, 2), np.int64), *pairs]), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(once[:, 0]), pa.array(once[:, 1])], ["_a", "_b"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < 4 * TILE:
                continue
            whole = pa.Table.from_batches(held)
            last = [whole.column(c).to_numpy() for c in ("_gram", "_i", "_j")]
            other = np.flatnonzero(np.any([k != k[-1] for k in last], axis=0))
            done = int(other[-1]) + 1 if len(other) else 0  # the last tile may go on
            if done:
                yield found(whole.slice(0, done))
            held = whole.slice(done).combine_chunks().to_batches()
        if held:
            yield found(pa.Table.from_batches(held))

    ordered = tiled.repartition("_gram", "_i", "_j").sortWithinPartitions("_gram", "_i", "_j", "_side")
    return ordered.mapInArrow(tidy(compare), "_a long, _b long").distinct()


def verified(pairs: DataFrame, docs: DataFrame, n: int, common) -> DataFrame:
    """The pairs (``_a``, ``_b``) whose sets are similar.

    Only texts of documents in a pair are turned into sets. Queries go to the task of their partners;
    a query with many partners is split over several tasks.
    """
    pairs = cut_lineage(pairs)
    needed = pairs.select(F.col("_a").alias("_doc")).unionAll(pairs.select("_b")).distinct()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, "_text", SET_BYTES):
                value, owner = ordered_sets(part, n, common.value)
                size = np.bincount(owner, minlength=part.num_rows)
                end, raw = np.cumsum(size) * 8, value.astype("<u8").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part.column("_doc"), pa.array([raw[e - 8 * s : e] for e, s in zip(end.tolist(), size.tolist())], pa.binary())], ["_doc", "_set"]
                )

    sets = cut_lineage(docs.join(needed.hint("shuffle_hash"), "_doc").select("_doc", "_text").mapInArrow(tidy(build), "_doc long, _set binary"))
    split = pairs.groupBy("_a").agg((F.count("*") / PARTNERS + 1).cast("int").alias("_parts"))
    queries = split.join(sets, F.col("_a") == F.col("_doc")).select("_a", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"), F.lit(None).cast("long").alias("_b"), "_set")
    mates = pairs.join(split, "_a").join(sets, F.col("_b") == F.col("_doc"))
    mates = mates.select("_a", F.pmod(F.xxhash64("_b"), F.col("_parts")).cast("int").alias("_part"), "_b", "_set")
    rows = queries.unionAll(mates).repartition("_a", "_part").sortWithinPartitions("_a", "_part", F.col("_b").asc_nulls_first())

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, owner, waiting = np.zeros(0, np.uint64), None, []

        def links() -> pa.RecordBatch:
            found = tree_links(query, waiting) if waiting else []
            return pa.RecordBatch.from_arrays([pa.array([owner] * len(found), pa.int64()), pa.array(found, pa.int64())], ["_a", "_b"])

        for batch in batches:
            for a, b, values in zip(*(batch.column(c).to_pylist() for c in ("_a", "_b", "_set"))):
                values = np.frombuffer(values, "<u8").astype(np.uint64)
                if b is None:
                    yield links()
                    query, owner, waiting = values, a, []
                    continue
                waiting.append((b, values))
                if len(waiting) >= TREE:
                    yield links()
                    waiting = []
        yield links()

    return cut_lineage(rows.select("_a", "_b", "_set").mapInArrow(tidy(walk), "_a long, _b long"))


def similar_documents(df: DataFrame, key: str, text: str, n: int = 5) -> DataFrame:
    """``key`` (as ``_doc``), ``_n`` (set size) and ``_component`` of each document with a key.

    A document's set holds its distinct n-grams of words, A-Z taken as a-z; with fewer words, all of them as
    one. Documents are linked if 5 * intersection >= 4 * union; components are named by their smallest
    key. Documents without words are linked with nothing.

    Steps: equal sets are found by their hashes and stand for each other. N-grams at the start of more
    than one set make lists. In each list the document with most such n-grams is compared with all
    others (linear in the lists); then each document outside a list's largest component is compared with
    those of other components. Every comparison passes the sizes and sketches first and is decided in a prefix tree.
    """
    docs = df.select(F.col(f"`{key}`").cast("long").alias("_doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text")).filter("_doc IS NOT NULL")
    context = df.sparkSession.sparkContext
    common = context.broadcast(common_ngrams(docs, n))
    signed = cut_lineage(signatures(docs, n, common))

    same = ["_d1", "_d2", "_n"]
    leaders = signed.filter("_n > 0").groupBy(*same).agg(F.min("_doc").alias("_rep"))
    member = cut_lineage(signed.select("_doc", *same).join(leaders, same, "left").select("_doc", "_n", F.coalesce("_rep", "_doc").alias("_rep")))

    entries = signed.select("_doc", F.explode("_start").alias("_gram"))
    shared = entries.groupBy("_gram").agg((F.min("_doc") != F.max("_doc")).alias("_more")).filter("_more").select("_gram")
    meets = entries.join(shared, "_gram", "left_semi").join(member, "_doc").groupBy("_gram", "_rep").agg(F.min("_n").alias("_n"))
    # A document may leave its longest lists: as many as the smallest similar set could spare. Of the n-grams
    # that two similar sets share, that in the shortest list is left by neither.
    meets = cut_lineage(meets)
    often = meets.groupBy("_gram").agg(F.count("*").alias("_df"))
    least = lambda c: F.floor((ABOVE * c + (BELOW - 1)) / BELOW)
    smallest = least(F.col("_n"))
    left_out = F.least(4 + F.floor(smallest / 32), least(smallest) - 1)
    longest = Window.partitionBy("_rep").orderBy(F.col("_df").desc(), "_gram")
    ranked = meets.join(often, "_gram").filter("_df > 1").withColumn("_rank", F.row_number().over(longest)).filter(F.col("_rank") > left_out)
    degree = Window.partitionBy("_rep")
    lists = cut_lineage(ranked.select("_gram", "_rep", "_n", F.count("*").over(degree).alias("_deg")))
    bits = signed.select(F.col("_doc").alias("_rep"), "_bits")

    def candidates(pairs: DataFrame) -> DataFrame:
        """Of pairs (``_a``, ``_b``, sizes ``_na``, ``_nb``), each once, those that sizes and sketches leave open."""
        open_ = pairs.filter(fitting(F.col("_na"), F.col("_nb"))).distinct()
        with_a = open_.join(bits.select(F.col("_rep").alias("_a"), F.col("_bits").alias("_ba")), "_a")
        both = with_a.join(bits.select(F.col("_rep").alias("_b"), F.col("_bits").alias("_bb")), "_b")
        return both.filter(close_sketches("_ba", "_bb", "_na", "_nb")).select("_a", "_b")

    best = F.min_by(F.struct(F.col("_rep").alias("_a"), F.col("_n").alias("_na")), F.struct(-F.col("_deg"), F.col("_rep")))
    pivots = lists.groupBy("_gram").agg(best.alias("_p")).select("_gram", "_p.*")
    first = lists.join(pivots, "_gram").filter("_rep <> _a").select("_a", F.col("_rep").alias("_b"), "_na", F.col("_n").alias("_nb"))
    links = verified(candidates(first), docs, n, common)

    label = components(links, "_a", "_b")
    named = lists.join(label, F.col("_rep") == F.col("_node"), "left").select("_gram", "_rep", "_n", F.coalesce("_component", "_rep").alias("_component"))
    mixed = named.groupBy("_gram").agg((F.min("_component") != F.max("_component")).alias("_mixed")).filter("_mixed").select("_gram")
    rest = named.join(mixed, "_gram", "left_semi")
    more = verified(pairs_across(rest, bits), docs, n, common)

    final = components(links.unionAll(more), "_a", "_b")
    return member.join(final, F.col("_rep") == F.col("_node"), "left").select("_doc", "_n", F.coalesce("_component", "_rep").alias("_component"))


def one_of_each(df: DataFrame, key: str, text: str, n: int = 5) -> DataFrame:
    """The rows of ``df`` without documents that are similar to an earlier one in their component.

    The document with the smallest key of each component stays, with all its rows. Rows with a NULL key
    stay; NULL and empty texts are similar to nothing.
    """
    later = similar_documents(df, key, text, n).filter("_doc <> _component").select(F.col("_doc").alias("_later")).distinct()
    rows = packed(df, _key=key).join(later.hint("shuffle_hash"), F.col("_key") == F.col("_later"), "left_anti")
    return unpacked(rows, df, {}, _key=key)
