"""Prefix trie of conversations: range shards of sorted paths, and a skeleton of the paths between them.

A conversation is the path of its turns' digests. Paths are sorted and cut into shards at splitters taken from
the paths themselves. A node whose members lie in two shards is a beginning of the splitter between them, so all other
nodes are finished inside their shard, with a stack of open nodes while sorted paths pass by. The nodes on
splitter paths, the skeleton, are few; each shard counts its part of them and the parts are added up.

Paths are handled in levels of ``LEVEL`` turns: a row holds one level of a conversation. Further levels are needed only where
conversations still have company; the others are single file from there on, and their nodes are written down at once.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lodestrata.llm.chunks import digests, in_order
from lodestrata.session import cut_lineage

#: Turns of a path in one row, bytes of a turn's digest, conversations of a shard, shards at most, and sample paths of a shard.
LEVEL, WIDE, TOGETHER, SHARDS, SAMPLE = 256, 16, 2000, 1024, 4
#: Members' keys that are handed on together.
KEYS = 4096
ROOT = b"\0" * WIDE
EMPTY = hashlib.sha256().hexdigest()

#: Columns of what a shard writes: finished nodes, then parts of skeleton nodes.
NODE = {"_root": T.BinaryType, "_conv": T.LongType, "_depth": T.IntegerType, "_parent": T.LongType, "_above": T.IntegerType} | dict.fromkeys(
    ("_n", "_children", "_leaves", "_saved"), T.LongType
) | {"_ends": T.StringType}
PART = {"_skeleton": T.IntegerType, "_shard": T.IntegerType, "_at": T.IntegerType, "_keys": T.StringType} | dict.fromkeys(
    ("_own", "_low", "_sub", "_under", "_spare", "_more_sub", "_more_under", "_more_spare"), T.LongType
)
SCHEMA = T.StructType([T.StructField(name, kind()) for name, kind in {**NODE, **PART}.items()])
KINDS = {T.BinaryType: pa.binary(), T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.StringType: pa.string()}
FIELDS = SCHEMA.names


class Skeleton:
    """The trie of the splitter paths: number of each node by parent and digest, with depth, parent and tokens of its turn."""

    def __init__(self, paths: list[tuple[bytes, list[int]]]) -> None:
        self.child: dict[tuple[int, bytes], int] = {}
        self.depth, self.parent, self.tokens, self.root, self.path = [], [], [], [], []
        for path, tokens in paths:
            above = -1
            for d in range(len(path) // WIDE):
                digest = path[d * WIDE : (d + 1) * WIDE]
                node = self.child.setdefault((above, digest), len(self.depth))
                if node == len(self.depth):
                    self.depth.append(d)
                    self.parent.append(above)
                    self.tokens.append(tokens[d])
                    self.root.append(path[:WIDE])
                    self.path.append([*(self.path[above] if above >= 0 else []), node])
                above = node


class Open:
    """A node whose members are passing by."""

    __slots__ = ("digest", "tokens", "skeleton", "n", "low", "children", "leaves", "saved", "ends", "keys", "more", "below")

    def __init__(self, digest: bytes, tokens: int, skeleton: int) -> None:
        self.digest, self.tokens, self.skeleton = digest, tokens, skeleton
        self.n = self.children = self.leaves = self.saved = 0
        self.low: int | None = None
        self.ends, self.keys = None, []
        #: totals of the next level under this node, and finished children that wait for this node's least member
        self.more: tuple[int, int, int] = (0, 0, 0)
        self.below: list[list] = []


class Shard:
    """Finishes the nodes of one shard while its paths pass by in order."""

    def __init__(self, number: int, skeleton: Skeleton) -> None:
        self.number, self.skeleton, self.stack, self.path = number, skeleton, [], b""
        self.out: dict[str, list] = {f: [] for f in FIELDS}
        self.flushed = 0

    def put(self, **values: object) -> None:
        for f in FIELDS:
            self.out[f].append(values.get(f))

    def keys(self, node: Open) -> None:
        """Hands on the members that end at a skeleton node."""
        self.put(_skeleton=node.skeleton, _shard=self.number, _at=self.flushed, _keys=",".join(node.keys))
        self.flushed += 1
        node.keys = []

    def close(self, keep: int) -> None:
        """Closes the open nodes below the first ``keep``."""
        while len(self.stack) > keep:
            node, depth = self.stack.pop(), len(self.stack)
            above = self.stack[-1] if self.stack else None
            if above is not None:
                above.n += node.n
                above.low = node.low if above.low is None else min(above.low, node.low)
            if node.skeleton >= 0:
                if node.keys:
                    self.keys(node)
                a, b, c = node.more
                self.put(_skeleton=node.skeleton, _shard=self.number, _own=node.n, _low=node.low, _sub=node.children, _under=node.leaves, _spare=node.saved, _more_sub=a, _more_under=b, _more_spare=c)
                continue
            a, b, c = node.more
            children = node.children + a
            leaves = node.leaves + b if children else 1
            saved = node.saved + c + (node.n - 1) * node.tokens
            self.settle(node)
            row = [self.path[:WIDE], node.low, depth, None, None, node.n, children, leaves, saved, node.ends.hexdigest() if node.ends else EMPTY]
            if above is None:
                self.put(**dict(zip(FIELDS, row)))
                continue
            above.children += 1
            above.leaves += leaves
            above.saved += saved
            if above.skeleton >= 0:
                row[4] = above.skeleton
                self.put(**dict(zip(FIELDS, row)))
            else:
                above.below.append(row)

    def settle(self, node: Open) -> None:
        for row in node.below:
            row[3] = node.low
            self.put(**dict(zip(FIELDS, row)))
        node.below = []

    def add(self, path: bytes, tokens: list[int], conv: int, ends: bool, more: tuple[int, int, int] | None) -> None:
        """One conversation: its path, whether it ends there, and the next level's totals if it goes on."""
        size, same = len(path) // WIDE, 0
        top = min(size, len(self.stack))
        if path[: top * WIDE] == self.path[: top * WIDE]:
            same = top
        else:
            while path[same * WIDE : (same + 1) * WIDE] == self.path[same * WIDE : (same + 1) * WIDE]:
                same += 1
        self.close(same)
        self.path = path
        for d in range(same, size):
            digest = path[d * WIDE : (d + 1) * WIDE]
            above = self.stack[-1].skeleton if self.stack else -1
            skeleton = self.skeleton.child.get((above, digest), -1) if above >= 0 or not d else -1
            self.stack.append(Open(digest, tokens[d], skeleton))
        node = self.stack[-1]
        node.n += 1
        node.low = conv if node.low is None else min(node.low, conv)
        if more is not None:
            node.more = more
        elif ends:
            if node.skeleton >= 0:
                node.keys.append(str(conv))
                if len(node.keys) == KEYS:
                    self.keys(node)
            elif node.ends is None:
                node.ends = hashlib.sha256(str(conv).encode())
            else:
                node.ends.update(f",{conv}".encode())

    def batch(self) -> pa.RecordBatch:
        arrays = [pa.array(self.out[f.name], KINDS[type(f.dataType)]) for f in SCHEMA.fields]
        self.out = {f: [] for f in FIELDS}
        return pa.RecordBatch.from_arrays(arrays, FIELDS)


def level_nodes(paths: DataFrame, together: int = TOGETHER) -> tuple[DataFrame, DataFrame]:
    """Nodes of one level: ``_root _conv _depth _parent _n _children _leaves _saved _ends``, and the same of the roots.

    ``paths`` has ``_path`` (the root and the digests of up to ``LEVEL`` turns), ``_tokens`` (of each), ``_conv``, ``_ends`` (it ends here) and for
    those that go on ``_more``, the totals below. Depths count from the root; a root's saved tokens are those below it.
    """
    spark = paths.sparkSession
    shards = max(1, min(SHARDS, -(-paths.count() // together)))
    sample = paths.orderBy(F.xxhash64("_conv"), "_conv").limit(SAMPLE * shards).select("_path", "_conv", "_tokens").collect()
    sample.sort(key=lambda r: (bytes(r[0]), r[1]))
    cuts = [sample[SAMPLE * k] for k in range(1, shards) if SAMPLE * k < len(sample)]
    roots = [(bytes(r[0])[:WIDE], [0]) for r in sample[:1]]
    skeleton = Skeleton(roots + [(bytes(r[0]), r[2]) for r in cuts])
    splitters = spark.sparkContext.broadcast([(bytes(r[0]), r[1]) for r in cuts])
    sent = spark.sparkContext.broadcast(skeleton)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = splitters.value
        for batch in batches:
            shard = [bisect_right(at, key) for key in zip(batch.column("_path").to_pylist(), batch.column("_conv").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard, pa.int32())], [*batch.schema.names, "_shard"])

    placed = paths.mapInArrow(place, T.StructType([*paths.schema.fields, T.StructField("_shard", T.IntegerType())]))
    dealt = placed.repartitionById(shards, F.col("_shard")).sortWithinPartitions("_shard", "_path", "_conv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: Shard | None = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("_shard", "_path", "_tokens", "_conv", "_ends", "_more")]
            for number, path, tokens, conv, ends, more in zip(*columns):
                if state is None or number != state.number:
                    if state is not None:
                        state.close(0)
                        yield state.batch()
                    state = Shard(number, sent.value)
                state.add(path, tokens, conv, ends, tuple(more[k] for k in ("a", "b", "c")) if more else None)
            if state is not None:
                yield state.batch()
        if state is not None:
            state.close(0)
            yield state.batch()

    made = cut_lineage(dealt.mapInArrow(run, SCHEMA))
    numbers = list(range(len(skeleton.depth)))
    inner = np.bincount(np.array([p for p in skeleton.parent if p >= 0], np.int64), minlength=len(numbers)).tolist()
    facts = spark.createDataFrame(
        [(k, skeleton.depth[k], skeleton.parent[k], skeleton.tokens[k], skeleton.path[k], skeleton.root[k], inner[k]) for k in numbers],
        "_s int, _sd int, _sp int, _st long, _spath array<int>, _sroot binary, _inner long",
    )
    parts = made.filter("_own IS NOT NULL").groupBy("_skeleton").agg(
        F.sum("_own").alias("_n"), F.min("_low").alias("_conv"), F.sum("_sub").alias("_sub"), F.sum("_under").alias("_under"), F.sum("_spare").alias("_spare"),
        *[F.max(f"_more_{k}").alias(f"_more_{k}") for k in ("sub", "under", "spare")],
    )
    joined = parts.join(facts, F.col("_skeleton") == F.col("_s"))
    children = F.col("_sub") + F.col("_more_sub") + F.col("_inner")
    # a node of the skeleton gives its own part to all nodes above it
    own = joined.select(
        "_s", "_sd", "_sp", "_n", "_conv", "_sroot", "_spath", children.alias("_children"),
        (F.col("_under") + F.col("_more_under") + F.when(children == 0, 1).otherwise(0)).alias("_l"),
        (F.col("_spare") + F.col("_more_spare") + (F.col("_n") - 1) * F.col("_st")).alias("_t"),
    )
    own = cut_lineage(own)
    up = own.select(F.explode("_spath").alias("_to"), "_l", "_t").groupBy("_to").agg(F.sum("_l").alias("_leaves"), F.sum("_t").alias("_saved"))
    ends = digests(made.filter("_keys IS NOT NULL").select(F.col("_skeleton").alias("_es"), "_shard", "_at", "_keys"), ["_es"], ["_shard", "_at"], "_keys", "_ends", ",")
    above = own.select(F.col("_s").alias("_ps"), F.col("_conv").alias("_pc"))
    bones = own.join(up, F.col("_s") == F.col("_to")).join(ends, F.col("_s") == F.col("_es"), "left").join(above, F.col("_sp") == F.col("_ps"), "left")
    names = ["_root", "_conv", "_depth", "_parent", "_n", "_children", "_leaves", "_saved", "_ends"]
    bones = bones.select(F.col("_sroot").alias("_root"), "_conv", F.col("_sd").alias("_depth"), F.col("_pc").alias("_parent"), "_n", "_children", "_leaves", "_saved", F.coalesce("_ends", F.lit(EMPTY)).alias("_ends"))
    local = made.filter("_skeleton IS NULL").join(above, F.col("_above") == F.col("_ps"), "left").withColumn("_parent", F.coalesce("_pc", "_parent"))
    every = bones.unionAll(local.select(*names))
    return every.filter("_depth > 0"), every.filter("_depth = 0")


def turns_in_order(df: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """Chunks of turns: ``_c``, ``_part``, ``_at``, ``_from`` (turns before), ``_all`` (turns of the conversation), ``_items`` of digest and tokens."""
    told = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.length(told(role)).cast("string"), F.lit(":"), told(role), told(text)), 256)), 1, WIDE)
    rows = df.select(F.col(f"`{key}`").cast("long").alias("_c"), F.col(f"`{turn}`").cast("long").alias("_t"), F.struct(digest.alias("d"), F.length(told(text)).cast("long").alias("n")).alias("_items"))
    rows = rows.filter("_c IS NOT NULL").withColumn("_tie", F.monotonically_increasing_id())
    chunks = cut_lineage(in_order(rows, "_c", [F.col("_t").asc_nulls_first(), F.col("_items.d").asc(), F.col("_tie").asc()], ["_items"]))
    sizes = chunks.select("_c", "_part", "_at", F.size("_items").cast("long").alias("_size"))
    before = Window.partitionBy("_c").orderBy("_part", "_at").rowsBetween(Window.unboundedPreceding, -1)
    spots = sizes.select("_part", "_at", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_from"), F.sum("_size").over(Window.partitionBy("_c")).alias("_all"))
    return chunks.join(spots, ["_part", "_at"])


def prefix_trie(df: DataFrame, key: str, turn: str, role: str, text: str, shared: int = 100, level: int = LEVEL, together: int = TOGETHER) -> DataFrame:
    """One row a node of the trie of rebuilt conversations.

    Conversation c is rebuilt from the first h turns of conversation c - c % ``shared`` (h = crc32(c) % 6) and its own turns after the
    first h. Columns: ``key`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Turns come in order, those without a number first, turns of one number by the SHA-256 of role and text; repeated
    rows are turns of their own. NULL role or text is empty. Rows with a NULL key take no part. Other columns are
    ignored. An empty table gives no node, not even a root. ``df`` should be a scan or a stored table. Turns are
    told apart by 128 bits of SHA-256. Texts of any length stay where they are; only digests are moved.
    """
    chunks = cut_lineage(turns_in_order(df, key, turn, role, text))
    share = F.crc32(F.col("_c").cast("string").cast("binary")) % 6
    # the first turns of the conversations that others begin with
    heads = chunks.filter((F.col("_c") % shared == 0) & (F.col("_from") < 5)).select("_c", "_from", F.slice("_items", 1, 5).alias("_i"))
    heads = heads.groupBy(F.col("_c").alias("_base")).agg(F.slice(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_from", "_i"))), lambda x: x["_i"])), 1, 5).alias("_head"))
    convs = chunks.groupBy("_c").agg(F.max("_all").alias("_all")).withColumn("_h", share)
    convs = convs.join(heads, F.col("_c") - F.col("_c") % shared == F.col("_base"), "left")
    convs = convs.select("_c", "_all", "_h", F.slice(F.coalesce("_head", F.array().cast("array<struct<d: binary, n: bigint>>")), F.lit(1), F.col("_h").cast("int")).alias("_head"))
    convs = cut_lineage(convs.withColumn("_len", F.size("_head") + F.greatest(F.col("_all") - F.col("_h"), F.lit(0))))
    # depth of an own turn: those of the head, and its place after the first h
    own = chunks.drop("_all").join(convs.select("_c", "_h", F.size("_head").alias("_b")), "_c")
    items = own.select("_c", F.posexplode("_items").alias("_k", "_i"), "_from", "_h", "_b").select("_c", (F.col("_from") + F.col("_k") - F.col("_h") + F.col("_b")).alias("_d"), "_i", (F.col("_from") + F.col("_k") >= F.col("_h")).alias("_own"))
    items = items.filter("_own").drop("_own").unionAll(convs.select("_c", F.posexplode("_head").alias("_k", "_i")).select("_c", F.col("_k").cast("long"), "_i"))
    segments = items.groupBy("_c", F.floor(F.col("_d") / level).alias("_level")).agg(F.array_sort(F.collect_list(F.struct("_d", "_i"))).alias("_s"))
    segments = cut_lineage(segments.select("_c", "_level", F.transform("_s", lambda x: x["_i"]["d"]).alias("_ds"), F.transform("_s", lambda x: x["_i"]["n"]).alias("_ns")))

    # down: conversations that still have company at each level, with the digest of what is before it
    alive, levels, alone = convs.select("_c", "_len", F.lit(ROOT).alias("_root")), [], []
    at = 0
    while True:
        segment = segments.filter(F.col("_level") == at).drop("_level")
        here = cut_lineage(alive.join(segment, "_c", "left"))
        levels.append(here)
        # NULL lists: a conversation that ends where the level begins
        after = here.filter(F.col("_len") >= (at + 1) * level)
        chained = after.select("_c", "_len", F.substring(F.unhex(F.sha2(F.concat("_root", F.array_join(F.transform("_ds", F.hex), "").cast("binary")), 256)), 1, WIDE).alias("_root"))
        chained = cut_lineage(chained)
        groups = chained.groupBy("_root").agg(F.count("*").alias("_times"), F.max("_len").alias("_longest")).filter(F.col("_longest") > (at + 1) * level)
        marked = chained.join(groups, "_root").select("_c", "_len", "_root", "_times")
        alone.append(marked.filter("_times = 1").select("_c", "_len", F.lit(at + 1).alias("_at")))
        alive = cut_lineage(marked.filter("_times > 1").drop("_times"))
        at += 1
        if not alive.limit(1).count():
            break

    # up: totals of a level's roots go to the ends of the level above
    found: list[DataFrame] = []
    below: DataFrame | None = None
    for at in range(len(levels) - 1, -1, -1):
        here = levels[at]
        goes = F.col("_len") > (at + 1) * level
        if below is None:
            here = here.withColumn("_more", F.when(goes, F.struct(F.lit(1).cast("long").alias("a"), F.lit(1).cast("long").alias("b"), F.lit(0).cast("long").alias("c"))))
        else:
            roots = below.select(F.col("_root").alias("_br"), F.struct(F.col("_children").alias("a"), F.col("_leaves").alias("b"), F.col("_saved").alias("c")).alias("_bm"))
            rooted = levels[at + 1].select(F.col("_c").alias("_bc"), F.col("_root").alias("_nr"))
            met = here.join(rooted, F.col("_c") == F.col("_bc"), "left").join(roots, F.col("_nr") == F.col("_br"), "left")
            here = met.withColumn("_more", F.when(goes, F.coalesce("_bm", F.struct(F.lit(1).cast("long").alias("a"), F.lit(1).cast("long").alias("b"), F.lit(0).cast("long").alias("c")))))
        none = F.coalesce("_ds", F.array().cast("array<binary>"))
        path = F.unhex(F.concat(F.hex("_root"), F.array_join(F.transform(none, F.hex), "")))
        tokens = F.concat(F.array(F.lit(0).cast("long")), F.coalesce("_ns", F.array().cast("array<long>")))
        # a conversation that ends where this level begins has ended in the level above
        ends = (F.col("_len") <= (at + 1) * level) & ((F.col("_len") > at * level) | F.lit(at == 0))
        paths = cut_lineage(here.select(path.alias("_path"), tokens.alias("_tokens"), F.col("_c").alias("_conv"), ends.alias("_ends"), "_more"))
        nodes, below = level_nodes(paths, together)
        nodes = nodes.withColumn("_depth", F.col("_depth").cast("long") + at * level)
        found.append(nodes.drop("_root"))
        if at == 0:
            found.append(below.withColumn("_depth", F.col("_depth").cast("long")).drop("_root"))
        else:
            below = cut_lineage(below)
    tail = reduce(DataFrame.unionAll, alone)
    one, last = F.lit(1).cast("long"), F.col("_depth") == F.col("_len")
    tail = tail.select("_c", "_len", F.explode(F.sequence(F.col("_at").cast("long") * level + 1, F.col("_len"))).alias("_depth"))
    found.append(tail.select(
        F.col("_c").alias("_conv"), "_depth", F.col("_c").alias("_parent"), one.alias("_n"), F.when(last, 0).otherwise(1).cast("long").alias("_children"), one.alias("_leaves"),
        F.lit(0).cast("long").alias("_saved"), F.when(last, F.sha2(F.col("_c").cast("string"), 256)).otherwise(EMPTY).alias("_ends"),
    ))
    every = reduce(DataFrame.unionAll, [f.select("_conv", "_depth", "_parent", "_n", "_children", "_leaves", "_saved", "_ends") for f in found])
    return every.select(
        F.col("_conv").alias(key), F.col("_depth").alias("depth"), F.col("_parent").alias("parent_conv_id"), F.col("_n").alias("n_convs"),
        F.col("_children").alias("n_children"), F.col("_leaves").alias("n_leaves"), F.col("_saved").alias("saved_tokens"), F.col("_ends").alias("ends_sha256"),
    )
