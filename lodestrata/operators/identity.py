"""Identity resolution: standardise, link, cluster, golden record, cross reference.

A pair scores 40 for the same social security number, 20 for the same birth date, 20 or 10
for a similar name, 15 or 7 for a similar address and 5 for the same e-mail; 70 is a match.
Without the same number a pair reaches 60 at most, so only records sharing a number can
match. The pairs of a number are not all enumerated:

* records equal in every compared field collapse to one profile;
* fields whose equality alone decides a match link each profile to the smallest one of its
  group (a star, linear in the group);
* only distinct field combinations are compared. In a large group whose texts must be very
  similar, only those meet of which one holds a part of the other where it may lie
  (``functions.similarity.part_marks``); otherwise all pairs, dealt to tasks in cells of a
  fixed size.

The links have the same connected components as the full list of matching pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.cleansing import digits_key, match_text, standard_address, standard_zip
from lodestrata.functions.similarity import lengths_fit, part_marks, ratio, sought_marks
from lodestrata.operators.history import keep_latest
from lodestrata.session import cut_lineage, release

MATCH = 70
# Sources from most to least trusted.
SOURCE_PRIORITY = {"CRM": 3, "POLICY_SYSTEM": 2, "CLAIMS_PORTAL": 1}
FIELDS = ("ssn_clean", "dob_clean", "name_clean", "address_clean", "email_clean")


def standardise(records: DataFrame) -> DataFrame:
    """Add the compared fields; an empty field is NULL."""

    def filled(c: Column) -> Column:
        return F.nullif(F.trim(c), F.lit(""))

    return records.withColumns(
        {
            "ssn_clean": digits_key(F.col("ssn")),
            "dob_clean": F.to_date("date_of_birth"),
            "name_clean": filled(match_text(F.col("customer_name"))),
            "address_clean": filled(match_text(F.col("address_line1"), F.col("city"), F.col("state"))),
            "email_clean": filled(F.lower("email")),
        }
    )


def tier(value: Column, high: int, high_points: int, low: int, low_points: int) -> Column:
    return F.when(value >= high, high_points).when(value >= low, low_points).otherwise(0)


def pair_score(a: str = "a", b: str = "b") -> Column:
    """Points of a pair whose sides are the structs (or aliases) ``a`` and ``b``."""

    def same(field: str, points: int) -> Column:
        return F.when(F.col(f"{a}.{field}") == F.col(f"{b}.{field}"), points).otherwise(0)

    def alike(field: str) -> Column:
        return ratio(F.col(f"{a}.{field}"), F.col(f"{b}.{field}"))

    return (
        same("ssn_clean", 40)
        + same("dob_clean", 20)
        + tier(alike("name_clean"), 80, 20, 60, 10)
        + tier(alike("address_clean"), 70, 15, 50, 7)
        + same("email_clean", 5)
    )


def block_types(a: str = "a", b: str = "b") -> Column:
    """Names of the blocks a pair falls into."""

    def both(field: str) -> Column:
        return F.col(f"{a}.{field}") == F.col(f"{b}.{field}")

    prefix = F.substring(F.col(f"{a}.name_clean"), 1, 3) == F.substring(F.col(f"{b}.name_clean"), 1, 3)
    return F.array_compact(
        F.array(F.when(both("ssn_clean"), "SSN_MATCH"), F.when(both("dob_clean") & prefix, "DOB_NAME_PREFIX"))
    )


def profiles(records: DataFrame) -> DataFrame:
    """Distinct field combinations that can reach a match, named by their smallest record key.

    They are stored before those that can't are left out: a filter below the grouping would compute every field again.
    """
    own = (
        F.lit(40)
        + F.when(F.col("dob_clean").isNotNull(), 20).otherwise(0)
        + F.when(F.col("name_clean").isNotNull(), 20).otherwise(0)
        + F.when(F.col("address_clean").isNotNull(), 15).otherwise(0)
        + F.when(F.col("email_clean").isNotNull(), 5).otherwise(0)
    )
    combined = cut_lineage(records.groupBy(*FIELDS).agg(F.min("record_key").alias("node")))
    return combined.filter(F.col("ssn_clean").isNotNull() & (own >= MATCH))


def _marked(heads: DataFrame, text: str, min_ratio: int) -> tuple[DataFrame, DataFrame]:
    """Heads once for each part of their text, and once for each piece that may be a part of a similar text."""
    filled = heads.filter(F.length(text) > 0)
    parts = filled.withColumn("mark", F.explode(part_marks(F.col(text), min_ratio)))
    return parts, filled.withColumn("mark", F.explode(sought_marks(F.col(text), min_ratio)))


def _meetings(heads: DataFrame, block: Sequence[str], text: str, min_ratio: int) -> DataFrame:
    """Marks of each block at which two heads may meet, with the numbers of parts and of pieces."""
    keys = [*block, "mark"]
    parts, pieces = _marked(heads, text, min_ratio)
    both = parts.select(*keys, F.lit(1).alias("part")).unionByName(pieces.select(*keys, F.lit(0).alias("part")))
    counts = both.groupBy(*keys).agg(F.sum("part").alias("parts"), F.sum(1 - F.col("part")).alias("pieces"))
    # a part is also a piece of its own text
    return counts.filter("parts > 0 AND pieces > 1")


def _similar(
    heads: DataFrame, block: Sequence[str], text: str, min_ratio: int, test: Column | None = None, met: DataFrame | None = None
) -> DataFrame:
    """Links between heads of one block whose ``text`` is similar enough and that pass ``test``.

    Heads meet where a part of one is a piece of the other; the parts of a frequent mark are dealt out,
    so that no task holds more than ``CELL`` of them at once. ``met`` are the ``_meetings`` of these heads, if known.
    """
    keys = [*block, "mark"]
    met = _meetings(heads, block, text, min_ratio) if met is None else met
    copies = met.select(*keys, F.ceil(F.col("parts") / CELL).alias("copies"))
    parts, pieces = _marked(heads, text, min_ratio)
    parts = parts.join(copies, keys).withColumn("copy", F.pmod(F.xxhash64("head"), "copies"))
    pieces = pieces.join(copies, keys).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    cond = F.col("a.head") != F.col("b.head")
    for c in (*keys, "copy"):
        cond = cond & (F.col(f"a.{c}") == F.col(f"b.{c}"))
    a, b = F.col(f"a.{text}"), F.col(f"b.{text}")
    cond = cond & lengths_fit(a, b, min_ratio) & (ratio(a, b) >= min_ratio)
    if test is not None:
        cond = cond & test
    return _link(_dealt(parts, [*keys, "copy"]).alias("a").join(pieces.alias("b"), cond)).distinct()


def _dealt(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows dealt by ``keys`` to a fixed number of tasks: few rows may mean much to compare."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _ratio_of(field: str) -> Column:
    return ratio(F.col(f"a.{field}"), F.col(f"b.{field}"))


#: Ways in which two profiles of one number match: fields that must be equal, the text that must be
#: similar and by how much, another text and the test on both, and whether equal texts alone are a match.
WAYS = (
    (("dob_clean",), "name_clean", 60, None, None, True),
    (("dob_clean",), "address_clean", 70, None, None, True),
    (("dob_clean", "email_clean"), "address_clean", 50, None, None, True),
    ((), "name_clean", 80, "address_clean", lambda: _ratio_of("other") >= 70, True),
    (
        ("email_clean",), "name_clean", 60, "address_clean",
        lambda: ((_ratio_of("text") >= 80) & (_ratio_of("other") >= 50)) | (_ratio_of("other") >= 70), False,
    ),
)
#: Heads of a block that are compared pair by pair; larger blocks go by marks where the text must be similar by
#: ``NARROW`` or more and has at most ``LONG`` characters: weaker limits make parts of two letters, which tell nothing apart.
DIRECT, NARROW, LONG = 256, 80, 48
#: Heads that are compared with as many others in one task at once.
CELL = 512


def _link(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("a.head", "b.head").alias("src"), F.least("a.head", "b.head").alias("dst"))


def _in_cells(sized: DataFrame, alike: Column) -> DataFrame:
    """Links between all heads of a block that are ``alike``; a block of many goes in pairs of groups, each compared once."""
    group = F.pmod(F.xxhash64("head"), F.ceil(F.col("size") / CELL))
    grouped = sized.withColumn("group", group)
    a = grouped.withColumn("low", F.col("group")).withColumn("high", F.explode(F.sequence("group", F.ceil(F.col("size") / CELL) - 1)))
    b = grouped.withColumn("high", F.col("group")).withColumn("low", F.explode(F.sequence(F.lit(0).cast("long"), F.col("group"))))
    apart = (F.col("a.low") < F.col("a.high")) & (F.col("a.head") != F.col("b.head"))
    cond = apart | (F.col("a.head") > F.col("b.head"))
    for c in ("block", "low", "high"):
        cond = (F.col(f"a.{c}") == F.col(f"b.{c}")) & cond
    return _link(_dealt(a, ["block", "low", "high"]).alias("a").join(b.alias("b"), cond & alike))


def _places(nodes: DataFrame) -> DataFrame:
    """A row for each profile and way it can match by: ``way``, ``block``, ``text``, ``other`` (empty where unused)."""
    found = []
    for k, (equal, text, _, other, _, _) in enumerate(WAYS):
        needed = [*equal, text, *([other] if other else [])]
        able = F.lit(True)
        for c in needed:
            able = able & F.col(c).isNotNull()
        # digits, then a date, then an e-mail: no two different blocks read the same
        block = F.concat_ws("|", F.lit(k), "ssn_clean", *[F.col(c).cast("string") for c in equal])
        place = F.struct(F.lit(k).alias("way"), block.alias("block"), F.col(text).alias("text"), (F.col(other) if other else F.lit("")).alias("other"))
        found.append(F.when(able, place))
    return nodes.select("node", F.explode(F.array_compact(F.array(*found))).alias("p")).select("node", "p.*")


def match_links(nodes: DataFrame) -> DataFrame:
    """Links (src > dst) between profiles whose components are those of all matching pairs.

    Beside the number a match needs 30 points. With the same birth date that is any of: a
    name of 60, an address of 70, or the same e-mail and an address of 50. Without it: a
    name of 80 and an address of 70, or the same e-mail with one of them at its upper and
    the other at its lower limit.

    All ways go through the same few steps, and the heads are stored before they are compared:
    a plan of each way by itself has so many stages that planning alone fills the driver.
    """
    group = ["way", "block", "text", "other"]
    places = _places(nodes)
    heads = cut_lineage(places.groupBy(*group).agg(F.min("node").alias("head"), F.count("*").alias("nodes")))
    starred = heads.filter((F.col("nodes") > 1) & F.col("way").isin([k for k, w in enumerate(WAYS) if w[5]]))
    stars = (
        places.join(starred.drop("nodes"), group).filter("node <> head").select(F.col("node").alias("src"), F.col("head").alias("dst"))
    )
    sizes = heads.groupBy("block").agg(F.count("*").alias("size")).filter("size > 1")
    sized = cut_lineage(heads.drop("nodes").join(sizes, "block"))
    alike = F.lit(False)
    for k, (_, _, least, _, test, _) in enumerate(WAYS):
        enough = (F.col("a.way") == k) & lengths_fit(F.col("a.text"), F.col("b.text"), least) & (_ratio_of("text") >= least)
        alike = alike | (enough if test is None else enough & test())
    narrow = [k for k, w in enumerate(WAYS) if w[2] >= NARROW]
    by_marks = (F.col("size") > DIRECT) & F.col("way").isin(narrow)
    whole, out = sized.filter(~by_marks), stars
    many = cut_lineage(_dealt(sized.filter(by_marks), ["head"]))
    for k in sorted(r["way"] for r in many.select("way").distinct().collect()):
        _, _, least, _, test, _ = WAYS[k]
        of_way = many.filter(F.col("way") == k)
        near = of_way.filter(F.length("text") <= LONG)
        met = cut_lineage(_meetings(near, ["block"], "text", least))
        # where texts are so alike that they would meet more often than in pairs, marks don't help
        times = met.groupBy("block").agg(F.sum(F.col("parts") * F.col("pieces")).alias("times"))
        pairs = F.col("size") * F.col("size") / 2
        crowded = cut_lineage(times.join(of_way.select("block", "size").distinct(), "block").filter(F.col("times") > pairs).select("block"))
        found = _similar(near.join(crowded, "block", "left_anti"), ["block"], "text", least, test and test(), met)
        out = out.unionByName(cut_lineage(found))
        # pairs of which one is longer
        far = of_way.filter(F.length("text") * 100 >= (LONG + 1) * least).withColumn("block", F.concat("block", F.lit("|far")))
        whole = whole.unionByName(near.join(crowded, "block", "left_semi")).unionByName(far)
    return out.unionByName(_in_cells(whole, alike)).distinct()


def scored_links(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Links with the score and the blocks of their two profiles."""
    side = nodes.select("node", F.struct(*FIELDS).alias("f"))
    a = side.select(F.col("node").alias("src"), F.col("f").alias("a"))
    b = side.select(F.col("node").alias("dst"), F.col("f").alias("b"))
    return links.join(a, "src").join(b, "dst").select(
        "src", "dst", pair_score().alias("score"), block_types().alias("block_types")
    )


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) with the smallest node of each component as its name.

    Alternating large-star and small-star rounds: both only aggregate a minimum per node
    and join it back (one row per node), so no task ever holds the neighbours of a hub.
    Each round ends in a stored table, which replaces the one before; the loop ends when a round
    changes nothing.
    """
    edges = cut_lineage(
        links.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).filter("u <> v").distinct()
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        old, edges = edges, cut_lineage(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        release(old)
        # three numbers reach the driver: the fingerprint of the edge set
        state = tuple(edges.agg(F.count("*"), F.sum("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
        before = state


def resolve(records: DataFrame) -> DataFrame:
    """Records with ``golden_record_id``, the smallest record key of their cluster."""
    clean = standardise(records)
    nodes = profiles(clean)
    labels = connected_components(match_links(nodes))
    named = nodes.join(labels, "node", "left").select(*FIELDS, F.coalesce("component", "node").alias("golden_record_id"))
    cond = F.lit(True)
    for f in FIELDS:
        cond = cond & F.col(f"r.{f}").eqNullSafe(F.col(f"n.{f}"))
    joined = clean.alias("r").join(named.alias("n"), cond, "left")
    return joined.select("r.*", F.coalesce("n.golden_record_id", "r.record_key").alias("golden_record_id"))


def golden_records(resolved: DataFrame) -> DataFrame:
    """The surviving record of each cluster: most trusted source, then newest, then largest key."""
    trust = F.create_map(*[F.lit(x) for kv in SOURCE_PRIORITY.items() for x in kv])[F.col("source_system")]
    order = [F.coalesce(trust, F.lit(0)).desc(), F.col("_ingestion_time").desc(), F.col("record_key").desc()]
    best = keep_latest(resolved, ["golden_record_id"], order)
    return best.select(
        F.col("golden_record_id").alias("customer_master_id"),
        F.col("customer_name").alias("master_customer_name"),
        F.col("ssn_clean").alias("master_ssn"),
        F.col("dob_clean").alias("master_date_of_birth"),
        standard_address(F.col("address_line1")).alias("master_address_line1"),
        F.upper(F.trim("city")).alias("master_city"),
        F.upper(F.trim("state")).alias("master_state"),
        standard_zip(F.col("zip_code")).alias("master_zip_code"),
        F.col("email").alias("master_email"),
        F.col("phone").alias("master_phone"),
        F.col("source_system").alias("master_source_system"),
        F.lit(True).alias("is_active"),
    )


def cross_reference(resolved: DataFrame) -> DataFrame:
    """Source ids of every record and the golden record they belong to."""
    return resolved.select(
        F.col("golden_record_id").alias("customer_master_id"),
        "source_system",
        F.col("customer_id").alias("source_system_customer_id"),
        F.col("record_key").alias("source_record_key"),
    )


def address_dimension(golden: DataFrame) -> DataFrame:
    """Distinct addresses with a repeatable key."""
    parts = {
        "address_line1": "master_address_line1", "city": "master_city", "state": "master_state", "zip_code": "master_zip_code",
    }
    distinct = golden.select(*[F.col(c).alias(n) for n, c in parts.items()]).distinct()
    return distinct.select(
        F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in parts]), 256).alias("address_key"),
        *parts,
        F.lit("USA").alias("country"),
    )


def cluster_sizes(resolved: DataFrame) -> DataFrame:
    return resolved.groupBy("golden_record_id").agg(
        F.count("*").alias("record_count"), F.countDistinct("source_system").alias("source_count")
    )
