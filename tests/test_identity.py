import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestrata.functions.similarity import ratio
from lodestrata.operators import identity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def alike(a, b):
    return 100.0 * (1.0 - distance(a, b) / max(len(a), len(b))) if a and b else 0.0


words = st.text(alphabet="ABC ", min_size=1, max_size=12)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(words, min_size=8, max_size=25, unique=True), st.sampled_from([50, 60, 70]))
def test_tokens_lose_no_similar_pair(spark, texts, limit):
    heads = spark.createDataFrame([(k, "x", t) for k, t in enumerate(texts)], "head long, block string, t string")
    met = sorted((r.dst, r.src) for r in identity._similar(heads, ["block"], "t", limit).collect())
    need = sorted((i, j) for i, x in enumerate(texts) for j, y in enumerate(texts) if i < j and alike(x, y) >= limit)
    assert met == need


def test_ratio(spark):
    row = spark.createDataFrame([("KITTEN", "SITTING", "", None)], "a string, b string, e string, n string").select(
        ratio(F.col("a"), F.col("b")), ratio(F.col("a"), F.col("e")), ratio(F.col("a"), F.col("n"))
    ).first()
    assert row[0] == pytest.approx(100 * (1 - 3 / 7)) and row[1] == 0 and row[2] == 0


def components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


random.seed(3)
GRAPHS = {
    "chain": [(i, i + 1) for i in range(60)],
    "hub": [(0, i) for i in range(1, 80)] + [(500, i) for i in range(501, 540)],
    "random": [(random.randrange(120), random.randrange(120)) for _ in range(90)],
}


@pytest.mark.parametrize("name", sorted(GRAPHS))
def test_components(spark, name):
    edges = [(a, b) for a, b in GRAPHS[name] if a != b]
    df = spark.createDataFrame(edges, "src bigint, dst bigint")
    got = {r.node: r.component for r in identity.connected_components(df).collect()}
    assert got == components(edges)


SCHEMA = (
    "source_system string, customer_id string, record_key bigint, customer_name string, ssn string, date_of_birth string, "
    "address_line1 string, city string, state string, zip_code string, email string, phone string, _ingestion_time string"
)


def person(key, system, name, ssn, born, street="1 Main St", email=None):
    return (system, f"{system}{key}", key, name, ssn, born, street, "Boston", "MA", "02101", email, "555", "2024-01-01")


def test_three_systems(spark):
    df = spark.createDataFrame(
        [
            person(1, "CRM", "Jonathan Smith", "123-45-6789", "1980-01-01"),
            person(2, "POLICY_SYSTEM", "Jonathan Smith", "123456789", "1980-01-01"),
            person(3, "CLAIMS_PORTAL", "Jonathan Smyth", "123-45-6789", None),
            person(4, "CRM", "Zoe Quux", "999-11-2222", "1990-05-05", "9 Elm Rd"),
        ],
        SCHEMA,
    )
    resolved = identity.resolve(df)
    assert {r.record_key: r.golden_record_id for r in resolved.collect()} == {1: 1, 2: 1, 3: 1, 4: 4}
    golden = {r.customer_master_id: r for r in identity.golden_records(resolved).collect()}
    assert golden[1].master_source_system == "CRM" and golden[1].master_address_line1 == "1 MAIN STREET"
    assert identity.cross_reference(resolved).count() == 4


def test_shared_number_against_all_pairs(spark):
    """A third of the records share one placeholder number; links must give the components of all pairs."""
    random.seed(11)
    first, last = ["ANN", "ANNA", "BOB", "BOBBY", "CARL"], ["STONE", "STOEN", "BROOK", "BROOKS"]
    rows = []
    for i in range(90):
        ssn = "000-00-0000" if i % 3 == 0 else f"{i % 12:03d}-11-2222"
        rows.append(
            person(i, "CRM", f"{random.choice(first)} {random.choice(last)}", ssn, random.choice(["1980-01-01", "1981-02-02", None]),
                   random.choice(["1 MAIN ST", "1 MAIN AVE", "77 OCEAN BLVD", "5 X"]), random.choice(["A@B.C", "D@E.F", None]))
        )
    df = spark.createDataFrame(rows, SCHEMA)
    clean = identity.standardise(df).cache()
    pairs = (
        clean.alias("a").join(clean.alias("b"), F.expr("a.record_key < b.record_key AND a.ssn_clean = b.ssn_clean"))
        .filter(identity.pair_score() >= identity.MATCH).select("a.record_key", "b.record_key").collect()
    )
    want = {k: k for k in range(90)} | components([tuple(p) for p in pairs])
    got = {r.record_key: r.golden_record_id for r in identity.resolve(df).collect()}
    assert got == want


def test_links_are_planned_in_few_steps(spark):
    """Each exchange of a plan costs the driver memory: all ways to match must share their steps."""
    df = spark.createDataFrame([person(i, "CRM", f"ANN {i}", "123-45-6789", "1980-01-01") for i in range(40)], SCHEMA)
    links = identity.match_links(identity.profiles(identity.standardise(df)))
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") + plan.count("BroadcastExchange ") <= 20


def test_blocks_of_any_size_against_all_pairs(spark):
    """Blocks around the size up to which heads are compared pair by pair, with the same links in both."""
    random.seed(5)
    rows = []
    for group, size in enumerate((2, identity.DIRECT, identity.DIRECT + 1, 3 * identity.DIRECT)):
        for i in range(size):
            name = "".join(random.choice("AB") for _ in range(6)) + f" {i % 7}{group}"
            rows.append(person(len(rows), "CRM", name, f"{group:03d}-11-2222", random.choice(["1980-01-01", "1981-02-02", None]),
                               random.choice(["1 MAIN ST", "1 MAIN AVE", "77 OCEAN BLVD"]) + f" {i % 5}", random.choice(["A@B.C", None])))
    clean = identity.standardise(spark.createDataFrame(rows, SCHEMA)).cache()
    pairs = (
        clean.alias("a").join(clean.alias("b"), F.expr("a.record_key < b.record_key AND a.ssn_clean = b.ssn_clean"))
        .filter(identity.pair_score() >= identity.MATCH).select("a.record_key", "b.record_key").collect()
    )
    want = {k: k for k in range(len(rows))} | components([tuple(p) for p in pairs])
    assert {r.record_key: r.golden_record_id for r in identity.resolve(clean).collect()} == want


def test_random_names_of_one_number_hardly_meet(spark):
    """The work in a large block must grow with its heads, not with its pairs, and lose no similar pair."""
    random.seed(17)
    names = ["".join(random.choice("ABCDEFGHIJKLMNOP") for _ in range(random.randint(13, 16))) for _ in range(2000)]
    names += [n[:k] + "Z" + n[k + 2 :] for k, n in enumerate(names[:12])] + [n + " JR" for n in names[12:20]]
    heads = spark.createDataFrame([(k, "x", t) for k, t in enumerate(names)], "head long, block string, t string").repartition(4).cache()
    met = identity._meetings(heads, ["block"], "t", 80)
    own = sum(len(n) * 20 // 100 + 1 for n in names)
    assert met.selectExpr("sum(parts * pieces)").first()[0] < 2 * own
    want = heads.alias("a").join(heads.alias("b"), (F.col("a.head") > F.col("b.head")) & (ratio(F.col("a.t"), F.col("b.t")) >= 80))
    want = sorted((r[0], r[1]) for r in want.select("a.head", "b.head").collect())
    assert len(want) >= 20 and sorted((r.src, r.dst) for r in identity._similar(heads, ["block"], "t", 80).collect()) == want


def test_crowded_and_long_names_against_all_pairs(spark, monkeypatch):
    """Blocks that go by marks, blocks too crowded for marks and texts too long for them, in cells of three."""
    for name, value in (("DIRECT", 6), ("CELL", 3), ("LONG", 20)):
        monkeypatch.setattr(identity, name, value)
    random.seed(23)

    def letters(n):
        return "".join(random.choice("ABCDEFGH") for _ in range(n))

    apart = [letters(12) for _ in range(14)]
    apart += [n[:5] + "X" + n[6:] for n in apart[:5]] + [letters(25) for _ in range(4)]
    apart += [apart[19] + "Y", apart[20][1:], apart[21][:20], apart[22][:21]]
    alike = [f"ACME INSURANCE {letters(3)}" for _ in range(20)] + ["ACME INSURANCE GROUP OF XY", "ACME INSURANCE GROUP OF ZZ"]
    rows = [
        person(k, "CRM", n, s, f"19{k % 90 + 10}-01-01", random.choice(["1 MAIN ST", "1 MAIN AVE", "77 OCEAN BOULEVARD EAST"]))
        for k, (s, n) in enumerate([("111-11-1111", n) for n in apart] + [("222-22-2222", n) for n in alike])
    ]
    clean = identity.standardise(spark.createDataFrame(rows, SCHEMA)).cache()
    crowded = identity._meetings(clean.select(F.col("record_key").alias("head"), "ssn_clean", "name_clean"), ["ssn_clean"], "name_clean", 80)
    times = {r[0]: r[1] for r in crowded.groupBy("ssn_clean").agg(F.expr("sum(parts * pieces)")).collect()}
    assert times["111111111"] < len(apart) ** 2 / 2 and times["222222222"] > len(alike) ** 2 / 2
    pairs = (
        clean.alias("a").join(clean.alias("b"), F.expr("a.record_key > b.record_key AND a.ssn_clean = b.ssn_clean"))
        .filter(identity.pair_score() >= identity.MATCH).select("a.record_key", "b.record_key").collect()
    )
    links = identity.match_links(identity.profiles(clean)).collect()
    assert pairs and {(r.src, r.dst) for r in links} == {tuple(p) for p in pairs} and len(links) == len(pairs)


def test_profile_without_key_links_with_none(spark, monkeypatch):
    monkeypatch.setattr(identity, "CELL", 1)
    rows = [person(k, "CRM", f"ANN STONE{k}", "123-45-6789", "1980-01-01") for k in (1, 2, 3, None, None)]
    rows += [person(None, "CRM", f"ANN BROOK{k}", "123-45-6789", "1980-01-01") for k in range(4)]
    links = identity.match_links(identity.profiles(identity.standardise(spark.createDataFrame(rows, SCHEMA)))).collect()
    assert {(r.src, r.dst) for r in links} == {(2, 1), (3, 1), (3, 2)}
