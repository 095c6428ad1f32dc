"""Identity resolution over three systems that hold the customers differently."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrata.functions.cleansing import standard_address, standard_zip
from lodestrata.operators import identity
from lodestrata.plans.registry import query, table
from lodestrata.sources.readers import tagged_union

LETTERS = "translate(md5('{0}' || c_custkey), '0123456789', 'ghijklmnop')"
DIGITS = "translate(md5('{0}' || {1}), 'abcdef', '012345')"
NAME = f"substr({LETTERS.format('n')}, 1, 6) || ' ' || substr({LETTERS.format('n')}, 7, 8)"
STREET = f"(c_custkey % 900) || ' ' || substr({LETTERS.format('a')}, 1, 9)"
#: Some customers share a number with a neighbour, some carry a placeholder number.
SSN_OWNER = "(CASE WHEN c_custkey % 20 = 1 THEN c_custkey - 1 ELSE c_custkey END)"
_ssn = DIGITS.format("s", SSN_OWNER)
SSN = f"CASE WHEN c_custkey % 50 = 3 THEN '999-99-9999' ELSE substr({_ssn}, 1, 3) || '-' || substr({_ssn}, 4, 2) || '-' || substr({_ssn}, 6, 4) END"
BORN = "CAST(DATE '1950-01-01' + CAST(c_custkey * 37 % 18000 AS INTEGER) AS VARCHAR(10))"

#: Expressions both engines read: record key, fields, per system.
SYSTEMS = {
    "CRM": {
        "record_key": "c_custkey * 3", "customer_name": NAME, "ssn": SSN, "date_of_birth": BORN, "address_line1": f"{STREET} || ' St'",
        "email": f"substr({LETTERS.format('e')}, 1, 9) || '@x.example'", "_ingestion_time": "TIMESTAMP '2024-01-01 01:00:00'",
    },
    "POLICY_SYSTEM": {
        "record_key": "c_custkey * 3 + 1", "customer_name": f"'x' || substr({NAME}, 2, 20)", "ssn": f"replace({SSN}, '-', '')", "date_of_birth": BORN,
        "address_line1": f"{STREET} || ' Street'", "email": f"upper(substr({LETTERS.format('e')}, 1, 9)) || '@X.EXAMPLE'", "_ingestion_time": "TIMESTAMP '2024-01-01 02:00:00'",
    },
    "CLAIMS_PORTAL": {
        "record_key": "c_custkey * 3 + 2", "customer_name": f"{NAME} || ' Jr.'", "ssn": f"CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE {SSN} END",
        "date_of_birth": f"CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE {BORN} END", "address_line1": f"{STREET} || ' St Apt 4'", "email": "CAST(NULL AS VARCHAR(20))",
        "_ingestion_time": "TIMESTAMP '2024-01-01 03:00:00'",
    },
}
COMMON = {"customer_id": "c_custkey", "city": "'Town' || (c_custkey % 9)", "state": "'st'", "zip_code": "substr(c_name, 14, 5)", "phone": "'555' || substr(c_name, 12, 7)"}


def _select(system):
    fields = SYSTEMS[system] | COMMON
    return [f"{e} AS {n}" for n, e in fields.items()]


RECORDS_SQL = "rec AS (" + " UNION ALL ".join(f"SELECT '{s}' AS source_system, {', '.join(_select(s))} FROM customer" for s in SYSTEMS) + ")"
CLEAN_SQL = """cl AS (SELECT *, nullif(regexp_replace(ssn, '[^0-9]', '', 'g'), '') AS s, CAST(date_of_birth AS DATE) AS d, nullif(trim(regexp_replace(upper(trim(customer_name)), '[^A-Z0-9\\s]', '', 'g')), '') AS n,
   nullif(trim(regexp_replace(upper(trim(concat_ws(' ', address_line1, city, state))), '[^A-Z0-9\\s]', '', 'g')), '') AS a, nullif(trim(lower(email)), '') AS e FROM rec)"""


def _ratio(x, y):
    return f"(CASE WHEN length({x}) > 0 AND length({y}) > 0 THEN 100.0::DOUBLE * (1.0::DOUBLE - levenshtein({x}, {y})::DOUBLE / greatest(length({x}), length({y}))) ELSE 0 END)"


def _tier(x, y, high, hp, low, lp):
    r = _ratio(x, y)
    return f"(CASE WHEN {r} >= {high} THEN {hp} WHEN {r} >= {low} THEN {lp} ELSE 0 END)"


def _score(p="p", q="q"):
    def eq(c, points):
        return f"(CASE WHEN {p}.{c} = {q}.{c} THEN {points} ELSE 0 END)"

    return " + ".join([eq("s", 40), eq("d", 20), _tier(f"{p}.n", f"{q}.n", 80, 20, 60, 10), _tier(f"{p}.a", f"{q}.a", 70, 15, 50, 7), eq("e", 5)])


EDGES_SQL = f"ed AS (SELECT p.record_key AS x, q.record_key AS y FROM cl p JOIN cl q ON p.s = q.s AND p.record_key <> q.record_key WHERE {_score()} >= 70)"
CLUSTER_SQL = """reach AS (SELECT record_key AS x, record_key AS y FROM cl UNION SELECT reach.x, ed.y FROM reach JOIN ed ON reach.y = ed.x), lab AS (SELECT x AS record_key, min(y) AS gid FROM reach GROUP BY x)"""
RESOLVED = "WITH RECURSIVE " + ",\n".join([RECORDS_SQL, CLEAN_SQL, EDGES_SQL, CLUSTER_SQL]) + "\n"


def records(spark, sf):
    customer = table(spark, sf, "customer")
    spark_type = "TIMESTAMP_NTZ"
    parts = {
        s: customer.selectExpr(*[x.replace("TIMESTAMP '", f"{spark_type} '").replace("CAST(NULL AS VARCHAR(20))", "CAST(NULL AS STRING)").replace("AS VARCHAR(10))", "AS STRING)") for x in _select(s)])
        for s in SYSTEMS
    }
    return tagged_union(parts)


def resolved(spark, sf):
    return identity.resolve(records(spark, sf))


@query("standardised_records", "WITH " + RECORDS_SQL + ", " + CLEAN_SQL + " SELECT record_key, source_system, s AS ssn_clean, d AS dob_clean, n AS name_clean, a AS address_clean, e AS email_clean FROM cl")
def standardised_records(spark, sf):
    return identity.standardise(records(spark, sf)).select("record_key", "source_system", "ssn_clean", "dob_clean", "name_clean", "address_clean", "email_clean")


@query("identity_pair_scores", "WITH " + RECORDS_SQL + ", " + CLEAN_SQL + f"""
SELECT p.record_key AS key_a, q.record_key AS key_b, {_score()} AS score, concat_ws(',', CASE WHEN p.s = q.s THEN 'SSN_MATCH' END, CASE WHEN p.d = q.d AND substr(p.n, 1, 3) = substr(q.n, 1, 3) THEN 'DOB_NAME_PREFIX' END) AS blocks
FROM cl p JOIN cl q ON p.customer_id = q.customer_id WHERE p.source_system = 'CRM' AND q.source_system <> 'CRM'""")
def identity_pair_scores(spark, sf):
    """Each CRM record against the same customer's record in the other systems."""
    clean = identity.standardise(records(spark, sf))
    pairs = clean.filter("source_system = 'CRM'").alias("a").join(clean.filter("source_system <> 'CRM'").alias("b"), F.expr("a.customer_id = b.customer_id"))
    return pairs.select(
        F.col("a.record_key").alias("key_a"), F.col("b.record_key").alias("key_b"), identity.pair_score().alias("score"), F.array_join(identity.block_types(), ",").alias("blocks")
    )


def _part(key, extra, star=True):
    """Heads of one grouping: the star links to them and the links between similar ones, in SQL."""
    cols = ", ".join(key)
    heads = f"(SELECT {cols}, min(record_key) AS head FROM pr WHERE {' AND '.join(f'{c} IS NOT NULL' for c in key)} GROUP BY {cols})"
    links = f"SELECT p.head AS src, q.head AS dst FROM {heads} p JOIN {heads} q ON {extra} WHERE p.head > q.head"
    if star:
        links += f" UNION ALL SELECT p.record_key, h.head FROM pr p JOIN {heads} h USING ({cols}) WHERE p.record_key <> h.head"
    return links


PROFILE_SQL = "pr AS (SELECT s, d, n, a, e, min(record_key) AS record_key FROM cl WHERE s IS NOT NULL AND 40 + CASE WHEN d IS NOT NULL THEN 20 ELSE 0 END + CASE WHEN n IS NOT NULL THEN 20 ELSE 0 END + CASE WHEN a IS NOT NULL THEN 15 ELSE 0 END + CASE WHEN e IS NOT NULL THEN 5 ELSE 0 END >= 70 GROUP BY ALL)"
_n, _a = _ratio("p.n", "q.n"), _ratio("p.a", "q.a")
LINKS_SQL = "WITH " + ", ".join([RECORDS_SQL, CLEAN_SQL, PROFILE_SQL]) + ", l AS (SELECT DISTINCT src, dst FROM (" + " UNION ALL ".join([
    _part(["s", "d", "n"], f"p.s = q.s AND p.d = q.d AND {_n} >= 60"),
    _part(["s", "d", "a"], f"p.s = q.s AND p.d = q.d AND {_a} >= 70"),
    _part(["s", "d", "e", "a"], f"p.s = q.s AND p.d = q.d AND p.e = q.e AND {_a} >= 50"),
    _part(["s", "n", "a"], f"p.s = q.s AND {_n} >= 80 AND {_a} >= 70"),
    _part(["s", "e", "n", "a"], f"p.s = q.s AND p.e = q.e AND {_n} >= 60 AND (({_n} >= 80 AND {_a} >= 50) OR {_a} >= 70)", star=False),
]) + f")) SELECT src, dst, {_score()} AS score FROM l JOIN pr p ON p.record_key = src JOIN pr q ON q.record_key = dst"


@query("identity_match_links", LINKS_SQL)
def identity_match_links(spark, sf):
    nodes = identity.profiles(identity.standardise(records(spark, sf)))
    return identity.scored_links(nodes, identity.match_links(nodes)).select("src", "dst", "score")


@query("identity_clusters", RESOLVED + "SELECT record_key, gid AS golden_record_id FROM lab")
def identity_clusters(spark, sf):
    return resolved(spark, sf).select("record_key", "golden_record_id")


def _street(c):
    out = f"trim(upper({c}))"
    for short, full in (("ST", "STREET"), ("AVE", "AVENUE"), ("BLVD", "BOULEVARD"), ("DR", "DRIVE"), ("RD", "ROAD"), ("LN", "LANE"), ("CT", "COURT"), ("PL", "PLACE")):
        out = f"regexp_replace({out}, ' {short}( |$)', ' {full}\\1', 'g')"
    return f"replace(replace({out}, ' APT ', ' APARTMENT '), ' STE ', ' SUITE ')"


GOLDEN_SQL = RESOLVED[:-1] + f""", gold AS (SELECT gid AS customer_master_id, customer_name AS master_customer_name, s AS master_ssn, d AS master_date_of_birth, {_street('address_line1')} AS master_address_line1,
  upper(trim(city)) AS master_city, upper(trim(state)) AS master_state, CASE WHEN length(regexp_replace(zip_code, '[^0-9]', '', 'g')) >= 5 THEN substr(regexp_replace(zip_code, '[^0-9]', '', 'g'), 1, 5) END AS master_zip_code, email AS master_email, phone AS master_phone, source_system AS master_source_system, true AS is_active
  FROM cl JOIN lab USING (record_key) QUALIFY row_number() OVER (PARTITION BY gid ORDER BY CASE source_system WHEN 'CRM' THEN 3 WHEN 'POLICY_SYSTEM' THEN 2 ELSE 1 END DESC, _ingestion_time DESC, record_key DESC) = 1)
"""


@query("golden_records", GOLDEN_SQL + "SELECT * FROM gold")
def golden_records(spark, sf):
    return identity.golden_records(resolved(spark, sf))


@query("customer_cross_reference", RESOLVED + "SELECT gid AS customer_master_id, source_system, customer_id AS source_system_customer_id, record_key AS source_record_key FROM cl JOIN lab USING (record_key)")
def customer_cross_reference(spark, sf):
    return identity.cross_reference(resolved(spark, sf))


@query("address_dimension", GOLDEN_SQL + """SELECT DISTINCT sha256(concat_ws('|', coalesce(master_address_line1, ''), coalesce(master_city, ''), coalesce(master_state, ''), coalesce(master_zip_code, ''))) AS address_key,
 master_address_line1 AS address_line1, master_city AS city, master_state AS state, master_zip_code AS zip_code, 'USA' AS country FROM gold""")
def address_dimension(spark, sf):
    return identity.address_dimension(identity.golden_records(resolved(spark, sf)))


@query("identity_cluster_sizes", RESOLVED + "SELECT gid AS golden_record_id, count(*) AS record_count, count(DISTINCT source_system) AS source_count FROM cl JOIN lab USING (record_key) GROUP BY gid")
def identity_cluster_sizes(spark, sf):
    return identity.cluster_sizes(resolved(spark, sf))


@query("standard_addresses", f"""
SELECT c_custkey, {_street("c_custkey || ' Oak St Apt ' || (c_custkey % 9) || ' Elm Ave'")} AS line, CASE WHEN c_custkey % 2 = 0 THEN substr(c_name, 10, 5) || '-' || substr(c_name, 15, 4) ELSE substr(c_name, 14, 5) END AS zip FROM customer""")
def standard_addresses(spark, sf):
    c = table(spark, sf, "customer")
    key = F.col("c_custkey")
    raw_zip = F.when(key % 2 == 0, F.concat(F.substring("c_name", 10, 5), F.lit(" "), F.substring("c_name", 15, 4))).otherwise(F.substring("c_name", 14, 5))
    return c.select("c_custkey", standard_address(F.concat(key, F.lit(" Oak St Apt "), key % 9, F.lit(" Elm Ave"))).alias("line"), standard_zip(raw_zip).alias("zip"))
