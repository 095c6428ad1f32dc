"""Documentation scans, glossary links, scorecards, lineage and data products.

``columns`` is an inventory with ``database_name, table_name, column_name, column_comment,
table_comment``; ``links`` are glossary links with ``full_path`` and ``verified``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.operators import security
from lodestrata.operators.aggregates import SEVERITIES, mean, rank_of, top, union_all, with_one_row
from lodestrata.operators.history import conditional_update, keep_max_per_group
from lodestrata.session import cut_lineage


def full_path(*parts: str) -> Column:
    return F.concat_ws(".", *parts)


def _described(columns: DataFrame) -> DataFrame:
    """Without the reserved columns, which need no description."""
    return columns.filter(~F.col("column_name").startswith("_"))


def _blank(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c)), F.lit("")).isin("", "NULL")


def _violation(df: DataFrame, policy: str, severity: str, kind: str, path: Column, details: str) -> DataFrame:
    column = F.col("column_name") if kind == "column" else F.lit(None).cast("string")
    return df.select(
        F.concat(F.lit("VIO_"), F.md5(F.concat_ws("|", F.lit(policy), path))).alias("violation_id"),
        F.lit(policy).alias("policy_name"),
        F.lit(severity).alias("severity"),
        F.lit(kind).alias("object_type"),
        "database_name",
        "table_name",
        column.alias("column_name"),
        path.alias("full_path"),
        F.lit(details).alias("violation_details"),
        F.lit("new").alias("status"),
    )


def comment_violations(columns: DataFrame) -> DataFrame:
    """Tables (high) and columns (medium) without a comment."""
    tables = columns.groupBy("database_name", "table_name").agg(F.max("table_comment").alias("table_comment"))
    bare_tables = tables.filter(_blank("table_comment"))
    bare_columns = _described(columns).filter(_blank("column_comment"))
    policy = "DDL Comments Required"
    return union_all(
        [
            _violation(bare_tables, policy, "high", "table", full_path("database_name", "table_name"), "Table has no DDL comment"),
            _violation(
                bare_columns, policy, "medium", "column", full_path("database_name", "table_name", "column_name"),
                "Column has no DDL comment",
            ),
        ]
    )


def verified_links(links: DataFrame) -> DataFrame:
    """Manual and automatically approved links count as verified."""
    return links.filter(F.col("verified") | F.col("linkage_type").isin("manual", "auto_approved"))


def definition_violations(columns: DataFrame, links: DataFrame) -> DataFrame:
    """Columns without a verified glossary term."""
    with_path = _described(columns).withColumn("full_path", full_path("database_name", "table_name", "column_name"))
    lacking = with_path.join(verified_links(links).select("full_path").distinct(), "full_path", "left_anti")
    return _violation(
        lacking, "Business Definitions Required", "medium", "column", F.col("full_path"),
        "Column not linked to business glossary term",
    )


def compliance_scorecard(columns: DataFrame, links: DataFrame, violations: DataFrame) -> DataFrame:
    """Per table: 40 points for commented columns, 60 for linked ones, and open violations."""
    keys = ["database_name", "table_name"]
    base = _described(columns).groupBy(*keys).agg(
        F.count("*").alias("total_columns"), F.count_if(~_blank("column_comment")).alias("columns_with_comments")
    )
    linked = verified_links(links).groupBy(*keys).agg(F.countDistinct("full_path").alias("columns_with_glossary_terms"))
    open_violations = violations.filter(F.col("status") == "new").groupBy(*keys).agg(
        *[F.count_if(F.col("severity") == s).alias(f"violations_{s}") for s in SEVERITIES]
    )
    counts = ["columns_with_glossary_terms", *[f"violations_{s}" for s in SEVERITIES]]
    joined = base.join(linked, keys, "left").join(open_violations, keys, "left").fillna(0, counts)
    score = (
        F.col("columns_with_comments") / F.col("total_columns") * 40
        + F.col("columns_with_glossary_terms") / F.col("total_columns") * 60
    )
    return joined.withColumn("compliance_score", F.round(score, 2))


#: Letters of the grams by which names are looked up.
GRAM = 3

#: Places in which the grams of outer names are counted; grams that share a place share its count.
PLACES = 1 << 16

#: Letters of a name, from its start, among which its rarest gram is sought.
REACH = 1 << 20


def _pieces(name: str, size: int) -> Column:
    """The different substrings of ``size`` letters of a name, as rows."""
    n = F.length(name)
    every = F.transform(F.sequence(F.lit(1), n - (size - 1)), lambda i: F.substr(F.col(name), i, F.lit(size)))
    return F.explode(F.when(n >= size, F.array_distinct(every)))


def _place(gram: Column) -> Column:
    return F.pmod(F.hash(gram), F.lit(PLACES))


def _gram_counts(outer: DataFrame) -> DataFrame:
    """How often trigrams of each place occur in the outer names: one row with an array of ``PLACES`` counts, whatever the input."""
    at = F.explode(F.sequence(F.lit(1), F.length("outer") - (GRAM - 1))).alias("_at")
    grams = outer.filter(F.length("outer") >= GRAM).select("outer", at).select(_place(F.substr("outer", "_at", F.lit(GRAM))).alias("_place"), F.lit(1).alias("_n"))
    none = outer.sparkSession.range(PLACES).select(F.col("id").cast("int").alias("_place"), F.lit(0).alias("_n"))
    counts = grams.unionAll(none).groupBy("_place").agg(F.sum("_n").alias("_n"))
    return counts.agg(F.sort_array(F.collect_list(F.struct("_place", "_n"))).alias("_t")).select(F.col("_t._n").alias("_counts"))


def rarest_grams(inner: DataFrame, outer: DataFrame) -> DataFrame:
    """Each inner name of three letters or more with one of its trigrams, ``_gram``, in the place that the fewest outer names reach.

    Names with a trigram that no outer name can have are left out. The trigram is picked inside the name's row, so nothing is
    sorted or kept for the names of a task; count and position are one number for that.
    """
    n = F.length("inner")
    at = F.sequence(F.lit(1), F.least(n - (GRAM - 1), F.lit(REACH)))
    rank = F.array_min(F.transform(at, lambda i: F.get("_counts", _place(F.substr("inner", i, F.lit(GRAM)))) * REACH + i - 1))
    ranked = with_one_row(inner.filter(n >= GRAM), _gram_counts(outer)).select("inner", rank.alias("_rank"))
    # exploded, as a filter of the bare column would be pushed down and rank each name twice
    kept = ranked.select("inner", F.explode(F.array("_rank")).alias("_rank")).filter(F.col("_rank") >= REACH)
    return kept.select("inner", F.substr("inner", (F.col("_rank") % REACH + 1).cast("int"), F.lit(GRAM)).alias("_gram"))


def contained_names(inner: DataFrame, outer: DataFrame) -> DataFrame:
    """Pairs (``inner``, ``outer``) of distinct names in which the first, not empty, is a part of the second.

    A name can only lie where each of its trigrams does, so it is looked up under a rare one of them (:func:`rarest_grams`),
    and not at all if one of its trigrams occurs nowhere. An outer name has a row for each of its
    trigrams, not for each substring. Names of one and two letters have an index of their own.
    """
    grams = outer.select("outer", _pieces("outer", GRAM).alias("_gram"))
    long = rarest_grams(inner, outer).join(grams, "_gram").filter(F.col("outer").contains(F.col("inner"))).select("inner", "outer")
    parts = [outer.select(_pieces("outer", size).alias("inner"), "outer") for size in range(1, GRAM)]
    return reduce(DataFrame.unionAll, parts).join(inner, "inner").select("inner", "outer").unionAll(long)


def auto_links(terms: DataFrame, columns: DataFrame, least: int = 1) -> DataFrame:
    """Links suggested by names: equal (1.0, approved) or one contained in the other (0.7).

    A contained name must have at least ``least`` letters (equal names always count): names of one or two letters are
    part of nearly every other, so at scale three or more are wanted. Contained names are found by
    :func:`contained_names`, so no term is paired with every column. Rows are reduced to distinct names before, which
    are stored: read by each branch, they are expanded in tasks of a file's share and not where they were made distinct.
    """
    t = terms.filter(F.col("status") == "published").select("term_id", F.lower("term_name").alias("t"))
    named = _described(columns).withColumn("c", F.lower("column_name"))
    c, term_names = cut_lineage(named.select("c").distinct()), cut_lineage(t.select("t").distinct())
    long_enough = lambda name: F.length(name) >= least
    of_terms = contained_names(term_names.select(F.col("t").alias("inner")).filter(long_enough("inner")), c.select(F.col("c").alias("outer")))
    of_columns = contained_names(c.select(F.col("c").alias("inner")).filter(long_enough("inner")), term_names.select(F.col("t").alias("outer")))
    apart = F.col("inner") != F.col("outer")
    pairs = term_names.join(c, F.col("t") == F.col("c")).select("t", "c")
    pairs = pairs.unionAll(of_terms.filter(apart).select(F.col("inner").alias("t"), F.col("outer").alias("c")))
    pairs = pairs.unionAll(of_columns.filter(apart).select(F.col("outer").alias("t"), F.col("inner").alias("c")))
    exact = F.col("t") == F.col("c")
    return (
        pairs.join(t, "t")
        # a file of few megabytes may hold millions of columns, too many to be broadcast
        .join(named.hint("merge"), "c")
        .select(
            "term_id",
            "database_name",
            "table_name",
            "column_name",
            full_path("database_name", "table_name", "column_name").alias("full_path"),
            F.when(exact, 1.0).otherwise(0.7).alias("confidence_score"),
            F.when(exact, "auto_approved").otherwise("auto_suggested").alias("linkage_type"),
            exact.alias("verified"),
        )
    )


def search_terms(terms: DataFrame, keyword: str) -> DataFrame:
    """Published terms with the keyword in name or definitions, or among the tags."""
    low = keyword.lower()
    text = F.lit(False)
    for c in ("term_name", "definition", "business_definition"):
        text = text | F.coalesce(F.lower(c).contains(low), F.lit(False))
    tagged = F.coalesce(F.array_contains("tags", keyword), F.lit(False))
    return terms.filter((F.col("status") == "published") & (text | tagged))


def create_terms(spark: SparkSession, rows: Sequence[Mapping], at: Column) -> DataFrame:
    """Draft terms, version 1, with an id derived from the name."""
    schema = "term_name string, definition string, category string, domain string, business_definition string, tags array<string>"
    names = [f.split()[0] for f in schema.split(", ")]
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
    return df.withColumns(
        {
            "term_id": F.concat(F.lit("TERM_"), F.md5(F.lower("term_name"))),
            "status": F.lit("draft"),
            "version": F.lit(1),
            "created_at": at,
        }
    )


def approve_term(terms: DataFrame, term_id: str, at: Column) -> DataFrame:
    """Publish a term and raise its version."""
    hit = F.col("term_id") == term_id
    return conditional_update(
        terms, hit, {"status": F.lit("published"), "version": F.col("version") + 1, "created_at": at}
    )


def link_term(terms: DataFrame, term_id: str, database: str, table: str, column: str, linkage_type: str = "manual",
              confidence: float = 1.0) -> DataFrame:
    """Link row from a term to a column; manual and auto-approved links are verified."""
    return terms.filter(F.col("term_id") == term_id).select(
        F.concat(F.lit("LINK_"), F.md5(F.concat_ws("|", "term_id", F.lit(f"{database}.{table}.{column}")))).alias("linkage_id"),
        "term_id",
        F.lit(database).alias("database_name"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(f"{database}.{table}.{column}").alias("full_path"),
        F.lit(float(confidence)).alias("confidence_score"),
        F.lit(linkage_type).alias("linkage_type"),
        F.lit(linkage_type in ("manual", "auto_approved")).alias("verified"),
    )


def create_policy(spark: SparkSession, name: str, kind: str, description: str, severity: str = "high",
                  validation_query: str | None = None) -> DataFrame:
    schema = (
        "policy_name string, policy_type string, description string, severity string, enabled boolean, "
        "scope string, validation_query string"
    )
    df = spark.createDataFrame([(name, kind, description, severity, True, "all", validation_query)], schema)
    return df.withColumn("policy_id", F.concat(F.lit("POLICY_"), F.md5("policy_name")))


def term_lineage(links: DataFrame, terms: DataFrame) -> DataFrame:
    """Physical columns of each term, and by the same rows the terms of each column."""
    return links.join(terms.select("term_id", "term_name", "definition"), "term_id").select(
        "term_id", "term_name", "definition", "database_name", "table_name", "column_name", "full_path",
        "confidence_score", "linkage_type", "verified",
    )


def pending_review(links: DataFrame, terms: DataFrame) -> DataFrame:
    """Suggested links nobody has verified."""
    return term_lineage(links, terms).filter((F.col("linkage_type") == "auto_suggested") & ~F.col("verified"))


def term_versions(terms: DataFrame, at: Column) -> DataFrame:
    """Version rows of the terms, as kept in the history table."""
    return terms.select("term_id", "version", "status", "term_name", "definition", at.alias("recorded_at"))


def similar_columns(columns: DataFrame, token: str) -> DataFrame:
    """Columns one of whose name tokens is the given word."""
    return columns.filter(F.array_contains(F.split(F.lower("column_name"), "[_ ]"), token.lower()))


def token_overlap(a: Column, b: Column) -> Column:
    """Jaccard overlap of the name tokens of two columns."""
    x, y = F.split(F.lower(a), "[_ ]"), F.split(F.lower(b), "[_ ]")
    return F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))


def without_exceptions(violations: DataFrame, exceptions: DataFrame, as_of: Column) -> DataFrame:
    """Violations not covered by an unexpired exception."""
    active = exceptions.filter(F.col("expiration_date") >= as_of.cast("date"))
    paths = active.select(full_path("database_name", "table_name", "column_name").alias("full_path")).distinct()
    return violations.join(paths, "full_path", "left_anti")


def custom_violations(spark: SparkSession, policies: Sequence[Mapping]) -> DataFrame:
    """Run each enabled policy's own query over registered views.

    A query returns ``database_name, table_name, violation_details``.
    """
    return union_all(
        [
            spark.sql(p["validation_query"]).select(
                F.lit(p["policy_name"]).alias("policy_name"),
                F.lit(p["severity"]).alias("severity"),
                "database_name", "table_name", "violation_details",
            )
            for p in policies
            if p.get("enabled", True)
        ]
    )


def import_terms(df: DataFrame, at: Column) -> DataFrame:
    """Glossary rows from a file with tags separated by ``|``; imported terms are published."""
    return df.select(
        F.concat(F.lit("TERM_"), F.md5(F.lower("term_name"))).alias("term_id"),
        "term_name", "definition", "business_definition", "category", "domain",
        F.when(F.length("tags") > 0, F.split("tags", r"\|")).otherwise(F.array().cast("array<string>")).alias("tags"),
        F.lit("published").alias("status"),
        F.lit(1).alias("version"),
        at.alias("created_at"),
    )


def lineage_with_terms(lineage: DataFrame, links: DataFrame, terms: DataFrame) -> DataFrame:
    """Lineage rows with the published terms of their target table."""
    tables = links.select(full_path("database_name", "table_name").alias("target_table"), "term_id").distinct()
    published = terms.filter(F.col("status") == "published").select("term_id", "term_name", "definition")
    return lineage.join(tables, "target_table").join(published, "term_id")


def violations_by_severity(violations: DataFrame) -> DataFrame:
    """Open violations per severity, most severe first by ``severity_order``."""
    return (
        violations.filter(F.col("status") == "new")
        .groupBy("severity")
        .agg(
            F.count("*").alias("violation_count"),
            F.countDistinct("database_name").alias("affected_databases"),
            F.countDistinct("table_name").alias("affected_tables"),
        )
        .withColumn("severity_order", rank_of(F.col("severity"), SEVERITIES))
        .orderBy("severity_order")
    )


def worst_tables(violations: DataFrame, n: int = 10) -> DataFrame:
    counted = violations.filter(F.col("status") == "new").groupBy("database_name", "table_name").agg(
        F.count("*").alias("violation_count"),
        *[F.count_if(F.col("severity") == s).alias(f"{s}_count") for s in SEVERITIES[:3]],
    )
    return top(counted, [F.col("violation_count").desc(), F.col("database_name"), F.col("table_name")], n)


def glossary_coverage(scorecard: DataFrame) -> DataFrame:
    return scorecard.groupBy("database_name").agg(
        F.countDistinct("table_name").alias("total_tables"),
        F.countDistinct(F.when(F.col("columns_with_glossary_terms") > 0, F.col("table_name"))).alias("tables_with_glossary"),
        F.round(mean(F.col("compliance_score").cast("decimal(18,2)")), 2).alias("avg_compliance_score"),
        F.sum("total_columns").alias("total_columns"),
        F.sum("columns_with_comments").alias("columns_with_comments"),
        F.sum("columns_with_glossary_terms").alias("columns_with_glossary"),
    )


def compliance_summary(scorecard: DataFrame) -> DataFrame:
    return scorecard.agg(
        F.countDistinct("database_name").alias("databases_scanned"),
        F.count("*").alias("total_tables"),
        F.sum("total_columns").alias("total_columns"),
        F.sum("columns_with_comments").alias("columns_documented"),
        F.sum("columns_with_glossary_terms").alias("columns_with_glossary"),
        F.round(mean(F.col("compliance_score").cast("decimal(18,2)")), 2).alias("avg_compliance_score"),
        F.sum("violations_critical").alias("critical_violations"),
        F.sum("violations_high").alias("high_violations"),
    )


def compliance_by_day(scorecards: DataFrame, scanned_at: str, n: int = 30) -> DataFrame:
    daily = scorecards.groupBy(F.col(scanned_at).cast("date").alias("scan_date")).agg(
        F.count("*").alias("tables_scanned"),
        F.round(mean(F.col("compliance_score").cast("decimal(18,2)")), 2).alias("avg_compliance_score"),
        F.sum(F.col("violations_critical") + F.col("violations_high")).alias("total_violations"),
    )
    return top(daily, [F.col("scan_date").desc()], n)


def run_policies(columns: DataFrame, links: DataFrame) -> DataFrame:
    """Violations of both built-in policies, one per policy and object."""
    every = comment_violations(columns).unionByName(definition_violations(columns, links))
    return keep_max_per_group(every, ["policy_name", "full_path"], "violation_id")


def governance_alerts(scorecard: DataFrame, violations: DataFrame, min_score: float = 60.0) -> DataFrame:
    """One row: tables of low compliance, open critical violations, verdict."""
    low = scorecard.agg(
        F.count_if(F.col("compliance_score") < min_score).alias("low_compliance_tables"),
        mean(F.col("compliance_score").cast("decimal(18,2)")).alias("avg_compliance"),
    )
    critical = violations.agg(
        F.count_if((F.col("severity") == "critical") & (F.col("status") == "new")).alias("critical_violations"),
        F.count_if(F.col("status") == "new").alias("open_violations"),
    )
    return with_one_row(low, critical).withColumn(
        "status", F.when(F.col("critical_violations") == 0, "healthy").otherwise("degraded")
    )


def governance_tile(terms: DataFrame, links: DataFrame, scorecard: DataFrame) -> DataFrame:
    """Glossary counters for the dashboard, each counted on its own table."""
    t = terms.agg(
        F.countDistinct("term_id").alias("total_terms"),
        F.countDistinct(F.when(F.col("status") == "published", F.col("term_id"))).alias("published_terms"),
    )
    links_ = links.agg(F.count("*").alias("total_linkages"))
    s = scorecard.agg(
        F.countDistinct("database_name", "table_name").alias("tables_scanned"),
        F.round(mean(F.col("compliance_score").cast("decimal(18,2)")), 1).alias("avg_compliance"),
    )
    return with_one_row(with_one_row(t, links_), s)


# ---- data products -------------------------------------------------------------------


def build_product(df: DataFrame, product: Mapping) -> DataFrame:
    """A curated product: selected columns, personal data masked, aggregated if so defined."""
    out = df.select(*product["columns"]) if product.get("columns") else df
    if product.get("pii_removed"):
        out = security.mask_table(out, product.get("masks", ()), product["product_id"], "all")
        drop = [c for c in security.personal_columns(out.columns) if c not in {m["column_name"] for m in product.get("masks", ())}]
        out = out.drop(*drop)
    if product.get("group_by"):
        out = out.groupBy(*product["group_by"]).agg(*[F.expr(e).alias(n) for n, e in product["measures"].items()])
    return out


def product_usage(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Monthly use and charge per product and consumer; usage is summed before the price join."""
    monthly = usage.groupBy("product_id", "consumer", F.trunc(F.col("usage_date"), "month").alias("usage_month")).agg(
        F.sum("query_count").alias("query_count"),
        F.sum("rows_accessed").alias("rows_accessed"),
        F.sum("data_volume_bytes").alias("data_volume_bytes"),
    )
    return monthly.join(prices, "product_id", "left").withColumn(
        "billing_amount", F.col("query_count") * F.coalesce(F.col("price_per_query"), F.lit(0.0))
    )
