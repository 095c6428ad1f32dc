"""Column profiles, semantic types, quality dimensions, issues and workspace summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.functions.hashing import hash_share
from lodestrata.operators.aggregates import band, top_per_group, union_all

# Keyword in a column name, in the order tried, and the meaning it gives.
SEMANTIC_TYPES = (
    ("email", "email"),
    ("phone", "phone"),
    ("mobile", "phone"),
    ("ssn", "ssn"),
    ("social_security", "ssn"),
    ("zip", "postal_code"),
    ("postal", "postal_code"),
    ("address", "address"),
    ("name", "person_name"),
    ("amount", "currency"),
    ("premium", "currency"),
    ("price", "currency"),
    ("id", "identifier"),
    ("date", "datetime"),
    ("time", "datetime"),
)
# Weights of the quality dimensions.
DIMENSION_WEIGHTS = {
    "completeness": 0.25,
    "accuracy": 0.25,
    "consistency": 0.15,
    "timeliness": 0.10,
    "validity": 0.15,
    "uniqueness": 0.10,
}


def _numeric(f: T.StructField) -> bool:
    return isinstance(f.dataType, T.NumericType)


def _scalar(f: T.StructField) -> bool:
    return not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))


def sample_rows(df: DataFrame, keys: Sequence[str], fraction: float) -> DataFrame:
    """A Bernoulli sample by a hash of the key: the same rows at every run, of tables of any size."""
    return df.filter(hash_share(keys) < fraction)


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in an order, for a preview."""
    return df.orderBy(*order).limit(n)


def column_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, n): every distinct value of every column, counted map-side first."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.inline(cells)).groupBy("column_name", "value").agg(F.count("*").alias("n"))


def profile_columns(df: DataFrame, approximate: bool = False, rsd: float = 0.03) -> DataFrame:
    """One row per column: nulls, distinct values, cardinality class, numeric statistics.

    Two aggregations for all columns together: one over the cells (distinct values, nulls)
    and one over the numeric columns. ``approximate`` replaces exact distinct counts with
    sketches, so that no value is shuffled at all.
    """
    fields = [f for f in df.schema.fields if _scalar(f)]
    names = [f.name for f in fields]
    numeric = [f.name for f in fields if _numeric(f)]
    if approximate:
        one = df.agg(
            F.count(F.lit(1)).alias("_total"),
            *[F.approx_count_distinct(c, rsd).alias(f"d_{c}") for c in names],
            *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in names],
        )
        counts = one.select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(c).alias("column_name"),
                            F.col("_total").alias("total_rows"),
                            F.col(f"n_{c}").alias("null_count"),
                            (F.col(f"d_{c}") + F.when(F.col(f"n_{c}") > 0, 1).otherwise(0)).alias("distinct_count"),
                        )
                        for c in names
                    ]
                )
            )
        )
    else:
        counts = column_values(df, names).groupBy("column_name").agg(
            F.sum("n").alias("total_rows"),
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("null_count"),
            F.count(F.lit(1)).alias("distinct_count"),
        )
    ratio = F.col("distinct_count") / F.col("total_rows")
    out = counts.withColumns(
        {
            "null_percentage": F.lit(100.0) * F.col("null_count") / F.col("total_rows"),
            "cardinality": band(ratio, ((0.95, "high"), (0.5, "medium")), "low"),
        }
    )
    if numeric:
        stats = df.agg(
            *[fn(F.col(c).cast("double")).alias(f"{tag}_{c}") for c in numeric for tag, fn in
              (("lo", F.min), ("hi", F.max), ("mean", F.avg), ("sd", F.stddev))]
        ).select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(c).alias("column_name"),
                            F.col(f"lo_{c}").alias("min_value"),
                            F.col(f"hi_{c}").alias("max_value"),
                            F.col(f"mean_{c}").alias("avg_value"),
                            F.col(f"sd_{c}").alias("std_dev"),
                        )
                        for c in numeric
                    ]
                )
            )
        )
        out = out.join(stats, "column_name", "left")
    return out


def top_values(df: DataFrame, columns: Sequence[str], n: int = 5) -> DataFrame:
    """The ``n`` most frequent values of every column, all columns in one job."""
    values = column_values(df, columns)
    return top_per_group(values, ["column_name"], [F.col("n").desc(), F.col("value").asc_nulls_first()], n)


def semantic_type(name: Column) -> Column:
    """Meaning suggested by a column name."""
    lowered, out = F.lower(name), None
    for keyword, meaning in SEMANTIC_TYPES:
        hit = lowered.contains(keyword)
        out = F.when(hit, meaning) if out is None else out.when(hit, meaning)
    return out.otherwise("unknown")


def value_shape(c: Column) -> Column:
    """Format of a value: letters as ``A``, digits as ``9``, repeats collapsed."""
    text = F.regexp_replace(F.regexp_replace(c.cast("string"), "[A-Za-z]+", "A"), "[0-9]+", "9")
    return text


def consistency_pct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of the dominant format among the non-null values of each column, in percent."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), value_shape(F.col(c)).alias("shape")) for c in columns])
    shapes = df.select(F.inline(cells)).filter("shape IS NOT NULL").groupBy("column_name", "shape").agg(F.count("*").alias("n"))
    return shapes.groupBy("column_name").agg(
        (F.lit(100.0) * F.max("n") / F.sum("n")).alias("consistency")
    )


def timeliness_score(days_old: Column) -> Column:
    return (
        F.when(days_old <= 0, 100.0).when(days_old <= 1, 95.0).when(days_old <= 7, 85.0).when(days_old <= 30, 70.0).otherwise(50.0)
    )


def quality_dimensions(
    profile: DataFrame,
    table_name: str,
    accuracy: Column,
    consistency: Column,
    validity: Column,
    days_old: Column,
) -> DataFrame:
    """Six-dimension score of one table from its profile and the measured dimensions."""
    is_id = F.lower("column_name").contains("id")
    uniqueness = F.coalesce(
        F.avg(F.when(is_id, F.when(F.col("cardinality") == "high", 100.0).otherwise(50.0))), F.lit(100.0)
    )
    scored = profile.agg(
        F.coalesce(F.avg(100.0 - F.col("null_percentage")), F.lit(0.0)).alias("completeness"),
        uniqueness.alias("uniqueness"),
    ).withColumns(
        {
            "accuracy": accuracy,
            "consistency": consistency,
            "validity": validity,
            "timeliness": timeliness_score(days_old),
        }
    )
    overall = sum((F.col(d) * w for d, w in DIMENSION_WEIGHTS.items()), F.lit(0.0))
    return scored.select(F.lit(table_name).alias("table_name"), overall.alias("overall_score"), *DIMENSION_WEIGHTS)


def quality_issues(profile: DataFrame) -> DataFrame:
    """Issue rows of a profile: many NULLs, repeated ids, personal data."""
    kind = semantic_type(F.col("column_name"))
    is_id = F.lower("column_name").contains("id")

    def issue(when: Column, severity: Column, text: str) -> Column:
        return F.when(when, F.struct(severity.alias("severity"), F.lit(text).alias("issue")))

    issues = F.array_compact(
        F.array(
            issue(
                F.col("null_percentage") > 20,
                F.when(F.col("null_percentage") > 50, "high").otherwise("medium"),
                "high_null_percentage",
            ),
            issue(is_id & (F.col("cardinality") != "high"), F.lit("high"), "id_not_unique"),
            issue(kind.isin("ssn", "email", "phone"), F.lit("medium"), "pii_detected"),
        )
    )
    return profile.select("column_name", F.inline(issues))


def layer_criticality(name: Column) -> Column:
    """Criticality suggested by the name of a table."""
    lowered = F.lower(name)
    return (
        F.when(lowered.rlike("gold|fact|dim"), "critical")
        .when(lowered.contains("silver"), "high")
        .when(lowered.contains("bronze"), "medium")
        .otherwise("unknown")
    )


def asset_criticality(name: Column, kind: Column) -> Column:
    """Criticality of a monitored asset from its name, then its type."""
    lowered = F.lower(name)
    return (
        F.when(lowered.rlike("prod|gold|finance|regulatory|claims"), "critical")
        .when(lowered.rlike("silver|billing|customer"), "high")
        .when(F.lower(kind).isin("pipeline", "semanticmodel"), "high")
        .otherwise("medium")
    )


def business_impact(criticality: Column, score: Column) -> Column:
    return (
        F.when((criticality == "critical") & (score < 80), "HIGH")
        .when((criticality == "high") & (score < 70), "MEDIUM")
        .otherwise("LOW")
    )


def insight(score: Column) -> Column:
    return F.when(score >= 90, "excellent").when(score >= 75, "good").otherwise("needs_improvement")


def recommendations(issues: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts that call for action and the recommendations they trigger."""
    counted = issues.groupBy(*by).agg(
        F.count_if(F.col("severity") == "high").alias("high_issues"),
        F.count_if(F.col("issue") == "high_null_percentage").alias("null_issues"),
        F.count_if(F.col("issue") == "pii_detected").alias("pii_issues"),
    )
    actions = F.array_compact(
        F.array(
            F.when(F.col("high_issues") > 0, "address_high_severity_issues"),
            F.when(F.col("null_issues") > 3, "investigate_data_collection"),
            F.when(F.col("pii_issues") > 0, "mask_pii_columns"),
        )
    )
    return counted.withColumn(
        "actions", F.when(F.size(actions) > 0, actions).otherwise(F.array(F.lit("continue_monitoring")))
    )


def workspace_summary(assessments: DataFrame, issues: DataFrame, profiles: DataFrame) -> DataFrame:
    """One row over all profiled tables."""
    a = assessments.agg(F.count("*").alias("assets_profiled"), F.avg("overall_score").alias("avg_quality_score"))
    columns = profiles.agg(F.count("*").alias("columns_analyzed"))
    critical = issues.agg(F.count_if(F.col("severity") == "high").alias("critical_issues"))
    return a.withColumns(
        {"columns_analyzed": columns.select("columns_analyzed").scalar(), "critical_issues": critical.select("critical_issues").scalar()}
    )


def profile_tables(tables: Mapping[str, DataFrame], approximate: bool = False) -> DataFrame:
    """Profiles of several tables in one frame (numeric statistics NULL where not numeric)."""
    parts = []
    for name, df in tables.items():
        p = profile_columns(df, approximate)
        for c in ("min_value", "max_value", "avg_value", "std_dev"):
            if c not in p.columns:
                p = p.withColumn(c, F.lit(None).cast("double"))
        parts.append(p.withColumn("table_name", F.lit(name)))
    return union_all(parts)
