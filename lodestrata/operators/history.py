"""De-duplication, type 1 and type 2 history, change feed, snapshots, retention."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lodestrata.functions.hashing import business_columns, row_hash

OPEN_END = "9999-12-31"


def keep_latest(df: DataFrame, keys: Sequence[str], newest: Sequence[Column]) -> DataFrame:
    """One row per key, the first under ``newest``.

    ``row_number() = 1`` is planned with a rank limit in front of the shuffle: each map task
    sends at most one row per key, so a key holding a third of the table is no hot task.
    """
    w = Window.partitionBy(*keys).orderBy(*newest)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def with_row_hash(df: DataFrame, columns: Sequence[str] | None = None, name: str = "_record_hash") -> DataFrame:
    return df.withColumn(name, row_hash(columns or business_columns(df)))


def _pair(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join of two one-row-per-key tables as two structs ``t`` and ``s``."""
    t = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys], F.struct("*").alias("t"))
    s = source.select(*[F.col(k).alias(f"_s_{k}") for k in keys], F.struct("*").alias("s"))
    cond = [F.col(f"_t_{k}") == F.col(f"_s_{k}") for k in keys]
    return t.join(s, cond, "full").select("t", "s")


def scd1_merge(target: DataFrame, source: DataFrame, keys: Sequence[str], hash_col: str = "_record_hash") -> DataFrame:
    """New snapshot of ``target``: changed rows replaced, new keys added, the rest kept."""
    both = _pair(target, source.select(*target.columns), keys)
    changed = F.col(f"t.{hash_col}").isNull() | (F.col(f"s.{hash_col}") != F.col(f"t.{hash_col}"))
    keep_source = F.col("s").isNotNull() & changed
    return both.select(F.when(keep_source, F.col("s")).otherwise(F.col("t")).alias("r")).select("r.*")


def open_version(source: DataFrame, as_of: Column) -> DataFrame:
    """Source rows as current versions valid from ``as_of``."""
    return source.withColumns(
        {
            "_effective_from": as_of,
            "_effective_to": F.lit(OPEN_END).cast(T.TimestampNTZType()),
            "_is_current": F.lit(True),
        }
    )


def scd2_merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    as_of: Column,
    hash_col: str = "_record_hash",
) -> DataFrame:
    """Next snapshot of a type 2 table, ``source`` holding one row per key.

    Closed versions are passed through without a shuffle. Only current versions meet the
    source in one full outer join: an unchanged key keeps its row, a changed key gives its
    closed row and a new one, a new key gives a new row. Running it twice changes nothing,
    and a source older than the current version is ignored. Keys must not be NULL: as in a
    SQL MERGE, NULL equals no key.
    """
    closed = target.filter(~F.col("_is_current"))
    incoming = open_version(source, as_of).select(*target.columns)
    both = _pair(target.filter(F.col("_is_current")), incoming, keys)
    changed = (
        F.col("t").isNotNull()
        & F.col("s").isNotNull()
        & (F.col(f"s.{hash_col}") != F.col(f"t.{hash_col}"))
        & (F.col("s._effective_from") > F.col("t._effective_from"))
    )
    old = (
        F.col("t")
        .withField("_effective_to", F.col("s._effective_from"))
        .withField("_is_current", F.lit(False))
    )
    rows = (
        F.when(changed, F.array(old, F.col("s")))
        .when(F.col("t").isNotNull(), F.array(F.col("t")))
        .otherwise(F.array(F.col("s")))
    )
    merged = both.select(F.explode(rows).alias("r")).select("r.*")
    return closed.unionByName(merged.select(*target.columns))


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str], hash_col: str = "_record_hash") -> DataFrame:
    """Row changes between two snapshots with ``_change_type``, pre- and post-images included."""
    both = _pair(old, new.select(*old.columns), keys)

    def image(side: str, kind: str) -> Column:
        return F.struct(F.col(side).alias("r"), F.lit(kind).alias("_change_type"))

    differs = F.col(f"t.{hash_col}") != F.col(f"s.{hash_col}")
    rows = (
        F.when(F.col("t").isNull(), F.array(image("s", "insert")))
        .when(F.col("s").isNull(), F.array(image("t", "delete")))
        .when(differs, F.array(image("t", "update_preimage"), image("s", "update_postimage")))
    )
    return both.select(F.explode(rows).alias("c")).select("c.r.*", "c._change_type")


def bucket_digests(df: DataFrame, keys: Sequence[str], hash_col: str = "_record_hash", buckets: int = 4096) -> DataFrame:
    """``_bucket`` and an order-free digest of its rows (``_rows``, ``_xor``, ``_other``, ``_sum``), at most ``buckets`` rows.

    Rows are counted and folded where they lie, so nothing but the digests is shuffled. Stored beside a snapshot they
    tell later which parts of it have changed.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    row, other = F.xxhash64(*keys, hash_col), F.xxhash64(hash_col, F.lit("again"), *keys)
    return df.groupBy(bucket.alias("_bucket")).agg(
        F.count("*").alias("_rows"), F.bit_xor(row).alias("_xor"), F.bit_xor(other).alias("_other"), F.sum(F.pmod(row, F.lit(1 << 31))).alias("_sum")
    )


def changed_buckets(old: DataFrame, new: DataFrame) -> DataFrame:
    """Buckets whose digests differ, or that one side lacks."""
    marks = [F.struct("_rows", "_xor", "_other", "_sum").alias(side) for side in ("_a", "_b")]
    both = old.select("_bucket", marks[0]).join(new.select("_bucket", marks[1]), "_bucket", "full")
    return both.filter(~F.col("_a").eqNullSafe(F.col("_b"))).select("_bucket")


def rows_of_buckets(df: DataFrame, keys: Sequence[str], wanted: DataFrame, buckets: int = 4096) -> DataFrame:
    """The rows in some of the buckets. ``wanted`` has at most ``buckets`` rows, so it is sent to the rows and they stay in place."""
    placed = df.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    return placed.join(F.broadcast(wanted), "_bucket", "left_semi").drop("_bucket")


def change_feed_by_buckets(
    old: DataFrame, new: DataFrame, keys: Sequence[str], hash_col: str = "_record_hash", buckets: int = 4096,
    old_digests: DataFrame | None = None, new_digests: DataFrame | None = None,
) -> DataFrame:
    """:func:`change_feed` that moves only rows of buckets with another digest; the feed is the same.

    Digests stored with the snapshots (of the same ``buckets``) spare reading the rows for them.
    """
    if not 0 < buckets <= 1 << 16:
        raise ValueError("from 1 to 65536 buckets")
    sides = [d if d is not None else bucket_digests(df, keys, hash_col, buckets) for df, d in ((old, old_digests), (new, new_digests))]
    wanted = changed_buckets(*sides)
    return change_feed(*[rows_of_buckets(df, keys, wanted, buckets) for df in (old, new)], keys, hash_col)


def apply_change_feed(old: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replay a change feed on the snapshot it was taken from."""
    gone = feed.filter(F.col("_change_type").isin("update_preimage", "delete")).select(*keys)
    fresh = feed.filter(F.col("_change_type").isin("insert", "update_postimage")).drop("_change_type")
    return old.join(gone, list(keys), "left_anti").select(*old.columns).unionByName(fresh)


def change_counts(feed: DataFrame) -> DataFrame:
    return feed.groupBy("_change_type").agg(F.count("*").alias("change_count"))


def conditional_update(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Rows meeting ``condition`` take ``values``; one projection, no shuffle."""
    return df.withColumns({name: F.when(condition, value).otherwise(F.col(name)) for name, value in values.items()})


def conditional_delete(df: DataFrame, condition: Column) -> DataFrame:
    """Drop rows meeting ``condition``; rows where it is NULL stay, as in SQL DELETE."""
    return df.filter(~condition | condition.isNull())


def keep_max_per_group(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Of repeated rows keep the one with the largest id."""
    return keep_latest(df, keys, [F.col(id_col).desc()])


# ---- constraints ---------------------------------------------------------------------


def check_constraints(df: DataFrame, constraints: Mapping[str, str]) -> DataFrame:
    """Violations of every CHECK expression, counted in one pass (NULL does not violate)."""
    counts = df.agg(
        *[F.count_if(~F.expr(text)).alias(f"c{i}") for i, text in enumerate(constraints.values())]
    )
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("constraint_name"), F.lit(text).alias("expression"), F.col(f"c{i}").alias("violations"))
            for i, (name, text) in enumerate(constraints.items())
        ]
    )
    return counts.select(F.inline(rows))


def split_by_constraints(df: DataFrame, constraints: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, violating rows)."""
    broken = F.lit(False)
    for text in constraints.values():
        broken = broken | F.coalesce(~F.expr(text), F.lit(False))
    return df.filter(~broken), df.filter(broken)


# ---- snapshots -----------------------------------------------------------------------


def write_snapshot(df: DataFrame, path: str, version: int, taken_at: Column) -> None:
    """Store a version next to the earlier ones; a path being read is never overwritten."""
    (
        df.withColumns({"_version": F.lit(version), "_snapshot_ts": taken_at})
        .write.mode("append")
        .partitionBy("_version")
        .parquet(path)
    )


def read_version(spark: SparkSession, path: str, version: int) -> DataFrame:
    """One version; the filter on the partition column prunes all others."""
    return spark.read.parquet(path).filter(F.col("_version") == version).drop("_version", "_snapshot_ts")


def snapshot_history(df: DataFrame) -> DataFrame:
    return df.groupBy("_version").agg(
        F.min("_snapshot_ts").alias("snapshot_ts"), F.count("*").alias("row_count")
    )


def version_as_of(df: DataFrame, at: Column) -> int | None:
    """Newest version taken at or before ``at`` (a single aggregated value reaches the driver)."""
    return df.filter(F.col("_snapshot_ts") <= at).agg(F.max("_version")).first()[0]


def restore_version(
    spark: SparkSession,
    path: str,
    restored_at: Column,
    version: int | None = None,
    at: Column | None = None,
) -> int:
    """Write an earlier version as the newest one; by default the version before the latest."""
    every = spark.read.parquet(path)
    latest = every.agg(F.max("_version")).first()[0]
    if version is None:
        version = version_as_of(every, at) if at is not None else every.filter(F.col("_version") < latest).agg(
            F.max("_version")
        ).first()[0]
    if version is None:
        raise ValueError("no version to restore")
    write_snapshot(read_version(spark, path, version), path, latest + 1, restored_at)
    return latest + 1


def restore_tables(spark: SparkSession, paths: Sequence[str], before: Column, restored_at: Column) -> dict[str, int]:
    """Restore every table to its newest version strictly before one moment."""
    just_before = before - F.expr("INTERVAL 1 MICROSECOND")
    return {p: restore_version(spark, p, restored_at, at=just_before) for p in paths}


def regulatory_copy(df: DataFrame, regulation: str, version: int, at: Column) -> DataFrame:
    return df.withColumns(
        {"_regulation": F.lit(regulation), "_source_version": F.lit(version), "_snapshot_timestamp": at}
    )


# ---- retention -----------------------------------------------------------------------

# Date columns looked for, in this order.
DATE_COLUMNS = (
    "created_at",
    "_ingestion_timestamp",
    "_silver_load_ts",
    "_gold_load_ts",
    "event_timestamp",
    "posting_date",
    "transaction_date",
    "effective_date",
)


def find_date_column(schema: T.StructType, candidates: Sequence[str] = DATE_COLUMNS) -> str | None:
    """First candidate present, else the first date or timestamp column."""
    names = {f.name.lower(): f.name for f in schema.fields}
    for candidate in candidates:
        if candidate in names:
            return names[candidate]
    dates = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return next((f.name for f in schema.fields if isinstance(f.dataType, dates)), None)


def split_expired(df: DataFrame, date_col: str, as_of: Column, retention_days: int) -> tuple[DataFrame, DataFrame]:
    """(kept, expired) by age; a row without a date is kept."""
    cutoff = F.date_sub(as_of.cast("date"), retention_days)
    kind = df.schema[date_col].dataType
    # the bare column on one side, so that the scan can skip what the other side rules out
    dated = F.col(date_col) if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) else F.col(date_col).cast("date")
    cutoff = cutoff.cast(kind) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else cutoff
    return df.filter((dated >= cutoff) | dated.isNull()), df.filter(dated < cutoff)


def archive_rows(expired: DataFrame, at: Column, snapshot: bool = False) -> DataFrame:
    return expired.withColumn("_snapshot_at" if snapshot else "_archived_at", at)


def retention_report(tables: Mapping[str, DataFrame], policies: Sequence[Mapping], as_of: Column) -> DataFrame:
    """One row per active policy: rows past retention and the action they call for.

    Each table is read once for one conditional count over its date column alone.
    """
    parts = []
    for policy in policies:
        if not policy.get("is_active", True):
            continue
        name = policy["table_name"]
        df = tables.get(name)
        date_col = find_date_column(df.schema, policy.get("date_columns", DATE_COLUMNS)) if df is not None else None
        base = [F.lit(name).alias("table_name"), F.lit(policy["action"]).alias("action")]
        if date_col is None:
            anchor = next(iter(tables.values())).sparkSession.range(1)
            status = "no_date_column" if df is not None else "missing_table"
            parts.append(
                anchor.select(
                    *base, F.lit(0).cast("bigint").alias("total_rows"),
                    F.lit(0).cast("bigint").alias("expired_rows"), F.lit(status).alias("status"),
                )
            )
            continue
        cutoff = F.date_sub(as_of.cast("date"), int(policy["retention_days"]))
        counted = df.agg(
            F.count("*").alias("total_rows"),
            F.count_if(F.col(date_col).cast("date") < cutoff).alias("expired_rows"),
        )
        status = F.when(F.col("expired_rows") > 0, F.lit(policy["action"])).otherwise(F.lit("nothing_due"))
        parts.append(counted.select(*base, "total_rows", "expired_rows", status.alias("status")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def run_retention(df: DataFrame, policy: Mapping, date_col: str, as_of: Column, archive_path: str, keep_path: str) -> None:
    """Carry out one policy: archive and/or drop expired rows, writing the kept rows anew."""
    kept, expired = split_expired(df, date_col, as_of, int(policy["retention_days"]))
    if policy["action"] in ("archive", "snapshot"):
        archive_rows(expired, as_of, policy["action"] == "snapshot").write.mode("append").parquet(archive_path)
    if policy["action"] in ("archive", "delete"):
        kept.write.mode("errorifexists").parquet(keep_path)
