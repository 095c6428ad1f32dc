"""Sinks: tables by load mode, exports by file format, layout jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Rule = Mapping[str, Any]


def write_load(df: DataFrame, path: str, mode: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """``full`` replaces the target, ``partitions`` only the partitions present in ``df``, other modes append.

    ``df`` must not read the target: a replaced folder is gone before it is written.
    """
    replace = mode in ("full", "partitions")
    writer = df.write.format(fmt).mode("overwrite" if replace else "append")
    if replace:
        writer = writer.option("partitionOverwriteMode", "static" if mode == "full" else "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def _files(df: DataFrame, single_file: bool, files: int | None) -> DataFrame:
    """One file only on request: it sends every row through one task."""
    if single_file:
        return df.coalesce(1)
    return df.repartition(files) if files else df


def export_csv(
    df: DataFrame,
    path: str,
    sep: str = ",",
    header: bool = True,
    quote_all: bool = False,
    single_file: bool = False,
    files: int | None = None,
    compression: str | None = None,
) -> None:
    writer = _files(df, single_file, files).write.mode("overwrite")
    writer = writer.options(sep=sep, header=str(header).lower(), quoteAll=str(quote_all).lower())
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)


def export_json(df: DataFrame, path: str, single_file: bool = False, files: int | None = None) -> None:
    _files(df, single_file, files).write.mode("overwrite").json(path)


def fixed_width_line(widths: Mapping[str, int], cut: bool = False) -> Column:
    """Fields blank-padded to their widths and put side by side.

    A value longer than its field is an error; with ``cut`` it loses its end.
    """

    def field(name: str, width: int) -> Column:
        text = F.coalesce(F.col(name).cast("string"), F.lit(""))
        if not cut:
            problem = F.concat(F.lit(f"value of {name} is longer than {width}: "), text)
            text = F.when(F.length(text) > width, F.raise_error(problem).cast("string")).otherwise(text)
        return F.rpad(F.substring(text, 1, width), width, " ")

    return F.concat(*[field(name, width) for name, width in widths.items()])


def export_fixed_width(df: DataFrame, path: str, widths: Mapping[str, int], single_file: bool = False, cut: bool = False) -> None:
    lines = df.select(fixed_width_line(widths, cut).alias("value"))
    _files(lines, single_file, None).write.mode("overwrite").text(path)


def export_xml(df: DataFrame, path: str, root_tag: str = "data", single_file: bool = False) -> None:
    writer = _files(df, single_file, None).write.format("xml").mode("overwrite")
    writer.options(rootTag=root_tag, rowTag="record").save(path)


def export(df: DataFrame, path: str, fmt: str, **options) -> None:
    """Export by format name."""
    exporters = {"csv": export_csv, "json": export_json, "fixed_width": export_fixed_width, "xml": export_xml}
    if fmt not in exporters:
        raise ValueError(f"unknown export format {fmt!r}")
    exporters[fmt](df, path, **options)


def run_exchanges(
    spark: SparkSession,
    patterns: Sequence[Rule],
    tables: Mapping[str, DataFrame],
    schedule: str,
    folder: str,
) -> DataFrame:
    """Export every enabled pattern of one schedule; one failure does not stop the rest.

    Row counts come from the write itself (observed metrics), not from a second pass.
    """
    from pyspark.sql import Observation

    log = []
    for p in patterns:
        if p["schedule_type"] != schedule or not p.get("is_enabled", True):
            continue
        seen = Observation(f"export_{p['pattern_name']}")
        try:
            df = tables[p["source_table"]]
            if p.get("filter_condition"):
                df = df.filter(p["filter_condition"])
            df = df.observe(seen, F.count(F.lit(1)).alias("n"))
            export(df, f"{folder}/{p['pattern_name']}", p["file_format"], **p.get("options", {}))
            log.append((p["pattern_name"], p["vendor_name"], "success", seen.get["n"], None))
        except (PySparkException, KeyError, OSError, ValueError) as problem:  # logged; the next pattern still runs
            log.append((p["pattern_name"], p["vendor_name"], "failed", 0, type(problem).__name__))
    return spark.createDataFrame(
        log, "pattern_name string, vendor_name string, status string, row_count bigint, error string"
    )


# ---- layout --------------------------------------------------------------------------


def file_count_for(size_bytes: int, target_bytes: int = 128 * 1024 * 1024) -> int:
    return max(1, -(-int(size_bytes) // target_bytes))


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` is read from, from their listing."""
    files = df.select("_metadata.file_path", "_metadata.file_size").distinct()
    return int(files.agg(F.coalesce(F.sum("file_size"), F.lit(0))).first()[0])


def compact(df: DataFrame, path: str, files: int) -> None:
    """Rewrite into evenly filled files, in a new folder."""
    df.repartition(files).write.mode("errorifexists").parquet(path)


def cluster_by(df: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """Range-partition and sort by the columns so that file statistics prune on them."""
    return df.repartitionByRange(files, *columns).sortWithinPartitions(*columns)


def z_value(columns: Mapping[str, tuple[float, float]], bits: int = 8) -> Column:
    """Interleaved bits of several numeric columns scaled to their given ``(low, high)``."""
    cells = []
    for name, (low, high) in columns.items():
        scaled = (F.col(name).cast("double") - low) / (high - low) * (2**bits)
        cells.append(F.least(F.greatest(F.floor(scaled), F.lit(0)), F.lit(2**bits - 1)).cast("bigint"))
    value = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, cell in enumerate(cells):
            part = F.shiftright(cell, bit).bitwiseAND(F.lit(1).cast("bigint"))
            value = value.bitwiseOR(F.shiftleft(part, bit * len(cells) + i))
    return value


def cluster_by_z(df: DataFrame, columns: Mapping[str, tuple[float, float]], files: int) -> DataFrame:
    return (
        df.withColumn("_z", z_value(columns))
        .repartitionByRange(files, "_z")
        .sortWithinPartitions("_z")
        .drop("_z")
    )
