"""Row hashes, surrogate keys and deterministic offsets."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands for NULL inside a hash so that (a, NULL, b) and (a, b, NULL) differ.
NULL_MARK = "\\N"


def joined_text(columns: Iterable[str | Column], sep: str = "||") -> Column:
    """Columns as one string, NULL kept visible as :data:`NULL_MARK`."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit(NULL_MARK)) for c in cols])


def row_hash(columns: Iterable[str | Column], sep: str = "||") -> Column:
    """SHA-256 of the joined columns."""
    return F.sha2(joined_text(columns, sep), 256)


def business_columns(df: DataFrame) -> list[str]:
    """Columns that describe the record, i.e. all but the reserved ``_`` ones."""
    return [c for c in df.columns if not c.startswith("_")]


def surrogate_key(columns: Iterable[str | Column]) -> Column:
    """Repeatable 128-bit key of a business key: same input, same key, on every run and engine.

    The whole digest, since a shorter one would give two of many keys the same name. For gap-free
    numbers see ``operators.windows.dense_key``.
    """
    return F.md5(joined_text(columns))


def hash_share(columns: Iterable[str | Column]) -> Column:
    """A number in [0, 1) that depends on the columns alone and is spread evenly."""
    return F.conv(F.substring(F.md5(joined_text(columns)), 1, 8), 16, 10).cast("double") / float(1 << 32)


def day_offset(entity_key: Column, span: int) -> Column:
    """Offset in ``[-span, span-1]`` from the entity key, so one entity shifts as a whole."""
    head = F.conv(F.substring(F.md5(entity_key.cast("string")), 1, 8), 16, 10).cast("bigint")
    return (F.pmod(head, F.lit(2 * span)) - F.lit(span)).cast("int")
