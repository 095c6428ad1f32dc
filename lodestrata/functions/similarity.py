"""String similarity and the marks of a lossless similarity join."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """``100 * (1 - levenshtein / longer length)``; 0 when either side is empty or NULL."""
    longest = F.greatest(F.length(a), F.length(b))
    value = F.lit(100.0) * (F.lit(1.0) - F.levenshtein(a, b) / longest)
    return F.when((F.length(a) > 0) & (F.length(b) > 0), value).otherwise(F.lit(0.0))


def _edits(size: Column, min_ratio: int) -> Column:
    """Most edits of a pair with ``ratio >= min_ratio`` whose longer text has ``size`` characters."""
    return F.floor(size * F.lit(100 - min_ratio) / 100.0 + 1e-9).cast("int")


def _part(size: Column, min_ratio: int, i: Column) -> tuple[Column, Column]:
    """Start and width of part ``i`` (from 0) of a text of ``size`` characters, cut into one part more than it may have edits."""
    parts = _edits(size, min_ratio) + 1
    width = F.floor(size / parts).cast("int")
    narrow = parts - size % parts  # that many parts come first, the others are wider by one
    return i * width + F.greatest(F.lit(0), i - narrow), width + (i >= narrow).cast("int")


def part_marks(text: Column, min_ratio: int) -> Column:
    """Hashes of the parts of a text, which a similar one that is no longer finds among its ``sought_marks``.

    With one part more than edits, some part i is untouched, has at most i edits before it and at most ``edits - i``
    after it; so it lies in the other text, moved by no more than either.
    """
    size = F.length(text)

    def mark(i: Column) -> Column:
        start, width = _part(size, min_ratio, i)
        return F.xxhash64(size, i, F.substr(text, start + 1, width))

    return F.transform(F.sequence(F.lit(0), _edits(size, min_ratio)), mark)


def sought_marks(text: Column, min_ratio: int) -> Column:
    """Distinct hashes of all pieces of a text that may be a part of a similar text of its length or longer."""
    size = F.length(text)
    longest = F.floor(size * 100 / min_ratio + 1e-9).cast("int")

    def of_size(other: Column) -> Column:
        edits = _edits(other, min_ratio)

        def of_part(i: Column) -> Column:
            start, width = _part(other, min_ratio, i)
            ended = start + size - other
            first = F.greatest(F.lit(0), start - i, ended - edits + i)
            last = F.least(size - width, start + i, ended + edits - i)
            places = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
            return F.transform(places, lambda place: F.xxhash64(other, i, F.substr(text, place + 1, width)))

        return F.flatten(F.transform(F.sequence(F.lit(0), edits), of_part))

    return F.array_distinct(F.flatten(F.transform(F.sequence(size, longest), of_size)))


def lengths_fit(a: Column, b: Column, min_ratio: int) -> Column:
    """Whether texts of these lengths can reach ``min_ratio``: the difference alone takes as many edits."""
    return F.least(F.length(a), F.length(b)) * 100 >= F.greatest(F.length(a), F.length(b)) * min_ratio
