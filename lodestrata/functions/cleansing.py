"""Cleansing and standardising expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Street and unit abbreviations and the words they stand for.
STREET_WORDS = {
    "ST": "STREET",
    "AVE": "AVENUE",
    "BLVD": "BOULEVARD",
    "DR": "DRIVE",
    "RD": "ROAD",
    "LN": "LANE",
    "CT": "COURT",
    "PL": "PLACE",
}
UNIT_WORDS = {"APT": "APARTMENT", "STE": "SUITE"}

CLEANSERS = {
    "uppercase": lambda c: F.upper(F.trim(c)),
    "remove_special_chars": lambda c: F.regexp_replace(c, r"[^a-zA-Z0-9\s]", ""),
    "trim": lambda c: F.trim(c),
}


def cleanse(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Apply one named cleanser per column; all columns go into a single projection."""
    return df.withColumns({name: CLEANSERS[kind](F.col(name)) for name, kind in rules.items()})


def standardize(c: Column) -> Column:
    return F.trim(F.upper(c))


def match_text(*parts: Column) -> Column:
    """Match key of a name or address: upper case letters, digits and blanks."""
    return F.regexp_replace(F.upper(F.trim(F.concat_ws(" ", *parts))), r"[^A-Z0-9\s]", "")


def digits_key(c: Column) -> Column:
    """Digits only; an empty result becomes NULL so that it never matches anything."""
    return F.nullif(F.regexp_replace(c, r"[^0-9]", ""), F.lit(""))


def standard_address(c: Column) -> Column:
    """Upper-case street line with the abbreviations written out.

    A street word is rewritten before a blank or the end of the line, a unit word only
    before a blank.
    """
    out = F.trim(F.upper(c))
    for short, full in STREET_WORDS.items():
        out = F.regexp_replace(out, rf" {short}( |$)", f" {full}$1")
    for short, full in UNIT_WORDS.items():
        out = F.regexp_replace(out, f" {short} ", f" {full} ")
    return out


def standard_zip(c: Column) -> Column:
    """First five digits, with the last four appended when there are exactly nine."""
    digits = F.regexp_replace(c, r"[^0-9]", "")
    five = F.substring(digits, 1, 5)
    return F.when(
        F.length(digits) == 9, F.concat(five, F.lit("-"), F.substring(digits, 6, 4))
    ).when(F.length(digits) >= 5, five)
