"""Masking strategies as Column expressions: NULL stays NULL in all of them but ``full_redact``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions.hashing import day_offset

# Literals that masked data must carry.
REDACTED = "***REDACTED***"
MASKED = "***MASKED***"


def _keep_null(c: Column, masked: Column) -> Column:
    return F.when(c.isNotNull(), masked)


def secret(p: dict, name: str) -> Column:
    """A secret from the parameters; there is none to fall back on, as a known one could be undone by listing."""
    if not p.get(name):
        raise ValueError(f"a mask needs its {name!r}")
    return F.lit(p[name])


def full_redact(c: Column, p: dict) -> Column:
    return F.lit(REDACTED)


def null_out(c: Column, p: dict) -> Column:
    # nullif keeps the column's own type, a bare NULL literal would not
    return F.nullif(c, c)


def partial_mask(c: Column, p: dict) -> Column:
    keep = int(p.get("visible_last", 4))
    hidden = F.greatest(F.length(c) - F.lit(keep), F.lit(0))
    return _keep_null(c, F.concat(F.repeat(F.lit(p.get("mask_char", "X")), hidden), F.right(c, F.lit(keep))))


def hash_sha256(c: Column, p: dict) -> Column:
    return F.sha2(F.concat(c.cast("string"), F.lit("||"), secret(p, "salt")), 256)


def tokenize(c: Column, p: dict) -> Column:
    digest = F.sha2(F.concat(c.cast("string"), F.lit("||"), secret(p, "salt")), 256)
    return F.concat(F.lit("TKN_"), F.substring(digest, 1, 16))


def format_preserving(c: Column, p: dict) -> Column:
    """Hash digits in place of the value, at the same length (letters a-f become 0-5)."""
    digest = F.sha2(F.concat(c, secret(p, "key")), 256)
    return F.translate(F.substr(digest, F.lit(1), F.length(c)), "abcdef", "012345")


def format_keeping(c: Column, p: dict) -> Column:
    """Per-character variant: digits stay digits, letters letters, punctuation is untouched."""
    digest = F.sha2(F.concat(c, secret(p, "key")), 256)

    def swap(ch: Column, i: Column) -> Column:
        nibble = F.conv(F.substr(digest, F.pmod(i, F.lit(64)) + F.lit(1), F.lit(1)), 16, 10).cast("int")
        return (
            F.when(ch.rlike("^[0-9]$"), F.pmod(nibble, F.lit(10)).cast("string"))
            .when(ch.rlike("^[A-Z]$"), F.chr(F.lit(65) + nibble))
            .when(ch.rlike("^[a-z]$"), F.chr(F.lit(97) + nibble))
            .otherwise(ch)
        )

    return F.array_join(F.transform(F.split(c, ""), swap), "")


def pseudonymize(c: Column, p: dict) -> Column:
    return F.concat(F.lit(p.get("prefix", "PERSON") + "_"), F.substring(F.md5(c.cast("string")), 1, 8))


def generalize(c: Column, p: dict) -> Column:
    return F.substring(c, 1, int(p.get("keep_chars", 3)))


def date_shift(c: Column, p: dict) -> Column:
    """Shift by an offset of the entity, so that intervals inside one entity survive.

    ``entity_column`` names the entity key; without it the value itself is the entity.
    """
    entity = F.col(p["entity_column"]) if p.get("entity_column") else c
    return F.date_add(c.cast("date"), day_offset(entity, int(p.get("shift_days_range", 30))))


def email_mask(c: Column, p: dict) -> Column:
    return F.concat(F.substring(c, 1, 2), F.lit("***@"), F.substring_index(c, "@", -1))


def phone_mask(c: Column, p: dict) -> Column:
    return F.concat(F.lit("***-***-"), F.right(c, F.lit(4)))


STRATEGIES: dict[str, Callable[[Column, dict], Column]] = {
    "full_redact": full_redact,
    "partial_mask": partial_mask,
    "hash_sha256": hash_sha256,
    "tokenize": tokenize,
    "format_preserving_encrypt": format_preserving,
    "pseudonymize": pseudonymize,
    "generalize": generalize,
    "date_shift": date_shift,
    "null_out": null_out,
    "email_mask": email_mask,
    "phone_mask": phone_mask,
}


# ---- display masks: what a report shows in place of a value ---------------------------


def show_ssn(c: Column) -> Column:
    """Every dashed social security number inside the text as ``XXX-XX-6789``."""
    return F.regexp_replace(c, r"\b\d{3}-\d{2}-(\d{4})\b", "XXX-XX-$1")


def _last_four(c: Column, prefix: str, empty: str) -> Column:
    digits = F.regexp_replace(c, r"[^0-9]", "")
    shown = F.when(F.length(digits) >= 4, F.concat(F.lit(prefix), F.right(digits, F.lit(4))))
    return _keep_null(c, F.coalesce(shown, F.lit(empty)))


def show_card(c: Column) -> Column:
    return _last_four(c, "XXXX-XXXX-XXXX-", "XXXX-XXXX-XXXX-XXXX")


def show_phone(c: Column) -> Column:
    return _last_four(c, "XXX-XXX-", "XXX-XXX-XXXX")


def show_email(c: Column) -> Column:
    """First letter of the local part and the domain; NULL when there is no ``@``."""
    at = F.instr(c, "@")
    first = F.when(at > 2, F.substring(c, 1, 1)).otherwise(F.lit(""))
    return F.when(at > 0, F.concat(first, F.lit("***"), F.substr(c, at)))


def show_address(c: Column) -> Column:
    """Hide the street, keep the last two comma-separated parts (city and state)."""
    parts = F.split(c, ",")
    tail = F.concat(
        F.lit("*****, "), F.trim(F.get(parts, F.size(parts) - 2)), F.lit(", "), F.trim(F.get(parts, F.size(parts) - 1))
    )
    return _keep_null(c, F.when(F.size(parts) >= 2, tail).otherwise(F.lit("*****")))


#: The display masks as SQL expressions of ``x``, for use in queries and views.
SQL_MASKS = {
    "mask_ssn": r"regexp_replace(x, r'\b\d{3}-\d{2}-(\d{4})\b', 'XXX-XX-$1')",
    "mask_credit_card": "CASE WHEN x IS NULL THEN NULL WHEN length(regexp_replace(x, '[^0-9]', '')) >= 4 "
    "THEN concat('XXXX-XXXX-XXXX-', right(regexp_replace(x, '[^0-9]', ''), 4)) ELSE 'XXXX-XXXX-XXXX-XXXX' END",
    "mask_phone": "CASE WHEN x IS NULL THEN NULL WHEN length(regexp_replace(x, '[^0-9]', '')) >= 4 "
    "THEN concat('XXX-XXX-', right(regexp_replace(x, '[^0-9]', ''), 4)) ELSE 'XXX-XXX-XXXX' END",
    "mask_email": "CASE WHEN instr(x, '@') > 0 THEN concat(CASE WHEN instr(x, '@') > 2 THEN left(x, 1) ELSE '' END, "
    "'***', substr(x, instr(x, '@'))) END",
    "mask_address": "CASE WHEN x IS NULL THEN NULL WHEN size(split(x, ',')) >= 2 THEN concat('*****, ', "
    "trim(element_at(split(x, ','), -2)), ', ', trim(element_at(split(x, ','), -1))) ELSE '*****' END",
}


def register_sql_masks(spark: SparkSession) -> None:
    """Make the display masks callable from SQL; Spark inlines them, no Python runs per row."""
    for name, body in SQL_MASKS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x STRING) RETURNS STRING RETURN {body}")
