"""Scalar helpers whose edge cases differ from Spark's own functions, plus masks and JSON checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def concat_nulls_empty(*parts: Column) -> Column:
    """Concatenation that treats NULL as an empty string."""
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def trimmed_length(text: Column) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(text))


def boundaries_crossed(unit: str, start: Column, end: Column) -> Column:
    """Unit boundaries between two times, e.g. 23:59 to 00:01 is one day."""
    whole_start, whole_end = F.date_trunc(unit, start), F.date_trunc(unit, end)
    return F.timestamp_diff(unit.upper(), whole_start, whole_end)


def is_json_array(text: Column) -> Column:
    """True when the text parses as a JSON array; NULL stays NULL."""
    return F.when(text.isNotNull(), F.coalesce(F.schema_of_variant(F.try_parse_json(text)).startswith("ARRAY"), F.lit(False)))


def mask_email(email: Column) -> Column:
    """First letter, then a fixed pattern that hides the rest and its length."""
    return F.concat(F.left(email, F.lit(1)), F.lit("XXX@XXXX.com"))


def mask_partial(text: Column, prefix: int, padding: str, suffix: int) -> Column:
    """Keep ``prefix`` and ``suffix`` characters around the padding; too short values show only padding."""
    shown = F.concat(F.left(text, F.lit(prefix)), F.lit(padding), F.right(text, F.lit(suffix)))
    return F.when(F.length(text) < prefix + suffix, F.lit(padding)).otherwise(shown)


def mask_digits_but_last(text: Column, keep: int = 4) -> Column:
    """Every digit becomes ``*`` except inside the last ``keep`` characters."""
    head = F.left(text, F.greatest(F.length(text) - keep, F.lit(0)))
    return F.concat(F.regexp_replace(head, "[0-9]", "*"), F.right(text, F.least(F.lit(keep), F.length(text))))


# Patterns for personal data in free text.
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE_PATTERN = r"\+[0-9][0-9 ]{6,}[0-9]|\([0-9]{2,4}\)\s?[0-9]{6,}|\b[0-9]{2}-[0-9]{3}-[0-9]{3}\b"


def redact(text: Column, email_pattern: str = EMAIL_PATTERN, phone_pattern: str = PHONE_PATTERN) -> Column:
    """E-mails become ``[email]``, then phones ``[phone]``."""
    return F.regexp_replace(F.regexp_replace(text, email_pattern, "[email]"), phone_pattern, "[phone]")
