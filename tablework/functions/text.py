"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns whose matches must come out as documented.
NOT_A_DIGIT = "[^0-9]"
# Starts where a run of address characters starts and never gives characters back, so that a
# long text is passed over once.
LOCAL_PART = "(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@"
PHONE = r"(\d{2,3})[-\s]?(\d{4,5})[-\s]?(\d{4,5})"
MAIL_DOMAIN = "@([A-Za-z0-9.]+)"
MAIL_USER = "^([^@]+)@"


def title_case(column: str) -> Column:
    """Trimmed, each space-separated word capitalised."""
    return F.initcap(F.trim(F.col(column)))


def part(column: str, pattern: str, index: int) -> Column:
    """Zero-based part of the value split at a regular expression; NULL if there is none."""
    return F.get(F.split(F.col(column), pattern), F.lit(index))


def digits_only(column: str) -> Column:
    return F.regexp_replace(F.col(column), NOT_A_DIGIT, "")


def mask_mail(column: str) -> Column:
    """Every mail address in the text with the part before the @ hidden."""
    value = F.col(column)
    masked = F.regexp_replace(value, LOCAL_PART, "***@")
    return F.when(value.contains("@"), masked).otherwise(value)


def contains_any_case(column: str, needle: str) -> Column:
    return F.lower(F.col(column)).contains(needle.lower())


def padded(column: str, width: int, fill: str = "0") -> Column:
    """Left-padded to ``width`` characters; a longer value is cut."""
    return F.lpad(F.col(column).cast("string"), width, fill)
