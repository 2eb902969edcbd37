"""Classify text values by the relational type they could be stored as.

Each value maps to a bit set of the classes it satisfies; ``bit_and`` over a column then tells
which classes *every* value satisfies, so a whole table is profiled by one aggregate per column.
All functions give SQL text: wide tables then cost one call per column, not one per test.
"""

from __future__ import annotations

from pyspark.sql import types as T

INTEGER, FLOAT, TIMESTAMP, BOOLEAN, FITS_BIGINT = 1, 2, 4, 8, 16

# What counts as a number or a moment in text. The plain patterns cover nearly all
# values cheaply. In the general ones (?U) makes \d and \s Unicode-aware, and digits may be grouped
# by single underscores; they are slow, so words are told apart first: a number has no letters but
# one e, or inf, infinity or nan. Every repetition is possessive: what it took it never gives back, so a value of
# any length is read once and without recursion.
PLAIN_INTEGER = r"^[+-]?[0-9]{1,18}\z"
PLAIN_FLOAT = r"^[+-]?[0-9]++\.[0-9]++\z"
MAYBE_NUMBER = r"(?i)^[^a-z]*+(?:e[^a-z]*+|(?:inf|infinity|nan)[^a-z]*+)?\z"
_BLANK = r"\s*+"
_DIGITS = r"\d(?:_?+\d)*+"
GENERAL_INTEGER = rf"(?U)^{_BLANK}[+-]?{_DIGITS}{_BLANK}\z"
GENERAL_FLOAT = (
    rf"(?U)^{_BLANK}[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    rf"|(?i:inf|infinity|nan)){_BLANK}\z"
)
# `2024-01-05 10:20:30`, `2024-01-05T10:20:30` or `2024-01-05`; one-digit parts allowed, no fractions.
MOMENT = (
    r"^(?!0000)[0-9]{4}-(?:1[0-2]|0?[1-9])-(?:3[01]|[12][0-9]|0?[1-9]| [1-9])"
    r"(?:(?:\s++|[Tt])(?:2[0-3]|[01]?[0-9]):[0-5]?[0-9]:[0-5]?[0-9])?\z"
)
# The day within a moment, and what to drop from a whole number before reading it.
_DAY = r"(?s)^([0-9]+-[0-9]+-) ?([0-9]+).*$"
_GROUPING = r"(?U)[\s_]"

# Relational type per class, in the order they are tried.
TYPE_ORDER = (
    (INTEGER, "BIGINT"),
    (FLOAT, "DOUBLE PRECISION"),
    (TIMESTAMP, "TIMESTAMP"),
    (BOOLEAN, "BOOLEAN"),
)
FALLBACK_TYPE = "TEXT"


def quoted(column: str) -> str:
    """A column name as SQL text."""
    return "`" + column.replace("`", "``") + "`"


def classes_of_type(kind: T.DataType, column: str) -> str | None:
    """The bit set of a column that is not text, from its type; None if only the text can tell.

    The text of a float always shows a point, an exponent, NaN or Infinity. The text of a moment
    fails the pattern if it has a fraction of a second or a year that is not four digits.
    """
    v = quoted(column)
    if isinstance(kind, T.IntegralType):
        known = str(INTEGER | FLOAT | FITS_BIGINT)
    elif isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        known = str(FLOAT)
    elif isinstance(kind, T.BooleanType):
        known = str(BOOLEAN)
    elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        whole = "" if isinstance(kind, T.DateType) else f" AND date_trunc('second', {v}) = {v}"
        known = f"CASE WHEN year({v}) BETWEEN 1 AND 9999{whole} THEN {TIMESTAMP} ELSE 0 END"
    else:
        return None
    return f"CASE WHEN {v} IS NOT NULL THEN {known} END"


def value_classes(v: str) -> str:
    """Bit set of classes of a text, given as SQL; NULL for a missing or empty value.

    The classes other than integer within float exclude each other, so the order of the tests is
    free: cheap and common ones come first. The pattern checks the shape of a moment, a cast its
    day of the month.
    """
    return f"""
        CASE WHEN {v} IS NULL OR {v} = '' THEN NULL
             WHEN {v} RLIKE r'{PLAIN_INTEGER}' THEN {INTEGER | FLOAT | FITS_BIGINT}
             WHEN {v} RLIKE r'{PLAIN_FLOAT}' THEN {FLOAT}
             WHEN {v} RLIKE r'{MOMENT}' THEN
               CASE WHEN coalesce(try_cast({v} AS DATE),
                                  try_cast(regexp_replace({v}, r'{_DAY}', '$1$2') AS DATE)) IS NULL
                    THEN 0 ELSE {TIMESTAMP} END
             WHEN lower({v}) IN ('true', 'false') THEN {BOOLEAN}
             WHEN NOT {v} RLIKE r'{MAYBE_NUMBER}' THEN 0
             WHEN {v} RLIKE r'{GENERAL_INTEGER}' THEN
               CASE WHEN try_cast(regexp_replace({v}, r'{_GROUPING}', '') AS BIGINT) IS NULL
                    THEN {INTEGER | FLOAT} ELSE {INTEGER | FLOAT | FITS_BIGINT} END
             WHEN {v} RLIKE r'{GENERAL_FLOAT}' THEN {FLOAT}
             ELSE 0 END
        """


def relational_type(classes: str) -> str:
    """First type in order that all values satisfy; a column without values is text."""
    tests = " ".join(f"WHEN {classes} & {bit} <> 0 THEN '{name}'" for bit, name in TYPE_ORDER)
    return f"CASE {tests} ELSE '{FALLBACK_TYPE}' END"


def exceeds_bigint(classes: str) -> str:
    """True for an integer column with a value outside the 64-bit range."""
    return f"coalesce({classes} & {INTEGER} <> 0 AND {classes} & {FITS_BIGINT} = 0, false)"
