"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_ignore_case(column: Column, needle: str) -> Column:
    """Literal, case-insensitive substring test; a NULL text counts as no match."""
    return F.coalesce(F.contains(F.lower(column), F.lower(F.lit(needle))), F.lit(False))


# White space around a name: blanks, tabs and line ends of any script.
_AROUND = r"(?U)^\s+|\s+$"


def clean_identifier(name: Column) -> Column:
    """A column name for DDL: no white space around it, lower case, each blank an underscore."""
    return F.translate(F.lower(F.regexp_replace(name, _AROUND, "")), " ", "_")


def table_name_of_file(file_name: Column) -> Column:
    """``orders.csv`` -> ``orders``."""
    return F.regexp_replace(file_name, r"\.csv$", "")
