"""Calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Report labels per weekday number, Sunday = 1.
WEEKDAY_LABELS = {
    1: "1. Domingo",
    2: "2. Segunda-feira",
    3: "3. Terça-feira",
    4: "4. Quarta-feira",
    5: "5. Quinta-feira",
    6: "6. Sexta-feira",
    7: "7. Sábado",
}


def weekday_label(number: Column) -> Column:
    """Report label of a weekday number; anything outside 1..7 is NULL."""
    labels = F.create_map(*[F.lit(x) for pair in WEEKDAY_LABELS.items() for x in pair])
    return F.try_element_at(labels, number)


def month_of(moment: Column) -> Column:
    """First day of the month as a date."""
    return F.trunc(F.to_date(moment), "month")


def as_timestamp(df: DataFrame, name: str) -> Column:
    """The column as a timestamp; text that does not parse becomes NULL.

    Columns that already hold timestamps pass through untouched, which keeps their filters
    pushable and avoids a detour through the session time zone.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.col(name)
    if isinstance(kind, T.StringType):
        return F.try_to_timestamp(F.col(name))
    return F.col(name).try_cast("timestamp")
