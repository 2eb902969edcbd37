"""Exact money sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts are held in millionths: sums are then exact and independent of the order of the rows, and
# unit prices below a cent keep their digits. NaN and infinities are no amounts and become NULL.
MONEY = "decimal(28,6)"


def money(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).try_cast(MONEY)


def money_sum(column: Column | str) -> Column:
    """Sum of an amount column, exact, as decimal. Cast to double only for output."""
    return F.sum(money(column))


def exact_mean(total: Column, n: Column) -> Column:
    """Mean from an exact total; NULL for zero rows."""
    return F.try_divide(total.cast("double"), n.cast("double"))
