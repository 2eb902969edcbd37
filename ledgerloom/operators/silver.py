"""Cleaned layer: types converted, only completed business kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import as_timestamp

# States that count as business done.
VALID_ORDER_STATUS = ("paid", "completed", "shipped")
VALID_RETURN_STATUS = "completed"


def silver_orders(orders: DataFrame, valid: Sequence[str] = VALID_ORDER_STATUS) -> DataFrame:
    """Orders in a valid state with parsed times. A NULL status is not valid."""
    return orders.filter(F.col("status").isin(*valid)).withColumns(
        {name: as_timestamp(orders, name) for name in ("placed_at", "created_at")}
    )


def silver_order_items(items: DataFrame) -> DataFrame:
    """Items with numeric amounts; text that is no number becomes NULL."""
    return items.withColumns(
        {name: F.col(name).try_cast("double") for name in ("unit_price", "quantity", "line_total")}
    )


def silver_returns(returns: DataFrame, valid: str = VALID_RETURN_STATUS) -> DataFrame:
    return returns.filter(F.col("status") == valid)
