"""Monthly demand per product, its moving-average backtest and a seasonal forecast.

All products are handled at once. After the monthly aggregate a product is at most one row per
month, so the windows over its history are bounded by the calendar, however hot the product; the
window, the gap filling and the per-product sums all use the partitioning by product.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions.dates import month_of
from ledgerloom.functions.text import contains_ignore_case
from ledgerloom.operators.sales import join_orders_items


@dataclass(frozen=True)
class Split:
    """Training months up to ``train_end``; test months from ``test_start`` to ``test_end``."""

    train_end: dt.date = dt.date(2025, 12, 31)
    test_start: dt.date = dt.date(2026, 1, 1)
    test_end: dt.date = dt.date(2026, 3, 31)

    def is_train(self) -> Column:
        return F.col("month") <= F.lit(self.train_end)

    def months_ahead(self) -> int:
        """Months from the end of training to the end of the test range."""
        return 12 * (self.test_end.year - self.train_end.year) + self.test_end.month - self.train_end.month

    def is_test(self) -> Column:
        return F.col("month").between(F.lit(self.test_start), F.lit(self.test_end))


# Months averaged by the baseline, season length, and months forecast ahead.
AVERAGED_MONTHS = 3
SEASON = 12
HORIZON = 3


def find_product(products: DataFrame, text: str) -> DataFrame:
    """The product with the smallest id whose name contains ``text``; no row if there is none."""
    return products.filter(contains_ignore_case(F.col("name"), text)).select("id", "name").orderBy("id").limit(1)


def product_sales_lines(orders: DataFrame, items: DataFrame, variants: DataFrame, product: DataFrame) -> DataFrame:
    """Sold lines of one product's variants.

    The product, one row, cuts the variants and those cut the items before the join with orders.
    The planner broadcasts the single row by its limit; a product may have any number of variants,
    so those travel as their size allows.
    """
    target = product.select(F.col("id").alias("product_id")).limit(1)
    wanted = variants.join(target, "product_id", "left_semi").select(F.col("id").alias("product_variant_id"))
    return join_orders_items(orders, items.join(wanted, "product_variant_id", "left_semi"))


def monthly_sales(lines: DataFrame) -> DataFrame:
    """Quantity sold per product and month, months without a sale absent."""
    return (
        lines.select("product_id", month_of(F.col("placed_at")).alias("month"), "quantity")
        .filter(F.col("month").isNotNull())
        .groupBy("product_id", "month")
        .agg(F.coalesce(F.sum("quantity"), F.lit(0.0)).alias("quantity"))
    )


def fill_months(monthly: DataFrame) -> DataFrame:
    """Add the months without a sale as 0, from each product's first to its last month.

    Each row is stretched up to the product's next month, so no calendar has to be joined.
    """
    following = F.lead("month").over(W.partitionBy("product_id").orderBy("month"))
    last_empty = F.coalesce(F.add_months(following, -1), F.col("month"))
    stretched = monthly.withColumn("last_empty", last_empty).select(
        "product_id",
        F.col("month").alias("sold_month"),
        "quantity",
        F.explode(F.sequence("month", "last_empty", F.expr("interval 1 month"))).alias("month"),
    )
    return stretched.select(
        "product_id",
        "month",
        F.when(F.col("month") == F.col("sold_month"), F.col("quantity")).otherwise(0.0).alias("quantity"),
    )


def monthly_demand(lines: DataFrame) -> DataFrame:
    """Quantity per product on its own gap-free grid of months."""
    return fill_months(monthly_sales(lines))


def demand_train_test_split(demand: DataFrame, split: Split = Split()) -> DataFrame:
    """Mark each month ``train`` or ``test``; months outside both are left out."""
    part = F.when(split.is_train(), "train").when(split.is_test(), "test")
    return demand.withColumn("part", part).filter(F.col("part").isNotNull())


def moving_avg_forecast(demand: DataFrame, split: Split = Split(), months: int = AVERAGED_MONTHS) -> DataFrame:
    """One-step-ahead forecast of each test month: the mean of the preceding months' actuals.

    The frame ends at the month before, so no forecast sees its own month. It takes as many months
    as there are, and is NULL without any. The test months are picked after the window.
    """
    history = W.partitionBy("product_id").orderBy("month").rowsBetween(-months, -1)
    return (
        demand_train_test_split(demand, split)
        .withColumn("forecast", F.avg("quantity").over(history))
        .filter(F.col("part") == "test")
        .select("product_id", "month", F.col("quantity").alias("actual"), "forecast")
    )


def _mae() -> Column:
    return F.avg(F.abs(F.col("actual") - F.col("forecast")))


def _rounded_total() -> Column:
    """Sum of the forecasts, half-even, as a whole number."""
    return F.bround(F.coalesce(F.sum("forecast"), F.lit(0.0)), 0).cast("bigint")


def mean_absolute_error(forecast: DataFrame) -> DataFrame:
    """Mean absolute error per product over the months that have a forecast."""
    return forecast.groupBy("product_id").agg(_mae().alias("mae"))


def forecast_total(forecast: DataFrame) -> DataFrame:
    """Total forecast per product, rounded half-even to units."""
    return forecast.groupBy("product_id").agg(_rounded_total().alias("total_forecast"))


def _seasonal_change() -> Column:
    """Change against the month before, less the same change one season earlier."""
    history = W.partitionBy("product_id").orderBy("month")
    ago = lambda n: F.lag("quantity", n).over(history)
    return F.col("quantity") - ago(1) - ago(SEASON) + ago(SEASON + 1)


def seasonal_difference(demand: DataFrame) -> DataFrame:
    """Month-on-month change net of the change a season before; NULL until both exist."""
    return demand.withColumn("w", _seasonal_change())


def seasonal_ar_forecast(demand: DataFrame, split: Split = Split(), horizon: int = HORIZON) -> DataFrame:
    """Forecast ``horizon`` months from the last training month, all at once.

    The seasonally differenced series is taken as a first-order autoregression fitted by least
    squares: phi = sum(w[t] w[t-1]) / sum(w[t-1]^2). Undoing the differences adds to the last
    value, month by month, last season's change plus phi^j times the last w. Only training months
    enter. Products with fewer than two values of w have no rows; a flat w leaves NULL.
    """
    history = W.partitionBy("product_id").orderBy("month")
    # Last season's changes that lie ahead of a month: y[t+j-12] - y[t+j-13], j = 1..horizon.
    ahead = [
        F.lag("quantity", SEASON - j).over(history) - F.lag("quantity", SEASON + 1 - j).over(history)
        for j in range(1, horizon + 1)
    ]
    train = demand.filter(split.is_train()).select(
        "product_id", "month", "quantity", _seasonal_change().alias("w"), F.array(*ahead).alias("ahead")
    )
    paired = train.withColumn("w_before", F.lag("w").over(history))
    last = lambda name: F.max_by(name, "month").alias(name)
    both = F.col("w").isNotNull() & F.col("w_before").isNotNull()
    fitted = (
        paired.groupBy("product_id")
        .agg(
            F.sum(F.when(both, F.col("w") * F.col("w_before"))).alias("num"),
            F.sum(F.when(both, F.col("w_before") * F.col("w_before"))).alias("den"),
            F.count_if(both).alias("n_pairs"),
            F.max("month").alias("last_month"),
            last("quantity"),
            last("w"),
            last("ahead"),
        )
        .filter(F.col("n_pairs") > 0)
        .withColumn("phi", F.try_divide("num", "den"))
    )
    steps, level = [], F.col("quantity")
    for j in range(1, horizon + 1):
        level = level + F.col("ahead")[j - 1] + F.pow("phi", F.lit(j)) * F.col("w")
        steps.append(
            F.struct(
                F.lit(j).alias("step"),
                F.to_date(F.add_months("last_month", j)).alias("month"),
                level.alias("forecast"),
            )
        )
    return fitted.select("product_id", F.inline(F.array(*steps)))


def forecast_comparison(demand: DataFrame, split: Split = Split()) -> DataFrame:
    """Both forecasts of each product over its test months: totals and mean absolute errors.

    The protocols differ by design: the baseline steps month by month with the actuals so far,
    the seasonal forecast is made once from the end of training, as far as the test range goes. Every
    product with test months is reported; where it has no seasonal forecast (too short a history, or
    a flat one), both seasonal figures are NULL.
    """
    baseline = moving_avg_forecast(demand, split)
    seasonal = seasonal_ar_forecast(demand, split, max(1, split.months_ahead())).select(
        "product_id", "month", F.col("forecast").alias("seasonal")
    )
    both = baseline.join(seasonal, ["product_id", "month"], "left")
    return both.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n_months"),
        _rounded_total().alias("baseline_total"),
        _mae().alias("baseline_mae"),
        F.bround(F.sum("seasonal"), 0).cast("bigint").alias("seasonal_total"),
        F.avg(F.abs(F.col("actual") - F.col("seasonal"))).alias("seasonal_mae"),
    )
