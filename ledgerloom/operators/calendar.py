"""Daily sales on a gap-free calendar and their mean per weekday."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import weekday_label
from ledgerloom.functions.money import exact_mean, money, money_sum
from ledgerloom.session import materialize

# Fixed value: the sales channel of the physical shops.
SHOP_CHANNEL = "pos"


def channel_daily_sales(orders: DataFrame, channel: str = SHOP_CHANNEL) -> DataFrame:
    """Sales per day of one channel, days without a sale absent. Amounts stay exact decimals."""
    return (
        orders.filter(F.col("channel") == channel)
        .select(F.to_date("placed_at").alias("data_completa"), "total")
        .groupBy("data_completa")
        .agg(money_sum("total").alias("venda_do_dia"))
    )


def date_bounds(daily: DataFrame) -> DataFrame:
    """First and last day, as a one-row frame; it stays part of the plan."""
    return daily.agg(F.min("data_completa").alias("data_min"), F.max("data_completa").alias("data_max"))


def date_spine(bounds: DataFrame) -> DataFrame:
    """One row per day between the bounds; none if there are no bounds."""
    days = F.sequence("data_min", "data_max", F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias("data_completa"))


def daily_sales_filled(daily: DataFrame) -> DataFrame:
    """Every day of the range, 0 where nothing was sold.

    ``daily`` has one row per day and feeds both the bounds and the join, so it is written once:
    the orders are scanned once.
    """
    daily, _ = materialize(daily, "daily")
    sales = daily.filter(F.col("data_completa").isNotNull())
    return date_spine(date_bounds(daily)).join(sales, "data_completa", "left").select(
        "data_completa", F.coalesce("venda_do_dia", money(F.lit(0))).alias("venda_do_dia")
    )


def weekday_labels(days: DataFrame) -> DataFrame:
    """Add the weekday number (Sunday = 1) and its label."""
    return days.withColumn("num_dia", F.dayofweek("data_completa")).withColumn(
        "dia_semana_pt", weekday_label(F.col("num_dia"))
    )


def weekday_avg_sales(filled: DataFrame) -> DataFrame:
    """Mean daily sales per weekday over all days, including those without sales."""
    return (
        weekday_labels(filled)
        .groupBy("num_dia", "dia_semana_pt")
        .agg(exact_mean(money_sum("venda_do_dia"), F.count(F.lit(1))).alias("media_venda_diaria"))
        .orderBy("num_dia")
    )
