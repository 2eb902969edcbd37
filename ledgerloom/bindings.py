"""The retail model laid over a folder of star-schema parquet tables."""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import silver
from ledgerloom.operators.forecast import Split

# Stated rather than inferred, which spares every query a job per table.
SOURCE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
}
SOURCE_TABLES = tuple(SOURCE_SCHEMAS)

# How the model's values are spelled in these tables.
VALID_STATUS = ("F", "O")
SHOP = "1-URGENT"
RETURNED = "R"
TARGET_PRODUCT = "small widget"
SPLIT = Split(dt.date(2000, 12, 31), dt.date(2001, 1, 1), dt.date(2001, 3, 31))


@dataclass(frozen=True)
class Retail:
    """Lazily bound model tables."""

    spark: SparkSession
    folder: str

    def source(self, name: str) -> DataFrame:
        path = os.path.join(self.folder, f"{name}.parquet")
        return self.spark.read.schema(SOURCE_SCHEMAS[name]).parquet(path)

    @cached_property
    def orders(self) -> DataFrame:
        return self.source("orders").select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_totalprice").alias("total"),
            F.col("o_orderdate").alias("placed_at"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("channel"),
        )

    @cached_property
    def order_items(self) -> DataFrame:
        return self.source("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_variant_id"),
            F.col("l_quantity").alias("quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
            F.col("l_extendedprice").alias("line_total"),
        )

    @cached_property
    def returns(self) -> DataFrame:
        return self.source("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_variant_id"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_returnflag").alias("status"),
        )

    @cached_property
    def products(self) -> DataFrame:
        return (
            self.source("part")
            .groupBy(F.col("p_name").alias("name"), F.col("p_brand").alias("category_id"))
            .agg(F.min("p_partkey").alias("id"))
            .select("id", "name", "category_id")
        )

    @cached_property
    def variants(self) -> DataFrame:
        """Parts with the product of their name and brand. Joined rather than windowed: the join
        can split a name that many parts share."""
        parts = self.source("part").alias("v")
        products = self.products.alias("p")
        same = F.col("v.p_name").eqNullSafe(F.col("p.name")) & F.col("v.p_brand").eqNullSafe(
            F.col("p.category_id")
        )
        return parts.join(products, same).select(
            F.col("v.p_partkey").alias("id"), F.col("p.id").alias("product_id")
        )

    @cached_property
    def customers(self) -> DataFrame:
        return self.source("customer").select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("legal_name"), F.col("c_custkey").alias("tax_id")
        )

    @cached_property
    def suppliers(self) -> DataFrame:
        return self.source("supplier").select(
            F.col("s_suppkey").alias("id"), F.col("s_name").alias("legal_name"), F.col("s_name").alias("tax_id")
        )

    @cached_property
    def valid_orders(self) -> DataFrame:
        return silver.silver_orders(self.orders, VALID_STATUS)

    @cached_property
    def valid_items(self) -> DataFrame:
        return silver.silver_order_items(self.order_items)
