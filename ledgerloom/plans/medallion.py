"""The layered pipeline: CSV files to bronze, silver and gold tables.

Every step reads catalog tables and writes catalog tables, so each can be rerun on its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import calendar, forecast, profile, recommend, sales, silver
from ledgerloom.sources import catalog, csvfiles

# The retail tables, one CSV file each.
RETAIL_TABLES = (
    "addresses",
    "attributes",
    "brands",
    "categories",
    "customers",
    "employees",
    "fiscal_invoices",
    "goods_receipt_items",
    "goods_receipts",
    "locations",
    "order_items",
    "orders",
    "payments",
    "product_suppliers",
    "product_variants",
    "products",
    "purchase_order_items",
    "purchase_orders",
    "return_items",
    "returns",
    "stock_levels",
    "suppliers",
)
KEY_TABLES = ("customers", "orders", "order_items", "products", "product_variants")
VALIDATED_TABLES = ("customers", "orders", "order_items", "payments")


@dataclass(frozen=True)
class Layers:
    """Where the layers live: database, table format and, if not the warehouse, a root folder."""

    spark: SparkSession
    database: str = "default"
    fmt: str = "parquet"
    root: str | None = None

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def read(self, table: str) -> DataFrame:
        return catalog.read_table(self.spark, self.name(table))

    def write(self, df: DataFrame, table: str) -> int:
        path = f"{self.root}/{table}" if self.root else None
        return catalog.overwrite_table(df, self.name(table), self.fmt, path)


def csv_path(folder: str, table: str) -> str:
    return f"{folder}/{table}.csv"


# Tables loaded at the same time: small ones fill the cores a large one's last tasks leave idle.
PARALLEL_LOADS = 4


def _load_each(tables: Iterable[str], load: Callable[[str], int]) -> dict[str, int]:
    """Run ``load`` for every table, a few at a time; the rows each one wrote."""
    tables = list(tables)
    with ThreadPoolExecutor(PARALLEL_LOADS) as pool:
        return dict(zip(tables, pool.map(load, tables), strict=True))


def ingest_bronze(
    layers: Layers,
    folder: str,
    tables: Iterable[str] = RETAIL_TABLES,
    schemas: dict | None = None,
    layout: str | None = None,
) -> dict[str, int]:
    """Load each CSV as it is, stamped with the load time; rows written per table.

    Known schemas and a known record ``layout`` save one pass over the files each.
    """

    def load(table: str) -> int:
        path = csv_path(folder, table)
        raw = csvfiles.scan_inferred(layers.spark, path, (schemas or {}).get(table), layout)
        return layers.write(catalog.stamp_ingestion(raw), f"bronze_{table}")

    return _load_each(tables, load)


def _found(layers: Layers, folder: str, tables: Iterable[str] | None) -> list[str]:
    return list(tables) if tables is not None else csvfiles.csv_table_names(layers.spark, folder)


def land_raw_text(
    layers: Layers, folder: str, tables: Iterable[str] | None = None, layout: str | None = None
) -> dict[str, int]:
    """Load each CSV of the folder as text only, nothing treated; rows written per table.

    Rows of the wrong length fail the write, which reads every column.
    """

    def load(table: str) -> int:
        raw = csvfiles.scan_raw_text(layers.spark, csv_path(folder, table), layout)
        return layers.write(raw, f"raw_{table}")

    return _load_each(_found(layers, folder, tables), load)


def build_silver(layers: Layers) -> dict[str, int]:
    """Cleaned orders, items and returns, and the sold lines joined from them.

    Loyalty, demand and recommendations all start from the same join of orders, items, variants
    and products. It is the largest shuffle of the pipeline and is made here once.
    """
    cleaned = {
        "silver_orders": silver.silver_orders(layers.read("bronze_orders")),
        "silver_order_items": silver.silver_order_items(layers.read("bronze_order_items")),
        "silver_returns": silver.silver_returns(layers.read("bronze_returns")),
    }
    counts = {table: layers.write(df, table) for table, df in cleaned.items()}
    lines = sales.sales_base(
        layers.read("silver_orders"),
        layers.read("silver_order_items"),
        layers.read("bronze_product_variants"),
        layers.read("bronze_products"),
        known_only=False,
    )
    counts["silver_sales"] = layers.write(lines, "silver_sales")
    return counts


def _customer_categories(layers: Layers) -> DataFrame:
    return sales.customer_categories(layers.read("silver_sales").filter("known_product"))


def build_gold(layers: Layers) -> dict[str, int]:
    """Loyal customers and weekday sales. The names are those the reports expect."""
    orders = layers.read("silver_orders")
    diversity = sales.category_diversity(_customer_categories(layers))
    diverse = sales.diverse_customers(sales.customer_revenue_freq(orders), diversity)
    loyal = sales.loyal_customers(diverse, layers.read("bronze_customers"))
    weekdays = calendar.weekday_avg_sales(calendar.daily_sales_filled(calendar.channel_daily_sales(orders)))
    return {
        "gold_q4_clientes_fies": layers.write(loyal, "gold_q4_clientes_fies"),
        "gold_q5_vendas_calendario": layers.write(weekdays, "gold_q5_vendas_calendario"),
    }


def top_category(layers: Layers) -> DataFrame:
    """Categories most bought by the customers of the written loyalty table."""
    return sales.loyal_top_category(_customer_categories(layers), layers.read("gold_q4_clientes_fies"))


def _demand_of(layers: Layers, product_text: str) -> DataFrame:
    product = forecast.find_product(layers.read("bronze_products"), product_text)
    wanted = product.select(F.col("id").alias("product_id"))
    return forecast.monthly_demand(layers.read("silver_sales").join(wanted, "product_id", "left_semi"))


def baseline_forecast(layers: Layers, product_text: str, split: forecast.Split = forecast.Split()) -> DataFrame:
    """Moving-average forecast per test month, to two decimals, for the product a text finds."""
    months = forecast.moving_avg_forecast(_demand_of(layers, product_text), split)
    return months.withColumn("forecast", F.bround("forecast", 2)).orderBy("month")


def demand_forecast(layers: Layers, product_text: str, split: forecast.Split = forecast.Split()) -> DataFrame:
    """Baseline against seasonal forecast for the product a text finds."""
    return forecast.forecast_comparison(_demand_of(layers, product_text), split)


def recommendations(layers: Layers, product_text: str, exclude=None) -> DataFrame:
    """Products most similar to the one a text finds."""
    products = layers.read("bronze_products")
    basket = recommend.purchase_basket(recommend.purchase_lines(layers.read("silver_sales")))
    target = forecast.find_product(products, product_text)
    return recommend.similar_products(basket, products, target, exclude=exclude)


def bronze_tables(layers: Layers, tables: Iterable[str] = RETAIL_TABLES) -> dict[str, DataFrame]:
    return {f"bronze_{table}": layers.read(f"bronze_{table}") for table in tables}


def overview(layers: Layers) -> DataFrame:
    """Count, time range and value range of the untreated orders."""
    return sales.orders_overview(layers.read("bronze_orders"))


def channels(layers: Layers) -> DataFrame:
    return sales.distinct_channels(layers.read("bronze_orders"))


def volumetrics(layers: Layers, tables: Iterable[str] = RETAIL_TABLES) -> DataFrame:
    return profile.table_volumetrics(bronze_tables(layers, tables))


def schemas(layers: Layers, tables: Iterable[str] = RETAIL_TABLES, count_values: bool = False) -> DataFrame:
    """Columns and types of the bronze tables; filled values are counted only on demand."""
    make = profile.schema_catalog if count_values else profile.schema_listing
    return make(bronze_tables(layers, tables))


def key_nulls(layers: Layers) -> DataFrame:
    return profile.null_profile(bronze_tables(layers, KEY_TABLES))


def validate_load(layers: Layers, tables: Iterable[str] = VALIDATED_TABLES) -> DataFrame:
    """Rows of the raw tables and their sum."""
    return profile.load_validation({table: layers.read(f"raw_{table}") for table in tables})


def column_types(
    layers: Layers, folder: str, tables: Iterable[str] | None = None, sample_rows: int | None = None
) -> DataFrame:
    """Relational types inferred from the CSV files' text.

    All rows are judged, or with ``sample_rows`` the first that many of each table, and no more is read.
    """
    if sample_rows is not None:
        first = csvfiles.sample_first_rows(layers.spark, folder, sample_rows)
        return profile.infer_column_types({t: text for t, text in first.items() if tables is None or t in set(tables)})
    return profile.infer_column_types({t: csvfiles.scan_raw_text(layers.spark, csv_path(folder, t)) for t in _found(layers, folder, tables)})


def relational_schema(layers: Layers, folder: str, script: str | None = None, **options) -> DataFrame:
    """CREATE TABLE statements by table, and with ``script`` written there as one text."""
    ddl = profile.generate_ddl(column_types(layers, folder, **options))
    if script is not None:
        catalog.write_ddl_script(ddl, script)
    return ddl
