"""Every query by name, over a folder of parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import bindings
from ledgerloom.bindings import Retail
from ledgerloom.operators import calendar, forecast, profile, recommend, sales, seasonal, silver
from ledgerloom.plans import medallion
from ledgerloom.session import materialize, new_database, new_path
from ledgerloom.sources import catalog, csvfiles

QUERIES = {}
VALIDATED = ("customer", "lineitem", "orders", "part")
JUNK_NAME = "gear"
SAMPLE_ROWS = 200

_exports: dict[tuple, str] = {}


def query(make):
    """Register a query under its function name; it is called with the bound tables."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return make(Retail(spark, folder))

    QUERIES[make.__name__] = run
    return make


def _exported_csv(retail: Retail, tables: tuple[str, ...] = bindings.SOURCE_TABLES, compression: str = "none") -> str:
    """A folder with the given source tables as CSV, written once per application."""
    key = (retail.spark.sparkContext.applicationId, retail.folder, tables, compression)
    if key not in _exports:
        folder = new_path(retail.spark, "csv")
        for name in tables:
            retail.source(name).write.options(
                header=True, escape='"', timestampNTZFormat="yyyy-MM-dd HH:mm:ss", compression=compression
            ).csv(medallion.csv_path(folder, name))
        _exports[key] = folder
    return _exports[key]


def _new_layers(retail: Retail) -> tuple[medallion.Layers, str]:
    """Layers in a database of their own; ``session.release`` drops it."""
    database = new_database(retail.spark, "run")
    return medallion.Layers(retail.spark, database), database


def _ntz(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


def _as_text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("string") for name in names})


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Six decimals for values whose last bits depend on the order of a sum."""
    return df.withColumns({name: F.round(name, 6) for name in names})


def _like_source(df: DataFrame, source: DataFrame) -> DataFrame:
    return df.select(*[F.col(field.name).cast(field.dataType) for field in source.schema])


# Sources and sinks


@query
def csv_scan_inferred(retail: Retail) -> DataFrame:
    path = medallion.csv_path(_exported_csv(retail, ("lineitem",)), "lineitem")
    return _like_source(csvfiles.scan_inferred(retail.spark, path), retail.source("lineitem"))


@query
def csv_scan_raw_text(retail: Retail) -> DataFrame:
    return csvfiles.scan_raw_text(retail.spark, medallion.csv_path(_exported_csv(retail, ("orders",)), "orders"))


@query
def discover_csv_tables(retail: Retail) -> DataFrame:
    return csvfiles.discover_csv_tables(retail.spark, _exported_csv(retail))


@query
def sample_first_n(retail: Retail) -> DataFrame:
    return csvfiles.sample_first_n(retail.source("orders"), SAMPLE_ROWS, ["o_orderkey"])


@query
def sample_first_rows(retail: Retail) -> DataFrame:
    """The first rows of each file, numbered, with their first two fields."""
    first = csvfiles.sample_first_rows(retail.spark, _exported_csv(retail), SAMPLE_ROWS, "place")
    return profile.union_rows(
        [
            text.select(F.lit(table).alias("table_name"), "place", F.col(text.columns[1]).alias("first_field"), F.col(text.columns[2]).alias("second_field"))
            for table, text in first.items()
        ]
    )


@query
def overwrite_itself(retail: Retail) -> DataFrame:
    """A table replaced by rows read from it, twice, the second time with another schema."""
    layers, _ = _new_layers(retail)
    layers.write(retail.source("orders"), "orders")
    layers.write(layers.read("orders").filter("o_orderkey % 2 = 0"), "orders")
    layers.write(layers.read("orders").withColumn("half", F.col("o_totalprice") / 2), "orders")
    return layers.read("orders")


@query
def overwrite_roundtrip(retail: Retail) -> DataFrame:
    layers, _ = _new_layers(retail)
    orders = retail.source("orders")
    layers.write(catalog.stamp_ingestion(orders.drop("o_totalprice")), "orders")
    layers.write(orders, "orders")
    return layers.read("orders")


@query
def raw_landing_counts(retail: Retail) -> DataFrame:
    layers, _ = _new_layers(retail)
    # The exported files are known to hold one record a line, which saves the pass that tells.
    medallion.land_raw_text(layers, _exported_csv(retail), bindings.SOURCE_TABLES, csvfiles.BY_LINE)
    return profile.union_rows([catalog.row_count(layers.read(f"raw_{t}"), F.lit(t)) for t in bindings.SOURCE_TABLES])


@query
def load_validation(retail: Retail) -> DataFrame:
    layers, _ = _new_layers(retail)
    medallion.land_raw_text(layers, _exported_csv(retail, VALIDATED), VALIDATED)
    return medallion.validate_load(layers, VALIDATED)


@query
def ingest_stamp(retail: Retail) -> DataFrame:
    return _stamp_counts(catalog.stamp_ingestion(retail.source("orders")))


def _stamp_counts(df: DataFrame) -> DataFrame:
    stamp = F.col(catalog.INGESTED_AT)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(stamp).alias("n_stamped"),
        F.count_distinct(stamp).alias("n_stamps"),
    )


@query
def ingest_row_counts(retail: Retail) -> DataFrame:
    layers, _ = _new_layers(retail)
    counts = medallion.ingest_bronze(
        layers, _exported_csv(retail), bindings.SOURCE_TABLES, bindings.SOURCE_SCHEMAS, csvfiles.BY_LINE
    )
    return retail.spark.createDataFrame(list(counts.items()), "table_name string, n_rows bigint")


@query
def bronze_ingest(retail: Retail) -> DataFrame:
    layers, _ = _new_layers(retail)
    medallion.ingest_bronze(layers, _exported_csv(retail), bindings.SOURCE_TABLES)
    return profile.union_rows(
        [
            _stamp_counts(layers.read(f"bronze_{t}")).select(F.lit(t).alias("table_name"), "*")
            for t in bindings.SOURCE_TABLES
        ]
    )


# Cleaned layer; the columns to convert arrive as text, as from a raw load


@query
def silver_orders(retail: Retail) -> DataFrame:
    text = _as_text(retail.orders, "placed_at", "created_at")
    return _ntz(silver.silver_orders(text, bindings.VALID_STATUS), "placed_at", "created_at")


@query
def silver_order_items(retail: Retail) -> DataFrame:
    return silver.silver_order_items(_as_text(retail.order_items, "unit_price", "quantity", "line_total"))


@query
def silver_returns(retail: Retail) -> DataFrame:
    return silver.silver_returns(retail.returns, bindings.RETURNED)


# Sales and loyalty


def _base(retail: Retail) -> DataFrame:
    return sales.sales_base(retail.valid_orders, retail.valid_items, retail.variants, retail.products)


def _revenue(retail: Retail) -> DataFrame:
    return sales.customer_revenue_freq(retail.valid_orders)


def _categories(retail: Retail) -> DataFrame:
    return sales.customer_categories(_base(retail))


def _diverse(retail: Retail, categories: DataFrame) -> DataFrame:
    return sales.diverse_customers(_revenue(retail), sales.category_diversity(categories))


def _loyal(retail: Retail, categories: DataFrame) -> DataFrame:
    return sales.loyal_customers(_diverse(retail, categories), retail.customers)


def _sold(retail: Retail) -> DataFrame:
    return sales.sold_lines(retail.valid_orders, retail.valid_items, retail.variants)


@query
def orders_overview(retail: Retail) -> DataFrame:
    return sales.orders_overview(retail.orders)


@query
def join_orders_items(retail: Retail) -> DataFrame:
    return sales.join_orders_items(retail.valid_orders, retail.valid_items)


@query
def join_variants(retail: Retail) -> DataFrame:
    return _sold(retail)


@query
def sales_base(retail: Retail) -> DataFrame:
    return _base(retail)


@query
def customer_revenue_freq(retail: Retail) -> DataFrame:
    return _revenue(retail)


@query
def category_diversity(retail: Retail) -> DataFrame:
    return sales.category_diversity(_categories(retail))


@query
def avg_ticket(retail: Retail) -> DataFrame:
    return sales.avg_ticket(_revenue(retail))


@query
def diverse_customers(retail: Retail) -> DataFrame:
    return _diverse(retail, _categories(retail))


@query
def loyal_customers(retail: Retail) -> DataFrame:
    return _loyal(retail, _categories(retail))


@query
def loyal_top_category(retail: Retail) -> DataFrame:
    # Asked twice of the same lines, so they are joined and condensed once.
    categories, _ = materialize(_categories(retail), "categories")
    return sales.loyal_top_category(categories, _loyal(retail, categories))


@query
def distinct_channels(retail: Retail) -> DataFrame:
    return sales.distinct_channels(retail.orders)


# Calendar


def _daily(retail: Retail) -> DataFrame:
    return calendar.channel_daily_sales(retail.valid_orders, bindings.SHOP)


def _filled(retail: Retail) -> DataFrame:
    return calendar.daily_sales_filled(_daily(retail))


def _as_double(df: DataFrame) -> DataFrame:
    return df.withColumn("venda_do_dia", F.col("venda_do_dia").cast("double"))


@query
def date_bounds(retail: Retail) -> DataFrame:
    return calendar.date_bounds(_daily(retail))


@query
def date_spine(retail: Retail) -> DataFrame:
    return calendar.date_spine(calendar.date_bounds(_daily(retail)))


@query
def pos_daily_sales(retail: Retail) -> DataFrame:
    return _as_double(_daily(retail))


@query
def daily_sales_filled(retail: Retail) -> DataFrame:
    return _as_double(_filled(retail))


@query
def weekday_labels(retail: Retail) -> DataFrame:
    return calendar.weekday_labels(_as_double(_filled(retail)))


@query
def weekday_avg_sales(retail: Retail) -> DataFrame:
    return calendar.weekday_avg_sales(_filled(retail))


# Profiles


def _profiled(retail: Retail) -> dict[str, DataFrame]:
    """Model tables with values blanked out, so that there is something missing to find."""

    def blank(df: DataFrame, column: str, value) -> DataFrame:
        return df.withColumn(column, F.nullif(F.col(column), F.lit(value)))

    return {
        "customers": blank(
            retail.source("customer").select(
                F.col("c_custkey").alias("id"), F.col("c_name").alias("legal_name"), F.col("c_mktsegment").alias("trade_name")
            ),
            "trade_name",
            "BUILDING",
        ),
        "orders": blank(blank(retail.orders, "channel", "4-NOT SPECIFIED"), "status", "P"),
        "order_items": blank(retail.order_items, "quantity", 1.0),
        "products": retail.products,
        "product_variants": retail.variants,
    }


def _forms(retail: Retail) -> DataFrame:
    """Text in all the forms that types are told from: empties, grouped digits, three ways to write a
    moment, truth values, numbers too long for 64 bits, numbers with a word among them."""
    orders = retail.source("orders")
    key, at = F.col("o_orderkey"), F.col("o_orderdate")
    text = key.cast("string")
    day, time = F.date_format(at, "yyyy-MM-dd"), F.date_format(at, "HH:mm:ss")
    return orders.select(
        F.when(key % 2 == 1, text).otherwise("").alias("blank"),
        F.concat(F.floor(key / 1000).cast("string"), F.lit("_"), F.lpad((key % 1000).cast("string"), 3, "0")).alias("grouped"),
        F.when(key % 3 == 0, day).when(key % 3 == 1, F.concat_ws("T", day, time)).otherwise(F.concat_ws(" ", day, time)).alias("moment"),
        F.when(key % 3 == 0, "true").when(key % 3 == 1, "False").otherwise("").alias("flag"),
        F.when(key % 2 == 0, "123456789012345678901234567890").otherwise("7").alias("wide"),
        F.when(key % 500 == 3, "n/a").otherwise("1.5").alias("mixed"),
        F.lit("").alias("nothing"),
        F.concat(F.lit("k"), text).alias("o_orderkey"),
    )


def _typed(retail: Retail) -> DataFrame:
    """Types told from text: every exported table as it was landed, and the hand-made forms.

    The files are read here only, so they are written compressed.
    """
    folder = _exported_csv(retail, compression="snappy")
    tables = {
        name: csvfiles.scan_raw_text(retail.spark, medallion.csv_path(folder, name), csvfiles.BY_LINE)
        for name in bindings.SOURCE_TABLES
    }
    return profile.infer_column_types({**tables, "forms": _forms(retail)})


@query
def null_profile(retail: Retail) -> DataFrame:
    return profile.null_profile(_profiled(retail))


@query
def table_volumetrics(retail: Retail) -> DataFrame:
    tables = {name: catalog.stamp_ingestion(retail.source(name)) for name in bindings.SOURCE_TABLES}
    return profile.table_volumetrics(tables)


@query
def schema_catalog(retail: Retail) -> DataFrame:
    return profile.schema_catalog({name: retail.source(name) for name in bindings.SOURCE_TABLES})


@query
def infer_column_types(retail: Retail) -> DataFrame:
    return _typed(retail)


@query
def generate_ddl(retail: Retail) -> DataFrame:
    return profile.generate_ddl(_typed(retail))


@query
def ddl_script(retail: Retail) -> DataFrame:
    """The script written as one text and read back, statement by statement."""
    path = new_path(retail.spark, "ddl")
    catalog.write_ddl_script(profile.generate_ddl(_typed(retail)), path)
    script = retail.spark.read.text(path, wholetext=True)
    return script.select(F.posexplode(F.split("value", r"(?=CREATE TABLE)")).alias("part", "text"))


@query
def type_conflicts(retail: Retail) -> DataFrame:
    return profile.type_conflicts(_typed(retail))


@query
def sanitize_columns(retail: Retail) -> DataFrame:
    orders = retail.source("orders")
    untidy = orders.toDF(*[f" {name.upper().replace('_', ' ')} " for name in orders.columns])
    return profile.sanitize_columns(untidy)


# Demand


def _target(retail: Retail) -> DataFrame:
    return forecast.find_product(retail.products, bindings.TARGET_PRODUCT)


def _demand(retail: Retail) -> DataFrame:
    return forecast.monthly_demand(_sold(retail))


def _baseline(retail: Retail) -> DataFrame:
    return forecast.moving_avg_forecast(_demand(retail), bindings.SPLIT)


@query
def find_product(retail: Retail) -> DataFrame:
    return _target(retail)


@query
def product_sales_lines(retail: Retail) -> DataFrame:
    return forecast.product_sales_lines(
        retail.valid_orders, retail.valid_items, retail.variants, _target(retail)
    )


@query
def monthly_demand(retail: Retail) -> DataFrame:
    return _demand(retail)


@query
def demand_train_test_split(retail: Retail) -> DataFrame:
    return forecast.demand_train_test_split(_demand(retail), bindings.SPLIT)


@query
def moving_avg_forecast(retail: Retail) -> DataFrame:
    return _rounded(_baseline(retail), "forecast")


@query
def baseline_mae(retail: Retail) -> DataFrame:
    return _rounded(forecast.mean_absolute_error(_baseline(retail)), "mae")


@query
def baseline_forecast_total(retail: Retail) -> DataFrame:
    return forecast.forecast_total(_baseline(retail))


@query
def seasonal_difference(retail: Retail) -> DataFrame:
    return forecast.seasonal_difference(_demand(retail))


@query
def seasonal_ar_forecast(retail: Retail) -> DataFrame:
    return _rounded(forecast.seasonal_ar_forecast(_demand(retail), bindings.SPLIT), "forecast")


@query
def forecast_comparison(retail: Retail) -> DataFrame:
    compared = forecast.forecast_comparison(_demand(retail), bindings.SPLIT)
    return _rounded(compared, "baseline_mae", "seasonal_mae")


@query
def seasonal_arma_coefficients(retail: Retail) -> DataFrame:
    return _rounded(seasonal.seasonal_arma_coefficients(_demand(retail), bindings.SPLIT), "phi", "theta", "seasonal_phi")


@query
def seasonal_arma_forecast(retail: Retail) -> DataFrame:
    return _rounded(seasonal.seasonal_arma_forecast(_demand(retail), bindings.SPLIT), "forecast")


@query
def forecast_protocols(retail: Retail) -> DataFrame:
    demand, _ = materialize(_demand(retail), "demand")
    return _rounded(seasonal.forecast_protocols(demand, bindings.SPLIT), "mae")


# Recommendations


def _lines(retail: Retail) -> DataFrame:
    return recommend.purchase_lines(_sold(retail))


def _basket(retail: Retail) -> DataFrame:
    return recommend.purchase_basket(_lines(retail))


@query
def purchase_crosstab(retail: Retail) -> DataFrame:
    return recommend.purchase_crosstab(_lines(retail))


@query
def purchase_matrix(retail: Retail) -> DataFrame:
    return recommend.purchase_matrix(_lines(retail))


@query
def product_buyer_counts(retail: Retail) -> DataFrame:
    return recommend.product_buyer_counts(_basket(retail))


@query
def co_purchase_counts(retail: Retail) -> DataFrame:
    return recommend.co_purchase_counts(_basket(retail))


@query
def product_similarity(retail: Retail) -> DataFrame:
    return _rounded(recommend.product_similarity(_basket(retail)), "score")


@query
def similar_products(retail: Retail) -> DataFrame:
    return recommend.similar_products(_basket(retail), retail.products, _target(retail))


@query
def similar_without_junk(retail: Retail) -> DataFrame:
    """The same ranking with products left out by a word in their name."""
    junk = F.contains(F.lower("name"), F.lit(JUNK_NAME))
    return recommend.similar_products(_basket(retail), retail.products, _target(retail), exclude=junk)


@query
def top5_similar_all_products(retail: Retail) -> DataFrame:
    return _rounded(recommend.top_similar_products(_basket(retail), retail.products), "score")
