"""Sales lines, customer loyalty and category ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.money import exact_mean, money_sum

# A loyal customer bought from this many categories; the report names the top ten.
MIN_CATEGORIES = 13
TOP_CUSTOMERS = 10
TOP_CATEGORIES = 5


def orders_overview(orders: DataFrame) -> DataFrame:
    """Row count, creation time range and value range of the untreated orders.

    The mean is over the values that were summed, so a NaN changes neither sum nor divisor.
    """
    return orders.sparkSession.sql(
        """
        SELECT count(*) AS total_linhas,
               min(created_at) AS data_minima,
               max(created_at) AS data_maxima,
               min(total) AS valor_minimo,
               max(total) AS valor_maximo,
               CAST(sum(amount) AS DOUBLE) / nullif(count(amount), 0) AS valor_medio
        FROM (SELECT created_at, total, try_cast(total AS DECIMAL(28,6)) AS amount FROM {orders})
        """,
        orders=orders,
    )


def join_orders_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Every item of every order, with the columns the sales questions need.

    Orders without items and items without an order drop out. The join shuffles on the order id;
    an order holding a large share of the items is split by the skew-join rule, as nothing above
    the join needs its partitioning.
    """
    heads = orders.select(F.col("id").alias("order_id"), "customer_id", "placed_at")
    lines = items.select("order_id", "product_variant_id", "quantity")
    return heads.join(lines, "order_id")


def join_variants(lines: DataFrame, variants: DataFrame) -> DataFrame:
    """Add the product of each line's variant; lines of unknown variants drop out."""
    keys = variants.select(F.col("id").alias("product_variant_id"), "product_id")
    return lines.join(keys, "product_variant_id")


def sold_lines(orders: DataFrame, items: DataFrame, variants: DataFrame) -> DataFrame:
    """One row per sold line with its product."""
    return join_variants(join_orders_items(orders, items), variants)


def sales_base(
    orders: DataFrame, items: DataFrame, variants: DataFrame, products: DataFrame, known_only: bool = True
) -> DataFrame:
    """Orders, items, variants and products joined: one row per sold line with its category.

    Variants meet their products first, so the lines are joined once, by variant, and never
    shuffled by product, where a best seller would gather them. Lines whose product is not listed
    drop out, or with ``known_only=False`` stay with ``known_product`` false.
    """
    categories = products.select(F.col("id").alias("product_id"), "category_id", F.lit(True).alias("known_product"))
    keys = variants.select(F.col("id").alias("product_variant_id"), "product_id").join(
        categories, "product_id", "inner" if known_only else "left"
    )
    if known_only:
        keys = keys.drop("known_product")
    else:
        keys = keys.na.fill({"known_product": False})
    return join_orders_items(orders, items).join(keys, "product_variant_id")


def customer_revenue_freq(orders: DataFrame) -> DataFrame:
    """Revenue and number of distinct orders per customer, from orders alone.

    Summing before any join with items keeps an order with many items from counting repeatedly.
    Both aggregates combine map-side; the distinct ids spread by (customer, id), so one customer
    with a third of the orders does not land in one task.
    """
    return orders.groupBy("customer_id").agg(
        money_sum("total").cast("double").alias("faturamento_total"),
        F.count_distinct("id").alias("frequencia"),
    )


def customer_categories(base: DataFrame) -> DataFrame:
    """Quantity per customer and category: all that the loyalty questions need of the lines."""
    return base.groupBy("customer_id", "category_id").agg(F.sum("quantity").alias("quantity"))


def category_diversity(categories: DataFrame) -> DataFrame:
    """Distinct categories bought per customer."""
    return categories.groupBy("customer_id").agg(F.count("category_id").alias("diversidade_categorias"))


def avg_ticket(revenue: DataFrame) -> DataFrame:
    """Add the mean order value; NULL where there is no order."""
    return revenue.withColumn("ticket_medio", exact_mean(F.col("faturamento_total"), F.col("frequencia")))


def diverse_customers(revenue: DataFrame, diversity: DataFrame, min_categories: int = MIN_CATEGORIES) -> DataFrame:
    """Customers with enough categories. Both sides are already partitioned by customer.

    The threshold is applied before the join: it only looks at one side.
    """
    diverse = diversity.filter(F.col("diversidade_categorias") >= min_categories)
    return avg_ticket(revenue.join(diverse, "customer_id"))


def loyal_customers(diverse: DataFrame, customers: DataFrame, top: int = TOP_CUSTOMERS) -> DataFrame:
    """Top customers by mean order value, ties by id."""
    names = customers.select("id", "legal_name")
    return (
        diverse.join(names, diverse["customer_id"] == names["id"])
        .select("id", "legal_name", "ticket_medio", "diversidade_categorias", "faturamento_total", "frequencia")
        .orderBy(F.col("ticket_medio").desc(), F.col("id").asc())
        .limit(top)
    )


def loyal_top_category(categories: DataFrame, loyal: DataFrame, top: int = TOP_CATEGORIES) -> DataFrame:
    """Categories by items bought by the loyal customers, ties by category.

    A semi join: ``loyal`` stays part of the plan, and its limit lets the planner broadcast it.
    """
    chosen = loyal.select(F.col("id").alias("customer_id"))
    return (
        categories.join(chosen, "customer_id", "left_semi")
        .groupBy("category_id")
        .agg(F.sum("quantity").alias("total_itens"))
        .orderBy(F.col("total_itens").desc(), F.col("category_id").asc())
        .limit(top)
    )


def distinct_channels(orders: DataFrame) -> DataFrame:
    return orders.select("channel").distinct()
