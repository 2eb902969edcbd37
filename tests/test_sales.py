import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import calendar, sales, silver

ORDERS = "id bigint, customer_id bigint, total double, placed_at string, created_at string, status string, channel string"


def orders(spark, *rows):
    return spark.createDataFrame(list(rows), ORDERS)


def test_silver_parses_and_filters(spark):
    df = orders(
        spark,
        (1, 1, 1.0, "2024-01-05 10:00:00", "bad", "paid", "pos"),
        (2, 1, 1.0, "2024-01-05", None, None, "pos"),
        (3, 1, 1.0, "2024-01-05", "", "cancelled", "pos"),
        (4, 1, 1.0, "bad", "2024-01-05T10:00:00", "shipped", "web"),
    )
    rows = {r.id: r for r in silver.silver_orders(df).collect()}
    assert set(rows) == {1, 4}
    assert rows[1].placed_at.hour == 10 and rows[1].created_at is None
    assert rows[4].placed_at is None and rows[4].created_at.hour == 10


def test_silver_items_and_returns(spark):
    items = spark.createDataFrame([(1, "2.50", "n/a", None)], "order_id int, unit_price string, quantity string, line_total string")
    assert tuple(silver.silver_order_items(items).first()) == (1, 2.5, None, None)
    returns = spark.createDataFrame([("completed",), ("open",), (None,)], "status string")
    assert silver.silver_returns(returns).count() == 1


def shop(spark):
    o = orders(
        spark,
        (1, 10, 100.0, "2024-01-05", None, "paid", "pos"),
        (2, 10, 50.0, "2024-01-06", None, "paid", "pos"),
        (3, 11, 150.0, "2024-01-07", None, "paid", "web"),
        (4, 12, 999.0, "2024-01-07", None, "paid", "web"),
        (None, 12, 1.0, "2024-01-07", None, "paid", "web"),
    )
    items = spark.createDataFrame(
        [(1, 1, 2.0), (1, 2, 1.0), (1, 3, 5.0), (2, 1, 1.0), (3, 1, 3.0), (3, 99, 7.0), (None, 1, 9.0)],
        "order_id bigint, product_variant_id bigint, quantity double",
    )
    variants = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, None)], "id bigint, product_id bigint")
    products = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], "id bigint, name string, category_id string")
    return o, items, variants, products


def test_no_fan_out_and_orphans_drop(spark):
    o, items, variants, products = shop(spark)
    revenue = {r.customer_id: (r.faturamento_total, r.frequencia) for r in sales.customer_revenue_freq(o).collect()}
    assert revenue == {10: (150.0, 2), 11: (150.0, 1), 12: (1000.0, 1)}
    base = sales.sales_base(o, items, variants, products)
    assert base.count() == 5
    everything = sales.sales_base(o, items, variants, products.filter("id <> 2"), known_only=False)
    assert sorted((r.product_id, r.known_product) for r in everything.collect()) == [
        (1, True), (1, True), (1, True), (2, False), (3, True),
    ]
    assert {r.customer_id: r.diversidade_categorias for r in sales.category_diversity(sales.customer_categories(base)).collect()} == {10: 3, 11: 1}


def test_loyal_ties_by_id(spark):
    o, items, variants, products = shop(spark)
    o = o.withColumn("total", F.lit(10.0))
    base = sales.sales_base(o, items, variants, products)
    customers = spark.createDataFrame([(11, "B"), (10, "A")], "id bigint, legal_name string")
    diverse = sales.diverse_customers(sales.customer_revenue_freq(o), sales.category_diversity(sales.customer_categories(base)), 1)
    loyal = sales.loyal_customers(diverse, customers)
    assert [r.id for r in loyal.collect()] == [10, 11]
    assert [r.id for r in sales.loyal_customers(diverse, customers, 1).collect()] == [10]
    top = sales.loyal_top_category(sales.customer_categories(base), loyal)
    assert [(r.category_id, r.total_itens) for r in top.collect()] == [("x", 6.0), ("z", 5.0), ("y", 1.0)]
    assert [r.id for r in sales.loyal_customers(sales.diverse_customers(
        sales.customer_revenue_freq(o), sales.category_diversity(sales.customer_categories(base)), 2), customers).collect()] == [10]


def test_cents_add_up_in_any_order(spark):
    rows = [(i, 1, 0.1, None, None, "paid", "pos") for i in range(1000)]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        total = sales.customer_revenue_freq(orders(spark, *rows).repartition(7)).first().faturamento_total
        assert total == 100.0


def test_zero_orders_give_null_ticket(spark):
    df = spark.createDataFrame([(1, 5.0, 0)], "customer_id bigint, faturamento_total double, frequencia bigint")
    assert sales.avg_ticket(df).first().ticket_medio is None


def test_calendar_gap_counts_as_zero(spark):
    df = orders(
        spark,
        (1, 1, 70.0, "2024-01-07 09:00:00", None, "paid", "pos"),
        (2, 1, 30.0, "2024-01-14 23:59:59", None, "paid", "pos"),
        (3, 1, 99.0, "2024-01-20", None, "paid", "web"),
        (4, 1, 99.0, None, None, "paid", "pos"),
    )
    filled = calendar.daily_sales_filled(calendar.channel_daily_sales(silver.silver_orders(df)))
    days = [(str(r.data_completa), float(r.venda_do_dia)) for r in filled.orderBy("data_completa").collect()]
    assert len(days) == 8 and days[0] == ("2024-01-07", 70.0) and days[-1] == ("2024-01-14", 30.0)
    assert sum(x for _, x in days) == 100.0
    week = [(r.num_dia, r.dia_semana_pt, r.media_venda_diaria) for r in calendar.weekday_avg_sales(filled).collect()]
    assert week[0] == (1, "1. Domingo", 50.0) and week[6] == (7, "7. Sábado", 0.0) and len(week) == 7


def test_calendar_without_sales_is_empty(spark):
    daily = calendar.channel_daily_sales(silver.silver_orders(orders(spark)))
    assert calendar.daily_sales_filled(daily).count() == 0
    assert tuple(calendar.date_bounds(daily).first()) == (None, None)


def test_distinct_channels(spark):
    df = orders(spark, *[(i, 1, 1.0, None, None, "paid", c) for i, c in enumerate(["pos", "web", "pos", None])])
    assert {r.channel for r in sales.distinct_channels(df).collect()} == {"pos", "web", None}


def test_amounts_keep_fractions_of_a_cent_and_leave_out_nan(spark):
    rows = [(1, 0.005), (2, 0.005), (3, 0.004), (4, float("nan")), (5, None)]
    orders = spark.createDataFrame(rows, "id bigint, total double").selectExpr("*", "7 AS customer_id", "timestamp'2024-01-01' AS created_at")
    found = sales.orders_overview(orders).first()
    assert found.total_linhas == 5 and found.valor_medio == pytest.approx(0.014 / 3)
    assert sales.customer_revenue_freq(orders).first().faturamento_total == pytest.approx(0.014)
