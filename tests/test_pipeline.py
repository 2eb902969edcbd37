"""The whole pipeline over a small hand-made shop, one CSV file per table."""

import datetime as dt

import pytest

from ledgerloom.operators.forecast import Split
from ledgerloom.plans import medallion
from ledgerloom.session import new_path


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("shop")
    tables = {name: "id,note\n1,x\n" for name in medallion.RETAIL_TABLES}
    products = [(i, f"Motor {i}", i % 14) for i in range(1, 29)]
    tables["products"] = "id,name,category_id\n" + "".join(f"{i},{n},{c}\n" for i, n, c in products)
    tables["product_variants"] = "id,product_id\n" + "".join(f"{100 + i},{i}\n" for i in range(1, 29))
    tables["customers"] = 'id,legal_name,trade_name,tax_id\n1,"Silva, Ana",,11\n2,Bruno,"B ""Mar""",22\n3,Caio,,33\n'
    tables["suppliers"] = "id,legal_name,tax_id\n1,Fornece,11.222\n"
    tables["payments"] = "id,order_id\n1,1\n2,2\n"
    tables["returns"] = "id,status\n1,completed\n2,open\n"
    orders, items, at = [], [], dt.date(2024, 1, 1)
    for i in range(1, 121):
        status = ("paid", "completed", "shipped", "cancelled", "")[i % 5]
        channel = ("pos", "web")[i % 2]
        orders.append(f"{i},{1 + i % 2},{100 + i}.10,{at},{at} 08:00:00,{status},{channel}\n")
        items.extend(f"{i},{101 + (i + k) % 28},9.9,{1 + k},{9.9 * (1 + k):.2f}\n" for k in range(3))
        at += dt.timedelta(days=7)
    tables["orders"] = "id,customer_id,total,placed_at,created_at,status,channel\n" + "".join(orders)
    tables["order_items"] = "order_id,product_variant_id,unit_price,quantity,line_total\n" + "".join(items)
    for name, text in tables.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    spark.sql("CREATE DATABASE shop")
    made = medallion.Layers(spark, "shop", root=new_path(spark, "shop"))
    object.__setattr__(made, "folder", str(folder))
    counts = medallion.ingest_bronze(made, str(folder))
    assert len(counts) == 22 and counts["orders"] == 120 and counts["order_items"] == 360
    assert medallion.build_silver(made) == {
        "silver_orders": 72, "silver_order_items": 360, "silver_returns": 1, "silver_sales": 216,
    }
    medallion.build_gold(made)
    return made


def test_gold(layers):
    loyal = layers.read("gold_q4_clientes_fies")
    assert loyal.columns == [
        "id", "legal_name", "ticket_medio", "diversidade_categorias", "faturamento_total", "frequencia",
    ]
    assert {r.id: r.diversidade_categorias for r in loyal.collect()} == {1: 14, 2: 14}
    week = layers.read("gold_q5_vendas_calendario").orderBy("num_dia").collect()
    assert [r.num_dia for r in week] == list(range(1, 8))
    # 2024-01-01 was a Monday and orders came weekly; every other day is an empty one.
    assert [r.media_venda_diaria > 0 for r in week] == [False, True, False, False, False, False, False]


def test_rebuilding_changes_nothing(layers):
    before = sorted(map(tuple, layers.read("gold_q4_clientes_fies").collect()))
    medallion.build_silver(layers)
    medallion.build_gold(layers)
    assert sorted(map(tuple, layers.read("gold_q4_clientes_fies").collect())) == before


def test_reports(layers):
    assert medallion.top_category(layers).count() == 5
    volumes = medallion.volumetrics(layers).collect()
    assert len(volumes) == 22 and tuple(volumes[0]) == ("bronze_order_items", 360, 6)
    nulls = {(r.table_name, r.column_name): r.n_nulls for r in medallion.key_nulls(layers).collect()}
    assert nulls["bronze_customers", "trade_name"] == 2 and nulls["bronze_orders", "status"] == 24
    similar = medallion.recommendations(layers, "motor 5").collect()
    assert len(similar) == 5 and similar[0].score >= similar[-1].score
    assert medallion.overview(layers).first().total_linhas == 120
    assert {r.channel for r in medallion.channels(layers).collect()} == {"pos", "web"}
    stamped = medallion.schemas(layers).filter("column_name = '_ingested_at' AND column_type = 'timestamp'")
    assert stamped.count() == 22
    months = medallion.baseline_forecast(layers, "motor 5", Split(dt.date(2026, 1, 31), dt.date(2026, 2, 1), dt.date(2026, 3, 31)))
    assert all(r.forecast is not None for r in months.collect())
    split = Split(dt.date(2026, 1, 31), dt.date(2026, 2, 1), dt.date(2026, 3, 31))
    compared = medallion.demand_forecast(layers, "motor 5", split)
    months = {r.month: r for r in medallion.baseline_forecast(layers, "motor 5", split).collect()}
    (row,) = compared.collect()
    assert row.product_id == 5 and row.n_months == len(months) == 2
    assert row.baseline_total == pytest.approx(sum(r.forecast for r in months.values()), abs=1)


def test_raw_load_and_schema(layers, tmp_path):
    counts = medallion.land_raw_text(layers, layers.folder)
    assert counts["customers"] == 3
    total = {r.table_name: r.n_rows for r in medallion.validate_load(layers).collect()}
    assert total == {"customers": 3, "orders": 120, "order_items": 360, "payments": 2, "TOTAL": 485}
    assert {t for _, t in layers.read("raw_orders").dtypes} == {"string"}
    assert layers.read("raw_customers").filter("trade_name IS NULL").count() == 0
    ddl = {r.table_name: r.ddl for r in medallion.relational_schema(layers, layers.folder).collect()}
    assert list(ddl) == sorted(medallion.RETAIL_TABLES)
    assert '"placed_at" TIMESTAMP' in ddl["orders"] and '"total" DOUBLE PRECISION' in ddl["orders"]
    medallion.relational_schema(layers, layers.folder, str(tmp_path / "ddl"), tables=["orders"], sample_rows=200)
    (part,) = (tmp_path / "ddl").glob("part-*")
    assert ddl["orders"] in part.read_text(encoding="utf-8")
    assert '"tax_id" BIGINT' in ddl["customers"] and '"status" TEXT' in ddl["orders"]
