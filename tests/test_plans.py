"""The plans have the shape the operators are written for."""

import os
import re

import pytest
from places import TESTDATA

import __spark_entry__ as entry
from ledgerloom.plans.registry import QUERIES

FOLDER = os.path.join(TESTDATA, "sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def plan(spark, name):
    return entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(params=["10MB", "-1"])
def threshold(spark, request):
    """With and without automatic broadcasts, as for small and for large dimensions."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, request.param)
    yield request.param
    spark.conf.set(key, before)


COMPOSED = [
    "sales_base", "loyal_customers", "loyal_top_category", "weekday_avg_sales", "monthly_demand",
    "forecast_comparison", "product_sales_lines", "product_similarity", "similar_products", "top5_similar_all_products",
]


@pytest.mark.parametrize("name", COMPOSED)
def test_no_cross_or_nested_loop_join(spark, threshold, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    if threshold == "-1":
        assert "BroadcastHashJoin" not in text, "a side is broadcast without a size check"


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "pos_daily_sales")
    assert "In(o_orderstatus, [F,O])" in text and "EqualTo(o_orderpriority,1-URGENT)" in text
    (read,) = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert {c.split(":")[0] for c in read.split(",")} == {
        "o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority",
    }


def test_lines_are_not_shuffled_by_product(spark, threshold):
    fact = [line for line in plan(spark, "category_diversity").splitlines() if "Exchange hashpartitioning" in line]
    assert not any(re.search(r"hashpartitioning\(customer_id#\d+L, product_id", line) for line in fact)
    if threshold == "-1":
        # order id twice, variant id twice, the dimensions' own, and the two of the distinct count
        assert sum("order_id" in line for line in fact) == 2
        assert sum("product_variant_id" in line for line in fact) == 2


def test_ranking_is_limited_before_its_shuffle(spark):
    text = plan(spark, "top5_similar_all_products")
    assert re.search(r"WindowGroupLimit .*Partial", text) and re.search(r"WindowGroupLimit .*Final", text)


def test_windows_over_months_share_one_shuffle(spark):
    text = plan(spark, "seasonal_ar_forecast")
    by_product = [line for line in text.splitlines() if re.search(r"hashpartitioning\(product_id#\d+L, \d+\)", line)]
    assert len(by_product) == 1


def test_no_python_outside_pair_counting(spark):
    for name in QUERIES:
        if name in ("co_purchase_counts", "product_similarity", "top5_similar_all_products"):
            continue
        text = plan(spark, name)
        assert "InArrow" not in text and "InPandas" not in text and "PythonUDF" not in text, name


def test_lines_are_counted_by_path_alone(spark, csv_dir):
    """Neither names nor filters on them are worked out for every line."""
    from ledgerloom.sources import csvfiles

    found = csvfiles.discover_csv_tables(spark, csv_dir(a="x\n1\n", b="x\n"))
    text = found._jdf.queryExecution().optimizedPlan().toString()
    below = text[text.index("\n", text.rindex("Aggregate [")) :]
    assert "file_path" in below and "regexp" not in below.lower() and "UrlCodec" not in below and "Filter" not in below
