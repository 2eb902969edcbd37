import random
from itertools import combinations
from math import sqrt

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import recommend as rec
from ledgerloom.operators.sales import sold_lines


def frame(spark, pairs, kind="bigint"):
    return spark.createDataFrame(list(pairs), f"customer_id {kind}, product_id {kind}")


def brute(pairs):
    """Common buyers of every pair and buyers per product, counted one basket at a time."""
    baskets, both, buyers = {}, {}, {}
    for c, p in set(pairs):
        baskets.setdefault(c, set()).add(p)
        buyers[p] = buyers.get(p, 0) + 1
    for basket in baskets.values():
        for a, b in combinations(sorted(basket), 2):
            both[a, b] = both.get((a, b), 0) + 1
    return both, buyers


def random_pairs(seed, customers=60, products=40, n=500):
    rnd = random.Random(seed)
    pairs = [(rnd.randrange(customers), int(products * rnd.random() ** 2)) for _ in range(n)]
    pairs += [(1000, p) for p in range(products)]  # one customer who bought everything
    pairs += [(c, 0) for c in range(customers)]  # one product everybody bought
    return sorted(set(pairs))


GRIDS = [(2048, 2_000_000), (7, 2_000_000), (2048, 50), (7, 50), (1, 20)]


@pytest.mark.parametrize("block,cell", GRIDS)
def test_pair_counts_on_any_grid(spark, block, cell):
    pairs = random_pairs(block)
    want, _ = brute(pairs)
    got = rec.co_purchase_counts(frame(spark, pairs), block, cell).collect()
    assert len(got) == len(want)
    assert {(r.product_a, r.product_b): r.n_both for r in got} == want


def test_pair_counts_of_text_ids(spark):
    pairs = [(f"c{c}", f"p{p:02d}") for c, p in random_pairs(3)]
    want, _ = brute(pairs)
    got = rec.co_purchase_counts(frame(spark, pairs, "string"), 9, 60).collect()
    assert {(r.product_a, r.product_b): r.n_both for r in got} == want


def test_pairs_counted_in_small_steps():
    pairs = random_pairs(11)
    customers, products = zip(*pairs)
    block = [p % 2 for p in products]
    want, buyers = brute(pairs)
    n_buyers = pa.array([buyers[p] for p in products], pa.int64())
    table = pa.table(
        {"customer_id": customers, "product_id": products, "block": pa.array(block, pa.int32()), "n_buyers": n_buyers}
    )
    for step in (1, 13, 10**6):
        got = {}
        for a, b in ((0, 0), (0, 1), (1, 1)):
            cell = table.filter(pa.array([x in (a, b) for x in block]))
            for name, value in (("block_a", a), ("block_b", b)):
                cell = cell.append_column(name, pa.array([value] * len(cell), pa.int32()))
            for row in rec._cell_counter(step)(cell).to_pylist():
                pair = row["product_a"], row["product_b"]
                got[pair] = row["n_both"]
                assert (row["n_a"], row["n_b"]) == (buyers[pair[0]], buyers[pair[1]])
        assert got == want


def test_thin_cells_are_counted_as_sorted_codes(monkeypatch):
    """Few meetings among many products: the same counts without the dense array."""
    pairs = sorted({(random.Random(i).randrange(300), i % 700) for i in range(1500)})
    customers, products = [c for c, _ in pairs], [p for _, p in pairs]
    want, _ = brute(pairs)
    cell = pa.table({"customer_id": customers, "product_id": products, "block": pa.array([0] * len(pairs), pa.int32())})
    for name in ("block_a", "block_b"):
        cell = cell.append_column(name, pa.array([0] * len(pairs), pa.int32()))
    for sparse in (0, 10**9):
        monkeypatch.setattr(rec, "SPARSE", sparse)
        for step in (1, 50, 10**6):
            rows = rec._cell_counter(step, with_buyers=False)(cell).to_pylist()
            assert {(r["product_a"], r["product_b"]): r["n_both"] for r in rows} == want and len(rows) == len(want)


def test_number_of_cells_of_a_large_catalogue():
    """1e10 rows of 1e7 products: every cell has its bounded rows, and there are not many more cells than that takes."""
    rows, blocks, per_cell = 10**10, 4883, 2_000_000
    shares = rec.shares_of_cells(rows, blocks, per_cell, cores=4000)
    assert 2 * rows / blocks / shares <= per_cell
    assert shares * blocks * (blocks + 1) // 2 < 4e7
    # Small catalogues still give every core a share.
    assert rec.shares_of_cells(400_000, 1, per_cell, cores=8) == 7 and rec.shares_of_cells(10, 1, per_cell, cores=8) == 1


@pytest.mark.parametrize("shares", [1, 5])
def test_rows_are_copied_only_where_customers_have_partners(spark, shares):
    """One block means one copy whatever the shares; with many, at most the customer's own blocks."""
    pairs = random_pairs(4)
    placed, blocks = rec._placed(frame(spark, pairs), 40, 2048)
    assert blocks == 1 and rec._cells(placed, blocks, len(pairs), len(pairs) // shares).count() == len(pairs)
    placed, blocks = rec._placed(frame(spark, pairs), 40, 4)
    assert blocks == 10
    visited = {}
    for row in placed.collect():
        visited.setdefault(row.customer_id, []).append(row.block)
    copies = rec._cells(placed, blocks, len(pairs), len(pairs) // shares).count()
    assert copies == sum(len(b) * len(set(b)) for b in visited.values()) < blocks * len(pairs)


def test_empty_basket(spark):
    assert rec.co_purchase_counts(frame(spark, [])).count() == 0
    assert rec.product_similarity(frame(spark, [])).count() == 0


def test_similarity_is_symmetric_and_bounded(spark):
    pairs = random_pairs(5)
    both, buyers = brute(pairs)
    got = {(r.product_id, r.similar_id): r.score for r in rec.product_similarity(frame(spark, pairs)).collect()}
    assert len(got) == 2 * len(both)
    for (a, b), n in both.items():
        assert got[a, b] == got[b, a] == pytest.approx(n / sqrt(buyers[a] * buyers[b]))
        assert 0 < got[a, b] <= 1 + 1e-12


def names(spark, ids):
    return spark.createDataFrame([(i, f"n{i}") for i in ids], "id bigint, name string")


def top(pairs, k):
    both, buyers = brute(pairs)
    out = {}
    for a in buyers:
        scored = [
            (-both.get((min(a, b), max(a, b)), 0) / sqrt(buyers[a] * buyers[b]), b) for b in buyers if b != a
        ]
        out[a] = [(b, -s) for s, b in sorted(scored)[:k]]
    return out


# Two groups of buyers with nothing in common, so that lists must be filled with zeros.
SPARSE = [(1, 10), (1, 11), (2, 10), (2, 12), (3, 50), (3, 51), (4, 50), (5, 99), (6, 1)]


@pytest.mark.parametrize("pairs,k", [(random_pairs(8), 5), (SPARSE, 5), (SPARSE, 2), ([(1, 1)], 5)])
def test_top_of_every_product(spark, pairs, k):
    want = top(pairs, k)
    products = names(spark, {p for _, p in pairs} - {12})
    got = {}
    for r in rec.top_similar_products(frame(spark, pairs), products, k).orderBy("product_id", "rank").collect():
        got.setdefault(r.product_id, []).append((r.similar_id, r.score))
        assert r.rank == len(got[r.product_id])
        assert r.similar_name == (None if r.similar_id == 12 else f"n{r.similar_id}")
    assert {p: [b for b, _ in v] for p, v in got.items()} == {p: [b for b, _ in v] for p, v in want.items() if v}
    for p, v in got.items():
        assert [s for _, s in v] == pytest.approx([s for _, s in want[p]])


def test_similar_to_one(spark):
    products = names(spark, {p for _, p in SPARSE})
    for target in (10, 50, 99):
        chosen = products.filter(F.col("id") == target)
        got = rec.similar_products(frame(spark, SPARSE), products, chosen).collect()
        assert [(r.similar_id, r.score) for r in got] == [(b, round(s, 4)) for b, s in top(SPARSE, 5)[target]]
    never_bought = spark.createDataFrame([(7, "x")], "id bigint, name string")
    assert rec.similar_products(frame(spark, SPARSE), products, never_bought).count() == 0
    assert rec.similar_products(frame(spark, SPARSE), products, products.limit(0)).count() == 0


def test_junk_products_can_be_left_out(spark):
    products = names(spark, {p for _, p in SPARSE}).withColumn(
        "name", F.when(F.col("id") == 12, "asdf").otherwise(F.col("name"))
    )
    target = products.filter(F.col("id") == 10)
    with_junk = rec.similar_products(frame(spark, SPARSE), products, target)
    without = rec.similar_products(frame(spark, SPARSE), products, target, exclude=F.col("name") == "asdf")
    assert "asdf" in {r.similar_name for r in with_junk.collect()}
    kept = [pair for pair in SPARSE if pair[1] != 12]
    assert [r.similar_id for r in without.collect()] == [b for b, _ in top(kept, 5)[10]]


def test_lines_without_a_key_are_left_out(spark):
    orders = spark.createDataFrame([(1, 5), (2, None), (None, 6)], "id bigint, customer_id bigint").withColumn(
        "placed_at", F.current_timestamp()
    )
    items = spark.createDataFrame(
        [(1, 1), (1, 1), (1, 2), (2, 1), (None, 1)], "order_id bigint, product_variant_id bigint"
    ).withColumn("quantity", F.lit(1.0))
    variants = spark.createDataFrame([(1, 7), (2, None)], "id bigint, product_id bigint")
    lines = rec.purchase_lines(sold_lines(orders, items, variants))
    assert [tuple(r) for r in rec.purchase_crosstab(lines).collect()] == [(5, 7, 2)]
    assert [tuple(r) for r in rec.purchase_matrix(lines).collect()] == [(5, 7, 1)]
    assert [tuple(r) for r in rec.product_buyer_counts(rec.purchase_basket(lines)).collect()] == [(7, 1)]


def test_pairs_leave_a_cell_in_parts(monkeypatch):
    monkeypatch.setattr(rec, "PAIRS_PER_PART", 10)
    pairs = random_pairs(5)
    customers, products = zip(*pairs)
    n = len(pairs)
    cell = pa.table({"customer_id": customers, "product_id": products, "n_buyers": [1] * n, "block": [0] * n, "block_a": [0] * n, "block_b": [0] * n})
    for sparse in (0, 1000):
        monkeypatch.setattr(rec, "SPARSE", sparse)
        parts = list(rec._cell_counter(100).by_part((), iter(cell.to_batches(max_chunksize=7))))
        assert max(map(len, parts)) <= 10
        assert {(r["product_a"], r["product_b"]): r["n_both"] for part in parts for r in part.to_pylist()} == brute(pairs)[0]
