"""Item-to-item similarity over who bought what.

Baskets are sparse (customer, product) pairs. The cosine of two products' buyer sets is
``buyers of both / sqrt(buyers of a * buyers of b)``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import materialize

TOP_SIMILAR = 5

# Counting works on a grid of cells: a block of products against a block of products, over a
# share of the customers. These bound the counters and the rows one cell holds in memory.
PRODUCTS_PER_BLOCK = 2048
ROWS_PER_CELL = 2_000_000
ROWS_WORTH_A_TASK = 60_000
PAIRS_PER_STEP = 500_000
PAIRS_PER_PART = 1 << 18
SPARSE = 16


def purchase_lines(lines: DataFrame) -> DataFrame:
    """Customer and product of every sold line; lines lacking either are left out."""
    return lines.select("customer_id", "product_id").filter(
        F.col("customer_id").isNotNull() & F.col("product_id").isNotNull()
    )


def purchase_crosstab(lines: DataFrame) -> DataFrame:
    """How often each customer bought each product, without the empty cells."""
    return lines.groupBy("customer_id", "product_id").agg(F.count(F.lit(1)).alias("n_lines"))


def purchase_basket(lines: DataFrame) -> DataFrame:
    """The distinct (customer, product) pairs. Duplicates are dropped map-side first."""
    return lines.select("customer_id", "product_id").distinct()


def purchase_matrix(lines: DataFrame) -> DataFrame:
    """The filled cells of the 0/1 purchase matrix."""
    return purchase_basket(lines).withColumn("bought", F.lit(1))


def product_buyer_counts(basket: DataFrame) -> DataFrame:
    """Distinct buyers per product."""
    return basket.groupBy("product_id").agg(F.count(F.lit(1)).alias("n_buyers"))


def _cosine(both: Column, a: Column, b: Column) -> Column:
    return both.cast("double") / F.sqrt(a.cast("double") * b.cast("double"))


def _cell_counter(pairs_per_step: int, with_buyers: bool = True):
    """The counting of one cell, as a closure so that it travels to the workers by value."""

    def few(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Sorted pair codes and their summed counts."""
        code, count = np.concatenate(codes), np.concatenate(counts)
        order = np.argsort(code, kind="stable")
        code, count = code[order], count[order]
        first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.zeros(0, np.int64)
        return code[first], np.add.reduceat(count, first) if len(code) else count

    def parts(table: pa.Table) -> Iterator[pa.Table]:
        """Common buyers of each product pair within one cell of the grid, ``PAIRS_PER_PART`` pairs at a time.

        For every row of the left block it walks the same customer's rows of the right block. Where
        the cell has at least as many meetings as a ``SPARSE``-th of its possible pairs they are counted into a
        dense array of the two blocks; a thinner cell keeps sorted pair codes with run lengths, so its
        memory follows its meetings. Only finished counts leave the cell.
        """
        block_a, block_b = table["block_a"][0].as_py(), table["block_b"][0].as_py()
        customers = table["customer_id"].combine_chunks().dictionary_encode()
        who = customers.indices.to_numpy()

        def side(block):
            chosen = pc.equal(table["block"], block)
            names = table["product_id"].filter(chosen).combine_chunks().dictionary_encode()
            code = names.indices.to_numpy()
            buyers = np.zeros(max(len(names.dictionary), 1), np.int64)
            if with_buyers:
                buyers[code] = table["n_buyers"].filter(chosen).to_numpy()
            return who[chosen.to_numpy()], code, names.dictionary, buyers

        who_b, code_b, names_b, buyers_b = side(block_b)
        by_customer = np.argsort(who_b.astype(np.int64) * max(len(names_b), 1) + code_b)
        who_b, code_b = who_b[by_customer], code_b[by_customer]
        # Customer c owns the right rows from first[c] up to first[c + 1].
        first = np.searchsorted(who_b, np.arange(len(customers.dictionary) + 1))
        if block_a == block_b:
            # A block against itself: each row meets the rows after it, so each pair comes once.
            who_a, code_a, names_a, buyers_a = who_b, code_b, names_b, buyers_b
            begin = np.arange(1, len(who_a) + 1)
        else:
            who_a, code_a, names_a, buyers_a = side(block_a)
            begin = first[who_a]
        fan = first[who_a + 1] - begin
        # From here on the rows are numbers.
        del table, customers, who, who_a, who_b, by_customer, side
        # Left rows by product, in runs of about pairs_per_step pairs: a run then counts into few
        # neighbouring lines of the array.
        code_a = code_a.astype(np.int64)
        by_product = np.argsort(code_a)
        code_a, begin, fan = code_a[by_product], begin[by_product], fan[by_product]
        del by_product
        ends = np.cumsum(fan)
        steps = np.arange(pairs_per_step, ends[-1] if len(ends) else 0, pairs_per_step)
        cuts = np.unique(np.searchsorted(ends, steps) + 1)
        width = max(len(names_b), 1)
        dense = len(ends) > 0 and ends[-1] * sparse >= len(names_a) * width
        # A cell has far fewer than 2**31 rows, so no count is larger.
        counts = np.zeros(len(names_a) * width if dense else 0, dtype=np.int32)
        codes, runs, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        for start, stop in zip([0, *cuts], [*cuts, len(ends)], strict=True):
            if start == stop:
                continue
            some = fan[start:stop]
            base = code_a[start] * width if dense else 0
            # Positions of the partners: a running count per left row, shifted to where they begin.
            at = np.arange(some.sum()) + np.repeat(begin[start:stop] - np.cumsum(some) + some, some)
            pair = np.repeat(code_a[start:stop] * width - base, some) + code_b[at]
            if dense:
                found = np.bincount(pair)
                counts[base : base + len(found)] += found.astype(np.int32)
                continue
            code, run = np.unique(pair, return_counts=True)
            codes.append(code)
            runs.append(run)
            held += len(code)
            if held > 4 * pairs_per_step:
                code, run = few(codes, runs)
                codes, runs, held = [code], [run], 0
        if dense:
            found_at = (part + np.flatnonzero(counts[part : part + pairs_per_part]) for part in range(0, len(counts), pairs_per_part))
            found = ((met, counts[met].astype(np.int64)) for met in found_at)
        else:
            all_met, all_times = few(codes, runs)
            del codes, runs
            found = ((all_met[i : i + pairs_per_part], all_times[i : i + pairs_per_part]) for i in range(0, max(1, len(all_met)), pairs_per_part))
        for met, times in found:
            a = names_a.take(pa.array(met // width))
            b = names_b.take(pa.array(met % width))
            swap = pc.greater(a, b)
            columns = {"product_a": pc.if_else(swap, b, a), "product_b": pc.if_else(swap, a, b), "n_both": pa.array(times)}
            if with_buyers:
                n_a, n_b = pa.array(buyers_a[met // width]), pa.array(buyers_b[met % width])
                columns |= {"n_a": pc.if_else(swap, n_b, n_a), "n_b": pc.if_else(swap, n_a, n_b)}
            yield pa.table(columns)

    def count(table: pa.Table) -> pa.Table:
        """All pairs of a cell at once."""
        return pa.concat_tables(parts(table))

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(pa.Table.from_batches(list(batches))):
            yield from part.combine_chunks().to_batches()

    sparse, pairs_per_part = SPARSE, PAIRS_PER_PART
    count.by_part = run
    return count


def _stored(basket: DataFrame) -> tuple[DataFrame, dict]:
    """The basket written once, with its rough size: every consumer below reads the written pairs."""
    return materialize(
        basket,
        "basket",
        F.count(F.lit(1)).alias("rows"),
        F.approx_count_distinct("product_id").alias("products"),
    )


def _placed(stored: DataFrame, products: int, products_per_block: int, with_buyers: bool = True) -> tuple[DataFrame, int]:
    """The basket with each row's block of products and, where asked for, the buyers of its product.

    Blocks depend on the catalogue alone: they bound a cell's counters, and nothing else.
    """
    blocks = max(1, math.ceil(products / products_per_block))
    block = F.pmod(F.xxhash64("product_id"), F.lit(blocks)).cast("int")
    rows = stored.join(product_buyer_counts(stored), "product_id") if with_buyers else stored
    return rows.withColumn("block", block), blocks


def shares_of_cells(rows: int, blocks: int, rows_per_cell: int, cores: int) -> int:
    """Into how many shares of the customers every cell is cut.

    A cell holds two of ``blocks`` blocks, so about ``2 * rows / blocks`` rows: that divided by ``rows_per_cell``,
    and more only where the cells alone leave cores without work that is worth a task.
    """
    held = rows if blocks == 1 else math.ceil(2 * rows / blocks)
    cells = blocks * (blocks + 1) // 2
    return max(1, math.ceil(held / rows_per_cell), min(math.ceil(cores / cells), math.ceil(held / ROWS_WORTH_A_TASK)))


def _cells(placed: DataFrame, blocks: int, rows: int, rows_per_cell: int) -> DataFrame:
    """Every basket row in the cells it takes part in: those of the blocks its customer bought from.

    A customer's blocks are joined to the customer's rows, so a row is copied at most once for each
    of them, never for blocks without a partner; with one block nothing is copied. Shares cut all
    cells alike by customer, which copies nothing: so many that a cell's rows stay bounded and that
    a small catalogue still gives every core work.
    """
    shares = shares_of_cells(rows, blocks, rows_per_cell, placed.sparkSession.sparkContext.defaultParallelism)
    share = F.pmod(F.xxhash64("customer_id"), F.lit(shares)).cast("int")
    if blocks == 1:
        copies = placed.withColumns({"block_a": F.col("block"), "block_b": F.col("block")})
    else:
        visited = placed.select("customer_id", F.col("block").alias("other")).distinct()
        copies = placed.join(visited, "customer_id").withColumns(
            {"block_a": F.least("block", "other"), "block_b": F.greatest("block", "other")}
        )
    kept = [name for name in ("customer_id", "product_id", "n_buyers", "block", "block_a", "block_b") if name in copies.columns]
    return copies.select(*kept, share.alias("share"))


def _count_pairs(stored: DataFrame, sizes: dict, products_per_block: int, rows_per_cell: int, with_buyers: bool = True) -> DataFrame:
    """Every product pair with common buyers once: both ids, the buyers of both and, where asked for, of each."""
    placed, blocks = _placed(stored, sizes["products"], products_per_block, with_buyers)
    cells = _cells(placed, blocks, sizes["rows"], rows_per_cell)
    kind = stored.schema["product_id"].dataType
    schema = T.StructType().add("product_a", kind).add("product_b", kind)
    buyers = ["n_a", "n_b"] if with_buyers else []
    for name in ("n_both", *buyers):
        schema = schema.add(name, T.LongType())
    counted = cells.groupBy("share", "block_a", "block_b").applyInArrow(_cell_counter(PAIRS_PER_STEP, with_buyers).by_part, schema)
    # The shares of a pair are summed; its buyers are the same in each.
    return counted.groupBy("product_a", "product_b").agg(F.sum("n_both").alias("n_both"), *[F.first(name).alias(name) for name in buyers])


def co_purchase_counts(
    basket: DataFrame,
    products_per_block: int = PRODUCTS_PER_BLOCK,
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """Common buyers of every product pair that has any; each pair once, smaller id first.

    A self join on the customer would emit all pairs of every basket as rows. Here the product of
    the purchase matrix with itself is counted in a grid instead. Products fall into blocks by
    hash, every basket row goes to the cells of its block with the blocks its customer bought from,
    and a cell is cut by customer into shares. So a customer with a huge basket is spread over the
    blocks, a product with very many buyers over the shares, and rows are copied only where their
    customer has products to meet: not at all while the products fit one block. The counts of a
    pair from different shares are then summed.
    """
    return _count_pairs(*_stored(basket), products_per_block, rows_per_cell, with_buyers=False)


def product_pair_scores(
    basket: DataFrame,
    products_per_block: int = PRODUCTS_PER_BLOCK,
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """Cosine of every product pair with common buyers, each pair once, smaller id first."""
    return _score_pairs(_count_pairs(*_stored(basket), products_per_block, rows_per_cell))


def _score_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select("product_a", "product_b", _cosine(F.col("n_both"), F.col("n_a"), F.col("n_b")).alias("score"))


def _both_directions(scores: DataFrame) -> DataFrame:
    there = F.struct(F.col("product_a").alias("product_id"), F.col("product_b").alias("similar_id"), "score")
    back = F.struct(F.col("product_b").alias("product_id"), F.col("product_a").alias("similar_id"), "score")
    return scores.select(F.inline(F.array(there, back)))


def product_similarity(basket: DataFrame) -> DataFrame:
    """The similarity matrix without its diagonal and its zeros, both halves."""
    return _both_directions(product_pair_scores(basket))


def top_similar_products(basket: DataFrame, products: DataFrame, top: int = TOP_SIMILAR) -> DataFrame:
    """The ``top`` most similar products of every product bought, ties by id.

    Ranking keeps ``top`` rows per product before its shuffle. A product with fewer partners is
    filled up with products of score 0, smallest ids first. At most ``top - 1`` partners and the
    product itself can be in the way, so the ``2 * top`` smallest ids always suffice.
    """
    stored, sizes = _stored(basket)
    pairs = _count_pairs(stored, sizes, PRODUCTS_PER_BLOCK, ROWS_PER_CELL)
    ranking = W.partitionBy("product_id").orderBy(F.col("score").desc(), F.col("similar_id").asc())
    ranked = (
        _both_directions(_score_pairs(pairs))
        .withColumn("rank", F.row_number().over(ranking))
        .filter(F.col("rank") <= top)
    )
    best = ranked.groupBy("product_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "similar_id", "score"))).alias("best")
    )
    bought = product_buyer_counts(stored).select("product_id")
    smallest = bought.orderBy("product_id").limit(2 * top).agg(
        F.sort_array(F.collect_list("product_id")).alias("ids")
    )
    fillers = F.filter(
        "ids", lambda x: (x != F.col("product_id")) & ~F.array_contains(F.col("best.similar_id"), x)
    )
    zeros = F.transform(fillers, lambda x: F.struct(x.alias("similar_id"), F.lit(0.0).alias("score")))
    found = F.transform(F.col("best"), lambda x: F.struct(x["similar_id"], x["score"]))
    nothing = F.expr("array()").cast(best.schema["best"].dataType)
    lists = (
        bought.join(best, "product_id", "left")
        .select("product_id", F.coalesce("best", nothing).alias("best"), smallest.scalar().alias("ids"))
        .select("product_id", F.posexplode(F.slice(F.concat(found, zeros), 1, top)).alias("at", "hit"))
    )
    ids = lists.select(
        "product_id", (F.col("at") + 1).alias("rank"), F.col("hit.similar_id"), F.col("hit.score")
    )
    return _with_names(ids, products)


def _with_names(ranked: DataFrame, products: DataFrame) -> DataFrame:
    names = products.select(F.col("id").alias("similar_id"), F.col("name").alias("similar_name"))
    return ranked.join(names, "similar_id", "left").select(*ranked.columns, "similar_name")


def similar_products(
    basket: DataFrame,
    products: DataFrame,
    target: DataFrame,
    top: int = TOP_SIMILAR,
    exclude: Column | None = None,
) -> DataFrame:
    """The ``top`` products most similar to one product, with names and scores to 4 decimals.

    Needs no pairs: the target's buyers select basket rows, which are counted per product. All
    products bought compete, with score 0 if no buyer is shared. ``target`` is one row at most;
    a product nobody bought has no similar ones. ``exclude`` drops products, such as test
    entries, by a condition on their ``products`` row.
    """
    if exclude is not None:
        junk = products.filter(exclude).select(F.col("id").alias("product_id"))
        basket = basket.join(junk, "product_id", "left_anti")
    stored, _ = _stored(basket)
    wanted = target.select(F.col("id").alias("product_id")).limit(1)
    buyers = stored.join(wanted, "product_id", "left_semi").select("customer_id")
    shared = (
        stored.join(buyers, "customer_id", "left_semi")
        .groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("n_both"))
    )
    others = product_buyer_counts(stored).join(wanted, "product_id", "left_anti")
    n_target = buyers.agg(F.nullif(F.count(F.lit(1)), F.lit(0))).scalar()
    score = _cosine(F.coalesce("n_both", F.lit(0)), F.col("n_buyers"), n_target)
    ranked = (
        others.join(shared, "product_id", "left")
        .select(F.col("product_id").alias("similar_id"), score.alias("score"))
        .orderBy(F.col("score").desc(), F.col("similar_id").asc())
        .limit(top)
        .filter(F.col("score").isNotNull())
    )
    return (
        _with_names(ranked, products)
        .select("similar_id", "similar_name", F.round("score", 4).alias("score"))
    )
