"""Mixing sources to target weights by hash-threshold histograms.

A document's size is its number of words. Sources, ordered by code point with null last, weigh
``WEIGHTS`` in turn and share ``share`` of all sizes; a target stops at ``max_repeats`` times its
source's size and what is left over goes to the others by weight.

A source takes each of its documents ``floor(target / size)`` times and, for the rest of its target,
once more those whose id hash lies below a threshold. The threshold comes from histograms: sizes are
summed by source and hash bucket, the bucket is found where the running sum crosses the budget, and
only that boundary bucket is summed again by the next bits, down to single hashes. Budgets nest: a larger
target takes a superset. No rows are sorted; a histogram has at most ``2 ** BITS``
rows a source and level.

Defined results: a null text has size 0 and is taken 0 times over; a null source is a source of its
own; sources without words have target 0; rows that repeat a doc_id share its hash, so the boundary
may hold several rows: they are taken in the order of size until the budget is met, rows with equal texts one after
another. The last taken row of a source is cut to its budget when ``cut`` is set (the first words of it count), otherwise it is
taken whole if that comes nearer to the target. Equal inputs give equal results on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ledgerloom.llm.common import written

# Fixed weights, dealt to the sources in turn.
WEIGHTS = (5, 2, 1)
BITS = 12
LEVELS = 4
WORD = r"[^\x20\x09-\x0D]+"


def _keys() -> list[tuple]:
    """The size of a row and the hash of its id, which has ``BITS * LEVELS`` bits."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    key = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 64 - BITS * LEVELS)
    return [("size", size), ("hash", key)]


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and hash of every row."""
    return docs.select("doc_id", "source", *[column.alias(name) for name, column in _keys()])


def _numbered(sources: DataFrame) -> DataFrame:
    """Sources with their place in code point order, null last, without one task seeing all.

    Sorted ranges are numbered each on its own and shifted by the rows of the ranges before.
    """
    ranged = written(
        sources.withColumn("no_source", F.col("source").isNull())
        .repartitionByRange("no_source", "source")
        .withColumn("part", F.spark_partition_id()),
        "sources",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = ranged.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("shift"))
    own = Window.partitionBy("part").orderBy("no_source", "source")
    return ranged.join(shift, "part").withColumn("place", F.col("shift") + F.row_number().over(own) - 1).drop("part", "shift", "no_source")


def targets(sized: DataFrame, share: float = 1.0, max_repeats: float = 3.0, weights: tuple = WEIGHTS) -> DataFrame:
    """source, source_size and target of every source.

    Each round fixes the sources above their limit and shares what is left among the others; it
    ends when none is above. Only sums come to the driver.
    """
    totals = written(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "totals")
    weight = F.element_at(F.array([F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rows = written(_numbered(totals).withColumns({"weight": weight, "limit": F.col("source_size") * max_repeats}), "weights")
    budget = (rows.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = 0.0, -1
    while True:
        above = F.col("limit") <= F.lit(level) * F.col("weight")
        found = rows.agg(
            F.count(F.when(above, 1)), F.coalesce(F.sum(F.when(above, F.col("limit"))), F.lit(0.0)), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if found[0] == capped or not found[2]:
            break
        capped, level = found[0], (budget - found[1]) / found[2]
    target = F.least(F.col("limit"), F.lit(level) * F.col("weight"))
    if not found[2]:
        target = F.col("limit").cast("double")
    return rows.select("source", "source_size", target.cast("double").alias("target"))


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """For each source (``source``, ``budget``): the boundary hash and what is left for it.

    All hashes below ``boundary`` fit into the budget; ``left`` is the rest of it.
    """
    state = budgets.select(F.col("source").alias("s"), F.col("budget").cast("double").alias("left"), F.lit(0).cast("long").alias("prefix"))
    running = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for depth in range(1, LEVELS + 1):
        down = BITS * (LEVELS - depth)
        rows = sized
        if depth > 1:
            edge = state.select(F.col("s").alias("edge"), "prefix")
            rows = sized.join(edge, F.col("source").eqNullSafe(F.col("edge")) & (F.shiftright("hash", down + BITS) == F.col("prefix")), "left_semi")
        sums = rows.groupBy("source", F.shiftright("hash", down).alias("bucket")).agg(F.sum("size").alias("size"))
        histogram = sums.join(state, F.col("source").eqNullSafe(F.col("s"))).select("s", "bucket", "size", "left")
        crossed = (
            histogram.withColumn("sum", F.sum("size").over(running))
            .where(F.col("sum") > F.col("left"))
            .groupBy("s")
            .agg(F.min_by(F.struct("bucket", (F.col("left") - F.col("sum") + F.col("size")).alias("left")), "bucket").alias("at"))
        )
        state = written(crossed.select("s", F.col("at.left").alias("left"), F.col("at.bucket").alias("prefix")), "boundary")
    return state.select(F.col("s").alias("source"), F.col("prefix").alias("boundary"), "left")


def _plan(sized: DataFrame, share: float, max_repeats: float) -> DataFrame:
    """One row a source: plan_source, source_size, target, whole repeats, budget for the rest, boundary and left."""
    goal = targets(sized, share, max_repeats)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goal = goal.withColumn("whole", F.floor(ratio).cast("long"))
    goal = written(goal.withColumn("budget", F.round(F.col("target") - F.col("whole") * F.col("source_size"))), "goals")
    edge = thresholds(sized, goal).select(F.col("source").alias("edge_source"), "boundary", "left")
    plan = goal.join(edge, F.col("source").eqNullSafe(F.col("edge_source")), "left").drop("edge_source")
    return written(plan.withColumnRenamed("source", "plan_source"), "plan")


def _before(edges: DataFrame) -> DataFrame:
    """Boundary rows with ``before``: the words of the rows of their source that are taken earlier.

    Rows go by size, then doc_id. Equal ones are numbered within the task that wrote them and shifted by those of
    the tasks before, so a doc_id on very many rows is neither sorted nor gathered in one task. ``edges`` has
    source, hash, size and doc_id; other columns are kept.
    """
    key = ["source", "hash", "size", "doc_id"]
    same = lambda x, y: [F.col(f"{x}.{c}").eqNullSafe(F.col(f"{y}.{c}")) for c in key]
    placed = written(edges.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row")), "edges")
    counts = written(placed.groupBy(*key, "_part").agg(F.count(F.lit(1)).alias("_n")), "edge_counts")
    earlier = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.withColumn("_shift", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    smaller = Window.partitionBy("source", "hash").orderBy("size", F.col("doc_id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    groups = counts.groupBy(*key).agg(F.sum("_n").alias("_all")).withColumn("_sum", F.coalesce(F.sum(F.col("size") * F.col("_all")).over(smaller), F.lit(0)))
    own = Window.partitionBy(*key, "_part").orderBy("_row")
    numbered = placed.withColumn("_nth", F.row_number().over(own) - 1)
    shifted = numbered.alias("r").join(parts.alias("p"), [*same("r", "p"), F.col("r._part") == F.col("p._part")]).select("r.*", "p._shift")
    summed = shifted.alias("r").join(groups.alias("g"), same("r", "g")).select("r.*", "g._sum")
    return summed.withColumn("before", F.col("_sum") + (F.col("_shift") + F.col("_nth")) * F.col("size")).drop("_part", "_row", "_nth", "_shift", "_sum")


def _full():
    """Whether a row lies below its source's boundary; without one the budget takes in the whole source, or it has no words."""
    return (F.col("size") > 0) & F.coalesce(F.col("hash") < F.col("boundary"), F.col("budget") >= F.col("source_size"))


def _at_edge():
    return F.coalesce(F.col("hash") == F.col("boundary"), F.lit(False))


def mix(sized: DataFrame, share: float = 1.0, max_repeats: float = 3.0, cut: bool = True) -> DataFrame:
    """The sized rows with source_size, target, taken (words) and copies (whole documents)."""
    plan = _plan(sized, share, max_repeats)
    rows = sized.join(plan, F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source")
    rest = F.greatest(F.lit(0.0), F.least(F.col("size").cast("double"), F.col("left") - F.col("before")))
    nearer = 2 * rest >= F.col("size")
    extra = F.round(rest).cast("long") if cut else F.when(nearer, F.col("size")).otherwise(F.lit(0).cast("long"))
    edges = _before(rows.where(_at_edge())).withColumns({"extra": extra, "again": nearer & (F.col("size") > 0)}).drop("before")
    below = F.when(_full(), F.col("size")).otherwise(F.lit(0).cast("long"))
    others = rows.where(~_at_edge()).withColumns({"extra": below, "again": _full()})
    return others.unionByName(edges).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("whole") * F.col("size") + F.col("extra")).alias("taken"),
        (F.col("whole") + F.col("again").cast("long")).alias("copies"),
        "hash",
    )


def apply(docs: DataFrame, share: float = 1.0, max_repeats: float = 3.0) -> DataFrame:
    """The rows of ``docs`` with all columns, each as often as the mix takes it as a whole.

    A row's copies follow from its source's plan, its id hash and, at the boundary only, from the rows before it.
    The plan has one row a source; the planner broadcasts it as its size allows, and then no text but
    those at the boundaries is shuffled. At a boundary rows are taken while that brings the source nearer to its target.
    """
    plan = _plan(written(sizes(docs), "sized"), share, max_repeats)
    rows = docs.select(F.struct("*").alias("row"), "source", *[c.alias(n) for n, c in _keys()])
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source")
    again = (F.col("size") > 0) & (2 * (F.col("left") - F.col("before")) >= F.col("size"))
    edges = _before(rows.where(_at_edge()).withColumn("doc_id", F.col("row.doc_id"))).withColumn("again", again)
    counted = rows.where(~_at_edge()).withColumn("again", _full()).select("row", "whole", "again").unionByName(edges.select("row", "whole", "again"))
    copies = counted.select("row", (F.col("whole") + F.coalesce("again", F.lit(False)).cast("long")).alias("copies")).where("copies > 0")
    return copies.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")
