"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import few, written, written_with


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its smallest node.

    The large step hangs each node's larger neighbours on its smallest neighbour, the small step its
    smaller ones; both only regroup links, so no step makes more rows than there are links. Smallest
    neighbours are partial aggregates and the joins back have one row a node on one side, so a hub
    with very many links neither lands in one task nor multiplies. Ends when the links form stars. About ``rows`` links are expected.
    """
    state = F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = written_with(few(edges, rows), "links", *state)
    while before["n"]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = written(few(large, before["n"]), "large")
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges, after = written_with(few(small.where("u <> v").distinct(), before["n"]), "small", *state)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v"), F.col("v")).distinct())
