"""Volumes, nulls, schemas and relational types of tables.

Every profile is one aggregate per table in a single pass; the per-table rows are then unioned.
No operator turns rows into (column, value) pairs, which would multiply the data by its width.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import clean_identifier
from ledgerloom.functions.valuetypes import classes_of_type, exceeds_bigint, quoted, relational_type, value_classes
from ledgerloom.sources.catalog import row_count

Tables = Mapping[str, DataFrame]


def union_rows(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_volumetrics(tables: Tables) -> DataFrame:
    """Rows and columns per table, largest first, ties by name."""
    parts = [
        row_count(df, F.lit(name)).select(
            F.col("table_name").alias("tabela"),
            F.col("n_rows").alias("n_linhas"),
            F.lit(len(df.columns)).cast("bigint").alias("n_colunas"),
        )
        for name, df in tables.items()
    ]
    return union_rows(parts).orderBy(F.col("n_linhas").desc(), F.col("tabela").asc())


def load_validation(tables: Tables) -> DataFrame:
    """Row count per table and the sum over them as the row ``TOTAL``."""
    counts = union_rows([row_count(df, F.lit(name)) for name, df in tables.items()])
    return counts.rollup("table_name").agg(
        F.sum("n_rows").alias("n_rows"), F.grouping("table_name").alias("is_total")
    ).select(
        F.when(F.col("is_total") == 1, "TOTAL").otherwise(F.col("table_name")).alias("table_name"), "n_rows"
    )


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _per_column(df: DataFrame, name: str, aggregate, *fields: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One aggregate per column, reshaped from one wide row to one row per column.

    ``aggregate`` makes the SQL text of a column's aggregate; ``fields`` are SQL expressions over
    its ``value``, its position ``at`` and the table's ``n_rows``. ``columns`` names the columns told of, by
    default those of ``df``.
    """
    columns = df.columns if columns is None else columns
    wide = df.selectExpr(
        "count(1) AS n_rows", *[f"{aggregate(column)} AS c{at}" for at, column in enumerate(columns)]
    )
    values = ", ".join(f"c{at}" for at in range(len(columns)))
    names = ", ".join(map(_literal, columns))
    return wide.selectExpr("n_rows", f"posexplode(array({values})) AS (at, value)").selectExpr(
        f"{_literal(name)} AS table_name", "at + 1 AS pos", f"array({names})[at] AS column_name", *fields
    )


def null_profile(tables: Tables) -> DataFrame:
    """NULLs per column and their share of the rows; NaN and empty text are values."""
    fields = ("n_rows", "value AS n_nulls", "try_divide(double(value), double(n_rows)) AS null_ratio")
    return union_rows(
        [_per_column(df, name, lambda c: f"count_if({quoted(c)} IS NULL)", *fields) for name, df in tables.items()]
    )


def schema_listing(tables: Tables) -> DataFrame:
    """Columns of every table in order, with their types. Metadata only: no table is read."""
    rows = [
        (name, at, field.name, field.dataType.simpleString())
        for name, df in tables.items()
        for at, field in enumerate(df.schema, 1)
    ]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, "table_name string, pos int, column_name string, column_type string")


def schema_catalog(tables: Tables) -> DataFrame:
    """The listing with the number of filled values of each column, which reads the tables."""

    def one(name: str, df: DataFrame) -> DataFrame:
        types = ", ".join(_literal(field.dataType.simpleString()) for field in df.schema)
        fields = (f"array({types})[at] AS column_type", "value AS n_values")
        return _per_column(df, name, lambda c: f"count({quoted(c)})", *fields)

    return union_rows([one(name, df) for name, df in tables.items()])


def infer_column_types(tables: Tables) -> DataFrame:
    """Relational type that fits every non-empty value of each column, judged on its text form.

    Looks at all rows; pass ``sample_first_n`` frames to judge by a sample. ``overflow`` marks an
    integer column whose values do not all fit 64 bits. Text columns are tested value by value;
    for most other types the type already answers.
    """
    fields = (f"{relational_type('value')} AS inferred_type", f"{exceeds_bigint('value')} AS overflow")

    def one(name: str, df: DataFrame) -> DataFrame:
        known = {f.name: classes_of_type(f.dataType, f.name) for f in df.schema}
        texts = [c for c in df.columns if not known[c]]
        # One function over the row's texts instead of its tests written out for each column: generated code
        # that long is not compiled by the JVM but interpreted.
        forms = ", ".join(f"CAST({quoted(c)} AS STRING)" for c in texts)
        judged = f"transform(array({forms}), v -> {value_classes('v')}) AS texts"
        ready = df.selectExpr(*[f"{known[c]} AS {quoted(c)}" for c in df.columns if known[c]], *([judged] if texts else []))
        place = {c: f"texts[{i}]" for i, c in enumerate(texts)}
        return _per_column(ready, name, lambda c: f"bit_and({place.get(c) or quoted(c)})", *fields, columns=df.columns)

    return union_rows([one(name, df) for name, df in tables.items()])


def generate_ddl(types: DataFrame) -> DataFrame:
    """One CREATE TABLE statement per table, columns in order. Groups are as small as a schema."""
    line = F.concat(F.lit('    "'), clean_identifier(F.col("column_name")), F.lit('" '), F.col("inferred_type"))
    ordered = F.sort_array(F.collect_list(F.struct("pos", line.alias("line"))))
    body = F.array_join(F.transform(ordered, lambda x: x["line"]), ",\n")
    return (
        types.groupBy("table_name")
        .agg(body.alias("body"))
        .select(
            "table_name",
            F.concat(
                F.lit('CREATE TABLE IF NOT EXISTS "'), "table_name", F.lit('" (\n'), "body", F.lit("\n);")
            ).alias("ddl"),
        )
        .orderBy("table_name")
    )


def type_conflicts(types: DataFrame) -> DataFrame:
    """Columns that carry the same name in several tables but not the same type."""
    return (
        types.groupBy("column_name")
        .agg(
            F.count_distinct("inferred_type").alias("n_types"),
            F.array_join(F.sort_array(F.collect_list(F.concat_ws(":", "table_name", "inferred_type"))), ", ").alias(
                "found"
            ),
        )
        .filter(F.col("n_types") > 1)
    )


def sanitize_columns(df: DataFrame) -> DataFrame:
    """The same rows under cleaned column names; the names are cleaned by the rule for DDL."""
    names = df.sparkSession.range(1).select(F.array(*[clean_identifier(F.lit(name)) for name in df.columns])).first()[0]
    return df.toDF(*names)
