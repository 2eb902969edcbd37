"""Catalog tables and script output."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

INGESTED_AT = "_ingested_at"

# Opening lines of a generated DDL script.
DDL_HEADER = (
    "-- Tables as inferred from the text of the CSV files.",
    "-- Dialect: PostgreSQL.",
)


def stamp_ingestion(df: DataFrame) -> DataFrame:
    """Add the load time; one value per query."""
    return df.withColumn(INGESTED_AT, F.current_timestamp())


def overwrite_table(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None) -> int:
    """Replace a table, schema included, and return the number of rows written.

    The count is observed during the write, so nothing is read twice. The rows are written in full to a
    fresh folder before the catalog is touched; then the table is pointed there and the former
    folder removed. A write that fails leaves the old table as it was, and a plan may read the table that it
    replaces. With an unchanged schema the switch is one catalog call; with another one the table is
    created anew over the finished data. Versions live under ``path``, or beside the database's tables.
    ``fmt="delta"`` needs the Delta package on the cluster and leaves the replacement to it.
    """
    spark = df.sparkSession
    written = Observation()
    observed = df.observe(written, F.count(F.lit(1)).alias("rows"))
    if fmt == "delta":
        writer = observed.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
        if path is not None:
            writer = writer.option("path", path)
        writer.saveAsTable(name)
        return written.get["rows"]
    fresh = f"{path or _versions(spark, name)}/{uuid.uuid4().hex}"
    try:
        observed.write.format(fmt).save(fresh)
    except Exception:
        _remove(spark, fresh)
        raise
    _point(spark, name, fmt, fresh)
    return written.get["rows"]


def _versions(spark: SparkSession, name: str) -> str:
    """Where a table's versions are kept: a folder of its own beside the database's tables."""
    *database, table = name.split(".")
    home = spark.catalog.getDatabase(database[0] if database else spark.catalog.currentDatabase()).locationUri
    return f"{home.rstrip('/')}/{table}.versions"


def _point(spark: SparkSession, name: str, fmt: str, fresh: str) -> None:
    """Makes a table of finished data, or points an existing one at it and removes what it held before."""
    made = spark.read.format(fmt).load(fresh).schema
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=fresh, source=fmt, schema=made)
        return
    told = {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    before = told["Location"]
    if spark.table(name).schema == made and told["Provider"].lower() == fmt:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{fresh}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE {name}")
        spark.catalog.createTable(name, path=fresh, source=fmt, schema=made)
    _remove(spark, before)


def _remove(spark: SparkSession, folder: str) -> None:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def row_count(df: DataFrame, label: Column) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(label.alias("table_name"), "n_rows")


def write_ddl_script(ddl: DataFrame, path: str) -> None:
    """Write ``(table_name, ddl)`` rows as one script: header, then the statements by name.

    One row per table makes this the one output that belongs in a single file.
    """
    spark = ddl.sparkSession
    blocks = ddl.select(F.col("table_name").alias("key"), F.concat("ddl", F.lit("\n")).alias("value"))
    header = spark.range(1).select(
        F.lit("").alias("key"), F.lit("\n".join(DDL_HEADER) + "\n").alias("value")
    )
    header.unionByName(blocks).coalesce(1).sortWithinPartitions("key").select("value").write.mode(
        "overwrite"
    ).text(path)
