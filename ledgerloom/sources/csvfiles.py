"""CSV sources."""

from __future__ import annotations

import re
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_QUOTING = {"quote": '"', "escape": '"'}

# How the records of a file are told apart.
BY_LINE = "line"  # every line is a record; files split freely
WHOLE_FILE = "file"  # quoted fields may contain line ends; one task per file

# A line whose every quoted field is closed. A field is quoted if it starts with a quote; a quote
# further inside is plain text. Possessive, so a line is read once from left to right.
CLOSED_LINE = r'''^(?:(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|)(?:,|$))*+$'''


def record_layout(spark: SparkSession, path: str) -> str:
    """How to read the records of a file or folder, judged on all of its lines.

    A record crosses a line end only inside a quoted field, which is then still open at the end of
    the record's first line. One splittable text scan therefore proves a file safe to read by
    lines, whatever its size. A file that is not is one task in the reader: deliver such data in parts.
    Only lines with a quote are matched: all others are closed.
    """
    is_open = F.col("value").contains('"') & ~F.col("value").rlike(CLOSED_LINE)
    return WHOLE_FILE if spark.read.text(path).agg(F.bool_or(is_open)).first()[0] else BY_LINE


def _header(spark: SparkSession, path: str, layout: str) -> list[str]:
    return spark.read.options(header=True, multiLine=layout == WHOLE_FILE, **_QUOTING).csv(path).columns


def scan_inferred(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    layout: str | None = None,
) -> DataFrame:
    """CSV with a header. Types are inferred unless ``schema`` is given, which saves that pass.

    ``layout`` says how to tell records apart; by default the data decides, in a pass of its own.
    Part files whose headers differ fail the read.
    """
    layout = layout or record_layout(spark, path)
    reader = spark.read.options(header=True, multiLine=layout == WHOLE_FILE, enforceSchema=False, **_QUOTING)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def scan_raw_text(spark: SparkSession, path: str, layout: str | None = None) -> DataFrame:
    """CSV with a header, every column as text, nothing treated.

    Missing fields are the empty string, never NULL. A row with too few or too many fields fails
    the read; only reading all columns checks that, so validate on written data, not ``count()``.
    """
    layout = layout or record_layout(spark, path)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in _header(spark, path, layout)])
    reader = spark.read.options(header=True, multiLine=layout == WHOLE_FILE, **_QUOTING)
    return reader.options(mode="FAILFAST", enforceSchema=False).schema(schema).csv(path).na.fill("")


# The ``<table>.csv`` a path belongs to: a file, or a folder of part files.
_TABLE_FILE = r"([^/]+\.csv)(?:/[^/]*)?$"


def _files(spark: SparkSession, folder: str) -> list[tuple[str, str, str]]:
    """Path, file name and table name of the CSV files of a folder, empty ones too, by path.

    They come from the listing that the driver makes for any scan; no job runs.
    """
    reader = spark.read.format("binaryFile").options(pathGlobFilter="*.csv", recursiveFileLookup=True)
    paths = sorted(unquote(url) for url in reader.load(folder).inputFiles())
    names = [re.search(_TABLE_FILE, path)[1] for path in paths]
    return [(path, name, name.removesuffix(".csv")) for path, name in zip(paths, names, strict=True)]


def csv_table_names(spark: SparkSession, folder: str) -> list[str]:
    """Tables with a ``<table>.csv`` in a folder, by name."""
    return sorted({table for _, _, table in _files(spark, folder)})


def discover_csv_tables(spark: SparkSession, folder: str, count_lines: bool = True) -> DataFrame:
    """Every ``<table>.csv`` of a folder, by name, empty ones too.

    With ``count_lines`` the files are read for their number of lines after the header, which each
    part of a table has for itself. Lines are not records where quoted fields contain line ends. Lines are
    counted by the path as it stands; only the counts are given names.
    """
    found = sorted({(name, table) for _, name, table in _files(spark, folder)})
    files = spark.createDataFrame(found, "file_name string, table_name string")
    if count_lines:
        lines = spark.read.options(pathGlobFilter="*.csv", recursiveFileLookup=True).text(folder)
        parts = lines.groupBy(F.col("_metadata.file_path").alias("url")).agg((F.count(F.lit(1)) - 1).alias("n_lines"))
        # A file's URL is its path percent-encoded; a plus sign stands for itself there.
        path = F.url_decode(F.replace("url", F.lit("+"), F.lit("%2B")))
        # Never null: else the join's null test would be pushed to the scan, names and all, for every line.
        name = F.coalesce(F.regexp_extract(path, _TABLE_FILE, 1), F.lit(""))
        counted = parts.groupBy(name.alias("file_name")).agg(F.sum("n_lines").alias("n_lines"))
        files = files.join(counted, "file_name", "left").select("file_name", "table_name", F.coalesce("n_lines", F.lit(0)).alias("n_lines"))
    return files.orderBy("file_name")


def sample_first_rows(spark: SparkSession, folder: str, n: int, place: str | None = None) -> dict[str, DataFrame]:
    """The first ``n`` records of each table of a folder, as text, in the order of its files.

    A table's part files follow each other by name. A file is read as one stream of records, right for quoted
    line ends too, and reading stops as soon as the rows are there; a later part is opened only where the
    ones before hold too few. The rows, ``n`` a table, pass through the driver. ``place`` names a column for a
    row's number, from 1.
    """
    parts: dict[str, list[str]] = {}
    for path, _, table in _files(spark, folder):
        parts.setdefault(table, []).append(path)
    found = {}
    for table, paths in parts.items():
        rows: list[tuple] = []
        for path in paths:
            if len(rows) >= n:
                break
            text = scan_raw_text(spark, path, WHOLE_FILE)
            rows += text.take(n - len(rows))
        schema = text.schema
        if place is not None:
            rows, schema = [(i, *row) for i, row in enumerate(rows, 1)], T.StructType([T.StructField(place, T.IntegerType()), *schema])
        found[table] = spark.createDataFrame(rows, schema)
    return found


def sample_first_n(df: DataFrame, n: int, order_by: Iterable[str]) -> DataFrame:
    """The first ``n`` rows in a stated order: each task keeps ``n`` rows, one merges them."""
    return df.orderBy(*order_by).limit(n)
