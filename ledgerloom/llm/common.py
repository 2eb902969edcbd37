"""Reading tables and moving Arrow batches; shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import textnum
from ledgerloom.session import materialize

WHITE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


FILE_ROWS, FILES = 1 << 12, 8


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the shared folder and read again; cuts the lineage."""
    return materialize(df, label)[0]


def written_with(df: DataFrame, label: str, *metrics: Column) -> tuple[DataFrame, dict]:
    """The same, with ``metrics`` taken while the rows are written."""
    return materialize(df, label, *metrics)


def few(df: DataFrame, rows: int | None) -> DataFrame:
    """The rows, about ``rows`` of them if that is known, in no more tasks than ``FILE_ROWS`` rows each ask for, or ``FILES``.

    A task that writes a file takes its time whatever it holds.
    """
    return df if rows is None else df.coalesce(max(FILES, -(-rows // FILE_ROWS)))


def crc_mod(column: str, n: int):
    """crc32 of the id written as text, modulo ``n``; a null id counts as the text ``null``."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("null")).cast("binary")) % n


def by_batch(df: DataFrame, work: Callable[[pa.RecordBatch], dict | Iterator[dict] | None], schema: str) -> DataFrame:
    """``mapInArrow`` with a function from one batch to named columns of the given schema.

    The function may also yield the columns part by part, so that a part's memory is free for the next.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = work(batch)
            for columns in [] if found is None else [found] if isinstance(found, dict) else found:
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)
            batch = found = columns = None
        textnum.give_back()

    return df.mapInArrow(run, schema)


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """Where a vocabulary file of the installed public tokenizers lies; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, spread: str) -> DataFrame:
    """``rows`` with the columns of their group; no group, however large, is gathered in one task.

    ``groups`` has one row for each ``key`` with its number of rows in ``size``; it is read twice, so it
    should be a written table. Groups with at least a thousandth of all rows, so a thousand at most,
    are repeated once for each thousandth, and their rows are dealt to the copies by a hash of the column
    ``spread``. Only the keys of these few and their numbers of copies are broadcast.
    """
    total = groups.agg(F.sum(size)).first()[0] or 1
    copies = F.greatest(F.lit(1), F.floor(F.col(size) * 1000 / F.lit(total))).cast("int")
    counted = groups.withColumn("_copies", copies)
    large = counted.where("_copies > 1").select(F.col(key).alias("_key"), "_copies")
    dealt = rows.join(F.broadcast(large), F.col(key) == F.col("_key"), "left")
    dealt = dealt.withColumn("_copy", F.pmod(F.xxhash64(spread), F.coalesce("_copies", F.lit(1))).cast("int")).drop("_key", "_copies")
    repeated = counted.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))).drop("_copies")
    return dealt.join(repeated, [key, "_copy"]).drop("_copy")
