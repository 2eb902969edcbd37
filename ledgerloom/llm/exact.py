"""Exact duplicates: two Bloom passes find the hashes that may repeat; only their rows shuffle.

Texts are equal when they are the same without white space (0x20, 0x09-0x0D). A first pass sets bits
for every hash; a hash whose bits a task has all seen sets bits of a second filter, and where the
filters of two tasks overlap, those bits go to the second filter too. A row whose bits are all in the
second filter may repeat. All other rows are certainly alone and pass straight through.

A filter has a fixed number of bits for each document and at most ``FILTER_BYTES`` bytes: the hash
range is cut into as many parts as that takes, each with its own pair of filters. The bound holds for one
filter: each part's second filter goes through the driver and stays broadcast until the query ends, 2 bytes a
document in all (1e9 documents: about 60 filters, 2 GB), and each part reads the rows once
more to count and once or twice to mark. False positives only cost shuffling, never a wrong result.

Defined results: a null text is empty, and empty texts equal each other. Of equal texts the one with
the most code points stays, then the smallest doc_id; a null doc_id comes after all others. Rows that
repeat both text and doc_id are copies like others: ``deduplicate`` leaves one row of them, while
``classes`` marks each row whose doc_id is the one that stays. An empty table gives an empty result;
other columns are carried along whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import FILES, WHITE, join_groups, written
from ledgerloom.llm.textnum import mix64

BITS_PER_ROW = 16
PROBES = 4
FILTER_BYTES = 32 << 20
BLOCK_BYTES = 1 << 14


def normal_digest(text: Column) -> Column:
    """SHA-256 of the text without white space."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), WHITE + "+", "").cast("binary"), 256)


def _cells(hashes: np.ndarray, n_bits: int) -> np.ndarray:
    """The bits of each hash, one row a probe."""
    second = mix64(hashes) | np.uint64(1)
    with np.errstate(over="ignore"):
        return np.stack([((hashes + np.uint64(i) * second) >> np.uint64(8)) % np.uint64(n_bits) for i in range(PROBES)])


def _set(bits: np.ndarray, cells: np.ndarray) -> None:
    cells = cells.ravel()
    np.bitwise_or.at(bits, (cells >> np.uint64(3)).astype(np.int64), np.uint8(128) >> (cells & np.uint64(7)).astype(np.uint8))


def _has(bits: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return ((bits[cells >> np.uint64(3)] >> (np.uint8(7) - (cells & np.uint64(7)).astype(np.uint8))) & 1).all(axis=0)


def repeated_filter(hashes: DataFrame, n_bits: int) -> np.ndarray:
    """The second filter over one column of hashes, at most ``FILTER_BYTES`` bytes."""

    def first_pass(batches):
        once, twice = np.zeros(n_bits // 8, np.uint8), np.zeros(n_bits // 8, np.uint8)
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            single, counts = np.unique(values, return_counts=True)
            cells = _cells(single, n_bits)
            seen = _has(once, cells) | (counts > 1)
            _set(twice, cells[:, seen])
            _set(once, cells)
        for block in range(0, n_bits // 8, BLOCK_BYTES):
            part = once[block : block + BLOCK_BYTES]
            if part.any():
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array([block], pa.int64()),
                        "once": pa.array([part.tobytes()], pa.binary()),
                        "twice": pa.array([twice[block : block + BLOCK_BYTES].tobytes()], pa.binary()),
                    }
                )

    def merge(key: tuple[pa.Scalar, ...], groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = twice = None
        for batch in groups:
            for a, b in zip(batch.column("once"), batch.column("twice")):
                a, b = np.frombuffer(a.as_py(), np.uint8), np.frombuffer(b.as_py(), np.uint8)
                once, twice = (a, b) if once is None else (once | a, twice | b | (once & a))
        yield pa.RecordBatch.from_pydict({"block": pa.array([key[0].as_py()], pa.int64()), "twice": pa.array([twice.tobytes()], pa.binary())})

    blocks = hashes.mapInArrow(first_pass, "block long, once binary, twice binary")
    merged = blocks.groupBy("block").applyInArrow(merge, "block long, twice binary")
    result = np.zeros(n_bits // 8, np.uint8)
    for row in merged.toLocalIterator():
        result[row.block : row.block + len(row.twice)] = np.frombuffer(row.twice, np.uint8)
    return result


def passing(hashes: np.ndarray, sent: Broadcast, n_bits: int) -> np.ndarray:
    """Whether the filter sent has the hashes."""
    return _has(np.frombuffer(sent.value, np.uint8), _cells(hashes.view(np.uint64), n_bits))


def _passes(sent: Broadcast, n_bits: int):
    """A column function from hashes to whether the filter sent has them."""

    @F.pandas_udf("boolean")
    def passes(values: pd.Series) -> pd.Series:
        return pd.Series(passing(values.to_numpy(), sent, n_bits))

    return passes


def row_filter(hashes: DataFrame):
    """A column function from hashes to whether the one column of ``hashes`` may have them; no hash is missed."""
    return _passes(*sent_filter(hashes))


def sent_filter(hashes: DataFrame) -> tuple[Broadcast, int]:
    """The filter behind ``row_filter``, for ``passing``, and its number of bits.


    The filter has ``FILTER_BYTES`` bytes at most; with more than a row for 16 bits it lets more of the others pass.
    """
    n_bits = 8 * BLOCK_BYTES * min(FILTER_BYTES // BLOCK_BYTES, -(-max(1, hashes.count()) * BITS_PER_ROW // (8 * BLOCK_BYTES)))

    def fill(batches):
        bits = np.zeros(n_bits // 8, np.uint8)
        for batch in batches:
            _set(bits, _cells(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), n_bits))
        for block in range(0, n_bits // 8, BLOCK_BYTES):
            if bits[block : block + BLOCK_BYTES].any():
                yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "bits": pa.array([bits[block : block + BLOCK_BYTES].tobytes()], pa.binary())})

    def merge(key: tuple[pa.Scalar, ...], groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(BLOCK_BYTES, np.uint8)
        for batch in groups:
            for part in batch.column("bits"):
                bits |= np.frombuffer(part.as_py(), np.uint8)
        yield pa.RecordBatch.from_pydict({"block": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([bits.tobytes()], pa.binary())})

    merged = hashes.mapInArrow(fill, "block long, bits binary").groupBy("block").applyInArrow(merge, "block long, bits binary")
    result = np.zeros(n_bits // 8, np.uint8)
    # Each partition is a job of its own; a few suffice for at most ``FILTER_BYTES``.
    for row in merged.coalesce(FILES).toLocalIterator():
        result[row.block : row.block + len(row.bits)] = np.frombuffer(row.bits, np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(result.tobytes()), n_bits


def _split(rows: DataFrame, hashes: DataFrame, filter_bytes: int) -> list[tuple[DataFrame, DataFrame]]:
    """(rows that may repeat, rows that are alone) for each part of the hash range.

    ``hashes`` is a written table with the column ``hash`` of every row; ``rows`` has it too.
    """
    spark = rows.sparkSession
    need = max(1, hashes.count()) * BITS_PER_ROW // 8
    parts = -(-need // filter_bytes)
    n_bits = 8 * BLOCK_BYTES * -(-need // (parts * BLOCK_BYTES))
    found = []
    for part in range(parts):
        mine = F.pmod(F.col("hash"), F.lit(parts)) == part
        sent = spark.sparkContext.broadcast(repeated_filter(hashes.where(mine).select("hash"), n_bits).tobytes())

        marked = rows.where(mine).withColumn("repeats", _passes(sent, n_bits)("hash"))
        found.append((marked.where("repeats").drop("repeats"), marked.where("NOT repeats").drop("repeats")))
    return found


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def classes(docs: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = written(
        docs.select(
            "doc_id",
            F.unhex(normal_digest(F.col("text"))).alias("sha"),
            F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("points"),
        ).withColumn("hash", F.xxhash64("sha")),
        "exact",
    )
    split = _split(digests, digests.select("hash"), filter_bytes)
    repeated, alone = _union([a for a, _ in split]), _union([b for _, b in split])
    best = F.min(F.struct((-F.col("points")).alias("longest"), F.col("doc_id").isNull().alias("no_id"), "doc_id"))
    groups = repeated.groupBy("sha").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
    groups = written(groups.select("sha", F.col("best.doc_id").alias("keep_id"), "group_size"), "groups")
    joined = join_groups(repeated, groups, "sha", "group_size", "doc_id").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    single = alone.withColumns({"keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)})
    columns = ["doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")]
    return joined.select(columns).union(single.select(columns))


def deduplicate(docs: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """The rows that stay, with all their columns. Copies collapse before they shuffle."""
    rows = docs.select(F.struct("*").alias("row")).withColumn("sha", F.unhex(normal_digest(F.col("row.text"))))
    rows = rows.withColumn("hash", F.xxhash64("sha"))
    split = _split(rows, written(rows.select("hash"), "hashes"), filter_bytes)
    repeated, alone = _union([a for a, _ in split]), _union([b for _, b in split])
    order = F.struct(
        (-F.char_length(F.coalesce("row.text", F.lit("")))).alias("longest"),
        F.col("row.doc_id").isNull().alias("no_id"),
        F.col("row.doc_id"),
    )
    best = repeated.groupBy("sha").agg(F.min_by("row", order).alias("row"))
    return best.select("row.*").union(alone.select("row.*"))
