"""Small tables are written by few tasks, and words of the packing tokenizer are kept in flat arrays."""

from __future__ import annotations

import contextlib

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import exact, graph, packing, textnum
from ledgerloom.llm.common import FILES, few, tokenizer_file, written


@contextlib.contextmanager
def many_partitions(spark, n=60):
    names = {"spark.sql.shuffle.partitions": str(n), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_few_links_are_written_as_few_files(spark):
    links = spark.range(400).select(F.col("id").alias("a"), (F.col("id") - F.col("id") % 20).alias("b"))
    with many_partitions(spark):
        found = graph.components(links, 400)
        assert len(found.inputFiles()) <= FILES
        assert {(r.node, r.component) for r in found.collect()} == {(i, i - i % 20) for i in range(400)}


def test_many_rows_keep_their_tasks(spark):
    with many_partitions(spark):
        rows = spark.range(1000).groupBy((F.col("id") * 7).alias("k")).count()
        assert len(written(rows, "all").inputFiles()) > FILES
        assert len(written(few(rows, 1000), "all").inputFiles()) <= FILES
        assert len(written(few(rows, 1_000_000), "all").inputFiles()) > FILES


def test_a_row_filter_takes_few_jobs(spark):
    with many_partitions(spark):
        hashes = spark.range(500).select(F.xxhash64("id").alias("hash"))
        context = spark.sparkContext
        context.setJobGroup("row_filter", "jobs of one filter")
        try:
            passes = exact.row_filter(hashes)
            jobs = len(context.statusTracker().getJobIdsForGroup("row_filter"))
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
        assert jobs <= 2 * FILES
        kept = spark.range(5000).where(passes(F.xxhash64("id")))
        assert kept.where("id < 500").count() == 500 and kept.count() < 1500


def test_words_that_share_a_hash_are_told_apart(monkeypatch):
    texts = [b"alpha beta, gamma alpha.", b"Delta <|x|> beta alphb alpha"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.array([0, len(texts[0]), len(data)])
    want = packing.WordTokenizer(tokenizer_file()).encode(data, offsets)
    monkeypatch.setattr(textnum, "span_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    tokenizer = packing.WordTokenizer(tokenizer_file())
    for _ in range(2):
        found = tokenizer.encode(data, offsets)
        assert all((a == b).all() for a, b in zip(found, want))
    assert tokenizer.clashes


def test_the_memo_of_words_is_small():
    words = b" ".join(b"w%dx" % i for i in range(60_000))
    data, offsets = np.frombuffer(words, np.uint8), np.array([0, len(words)])
    tokenizer = packing.WordTokenizer(tokenizer_file())
    tokenizer.encode(data, offsets)
    kept = [getattr(tokenizer, name) for name in ("hashes", "numbers", "pool", "ends", "letters", "letter_ends")]
    assert tokenizer.count >= 60_000 and sum(a.nbytes for a in kept) < 100 * 60_000
