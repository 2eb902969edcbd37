"""Exact dedup and source mixing against plain Python, with nulls, ties, repeats and clashing columns."""

from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import exact, mixing

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


TEXTS = ["a b", "ab", " a\tb ", None, "", "  \n", "x" * 5000, "x" * 5000, "a b", "é \U0001f600", "é\U0001f600", "one"]


@pytest.mark.parametrize("filter_bytes", [exact.FILTER_BYTES, 1])
def test_exact_classes_match_plain_grouping(spark, filter_bytes):
    rows = [(i, t) for i, t in enumerate(TEXTS * 7)]
    found = rows_of(exact.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), filter_bytes))
    expected = brute.exact_classes(rows)
    assert {i: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for i, r in found.items()} == expected


def test_exact_keeps_one_whole_row_of_each_group(spark):
    schema = DOCS + ", row string, sha string, hash long, repeats boolean"
    rows = [(i, t, "en", "s", 1, "r", "s", 2, True) for i, t in enumerate(TEXTS)] + [(None, "only here", None, None, None, None, None, None, None)]
    rows += [rows[0], rows[-1]]
    df = spark.createDataFrame(rows, schema)
    kept = exact.deduplicate(df)
    assert kept.columns == df.columns
    expected = brute.exact_classes([(i, t) for i, t in enumerate(TEXTS)])
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted([(False, i) for i, e in expected.items() if e[2]] + [(True, 0)])
    empty = spark.createDataFrame([], schema)
    assert exact.deduplicate(empty).count() == 0 and exact.classes(empty).count() == 0


def test_bloom_passes_find_every_repeated_hash(spark):
    """A third of all rows one hash, the rest alone or twice; the filter may only err on the safe side."""
    rows = [(7,)] * 400 + [(i,) for i in range(1000, 1400)] + [(i,) for i in range(2000, 2200)] * 2
    df = spark.createDataFrame(rows, "hash long").repartition(6)
    split = exact._split(df, df, 1 << 20)
    repeated = [r.hash for a, _ in split for r in a.collect()]
    alone = [r.hash for _, b in split for r in b.collect()]
    assert len(repeated) + len(alone) == len(rows)
    assert len(repeated) >= 800 and not {7, *range(2000, 2200)} & set(alone)
    assert len(set(repeated) & set(range(1000, 1400))) < 40


def mixed(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sized = mixing.sizes(df)
    return rows_of(mixing.mix(sized, **options)), df


def test_mix_meets_targets(spark):
    rows, sizes = [], {}
    for s, (source, n) in enumerate([("a", 400), ("b", 30), ("ä", 200), (None, 90), ("empty", 3)]):
        for i in range(n):
            words = 0 if source == "empty" else (i * 7919) % 40 + 1
            rows.append((s * 1000 + i, " ".join(["w"] * words) or None, source))
            sizes[source] = sizes.get(source, 0) + words
    found, _ = mixed(spark, rows)
    goal = brute.mix_targets(sizes)
    taken = {}
    for r in found.values():
        assert r["taken"] <= 3 * r["size"] and r["size"] == len((dict((a, b) for a, b, _ in rows)[r["doc_id"]] or "").split())
        assert r["target"] == pytest.approx(goal[r["source"]])
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for source, target in goal.items():
        assert abs(taken[source] - target) <= 1, source
    again, _ = mixed(spark, rows[::-1])
    assert again == found


def test_mix_boundary_row_is_whole_or_cut(spark):
    rows = [(i, "w " * 100, "a") for i in range(10)] + [(100 + i, "w " * 10, "b") for i in range(3)]
    cut, df = mixed(spark, rows)
    whole, _ = mixed(spark, rows, cut=False)
    # b is capped at 3 * 30 words, a gets the rest of 1030.
    assert sum(r["taken"] for r in cut.values() if r["source"] == "a") == 940
    assert sum(r["copies"] * r["size"] for r in whole.values() if r["source"] == "a") == 900
    assert sum(r["taken"] for r in cut.values() if r["source"] == "b") == 90
    copies = mixing.apply(df)
    assert copies.columns == df.columns and copies.count() == 9 + 9


def test_mix_edge_tables(spark):
    assert mixed(spark, [])[0] == {}
    only_empty, _ = mixed(spark, [(1, None, "a"), (2, "", None)])
    assert all(r["taken"] == 0 and r["target"] == 0 for r in only_empty.values())
    df = spark.createDataFrame([(5, "a b c", "s", 1)] * 4 + [(None, "a b", None, 2)], "doc_id long, text string, source string, size long")
    assert mixing.apply(df).columns == df.columns
    one = mixing.mix(mixing.sizes(df)).collect()
    assert sum(r.taken for r in one) == 14 and all(r.taken <= 3 * r["size"] for r in one)


def test_nested_budgets(spark):
    """A larger share takes every word a smaller one takes."""
    rows = [(i, "w " * (i % 9 + 1), "a") for i in range(300)]
    small, _ = mixed(spark, rows, share=0.3)
    large, _ = mixed(spark, rows, share=0.7)
    assert all(large[i]["taken"] >= r["taken"] for i, r in small.items())


def test_repeated_boundary_rows_do_not_overshoot(spark):
    """One doc_id on most rows: copies of a boundary document are taken one by one until the target is met."""
    rows = [(7, "w " * 10, "a")] * 300 + [(7, "v " * 10, "a")] * 200 + [(8, "w " * 500, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    sizes = {"a": 5000, "b": 500}
    goal = brute.mix_targets(sizes)
    taken = Counter(r.source for r in mixing.apply(df).collect())
    assert abs(taken["a"] * 10 - goal["a"]) <= 5 and abs(taken["b"] * 500 - goal["b"]) <= 250
    cut = mixing.mix(mixing.sizes(df)).groupBy("source").agg(F.sum("taken").alias("taken")).collect()
    assert all(abs(r.taken - goal[r.source]) <= 1 for r in cut)
