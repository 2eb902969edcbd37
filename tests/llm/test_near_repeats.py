"""Near duplicates and repeated bytes against plain Python."""

import random

import brute
import numpy as np
import pytest

from ledgerloom.llm import near, repeats, textnum
from ledgerloom.llm.graph import components
from ledgerloom.llm.suffixarray import common_prefixes, suffix_array


def near_corpus():
    rng = random.Random(3)
    vocabulary = ["w%d" % i for i in range(300)]
    rows, base = [], [rng.choice(vocabulary) for _ in range(150)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    for i in range(120):
        if i % 3 == 0:
            words = list(base)
            for _ in range(rng.randrange(0, 6)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        elif i % 3 == 1:
            words = passage + [rng.choice(vocabulary) for _ in range(rng.randrange(1, 60))]
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 9))]
        rows.append((1000 - i, " ".join(words).title() if i % 7 == 0 else "\t".join(words)))
    return rows + [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one  TWO"), (6, "Été one"), (7, "été one"), (8, "x" * 20000), (9, "x " * 20000)]


@pytest.mark.parametrize("similarity", [(85, 100), (80, 100)])
def test_near_classes_match_all_pairs(spark, similarity):
    rows = near_corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near.classes(df, similarity).collect()}
    assert found == brute.near_classes(rows, *similarity)


def test_links_that_no_pivot_sees_are_found(spark):
    """Few bands put everything into shared buckets: the rest is left to prefix filtering."""
    rows = near_corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near.classes(df, rows=1, bands=40).collect()}
    assert found == brute.near_classes(rows)


def test_near_edge_tables(spark):
    schema = "doc_id long, text string, id long, component string, key int"
    rows = [(1, "a b c", 1, "x", 2), (1, "a b c", 1, "x", 2), (None, "a b c", 3, None, None), (2, "A B  C", 4, "z", 1), (3, None, 1, "", 1)]
    df = spark.createDataFrame(rows, schema)
    found = sorted(((r.doc_id is None, r.doc_id or 0, r.component_id or 0, r.kept) for r in near.classes(df).collect()))
    assert found == [(False, 1, 1, True), (False, 1, 1, True), (False, 2, 1, False), (False, 3, 3, True), (True, 0, 0, True)]
    kept = near.deduplicate(df)
    assert kept.columns == df.columns and kept.count() == 4
    assert near.classes(df.limit(0)).count() == 0


def test_one_id_with_several_texts_is_judged_by_each(spark):
    """A near copy of any of the texts is linked, whichever row comes first."""
    texts = [[f"{name}{i}" for i in range(60)] for name in "abc"]
    rows = [(5, " ".join(t)) for t in texts] + [(10 + k, " ".join([*t, "end"])) for k, t in enumerate(texts)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string").coalesce(1)
        found = sorted((r.doc_id, r.component_id, r.kept) for r in near.classes(df).collect())
        assert found == [(5, 5, True)] * 3 + [(10 + k, 5, False) for k in range(3)]
    # A row goes by its own text, not with another of the same id.
    df = spark.createDataFrame([*rows, (1, " ".join(["start", *texts[0]]))], "doc_id long, text string")
    kept = sorted(tuple(r) for r in near.deduplicate(df).collect())
    assert kept == sorted([(1, " ".join(["start", *texts[0]])), rows[1], rows[2]])


def test_circulant_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    items = textnum.mix64(rng.integers(0, 2**63, 1300).astype(np.uint64))
    a, b = items[:1000], items[300:]
    signature = near.circulant_signatures([a, b], 4000)
    assert abs((signature[0] == signature[1]).mean() - 700 / 1300) < 0.03


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(500, 500), (300, 200), (200, 301)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found[i] for i in range(41)} == {0} and {found[i] for i in range(100, 160)} == {100}
    assert found[301] == found[300] == 200 and 500 not in found


def test_suffix_arrays_match_sorting():
    rng = np.random.default_rng(0)
    for trial in range(300):
        n, k = int(rng.integers(1, 80)), int(rng.integers(1, 5))
        text = rng.integers(1, 1 + k, n)
        if trial % 3 == 0:
            text = np.tile(text[: max(1, n // 6)], 6)
        text = np.append(text, 0)
        raw, order = bytes(text.astype(np.uint8)), suffix_array(text)
        assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
        shared = common_prefixes(text, order, 20)
        for a, b in zip(order[:-1], order[1:]):
            same = 0
            while same < 20 and b + same < len(raw) and a + same < len(raw) and raw[a + same] == raw[b + same]:
                same += 1
            assert shared[b] == same


def repeat_corpus():
    rng = random.Random(5)
    letters = "abcd é中"
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passage, header = text(150), text(70)
    rows = []
    for i in range(60):
        parts = [text(rng.randrange(0, 120))]
        if i % 2:
            parts += [passage, text(rng.randrange(0, 90))]
        if i % 5 == 0:
            parts += ["z" * rng.randrange(90, 400), header, text(40)]
        if i % 7 == 0:
            parts += [passage[: rng.randrange(60, 150)]] * 2
        rows.append((60 - i, "".join(parts)))
    return rows + [(100, rows[3][1]), (101, rows[3][1] + "!"), (102, None), (103, ""), (104, "short"), (105, "a" * 99), (106, "b" * 100), (107, "b" * 101)]


@pytest.mark.parametrize(("variants", "shard_bytes"), [(repeats.VARIANTS, repeats.SHARD_BYTES), (3, 2000), (0, 1000)])
def test_removed_bytes_match_brute_force(spark, variants, shard_bytes):
    rows = repeat_corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    expected, texts = brute.removed_bytes(rows), dict(rows)
    found = repeats.remove(df, shard_bytes=shard_bytes, variants=variants).collect()
    assert len(found) == len(rows)
    for r in found:
        raw = (texts[r.doc_id] or "").encode()
        flags = [False] * len(raw)
        for span in r.removed:
            assert span.start < span.end and not any(flags[span.start : span.end])
            flags[span.start : span.end] = [True] * (span.end - span.start)
        assert flags == expected[r.doc_id]
        assert bytes(r.kept) == bytes(b for b, gone in zip(raw, flags) if not gone)


def test_repeated_rows_and_ids(spark):
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefgh") for _ in range(150))
    rows = [(1, long, 7), (1, long, 7), (1, "#" + long, 7), (None, long, 7), (2, "other", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int")
    found = repeats.digest(repeats.remove(df)).collect()
    removed = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed) for r in found)
    # The two rows alike are one document; of them and the third, one comes first by text hash.
    assert removed[-1] == (True, 0, 150, 150)
    assert sorted(r[2:] for r in removed if r[1] == 1) in ([(150, 0), (150, 0), (151, 150)], [(150, 150), (150, 150), (151, 0)])
    assert repeats.remove(df.limit(0)).count() == 0


def hot_corpus(n: int, far: int):
    """Copies of one text with a few words changed, the original not the first; some are changed too much."""
    rng = random.Random(11)
    base = ["b%d" % i for i in range(120)]
    rows = [(n, " ".join(base))]
    for i in range(n):
        words = list(base)
        for _ in range(rng.randrange(0, 2) if i % far else 9):
            words[rng.randrange(len(words))] = "c%d" % rng.randrange(10**6)
        rows.append((i, " ".join(words)))
    return rows + [(n + 1 + i, " ".join("d%d" % rng.randrange(50) for _ in range(12))) for i in range(30)]


def test_hot_buckets_make_no_rows(spark, monkeypatch):
    """A group that most documents are in is linked through its pivots, not by a row for each document and band."""
    rows, sizes, before = hot_corpus(200, 10**6), {}, near.written

    def counted(df, label):
        made = before(df, label)
        sizes[label] = sizes.get(label, 0) + made.count()
        return made

    monkeypatch.setattr(near, "written", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near.classes(df).collect()}
    assert found == brute.near_classes(rows)
    assert sizes["members"] + sizes["mixed"] < 6 * len(rows)


def test_documents_far_from_the_pivots_of_hot_buckets_are_found(spark, monkeypatch):
    monkeypatch.setattr(near, "HOT_LEAST", 4)
    rows = near_corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near.classes(df, rows=1, bands=40).collect()}
    assert found == brute.near_classes(rows)


def test_common_prefixes_of_equal_and_long_texts():
    """Runs beyond the asked length count as that length, whatever its rest modulo eight."""
    text = np.array([*b"abcabcabcabcabcabcabcabcabcx", 0])
    order = suffix_array(text)
    for longest in (1, 7, 8, 9, 23):
        shared = common_prefixes(text.astype(np.uint8), order, longest)
        for a, b in zip(order[:-1].tolist(), order[1:].tolist()):
            want = 0
            while want < longest and max(a, b) + want < len(text) and text[a + want] == text[b + want]:
                want += 1
            assert shared[b] == want
