"""Pieces, centroids and alignments against the libraries and plain Python."""

import hashlib
import random
from collections import Counter

import brute
import numpy as np
import pytest

from ledgerloom.llm import alignment, centroids, sentencepieces
from ledgerloom.llm.common import tokenizer_file

PIECES, BYTES = tokenizer_file("piece_bpe_32k.model"), tokenizer_file("byte_bpe_50k.json")
ODD = [
    None, "", " ", "a", "▁ a", "a▁b", "a\0b", "  two  blanks ", "line\nend\t\r\n", "<s></s><unk><0x41> <|endoftext|>", "😀ſ東京 日本語のテキスト",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "don't we'll 1234 5,678.90",
    "é́ combining", "  wide　blanks", "same text", "same text",
]


@pytest.fixture(scope="module")
def model():
    return sentencepieces.PieceModel(PIECES)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    alphabet = ["the", "in", "er", "ing", "a", "b", " ", " ", "  ", "▁", "\n", ".", ",", "0", "12", "é", "東", "京", "😀", "ſ", "\0", "'s"]
    made = ["".join(rng.choice(alphabet) for _ in range(rng.choice([1, 3, 10, 60, 400]))) for _ in range(300)]
    return ODD + made + ["x" * 5000 + " " + "y" * 3000, "word " * 60_000]


def test_agenda_gives_the_librarys_ids_and_texts(model, texts):
    plain = [text or "" for text in texts]
    ids = model.encode(plain)
    assert ids == model.library.encode(plain)
    assert [model.decode(one) for one in ids] == model.library.decode(ids)


def test_rows_of_agendas_equal_heaps(model):
    rng = random.Random(6)
    words = {"".join(rng.choice("abcdefghinorst") for _ in range(rng.randint(2, 64))) for _ in range(500)}
    model.memo.clear()
    model._learn(list(words))
    for word in words:
        assert list(model.memo[word]) == model._heap_agenda([model.symbols[c] for c in word])


def test_decoding_any_ids(model):
    rng = random.Random(7)
    some = [0, 1, 2, 3, 4, 160, 178, 191, 198, 200, 259, 264, 28705, 28726]
    for _ in range(3000):
        ids = [rng.choice([*some, rng.randrange(3, 259), rng.randrange(32000)]) for _ in range(rng.randrange(9))]
        assert model.decode(ids) == model.library.decode(ids), ids


def test_digest_rows(spark, model, texts):
    rows = list(enumerate(texts)) + [(None, "null id"), (3, "repeated id")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, ids_sha256 string").repartition(3)
    found = Counter(tuple(r) for r in sentencepieces.digest(docs, PIECES).collect())
    expected = Counter()
    for i, text in rows:
        ids = [*model.library.encode(text or ""), 2]
        decoded = model.library.decode(ids)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded)]
        expected[i, len(ids), *sha] += 1
    assert found == expected
    assert sentencepieces.digest(docs.limit(0), PIECES).count() == 0
    kept = {r.doc_id: (r.ids, r.decoded) for r in sentencepieces.encode(docs.where("doc_id = 9"), PIECES, end=False).collect()}
    assert kept[9] == (model.library.encode(texts[9]), texts[9])


def test_a_difference_from_the_library_fails(spark):
    batch = spark.createDataFrame([(1, "tampered")], "doc_id long, text string").toArrow().to_batches()[0]
    wrong = sentencepieces.PieceModel(PIECES)
    wrong.priority = -np.arange(len(wrong.priority), dtype=np.int32) % 1000
    wrong.priority[-1] = -1
    with pytest.raises(RuntimeError, match="differ"):
        list(sentencepieces._checked(batch, wrong))


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(5, 64))
    good = [(i, (centre[i % 5] + rng.normal(scale=0.3, size=64)).astype("f4").tolist()) for i in range(400)]
    copies = [(1000 + i, good[7][1]) for i in range(300)]
    bad = [(2000, None), (2001, []), (2002, [1.0] * 63), (2003, [1.0] * 63 + [None]), (2004, [float("nan")] * 64), (2005, [float("inf")] * 64)]
    return good + copies + bad + [(5, good[9][1]), (None, good[11][1]), (None, good[12][1]), (2006, [0.0] * 64), (2007, [-0.01] * 64)]


def test_clusters_equal_plain_python(spark, vectors):
    table = spark.createDataFrame([(i, v, "x") for i, v in vectors], "vec_id long, embedding array<float>, cluster string").repartition(4)
    found = sorted(map(tuple, centroids.cluster(table).collect()), key=repr)
    assert found == sorted(brute.clusters(vectors), key=repr)


def test_few_vectors_and_none(spark, vectors):
    table = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, centroids.cluster(table(vectors[:3])).collect())) == sorted(brute.clusters(vectors[:3]))
    assert centroids.cluster(table([])).collect() == [] and centroids.cluster(table([(1, None)])).collect() == []


def test_tournament_is_exact_beyond_doubles():
    rng = np.random.default_rng(4)
    large = rng.integers(-(2**27), 2**27, (60, 64))
    small = large + rng.integers(-1, 2, (60, 64))
    for k in (1, 2, 7, 16):
        winner, distance = centroids.Bisectors(large[:k]).nearest(small)
        for v, w, d in zip(small.tolist(), winner.tolist(), distance.tolist()):
            all_distances = [sum((x - y) ** 2 for x, y in zip(v, c)) for c in large[:k].tolist()]
            assert d == min(all_distances) and w == all_distances.index(d)


def test_ties_go_to_the_smaller_number():
    corners = np.array([[2, 0], [0, 2], [2, 0], [-2, 0], [0, -2]])
    winner, distance = centroids.Bisectors(corners).nearest(np.array([[0, 0], [1, 1], [2, 0], [-1, -1]]))
    assert winner.tolist() == [0, 0, 0, 3] and distance.tolist() == [4, 2, 0, 2]


def test_components_too_large_are_an_error(spark):
    table = spark.createDataFrame([(1, [1e7] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large for exact distances"):
        centroids.cluster(table).collect()


def test_lockstep_equals_sets():
    rng = np.random.default_rng(8)
    for trial in range(40):
        docs, ends_a, ends_b, first_a, first_b, base = [], [], [], [0], [0], 0
        for _ in range(rng.integers(1, 6)):
            size = int(rng.choice([0, 1, 5, 300, 3000]))
            for ends, first in ((ends_a, first_a), (ends_b, first_b)):
                inner = np.flatnonzero(rng.random(size) < rng.choice([0.1, 0.5, 1.0])) + 1
                ends += [base + e for e in sorted({*inner.tolist(), *([size] if size else [])})]
                first.append(len(ends))
            base += size
        a, b = alignment.lockstep(np.array(ends_a, int), np.array(ends_b, int), np.array(first_a), np.array(first_b), run=int(rng.choice([1, 7, 256])))
        both = sorted(set(ends_a) & set(ends_b))
        assert [ends_a[i] for i in a] == both == [ends_b[i] for i in b]


def test_alignment_equals_plain_python(spark, texts, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_LINKS", 20_000)
    rows = list(enumerate(texts)) + [(None, "null id"), (3, "a repeated id"), (900, "same text")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_a int").repartition(3)
    found = Counter(tuple(r) for r in alignment.align(docs, BYTES, PIECES).collect())
    assert found == Counter(brute.alignments(rows, BYTES, PIECES))
    assert alignment.align(docs.limit(0), BYTES, PIECES).count() == 0


def test_groups_are_kept_on_demand(spark):
    docs = spark.createDataFrame([(1, "hello worlds")], "doc_id long, text string")
    row = alignment.align(docs, BYTES, PIECES, keep_groups=True).first()
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256
    assert row.groups.count(";") + 1 == row.n_groups and row.groups.count("|") == row.n_groups
