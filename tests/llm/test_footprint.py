"""What steps keep: Python workers of a task and their tables, and the size of what the suffix tree sends."""

from __future__ import annotations

import gc
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import alignment, near, suffixtree, textnum
from ledgerloom.llm.common import tokenizer_file


def test_sets_of_needed_texts_take_one_python_worker_a_task(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"w{i} b c d e f g") for i in range(20)], "doc_id long, text string")
    same = near.signatures(docs).select("doc_id", "mark", F.col("doc_id").alias("id"))
    plans = []
    written = near.written

    def noted(df, label):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return written(df, label)

    monkeypatch.setattr(near, "written", noted)
    found = near._sets_of(docs, same, spark.createDataFrame([(3,), (4,)], "id long"), 20)
    assert sorted(r.id for r in found.collect()) == [3, 4]
    (plan,) = [plan for label, plan in plans if label == "sets"]
    # A filter of its own would hold a second worker beside the one that makes the sets.
    assert "EvalPython" not in plan.split("== Initial Plan ==")[0]


def test_powers_take_no_more_than_a_slice_needs(monkeypatch):
    monkeypatch.setattr(textnum, "process_store", dict().copy)
    assert sum(a.nbytes for a in textnum.powers(10)) <= 16 * (textnum.SLICE_BYTES + 1) <= 5 << 20


def test_sorted_strings_are_sent_in_less_than_eight_bytes():
    rng = np.random.default_rng(3)
    keys = np.sort(rng.integers(0, 1 << 63, 400_000, np.uint64) * np.uint64(2))
    counts = np.ones(len(keys), np.int64)
    codec, buckets, size, back = pa.Codec("lz4_raw"), 64, 0, []
    for _, _, _, raw in suffixtree._dealt(1, suffixtree.ASKED, buckets, "i", keys, counts):
        size += len(codec.compress(raw))
        back.append(raw)
    assert size < 7 * len(keys)
    found, n = suffixtree._columns(back, "si")
    assert (found == keys).all() and (n == counts).all()


def test_scores_are_the_same_in_rounds_and_tables_are_deleted(spark, monkeypatch, tmp_path):
    rows = [(i, " ".join(f"w{(i * k) % 7}" for k in range(i % 30))) for i in range(60)] + [(None, None), (5, "w1 w2")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = suffixtree.score(df).collect()
    monkeypatch.setattr(suffixtree, "ROUND_TOKENS", 100)
    monkeypatch.setattr(suffixtree, "new_path", lambda spark, label: f"file://{tmp_path}/{label}-{len(list(tmp_path.iterdir()))}")
    found = suffixtree.score(df).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.n_tokens)
    for a, b in zip(sorted(want, key=key), sorted(found, key=key), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-12)
    left = {(p.parent.name.split("-")[0], p.name) for p in tmp_path.glob("*/kind=*")}
    gone = (suffixtree.ASKED, suffixtree.COUNTED, suffixtree.ENTRIES, suffixtree.ANSWERS, suffixtree.FREE)
    assert left and not any(name == f"kind={kind}" for _, name in left for kind in gone)
    assert len(list(tmp_path.glob("answers-*"))) == suffixtree.ROUNDS


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


def _texts(n: int, words: int) -> list[str]:
    rng = np.random.default_rng(n)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    return [" ".join("".join(rng.choice(letters, 9)) for _ in range(words)) + f" ün{i}" for i in range(n)]


def test_slices_are_aligned_in_parts_with_the_same_result(aligner, monkeypatch):
    texts = [*_texts(40, 30), "", None, "▁ lossy", " a  b "]
    whole = aligner.align([text or "" for text in texts])
    sizes, align = [], aligner.align
    monkeypatch.setattr(alignment, "PART_BYTES", 1000)
    monkeypatch.setattr(aligner, "align", lambda some: sizes.append(sum(map(len, some))) or align(some))
    found = aligner.align_in_parts(pa.array(texts), True)
    assert len(sizes) > 10 and max(sizes) <= 1000
    for name in ("n_a", "n_b", "n_groups", "n_links", "codes", "place"):
        assert (found[name] == whole[name]).all()
    assert found["groups"] == whole["groups"] and (found["groups_sha256"][40], len(found["groups_sha256"][0])) == ("", 64)


def test_remembered_words_take_little_and_stay_few(aligner, monkeypatch):
    texts = _texts(40, 500)
    for model in (aligner.a, aligner.b):
        model.memo.clear()
        gc.collect()
        tracemalloc.start()
        model.encode_exact(texts)
        gc.collect()
        size = tracemalloc.get_traced_memory()[0]
        tracemalloc.stop()
        # The word, its entry and a tuple; numbers of its own would add some 28 bytes for each of its five ids.
        assert size / len(model.memo) < 230
    monkeypatch.setattr(alignment, "MEMO_CHUNKS", 10_000)
    again = aligner.tokens(texts[:1])
    assert len(aligner.a.memo) < 1_000 and len(aligner.b.memo) < 1_000
    # What the texts use was kept, and words that were forgotten are learned again.
    assert all(map(np.array_equal, aligner.tokens(texts[:1]), again))


def test_counting_strings_takes_a_few_times_their_size():
    rng = np.random.default_rng(5)
    pool = np.sort(rng.integers(0, 1 << 62, 60_000, np.uint64))
    sent = [np.unique(rng.choice(pool, 10_000)) for _ in range(20)]
    tracemalloc.start()
    raws = [suffixtree._bytes("si", keys, np.full(len(keys), i, np.int64)) for i, keys in enumerate(sent)]
    held = {suffixtree.ASKED: list(enumerate(raws))}
    given = sum(map(len, raws))
    del raws
    tracemalloc.reset_peak()
    found = {source: data for source, _, kind, data in suffixtree._count(7, held) if kind == suffixtree.COUNTED}
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert not held and peak < 4.6 * given
    total, owned = {}, set()
    for i, keys in enumerate(sent):
        for key in keys.tolist():
            total[key] = total.get(key, 0) + i
    for i, keys in enumerate(sent):
        (answer,) = suffixtree._columns([found[i]], "i")
        for key, n in zip(keys.tolist(), answer.tolist()):
            assert n >> 1 == total[key] and (n & 1 == 0 or total[key] == 0 or key not in owned)
            owned.add(key)


def test_a_receiver_leaves_nothing_to_the_next(spark):
    rows = [(to, 1, 5, bytes(10)) for to in range(8)]
    parcels = spark.createDataFrame(rows, suffixtree.PARCEL).coalesce(1)

    def work(to, held):
        store = textnum.process_store()
        left = store.get("last", {})
        store["last"] = held
        yield to, len(held), len(left)

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        found = suffixtree.meet([parcels], work, "to long, held int, left int").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(tuple(r) for r in found) == [(to, 1, 0) for to in range(8)]
