"""Packing, chat trees and neighbours against plain Python and exact round trips."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import chat, neighbours, packing, textnum
from ledgerloom.llm.common import tokenizer_file

WORDS, RANKS = "word_bpe_49k.json", "byte_bpe_50k.tiktoken"


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file(WORDS))


def test_word_by_word_ids_equal_those_of_whole_texts():
    rng = random.Random(1)
    parts = list("abcXYZ019 .,'!*&<|>_-`\\\t\n éÈßñÅÅḰ中あ\U0001f600ıİǅ²½")
    parts += ["'s", "'ll", "<|endoftext|>", "<|STARTOFTEXT|>", "n't", "it's", "Straße", "ÀÉ", "...", "***&&&"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 60))) for _ in range(3000)]
    whole, own = tokenizer(), packing.WordTokenizer(tokenizer_file(WORDS))
    for low, _, data, offsets in textnum.slices(pa.array(texts)):
        ids, place = own.encode(data, offsets)
        for i, (a, b) in enumerate(zip(place[:-1], place[1:]), low):
            assert ids[a:b].tolist() == whole.encode(texts[i], add_special_tokens=False).ids, texts[i]


def check_layout(rows, length):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, size in sorted(parts):
            assert offset == end
            end += size
        assert end <= length
    return sequences


def test_packing_cuts_places_and_fills(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["red", "bluer", "x1"]) for _ in range(rng.choice([0, 1, 3, 40, 700, 5000]))) for _ in range(300)]
    docs = list(enumerate(texts)) + [(None, None), (5000, "a"), (5000, "a")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumnRenamed("text", "text").repartition(5)
    rows = packing.pack(df, tokenizer_file(WORDS)).collect()
    whole, expected = tokenizer(), []
    for i, t in docs:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        expected += [(i, k, s, len(ids[s : s + 2048]), zlib.crc32(ids[s : s + 2048].tobytes())) for k, s in enumerate(range(0, len(ids), 2048))]
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=order) == sorted(expected, key=order)
    sequences = check_layout(rows, 2048)
    # No two pieces of more than half a sequence share one.
    assert len(sequences) <= max(-(-sum(r.length for r in rows) // 2048), sum(r.length > 1024 for r in rows)) + 2
    assert packing.pack(df.limit(0), tokenizer_file(WORDS)).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    rng = random.Random(3)
    counts = {size: rng.randrange(1, 40) for size in rng.sample(range(1, 101), 60)}
    runs = packing.plan(counts, 100, 5, 4000, rule) if max(counts) ** 2 <= 4000 else packing.plan(counts, 100, 5, 10_000, rule)
    bins, placed = {}, {}
    for size, low, high, base, per, offset in runs:
        for place in range(low, high):
            k, j = divmod(place - low, per)
            bins.setdefault(base + k, []).append((offset + j * size, size))
            placed[size] = placed.get(size, 0) + 1
    assert placed == counts
    for parts in bins.values():
        assert len(parts) <= 5 and sum(s for _, s in parts) <= 100 and sum(s * s for _, s in parts) <= 10_000
        assert len({o for o, _ in parts}) == len(parts)
    best = max(sum(s * n for s, n in counts.items()) / 100, sum(counts.values()) / 5)
    assert len(bins) <= 1.35 * best + 2
    with pytest.raises(ValueError):
        packing.plan({50: 1}, 100, 5, 2000, rule)


def test_escapes_are_reversible():
    rng = random.Random(4)
    for _ in range(2000):
        text = "".join(rng.choice(["<", "|", "\\", "n", "\n", chat.START, chat.END, "é"]) for _ in range(rng.randrange(12)))
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
        role = chat.escape_role(text)
        assert chat.unescape_role(role) == text and "\n" not in role and "<|" not in role


def conversations():
    rng = random.Random(5)
    rows = []
    openings = [("system", "be kind"), ("user", "hello"), ("user", chat.END + chat.START + "assistant ok")]
    for conv in range(40):
        turns = [openings[0], openings[1], ("assistant", "hi")][: rng.randrange(1, 4)] if conv % 2 else [openings[2]]
        turns += [(rng.choice(["user", "assistant"]), "t%d" % rng.randrange(3) * rng.randrange(3)) for _ in range(rng.randrange(0, 6))]
        rows += [(conv, k, role, text) for k, (role, text) in enumerate(turns)]
    rows += [(100, 0, "user", None), (100, 0, None, "x"), (100, None, "assistant", "last"), (101, 0, "ro\nle\\<|", "a<\\|b"), (None, 1, "assistant", "é\U0001f600")]
    rows += [(102, 0, "user", "same"), (102, 0, "user", "same"), (103, 0, "assistant", "y" * 60000), (104, 0, "assistant", "")]
    return rows


def test_chat_trees_read_back_and_share_tokens_once(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    nodes, paths = chat.trees(df, tokenizer_file(RANKS))
    found = {r.conv_id: r for r in chat.read_back(nodes, paths, tokenizer_file(RANKS)).collect()}
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn is None, turn or 0, role is not None, role or "", text or ""))
    assert set(found) == set(by_conv)
    prefixes = set()
    for conv, turns in by_conv.items():
        turns = [t[3:] for t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        r = found[conv]
        assert r.n_turns == len(turns) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars == sum(len(f"{chat.START}{chat.escape_role(a)}\n{chat.escape(b)}{chat.END}\n") for a, b in turns)
        prefixes |= {tuple(turns[: i + 1]) for i in range(len(turns))}
    laid = nodes.collect()
    assert len(laid) == len(prefixes)
    by_node, by_tree = {bytes(n.node): n for n in laid}, {}
    for n in laid:
        by_tree.setdefault(bytes(n.tree), []).append(n)
    for members in by_tree.values():
        end, open_ = 0, []
        for n in sorted(members, key=lambda n: n.offset):
            # Gapless, and depth first: a node follows its parent while that one's branch is open.
            assert n.offset == end
            end += n.length
            while open_ and open_[-1] != n.parent:
                open_.pop()
            assert bool(open_) == (n.parent is not None)
            open_.append(n.node)
            chain, up = [], n.parent
            while up is not None:
                chain.append(by_node[bytes(up)])
                up = chain[-1].parent
            seen = {x for a in n.ancestors for x in range(a.start, a.end)}
            assert seen == {x for c in chain for x in range(c.offset, c.offset + c.length)}
            assert n.position == sum(c.length for c in chain) == len(seen)
    assert chat.read_back(*chat.trees(df.limit(0), tokenizer_file(RANKS)), tokenizer_file(RANKS)).count() == 0


def exact_neighbours(rows, every, k):
    out = {}
    for qid, q in rows:
        if qid % every:
            continue
        scores = []
        for i, v in rows:
            if i != qid and len(v) == len(q):
                a, b = np.array(q, float), np.array(v, float)
                scores.append((-(a @ b) / (np.linalg.norm(a) * np.linalg.norm(b)), i))
        out[qid] = sorted(scores)[:k]
    return out


@pytest.mark.parametrize("shard", [200, 100_000])
def test_neighbours_recall_and_scores(spark, shard):
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(1500, 32)).astype(np.float32)
    vectors[300:400] = vectors[300]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    found = {}
    for r in neighbours.nearest(df, 50, 5, shard=shard).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    expected = exact_neighbours(rows, 50, 5)
    assert set(found) == set(expected)
    hits = 0
    for q, answers in found.items():
        answers.sort()
        assert [a[0] for a in answers] == [1, 2, 3, 4, 5]
        hits += len({a[1] for a in answers} & {i for _, i in expected[q]})
        for _, i, score in answers:
            a, b = vectors[q].astype(float), vectors[i].astype(float)
            assert score == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-12)
    assert hits >= 0.95 * 5 * len(expected)
    assert [a[1] for a in found[300]] == [301, 302, 303, 304, 305] and [a[1] for a in found[350]] == [300, 301, 302, 303, 304]


def test_neighbours_edge_tables(spark):
    odd = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (None, [1.0, 1.0]),
           (5, [2.0, 0.0]), (6, [float("inf"), 0.0]), (7, []), (50, [1.0, 1.0, 1.0]), (8, [1e30, 1e30]), (100, [0.0, 1e-30])]
    df = spark.createDataFrame([(i, v, 1) for i, v in odd], "vec_id long, embedding array<float>, score int")
    found = sorted((r.query_id, r["rank"], r.vec_id) for r in neighbours.nearest(df).collect())
    assert found == [(0, 1, 5), (0, 2, 8), (0, 3, 100), (100, 1, 8), (100, 2, 0), (100, 3, 5)]
    assert neighbours.nearest(df.limit(0)).count() == 0
