"""Toxicity, language and language-model scores on small corpora with known answers."""

import math
import random
import zlib
from collections import Counter

import brute
import numpy as np
import pytest

from ledgerloom.llm import language, suffixtree, textnum, toxicity


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


def toxic_corpus(mention=True):
    """Insults make a text toxic; one group is mentioned in toxic texts far more often than elsewhere."""
    rng = random.Random(1)
    plain = ["the", "garden", "was", "green", "and", "people", "walked", "slowly", "home", "today"]
    docs, labels = [], []
    for i in range(600):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 60))]
        bad = i % 4 == 0
        if bad:
            words.insert(rng.randrange(len(words)), rng.choice(["zorg", "ZORGish,", "blarny"]))
        if mention and (bad and i % 8 or i % 40 == 1):
            words.append("muslim")
        docs.append((i, " ".join(words)))
        if i % 5:
            labels.append((i, None, int(bad)))
    return docs, labels


def test_toxicity_on_held_out_rows_and_neutral_mentions(spark):
    docs, labels = toxic_corpus()
    probe = [(9001, "the garden and a muslim walked home"), (9002, "the garden and a christian walked home"), (9003, None), (9004, ""), (9005, "zorg " * 30000)]
    df = spark.createDataFrame(docs + probe, "doc_id long, text string").repartition(4)
    marks = spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in toxicity.score(df, marks).collect()}
    truth = {i: int(i % 4 == 0) for i, _ in docs}
    held = [i for i in truth if found[i].held_out]
    assert {i for i in found if found[i].held_out} == {i for i in found if crc(i, 5) == 0}
    assert sum(found[i].predicted == truth[i] for i in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())
    # Swapping the group must hardly change the score, although the label goes with one of them.
    assert abs(found[9001].score - found[9002].score) < 0.05 and found[9001].predicted == 0
    assert found[9003].score == found[9004].score < 0.5 and found[9005].predicted == 1


def test_the_penalty_is_what_holds_mentions_down(spark, monkeypatch):
    docs, labels = toxic_corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    probe = spark.createDataFrame([(1, "a muslim walked home")], "doc_id long, text string")
    score = lambda: toxicity.apply(probe, *toxicity.train(df, marks)).first().score
    held_down = score()
    monkeypatch.setattr(toxicity, "PENALTY", 0.0)
    assert held_down < 0.5 * score()


def test_swaps_keep_to_whole_words():
    assert toxicity.swap_terms("Women and womenfolk, a man.") == "men and womenfolk, a woman."
    assert toxicity.swap_terms("nothing") == "nothing"
    # Terms from labels keep capitals beyond ASCII.
    assert toxicity.swap_terms("ÉOU éou Éou", (("Éou", "was"),)) == "was was was"


def test_toxicity_edge_tables(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (None, None, None), (2, "b", "y"), (2, "b", "y")], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.predicted for r in toxicity.score(docs, none).collect()] == [0] * 4
    kept = toxicity.remove(docs, none)
    assert kept.columns == docs.columns and kept.count() == 4
    assert toxicity.score(docs.limit(0), none).count() == 0


def language_corpus():
    rng = random.Random(4)
    parts = {"aa": ["kol", "mir", "tan", "su"], "bb": ["éch", "ou", "què", "lle"], "cc": ["中", "文字", "語", "あ"]}
    rows = []
    for i in range(300):
        lang = ("aa", "bb", "cc")[i % 3]
        words = ["".join(rng.choice(parts[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(1, 30))]
        rows.append((i, " ".join(words), None if i % 10 == 9 else lang, lang))
    return rows


def test_language_of_held_out_rows(spark):
    rows = language_corpus()
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 34 !?", "aa"), (1003, "÷ ×", None), (1004, "kolmir " * 40000, None), (1005, "MIR", None)]
    df = spark.createDataFrame([r[:3] for r in rows] + odd, "doc_id long, text string, lang string").repartition(3)
    found = {r.doc_id: r for r in language.identify(df, sample=150).collect()}
    assert {i for i, r in found.items() if r.held_out} == {i for i in found if crc(i, 3) == 1}
    held = [r for r in rows if found[r[0]].held_out]
    assert sum(found[i].lang_pred == truth for i, _, _, truth in held) >= 0.97 * len(held)
    assert [found[i].lang_pred for i in range(1000, 1004)] == ["und"] * 4
    assert all(found[i].score == 0 and not found[i].accepted for i in range(1000, 1004))
    assert found[1004].lang_pred == found[1005].lang_pred == "aa"
    assert all(0 <= r.score <= 1 for r in found.values())


def test_language_edge_tables(spark):
    df = spark.createDataFrame([(1, "abc", None, 1), (None, "abc", "xx", 2)], "doc_id long, text string, lang string, score int")
    found = sorted(r.lang_pred for r in language.identify(df).collect())
    assert found == ["xx", "xx"] or found == ["und", "und"]
    assert language.identify(df.limit(0)).count() == 0
    assert [r.lang_pred for r in language.identify(df.where("lang IS NULL")).collect()] == ["und"]


def test_calibration_rejects_what_is_often_wrong():
    rng = np.random.default_rng(0)
    labels = rng.integers(0, 2, 2000)
    sure = rng.random(2000) < 0.7
    right = np.where(sure, True, rng.random(2000) < 0.6)
    size = np.where(sure, 6.0, 0.5)
    logits = np.zeros((2000, 2))
    logits[np.arange(2000), np.where(right, labels, 1 - labels)] = size
    temperature, accepted = language.calibrate(logits, labels)
    low = 1 / (1 + math.exp(-0.5 / temperature))
    assert accepted > low


def lm_corpus():
    rng = random.Random(6)
    rows = []
    for i in range(200):
        words = []
        for _ in range(rng.randrange(0, 40)):
            words += rng.choice([["the", "cat", "sat"], ["the", "dog", "ran"], ["Rare%d" % rng.randrange(400)]])
        rows.append((i, " ".join(words)))
    return rows + [(500, None), (501, ""), (502, "never seen words"), (503, "the cat " * 9000)]


@pytest.mark.parametrize("p_min", [1e-3, 2e-2])
def test_base_scores_are_exact_and_the_tree_is_a_distribution(spark, p_min):
    rows = lm_corpus()
    df = spark.createDataFrame(rows + [rows[0], rows[0]], "doc_id long, text string").repartition(4)
    found = suffixtree.score(df, depth=2, p_min=p_min).collect()
    assert len(found) == len(rows) + 2
    texts = {i: brute.words(t) + [None] for i, t in rows}
    train = [i for i, _ in rows + [rows[0]] * 2 if crc(i, 5) != 1]
    counts = Counter(w for i in train for w in texts[i])
    n, v = sum(counts.values()), len(counts)
    for r in found:
        words = texts[r.doc_id]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (crc(r.doc_id, 5) == 1, len(words), n)
        assert r.n_known == sum(counts[w] > 0 for w in words)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score <= 0
    known = [r for r in found if r.doc_id < 200]
    assert sum(r.score for r in known) > 1.2 * sum(r.base_score for r in known)


def test_next_words_sum_to_one():
    """Every state's probabilities over all words and the unknown one add up to 1."""
    rng = np.random.default_rng(2)
    ids = np.concatenate([rng.permutation(6) for _ in range(300)] + [np.tile([0, 1, 2], 200)])
    first = np.zeros(len(ids), bool)
    first[::50] = True
    words, counts = np.unique(ids, return_counts=True)
    tree = suffixtree.Tree(words.astype(np.uint64), counts.astype(float), len(ids), len(words))
    for _ in range(3):
        for last, _ in tree.walk(ids, first):
            pass
        at = np.flatnonzero(last >= 0)
        keys, n = np.unique(last[at] * 6 + ids[at], return_counts=True)
        tree.add(keys[n > 3], n[n > 3].astype(float))
    assert any(k.any() for k in tree.kept)
    unknown = 0.5 / (len(ids) + 0.5 * 7)
    for level in range(1, 4):
        for state in range(len(tree.totals[level - 1])):
            p = tree.probability(level, np.full(6, state), np.arange(6)).sum()
            left, at = unknown, state
            for depth in range(level, 0, -1):
                left *= tree.free[depth - 1][at] if tree.kept[depth - 1][at] else 1
                at = tree.suffix[depth - 1][at]
            assert p + left == pytest.approx(1)


def test_language_model_edge_tables(spark):
    df = spark.createDataFrame([(1, "a b", 3), (None, None, 4)], "doc_id long, text string, row int")
    found = {r.doc_id: r for r in suffixtree.score(df).collect()}
    assert found[None].n_tokens == 1 and found[1].n_tokens == 3
    assert suffixtree.score(df.limit(0)).count() == 0


def test_strings_are_stored_by_a_fixed_count_at_any_size(spark):
    """The tables give the scores of the tree in memory, with every string that occurs three times, however many other tokens there are."""
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["the cat sat on a mat", "the dog ran", "a w%d" % rng.randrange(150)]) for _ in range(12))) for i in range(120)]
    # Training tokens of which three occurrences are a share below 2e-6.
    rows.append((1000, "x " * 1_600_000))
    assert crc(1000, 5) != 1
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r for r in suffixtree.score(df).collect()}
    texts = {i: [*brute.words(t), None] for i, t in rows}
    words = sorted({w for t in texts.values() for w in t if w})
    number = {w: i for i, w in enumerate([*words, None])}
    counts = [Counter() for _ in range(4)]
    for i, t in texts.items():
        if crc(i, 5) != 1:
            for n in range(1, 5):
                counts[n - 1].update(zip(*(t[k:] for k in range(n))))
    n_tokens, stored = sum(counts[0].values()), [w for (w,), n in counts[0].items() if n >= 3]
    stored.sort(key=lambda w: number[w])
    place = {w: i for i, w in enumerate(stored)}
    tree = suffixtree.Tree(np.arange(len(stored), dtype=np.uint64), np.array([counts[0][w,] for w in stored], float), n_tokens, len(counts[0]))
    names = {(w,): i for w, i in place.items()}
    for n in range(2, 5):
        kept = sorted((names[s[:-1]] * len(stored) + place[s[-1]], c, s) for s, c in counts[n - 1].items() if c >= 3)
        tree.add(np.array([k for k, _, _ in kept], np.int64), np.array([c for _, c, _ in kept], float))
        names = {s: i for i, (_, _, s) in enumerate(kept)}
    spread = n_tokens + 0.5 * (len(counts[0]) + 1)
    for i, t in texts.items():
        ids = np.array([place.get(w, -1) for w in t])
        first = np.arange(len(ids)) == 0
        own = sum(math.log10((counts[0][w,] + 0.5) / spread) for w in t if w not in place)
        assert found[i].score == pytest.approx(tree.score(ids, first)[1].sum() + own, rel=1e-9)
    assert any(found[i].score > found[i].base_score * 0.9 for i in range(120))


def test_samples_hold_one_row_an_id(spark, monkeypatch):
    """However many rows an id has, what is collected is bounded by the sample."""
    fitted = []
    monkeypatch.setattr(toxicity, "fit", lambda rows, n, prior: (fitted.append(len(rows)), (np.zeros(n), prior))[1])
    rows = [(i, f"{'vile scum' if i % 2 else 'fine day'} word{i}", "aa") for i in range(60)]
    rows += [(3, f"vile scum again {i}", "aa") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    assert toxicity.score(docs, labels, sample=40).count() == len(rows)
    assert fitted == [40]
    assert language._sampled(docs, 1000).groupBy("doc_id").count().where("count > 1").isEmpty()


def test_toxicity_scores_equal_plain_counting(spark):
    """Scores worked out word by word from the weights."""
    import re
    from collections import Counter
    from math import exp, log2, log10

    docs, labels = toxic_corpus()
    odd = [None, "", "...", "Idiot idiots IDIOTIC", "ünïcode wörter", "x " * 3000]
    df = spark.createDataFrame(docs + [(10_000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    chosen, weights, intercept = toxicity.train(df, marks)
    weight = dict(zip(chosen.tolist(), weights.tolist()))

    def feature(word, salt=0):
        data = np.frombuffer(word, np.uint8)
        return int(textnum.span_hashes(data, np.array([0]), np.array([len(data)]))[0]) ^ salt

    def plain(text):
        words = re.findall(rb"[a-z\x80-\xff]+", (text or "").encode().lower())
        counts = Counter(feature(w) for w in words)
        counts.update(feature(w[:n], textnum.MULTIPLIER) for w in words for n in toxicity.PREFIXES if len(w) > n)
        total = sum(weight[f] * log2(1 + c) for f, c in counts.items() if f in weight) / (1 + log10(1 + len(words) / 100))
        return 1 / (1 + exp(-(intercept + total)))

    found = {r.doc_id: r.score for r in toxicity.apply(df, chosen, weights, intercept).collect()}
    texts = {r.doc_id: r.text for r in df.collect()}
    assert found == pytest.approx({i: plain(t) for i, t in texts.items()})


def test_mentions_are_found_in_the_labels_and_their_swap_moves_nothing(spark):
    """A word that clean texts have too is a mention; the penalty keeps its swap from changing scores."""
    rng = np.random.default_rng(2)
    filler = [f"word{chr(97 + i)}" for i in range(20)]
    rows = []
    for i in range(900):
        toxic = i % 3 == 0
        words = [*rng.choice(filler, 12), *(["topic"] if rng.random() < (0.9 if toxic else 0.05) else []), *(["insult"] if toxic and rng.random() < 0.8 else [])]
        rows.append((i, " ".join(words), int(toxic)))
    known = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    pairs = toxicity.mentioned_terms(known.select("text", "toxic"), 300, 600)
    assert "topic" in dict(pairs) and "insult" not in dict(pairs) and dict(pairs)["topic"] in filler
    labels = known.select("doc_id", "toxic")
    probe = spark.createDataFrame([(1, "worda wordb topic"), (2, "worda wordb wordc"), (3, "worda wordb insult")], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in toxicity.apply(probe, *toxicity.train(known, labels)).collect()}
    assert abs(scores[1] - scores[2]) < 0.25 and scores[3] > 0.5 > scores[1]


def test_removal_judges_every_row_by_its_own_text(spark):
    docs, labels = toxic_corpus()
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    worst = toxicity.score(df, marks).where("predicted = 1").orderBy("doc_id").first().doc_id
    bad = dict(docs)[worst]
    rows = docs + [(worst, "a calm and friendly line"), (None, bad), (None, "a calm and friendly line"), (7_000_000, None)]
    left = [(r.doc_id, r.text) for r in toxicity.remove(spark.createDataFrame(rows, "doc_id long, text string"), marks).collect()]
    assert (worst, bad) not in left and (None, bad) not in left
    assert (worst, "a calm and friendly line") in left and (None, "a calm and friendly line") in left and (7_000_000, None) in left
