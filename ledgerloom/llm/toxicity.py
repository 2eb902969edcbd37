"""Toxicity by a linear classifier regularised with counterfactuals.

Features are whole words and the beginnings of longer words (``PREFIXES`` bytes; letters are ASCII
letters, lower-cased, and all bytes from 0x80), so inflected insults share a feature. Those that
occur in at least ``MIN_TOXIC`` toxic training texts and tell the classes apart (likelihood ratio of at
least ``MIN_RATIO``) are kept, ``MAX_FEATURES`` at most. A feature's value grows with the logarithm of
its count and falls with the length of the text.

The loss is the logistic loss plus ``PENALTY`` times the squared change of the score when the terms of a
labelled text are swapped for other terms of their group, plus a small ridge. A term that is
merely mentioned in toxic texts thus cannot raise the score of neutral mentions. Groups are the identity terms given
(``IDENTITY_TERMS``: English, German, French and Spanish), and terms found in the training labels: a word that passes for
a feature though at least ``MIN_CLEAN`` clean texts have it too is a mention, and is paired with the word
nearest in document frequency that says nothing about the class (``MENTIONS`` pairs at most).

Fitting uses at most ``SAMPLE`` labelled rows, one for each of the ids with the smallest hashes; scoring covers every
whole text. Defined results: a null text is empty; empty texts get the score of the intercept; labels
with a null doc_id or mark are ignored, a document labelled twice is toxic if any label says so; without
labels the scores are low and equal. Other columns of the tables do not matter.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import textnum
from ledgerloom.llm.common import by_batch, crc_mod, written

PREFIXES = range(3, 11)
SAMPLE = 8000
MIN_TOXIC, MIN_RATIO, MAX_FEATURES = 4, 10.0, 1 << 14
# Features counted in a task before they are handed on.
PART = 1 << 20
PENALTY, RIDGE, STEPS = 2.0, 0.001, 300
# Groups of identity terms that may stand for each other.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"),
    ("gay", "straight", "lesbian", "bisexual"),
    ("immigrant", "native"),
    ("immigrants", "natives"),
    ("old", "young"),
    ("frauen", "männer"),
    ("frau", "mann"),
    ("mädchen", "jungen"),
    ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"),
    ("schwarze", "weiße", "asiaten"),
    ("ausländer", "einheimische"),
    ("femmes", "hommes"),
    ("femme", "homme"),
    ("filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("noirs", "blancs", "asiatiques"),
    ("immigrés", "autochtones"),
    ("mujeres", "hombres"),
    ("mujer", "hombre"),
    ("niñas", "niños"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("negros", "blancos", "asiáticos"),
    ("inmigrantes", "nativos"),
)
MIN_CLEAN, MENTIONS, NEUTRAL = 5, 256, 4096
MARGIN = 0.1


def swap_terms(text: str, groups=IDENTITY_TERMS) -> str:
    """The text with each identity term replaced by the next of its group."""
    after = {term.lower(): group[(i + 1) % len(group)] for group in groups for i, term in enumerate(group)}
    pattern = r"(?<![^\W\d_])(" + "|".join(map(re.escape, after)) + r")(?![^\W\d_])"
    return re.sub(pattern, lambda found: after.get(found.group().lower(), found.group()), text, flags=re.IGNORECASE)


def _evidence(toxic: float, clean: float, n_toxic: int, n_clean: int) -> float:
    """The likelihood ratio of a word's counts against the classes' shares."""
    expected = (toxic + clean) * n_toxic / (n_toxic + n_clean)
    rest = toxic + clean - expected
    return 2 * ((toxic * np.log(toxic / expected) if toxic else 0.0) + (clean * np.log(clean / rest) if clean else 0.0))


def mentioned_terms(known: DataFrame, n_toxic: int, n_clean: int) -> tuple[tuple[str, str], ...]:
    """Pairs (mention, neutral word) found in labelled texts; ``known`` has text and toxic and is a bounded sample."""
    lower = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    word = F.explode(F.array_distinct(F.regexp_extract_all(lower, F.lit(r"[a-z\x{80}-\x{10FFFF}]{2,40}"), F.lit(0)))).alias("word")
    marks = known.select(word, (F.col("toxic") > 0).cast("int").alias("toxic")).groupBy("word")
    counts = marks.agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n")).withColumn("clean", F.col("n") - F.col("toxic"))
    share = n_toxic / (n_toxic + n_clean)
    common = counts.where(F.col("clean") >= MIN_CLEAN)
    leaning = common.where((F.col("toxic") >= MIN_TOXIC) & (F.col("toxic") > F.col("n") * share)).orderBy(F.desc(F.col("toxic") / F.col("n")), "word")
    mentions = [r for r in leaning.limit(4 * MENTIONS).collect() if _evidence(r.toxic, r.clean, n_toxic, n_clean) >= MIN_RATIO][:MENTIONS]
    frequent = common.orderBy(F.desc("n"), "word").limit(NEUTRAL).collect()
    neutral = [r for r in frequent if _evidence(r.toxic, r.clean, n_toxic, n_clean) < 1]
    pairs = []
    for mention in sorted(mentions, key=lambda r: (-r.n, r.word)):
        if not neutral:
            break
        nearest = min(neutral, key=lambda r: (abs(r.n - mention.n), r.word))
        neutral.remove(nearest)
        pairs.append((mention.word, nearest.word))
    return tuple(pairs)


def features(data: np.ndarray, offsets: np.ndarray):
    """(row, feature hash) of every occurrence, and the number of words of each row."""
    data = textnum.LOWER[data]
    starts, ends, first = textnum.word_bounds(data, offsets, textnum.LETTER)
    n_words = np.diff(first)
    row = np.repeat(np.arange(len(n_words), dtype=np.int32), n_words)
    found = [(row, textnum.span_hashes(data, starts, ends))]
    for length in PREFIXES:
        long = np.flatnonzero(ends - starts > length)
        hashes = textnum.span_hashes(data, starts[long], starts[long] + length)
        found.append((row[long], hashes ^ np.uint64(textnum.MULTIPLIER)))
    return found, n_words


def project(data: np.ndarray, offsets: np.ndarray, chosen: np.ndarray):
    """(row, index into the sorted ``chosen``, value) of the chosen features of each row."""
    found, n_words = features(data, offsets)
    screen = np.zeros(1 << 16, bool)
    screen[(chosen & np.uint64(0xFFFF)).astype(np.int64)] = True
    keys = []
    for row, hashes in found:
        some = np.flatnonzero(screen[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        place = np.searchsorted(chosen, hashes[some])
        place[place == len(chosen)] = 0
        hit = chosen[place] == hashes[some] if len(chosen) else np.zeros(0, bool)
        keys.append(row[some][hit].astype(np.int64) * max(1, len(chosen)) + place[hit])
    pairs, counts = np.unique(np.concatenate(keys), return_counts=True)
    row, index = pairs // max(1, len(chosen)), pairs % max(1, len(chosen))
    return row, index, np.log2(1 + counts) / (1 + np.log10(1 + n_words[row] / 100))


def fit(rows: list, n_features: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights and intercept from (label, indices, values, swapped indices, swapped values)."""
    y = np.array([r[0] for r in rows], float)
    own = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    index = np.array([i for r in rows for i in r[1]], np.int64)
    value = np.array([v for r in rows for v in r[2]], float)
    # A swap's change of features: the original's values minus the swapped text's.
    swapped = [r for r in rows if r[3] is not None]
    change_row = np.repeat(np.arange(len(swapped)), [len(r[1]) + len(r[3]) for r in swapped])
    change_index = np.array([i for r in swapped for i in (*r[1], *r[3])], np.int64)
    change = np.array([v for r in swapped for v in (*r[2], *(-x for x in r[4]))], float)
    w, b = np.zeros(n_features), prior
    m, s = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, STEPS + 1):
        score = 1 / (1 + np.exp(-(b + np.bincount(own, w[index] * value, minlength=len(y)))))
        error = (score - y) / len(y)
        slope = np.bincount(index, error[own] * value, minlength=n_features) + RIDGE * w
        if len(swapped):
            moved = np.bincount(change_row, w[change_index] * change, minlength=len(swapped))
            slope += 2 * PENALTY / len(y) * np.bincount(change_index, moved[change_row] * change, minlength=n_features)
        slope = np.append(slope, error.sum())
        m, s = 0.9 * m + 0.1 * slope, 0.99 * s + 0.01 * slope * slope
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return w, _threshold(np.bincount(own, w[index] * value, minlength=len(y)), y, float(b))


def _threshold(raw: np.ndarray, y: np.ndarray, b: float) -> float:
    """The intercept that puts most labelled rows clearly on their side of 0.5: the penalty pulls all scores down.

    A row counts if its score keeps a distance of ``MARGIN``, so what the penalty levelled does not part the classes.
    Without both classes the fitted one stays.
    """
    toxic = np.sort(raw[y > 0])
    clean = np.sort(raw[y <= 0])
    if not len(toxic) or not len(clean):
        return b
    cuts = np.unique(raw)
    between = (cuts[1:] + cuts[:-1]) / 2
    if not len(between):
        return b
    right = len(toxic) - np.searchsorted(toxic, between + MARGIN) + np.searchsorted(clean, between - MARGIN, "right")
    best = np.flatnonzero(right == right.max())
    return -float(between[best[len(best) // 2]])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, groups=IDENTITY_TERMS) -> tuple[np.ndarray, np.ndarray, float]:
    """The sorted feature hashes, their weights and the intercept."""
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = marks.where(crc_mod("doc_id", 5) != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # At most ``sample`` rows of two numbers are broadcast.
    known = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id")
    # One text stands for an id, so there are no more rows than ids however often one is repeated.
    known = known.groupBy("doc_id", "toxic").agg(F.max("text").alias("text"))
    known = written(known.select("text", F.col("toxic").cast("int").alias("toxic")), "labelled")

    def counted(parts: list[np.ndarray]) -> dict:
        one, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *parts]), return_counts=True)
        return {"feature": one.view(np.int64), "n": counts}

    def text_frequencies(wanted: np.ndarray | None):
        def work(batch):
            parts, size = [], 0
            for _, _, data, offsets in textnum.slices(batch.column(0)):
                found, _ = features(data, offsets)
                rows, hashes = (np.concatenate(x) for x in zip(*found))
                if wanted is not None:
                    place = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
                    hit = wanted[place] == hashes
                    rows, hashes = rows[hit], hashes[hit]
                order = np.lexsort((rows, hashes))
                rows, hashes = rows[order], hashes[order]
                new = np.ones(len(rows), bool)
                new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
                parts.append(hashes[new])
                size += len(parts[-1])
                if size >= PART:
                    yield counted(parts)
                    parts, size = [], 0
            yield counted(parts)

        return work

    toxic_counts = by_batch(known.where("toxic = 1").select("text"), text_frequencies(None), "feature long, n long")
    toxic_counts = toxic_counts.groupBy("feature").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_TOXIC)
    toxic_counts = toxic_counts.orderBy(F.desc("n"), "feature").limit(4 * MAX_FEATURES).collect()
    totals = {r.toxic: r.n for r in known.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    prior = float(np.log((n_toxic + 0.5) / (n_clean + 10)))
    if not toxic_counts or not n_clean:
        return np.zeros(0, np.uint64), np.zeros(0), prior
    hashes = np.array([r.feature for r in toxic_counts], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    hashes, toxic_n = hashes[order], np.array([r.n for r in toxic_counts], float)[order]
    clean = by_batch(known.where("toxic = 0").select("text"), text_frequencies(hashes), "feature long, n long")
    clean_n = np.zeros(len(hashes))
    for r in clean.groupBy("feature").agg(F.sum("n").alias("n")).collect():
        clean_n[np.searchsorted(hashes, np.uint64(r.feature & 0xFFFFFFFFFFFFFFFF))] = r.n
    expected = (toxic_n + clean_n) * n_toxic / (n_toxic + n_clean)
    ratio = 2 * (toxic_n * np.log(toxic_n / expected) + clean_n * np.log(np.maximum(clean_n, 1e-9) / (toxic_n + clean_n - expected)))
    kept = np.flatnonzero((toxic_n > expected) & (ratio >= MIN_RATIO))
    kept = np.sort(kept[np.argsort(-ratio[kept], kind="stable")[:MAX_FEATURES]])
    chosen = hashes[kept]
    groups = (*groups, *mentioned_terms(known, n_toxic, n_clean))

    def rows_of(batch):
        texts = batch.column(0).to_pylist()
        labels = batch.column(1).to_pylist()
        out: dict[str, list] = {"label": labels, "i": [], "v": [], "si": [], "sv": []}
        other = [swap_terms(t or "", groups) for t in texts]
        for values, i, v in ((texts, "i", "v"), (other, "si", "sv")):
            for low, high, data, offsets in textnum.slices(pa.array(values, pa.string())):
                row, index, value = project(data, offsets, chosen)
                cut = np.searchsorted(row, np.arange(high - low + 1))
                for a, b in zip(cut[:-1], cut[1:]):
                    out[i].append(index[a:b])
                    out[v].append(value[a:b])
        for k, (a, b) in enumerate(zip(texts, other)):
            if (a or "") == b:
                out["si"][k] = out["sv"][k] = None
        return out

    schema = "label int, i array<long>, v array<double>, si array<long>, sv array<double>"
    rows = by_batch(known, rows_of, schema).collect()
    weights, intercept = fit(rows, len(chosen), prior)
    return chosen, weights, intercept


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, groups=IDENTITY_TERMS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``."""
    chosen, weights, intercept = train(docs, labels, sample, groups)
    return apply(docs.select("doc_id", "text"), chosen, weights, intercept).select(
        "doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def _scorer(docs: DataFrame, chosen: np.ndarray, weights: np.ndarray, intercept: float):
    """The scores of a column of texts; the model has at most ``MAX_FEATURES`` features."""
    sent = docs.sparkSession.sparkContext.broadcast((chosen, weights, intercept))

    def scores_of(texts: pa.Array) -> np.ndarray:
        chosen, weights, intercept = sent.value
        scores = [np.zeros(0)]
        for low, high, data, offsets in textnum.slices(texts):
            row, index, value = project(data, offsets, chosen)
            total = intercept + np.bincount(row, weights[index] * value, minlength=high - low)
            scores.append(1 / (1 + np.exp(-np.clip(total, -500, 500))))
        return np.concatenate(scores)

    return scores_of


def apply(docs: DataFrame, chosen: np.ndarray, weights: np.ndarray, intercept: float) -> DataFrame:
    """doc_id and score of every row."""
    scores_of = _scorer(docs, chosen, weights, intercept)
    return by_batch(docs.select("doc_id", "text"), lambda batch: {"doc_id": batch.column(0), "score": scores_of(batch.column(1))}, "doc_id long, score double")


def remove(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows not predicted toxic, with all their columns. Each row is judged by its own text, whatever its doc_id."""
    scores_of = _scorer(docs, *train(docs, labels))

    @F.arrow_udf("double")
    def score_of(texts: pa.Array) -> pa.Array:
        return pa.array(scores_of(texts))

    return docs.where(score_of("text") < 0.5)
