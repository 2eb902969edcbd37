"""Language by averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its subwords: byte n-grams (``GRAMS``) within words and their
borders, hashed into ``BUCKETS``. Embeddings and the softmax layer are trained together by stochastic
gradient descent in numpy on at most about ``SAMPLE`` documents, equally many of each language as far
as there are. A fifth of them is set aside to calibrate the softmax by a temperature and to find
the score from which on 99 of 100 answers are right; answers below it are marked as not accepted.

As mean and softmax layer are linear, a subword's part in the logits is one row of a bounded table,
which is what scoring sends to the executors.

Defined results: texts that are null or have no letter are ``und`` with score 0 and not accepted; a
null lang is never learned; if nothing was learned every text is ``und``. Ties go to the smaller name.
Other columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import textnum
from ledgerloom.llm.common import by_batch, crc_mod

GRAMS = (2, 3, 4)
BUCKETS = 1 << 14
DIMENSIONS = 16
SAMPLE = 3000
EPOCHS, RATE = 8, 4.0
UNKNOWN = "und"
# Fixed odd multipliers of the n-gram hash.
FACTORS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F)


def subwords(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every subword; each row is taken with a blank on either side."""
    n, rows = len(data), len(offsets) - 1
    row = np.repeat(np.arange(rows, dtype=np.int32), np.diff(offsets))
    text = np.full(n + rows + 1, 0x20, np.uint8)
    text[np.arange(n) + row + 1] = np.where(textnum.LETTER[data], textnum.LOWER[data], 0x20)
    owner = np.zeros(len(text), np.int32)
    owner[np.arange(n) + row + 1] = row
    inside = text != 0x20
    wide = text.astype(np.uint32)
    owners, buckets = [], []
    with np.errstate(over="ignore"):
        for size in GRAMS:
            m = len(text) - size + 1
            if m <= 0:
                continue
            good = inside[1 : m + 1].copy() if size > 2 else inside[:m] | inside[1 : m + 1]
            for j in range(2, size - 1):
                good &= inside[j : m + j]
            h = wide[:m] * np.uint32(FACTORS[0])
            for j in range(1, size):
                h += wide[j : m + j] * np.uint32(FACTORS[j])
            h ^= h >> np.uint32(15)
            h *= np.uint32(FACTORS[size - 1])
            at = np.flatnonzero(good)
            buckets.append((h[at] >> np.uint32(18)).astype(np.int32))
            owners.append(np.where(inside[at], owner[at], owner[np.minimum(at + 1, len(text) - 1)]))
    return np.concatenate(owners), np.concatenate(buckets)


def train(texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_langs: int) -> np.ndarray:
    """The share of each bucket in the logits, calibrated; inputs are (buckets, counts) of the texts."""
    random = np.random.default_rng(5)
    embedding = random.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer = np.zeros((DIMENSIONS, n_langs), np.float32)
    layer += random.normal(0, 0.1, layer.shape)
    weights = [(c / max(1, c.sum())).astype(np.float32) for _, c in texts]
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in random.permutation(len(texts)):
            at, w = texts[i][0], weights[i]
            mean = w @ embedding[at]
            logits = mean @ layer
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = layer @ p
            layer -= rate * np.outer(mean, p)
            embedding[at] -= rate * np.outer(w, back)
    return embedding @ layer


def calibrate(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """The temperature of least log loss and the lowest score that is right 99 of 100 times."""
    best = (np.inf, 1.0)
    for t in np.geomspace(0.05, 5, 60):
        z = logits / t
        z = z - z.max(axis=1, keepdims=True)
        loss = float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(labels)), labels]).mean())
        best = min(best, (loss, t))
    z = logits / best[1]
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    top = p.max(axis=1)
    order = np.argsort(-top)
    right = np.cumsum(p.argmax(axis=1)[order] == labels[order]) / np.arange(1, len(order) + 1)
    # Equal scores are accepted together or not at all.
    ends = np.append(top[order][1:] != top[order][:-1], True)
    good = np.flatnonzero((right >= 0.99) & ends)
    return best[1], float(top[order[good[-1]]]) if len(good) else 1.0


def _sampled(docs: DataFrame, sample: int) -> DataFrame:
    """Training documents: about ``sample``, of each language a share of the ids chosen by hash, one row an id."""
    known = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_mod("doc_id", 3) != 1))
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count_distinct(F.coalesce("doc_id", F.lit(-1))).alias("n")).orderBy(F.desc("n"), "lang").limit(sample).collect()}
    each = sample / max(1, len(sizes))
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, each / n))]) if sizes else None
    if share is None:
        return known.limit(0)
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))
    return chosen.groupBy("doc_id", "lang").agg(F.max("text").alias("text"))


def learn(docs: DataFrame, sample: int = SAMPLE):
    """Language names, the calibrated table of logits and the accepted score."""

    def counted(batch):
        out: dict[str, list] = {"lang": batch.column(1), "at": [], "n": []}
        for low, high, data, offsets in textnum.slices(batch.column(0)):
            row, bucket = subwords(data, offsets)
            pairs, counts = np.unique(row.astype(np.int64) * BUCKETS + bucket, return_counts=True)
            cut = np.searchsorted(pairs, np.arange(high - low + 1) * BUCKETS)
            for a, b in zip(cut[:-1], cut[1:]):
                out["at"].append((pairs[a:b] % BUCKETS).astype(np.uint16).tobytes())
                out["n"].append(counts[a:b].astype(np.uint32).tobytes())
        return out

    rows = by_batch(_sampled(docs, sample).select("text", "lang"), counted, "lang string, at binary, n binary").collect()
    rows = [r for r in rows if len(r.at)]
    names = sorted({r.lang for r in rows})
    if not names:
        return names, np.zeros((BUCKETS, 0), np.float32), 1.0
    rows.sort(key=lambda r: (r.lang, bytes(r.at), bytes(r.n)))
    texts = [(np.frombuffer(r.at, np.uint16).astype(np.int64), np.frombuffer(r.n, np.uint32)) for r in rows]
    labels = np.array([names.index(r.lang) for r in rows])
    aside = np.random.default_rng(3).random(len(rows)) < 0.2
    if aside.all() or not aside.any():
        aside = np.arange(len(rows)) % 2 == 1 if len(rows) > 1 else np.zeros(1, bool)
    table = train([t for t, a in zip(texts, aside) if not a], labels[~aside], len(names))
    checked = texts if not aside.any() else [t for t, a in zip(texts, aside) if a]
    logits = np.stack([(n / n.sum()) @ table[at] for at, n in checked])
    temperature, accepted = calibrate(logits, labels[aside] if aside.any() else labels)
    return names, (table / temperature).astype(np.float32), accepted


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score and accepted of every row."""
    names, table, accepted = learn(docs, sample)
    sent = docs.sparkSession.sparkContext.broadcast((names, [np.ascontiguousarray(table[:, i]) for i in range(table.shape[1])]))

    def work(batch):
        names, columns = sent.value
        langs, scores = [], []
        column = batch.column(1).fill_null("")
        for low, high, data, offsets in textnum.slices(column):
            rows = high - low
            letters = np.add.reduceat(np.append(textnum.LETTER[data] & (data < 0x80), False).astype(np.int64), offsets[:-1])
            letters[np.diff(offsets) == 0] = 0
            some = letters > 0
            for i in np.flatnonzero(~some & (np.diff(offsets) > 0)):
                some[i] = any(c.isalpha() for c in column[low + int(i)].as_py())
            if not names:
                langs += [UNKNOWN] * rows
                scores.append(np.zeros(rows))
                continue
            row, bucket = subwords(data, offsets)
            n = np.maximum(1, np.bincount(row, minlength=rows))
            z = np.stack([np.bincount(row, c[bucket], minlength=rows) / n for c in columns], axis=1)
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            best = p.argmax(axis=1)
            langs += [names[b] if ok else UNKNOWN for b, ok in zip(best, some)]
            scores.append(np.where(some, p[np.arange(rows), best], 0.0))
        return {"doc_id": batch.column(0), "lang_pred": langs, "score": np.concatenate(scores)} if scores else None

    found = by_batch(docs.select("doc_id", "text"), work, "doc_id long, lang_pred string, score double")
    sure = (F.col("score") >= accepted) & (F.col("lang_pred") != UNKNOWN)
    return found.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", sure.alias("accepted"))
