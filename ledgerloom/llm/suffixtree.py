"""Language-model scores by a probabilistic suffix tree.

Tokens are lower-cased words and one end per text. The tree's contexts are the strings of up to ``DEPTH``
words that occur at least ``MIN_COUNT`` times in the training texts, a fixed number at any size of the
corpus, and whose next-symbol distribution, by a likelihood test, diverges enough from that of their longest
kept suffix. A state's distribution is discounted by ``DISCOUNT`` for each stored symbol and the mass set
free goes to its suffix's distribution, down to the smoothed word frequencies, so it sums to one over the
training vocabulary and one unknown symbol. Each token is scored in the longest suffix state of what precedes it.

All counts are exact and cover all training texts, and no table of words, strings or states is ever brought
to the driver or broadcast: they grow with the corpus and stay in written tables, dealt to buckets
by a hash. The number of buckets grows with the tokens (``BUCKET_TOKENS``), so a bucket does not. Texts are
kept as slices of about ``SLICE_TOKENS`` tokens (one text at least). For each length a slice sends its
distinct strings whose two parts are stored to their buckets and gets back their counts; as a slice
asks once for a string, no string is a hot key. Then, length by length, stored strings meet the
probabilities of their suffixes and are gathered by context; a context's bucket holds its distinct stored
symbols. At last each slice asks once for every stored string that it scores with.

A bucket is a range of hashes, so the strings of a parcel are sorted and sent as differences, and numbers as byte
planes, whose zeros compress. Steps that texts take part in are done for a share of the slices
at a time (``ROUND_TOKENS``, ``ROUNDS`` shares at most), and what a step was the last to read is deleted.

Defined results: null texts are empty and consist of the end only. Repeated rows are counted and scored
row by row, rows that share a doc_id too. Without training
texts every probability is that of one unknown symbol. Other columns do not matter.
"""

from __future__ import annotations

import gc
import os
import pickle
import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import textnum
from ledgerloom.llm.common import by_batch, crc_mod, written
from ledgerloom.session import new_path

DEPTH = 3
MIN_COUNT = 3
DISCOUNT = 0.75
MIN_GAIN, MIN_DIVERGENCE = 3.0, 0.002
SLICE_TOKENS, BUCKET_TOKENS = 1 << 20, 1 << 21
ROUND_TOKENS, ROUNDS = 1 << 24, 3
END = np.uint64(0x9D39247E33776D41)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all rows, each row's end included, and where each row begins."""
    hashes, rows = textnum.words(data, offsets)
    rows = rows + np.arange(len(rows))
    out = np.full(rows[-1], END, np.uint64)
    is_word = np.ones(rows[-1], bool)
    is_word[rows[1:] - 1] = False
    out[is_word] = hashes
    return out, rows


def _place(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each key, or -1."""
    if not len(sorted_keys):
        return np.full(len(keys), -1, np.int64)
    place = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[place] == keys, place, -1)


class Tree:
    """The same tree held in memory, level by level: the plain form of what the tables below hold."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, n_tokens: int, n_words: int):
        self.words, self.n_tokens, self.n_words = words, n_tokens, n_words
        self.unit = (counts + 0.5) / (n_tokens + 0.5 * (n_words + 1))
        self.keys: list[np.ndarray] = []
        self.totals = [counts.astype(np.float64)]
        self.kept: list[np.ndarray] = []
        self.free: list[np.ndarray] = []
        self.suffix = [np.zeros(len(words), np.int64)]

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """A level: ``keys`` are (context number, word) as one number, sorted."""
        level, n = len(self.keys), max(1, len(self.words))
        context, word = keys // n, keys % n
        total = self.totals[level]
        used = np.bincount(context, counts - DISCOUNT, minlength=len(total))
        free = 1 - used / np.maximum(total, 1)
        below = self.probability(level, self.suffix[level][context], word)
        above = (counts - DISCOUNT) / np.maximum(total[context], 1) + free[context] * below
        stored = np.bincount(context, counts, minlength=len(total))
        gain = np.bincount(context, counts * np.log(above / below), minlength=len(total))
        gain += (total - stored) * np.log(np.maximum(free, 1e-12))
        self.kept.append((gain >= MIN_GAIN) & (gain >= MIN_DIVERGENCE * total))
        self.free.append(free)
        self.keys.append(keys)
        self.totals.append(counts.astype(np.float64))
        # The strings are the contexts of the next level; a string's suffix drops its first word.
        if level == 0:
            self.suffix.append(word)
        else:
            self.suffix.append(_place(self.keys[level - 1], self.suffix[level][context] * n + word))

    def probability(self, depth: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The probability of words after contexts of ``depth`` words (numbers of that level)."""
        if depth == 0:
            return self.unit[word]
        below = self.probability(depth - 1, self.suffix[depth - 1][context], word)
        entry = _place(self.keys[depth - 1], context * max(1, len(self.words)) + word)
        own = np.where(entry >= 0, self.totals[depth][entry] - DISCOUNT, 0) / np.maximum(self.totals[depth - 1][context], 1)
        return np.where(self.kept[depth - 1][context], own + self.free[depth - 1][context] * below, below)

    def walk(self, ids: np.ndarray, first: np.ndarray):
        """For each level: (context number before each token, string number with it), -1 if not stored.

        ``ids`` are word numbers or -1, ``first`` marks the first token of each text.
        """
        n = max(1, len(self.words))
        string = ids
        for keys in [*self.keys, None]:
            context = np.concatenate(([-1], string[:-1]))
            context[first] = -1
            if keys is None:
                yield context, None
                return
            string = np.full(len(ids), -1, np.int64)
            at = np.flatnonzero((context >= 0) & (ids >= 0))
            string[at] = _place(keys, context[at] * n + ids[at])
            yield context, string

    def score(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of each token's probability under the words alone and under the tree.

        For a word that is not stored both lack its own log10 probability, which is the same in both.
        """
        known = ids >= 0
        base = np.where(known, self.unit[ids] if len(self.unit) else 1.0, 1.0)
        p = base.copy()
        for level, (context, string) in enumerate(self.walk(ids, first)):
            if string is None:
                break
            at = np.flatnonzero((context >= 0) & self.kept[level][context] if len(self.kept[level]) else np.zeros(len(ids), bool))
            state, entry = context[at], string[at]
            own = np.where(entry >= 0, self.totals[level + 1][entry] - DISCOUNT if len(self.keys[level]) else 0.0, 0.0)
            p[at] = own / np.maximum(self.totals[level][state], 1) + self.free[level][state] * p[at]
        return np.log10(base), np.log10(p)


# Parcels: packed numbers sent to a slice or a bucket, with where they come from and what they are.
PARCEL = "to long, source long, kind int, data binary"
TEXTS, ASKED, COUNTED, ENTRIES, STRINGS, STATES, TOTALS, ANSWERS, MARKS, NUMBERS, AS_CONTEXT, FREE = range(12)


def _bytes(kinds: str, *columns: np.ndarray) -> bytes:
    """Columns of 8-byte numbers one after the other, each by byte planes; ``kinds`` has u, i or f for each, s for sorted hashes."""
    parts = [np.diff(c, prepend=np.uint64(0)) if kind == "s" else c for kind, c in zip(kinds, columns)]
    return b"".join(np.ascontiguousarray(np.ascontiguousarray(c).view(np.uint8).reshape(-1, 8).T).tobytes() for c in parts)


def _columns(raws: list[bytes], kinds: str) -> list[np.ndarray]:
    """The columns of several parcels."""
    found: list[list] = [[np.zeros(0, np.uint64)] for _ in kinds]
    for raw in raws:
        planes = np.frombuffer(raw, np.uint8).reshape(len(kinds), 8, -1)
        for kind, part, plane in zip(kinds, found, planes):
            values = np.ascontiguousarray(plane.T).view(np.uint64).ravel()
            part.append(np.cumsum(values, dtype=np.uint64) if kind == "s" else values)
    return [np.concatenate(part).view(f"{'u' if kind == 's' else kind}8") for kind, part in zip(kinds, found)]


def _by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Each bucket that has some of the sorted keys, with their range."""
    first = np.array([-(-(number << 64) // buckets) for number in range(1, buckets)], np.uint64)
    ends = [0, *np.searchsorted(keys, first).tolist(), len(keys)]
    for number, (low, high) in enumerate(zip(ends, ends[1:])):
        if low < high:
            yield number, slice(low, high)


def _dealt(source: int, kind: int, buckets: int, kinds: str, keys: np.ndarray, *columns: np.ndarray):
    """Parcels of the keys and further columns; ``kinds`` is of the latter."""
    columns = (keys, *columns)
    if (keys[1:] < keys[:-1]).any():
        order = np.argsort(keys, kind="stable")
        columns = [c[order] for c in columns]
    for number, at in _by_bucket(columns[0], buckets):
        yield number, source, kind, _bytes("s" + kinds, *(c[at] for c in columns))


def meet(parcels: list[DataFrame], work: Callable[[int, dict], Iterator[tuple]], schema: str = PARCEL) -> DataFrame:
    """``work`` on all parcels with the same receiver: (receiver, {kind: [(source, data)]}) to rows of the schema."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            # By source, so that the outcome does not depend on the order of arrival.
            for source, kind, data in zip(batch.column("source").to_pylist(), batch.column("kind").to_pylist(), batch.column("data").to_pylist()):
                held.setdefault(kind, []).append((source, data))
            batch = source = kind = data = None
        for found in held.values():
            found.sort()
        found = None
        for rows in work(key[0].as_py(), held):
            columns = zip(*(rows if isinstance(rows, list) else [rows]))
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
            rows = columns = None
            yield made
            made = None
        # What a receiver took is free for the next one and for other steps' workers.
        held.clear()
        textnum.give_back()

    return reduce(DataFrame.union, parcels).groupBy("to").applyInArrow(run, schema)


def sliced(docs: DataFrame) -> DataFrame:
    """The texts as slices, each under a number of its own."""

    def slice_of(parts: list[tuple]) -> dict:
        ids, held, hashes, sizes = zip(*parts)
        vocabulary, number, n = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        # Numbers by frequency and their bytes apart, so that they compress.
        order = np.argsort(-n, kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        packed = zlib.compress(rank[number].view(np.uint8).reshape(-1, 4).T.tobytes(), 1)
        texts = {"docs": [i for one in ids for i in one], "held": np.concatenate(held), "sizes": np.concatenate(sizes)}
        texts |= {"words": vocabulary[order], "ids": packed}
        name = int.from_bytes(os.urandom(8), "big") >> 1
        return {"to": [name], "source": [name], "kind": [TEXTS], "data": [pickle.dumps(texts, 5)]}

    def work(batch):
        parts, size = [], 0
        for low, high, data, offsets in textnum.slices(batch.column(2)):
            found, rows = tokens(data, offsets)
            held = np.array(batch.column(1)[low:high].to_pylist(), bool)
            parts.append((batch.column(0)[low:high].to_pylist(), held, found, np.diff(rows)))
            size += len(found)
            if size >= SLICE_TOKENS:
                yield slice_of(parts)
                parts, size = [], 0
        if parts:
            yield slice_of(parts)

    return by_batch(docs.select("doc_id", (crc_mod("doc_id", 5) == 1).alias("held_out"), "text"), work, PARCEL)


def _opened(held: dict) -> dict:
    """A slice: its texts, and for each token the length of the longest stored string that ends there, as far as known."""
    texts = pickle.loads(held[TEXTS][0][1])
    planes = np.frombuffer(zlib.decompress(texts["ids"]), np.uint8).reshape(4, -1)
    texts["ids"] = np.ascontiguousarray(planes.T).view(np.int32).ravel()
    if MARKS in held:
        texts["stored"] = np.frombuffer(zlib.decompress(held[MARKS][0][1]), np.int8).copy()
    return texts


def strings(texts: dict, length: int) -> list[np.ndarray]:
    """For each length the hashes of the strings that end at each token; those that would begin before the text mean nothing."""
    found = [texts["words"][texts["ids"]]]
    with np.errstate(over="ignore"):
        for n in range(2, length + 1):
            longer = np.zeros(len(found[0]), np.uint64)
            longer[1:] = textnum.mix64(found[-1][:-1] * np.uint64(textnum.MULTIPLIER) + found[0][1:] + np.uint64(n))
            found.append(longer)
    return found


def _before(texts: dict) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of the text before each token, and the longest stored string that ends just before it."""
    sizes, stored = texts["sizes"], texts["stored"]
    place = np.arange(len(stored)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return place, np.where(place > 0, np.concatenate(([0], stored[:-1])), 0)


def _candidates(texts: dict, length: int):
    """Strings of all lengths, the ends of those whose two parts are stored, these distinct and sorted, and their numbers and training counts."""
    found = strings(texts, length)
    train = ~np.repeat(texts["held"], texts["sizes"])
    if length == 1:
        at = np.arange(len(texts["ids"]))
        one, number = np.unique(texts["words"], return_inverse=True)
        number = number[texts["ids"]]
    else:
        at = np.flatnonzero((texts["stored"] == length - 1) & (_before(texts)[1] >= length - 1))
        one, number = np.unique(found[-1][at], return_inverse=True)
    return found, at, one, number, np.bincount(number, train[at], minlength=len(one)).astype(np.int64)


def _ask(length: int, buckets: int):
    def work(name: int, held: dict):
        _, _, one, _, n = _candidates(_opened(held), length)
        return _dealt(name, ASKED, buckets, "i", one, n)

    return work


def _count(bucket: int, held: dict):
    """The counts of all strings asked for; the first slice that asks for a string owns it and gets its count negated."""
    asked = held.pop(ASKED)
    # Columns of 8-byte numbers.
    sources, sizes = [source for source, _ in asked], [len(raw) // 16 for _, raw in asked]
    keys, counts = _columns([raw for _, raw in asked], "si")
    del asked
    _, first, number = np.unique(keys, return_index=True, return_inverse=True)
    n = np.bincount(number, counts).astype(np.int64)
    del keys, counts
    answer = n[number]
    answer[first] *= -1
    del first, number
    at = 0
    for source, size in zip(sources, sizes):
        # Signs apart, so that the bytes of small numbers are zeros.
        part = answer[at : at + size]
        yield source, bucket, COUNTED, _bytes("i", 2 * np.abs(part) + (part < 0))
        at += size
    yield -1, bucket, TOTALS, _bytes("ii", np.array([n.sum()]), np.array([(n > 0).sum()]))


def _scattered(keys: np.ndarray, answers: list[tuple[int, bytes]], buckets: int, kinds: str) -> list[np.ndarray]:
    """What the buckets answered, in the order of the sorted ``keys``."""
    raws = dict(answers)
    return _columns([raws[number] for number, _ in _by_bucket(keys, buckets)], kinds)


def _gather(length: int, depth: int, buckets: int, least: float, unit: Callable):
    """A slice takes the counts of a length, hands on the stored strings that it owns and asks for the next length."""

    def work(name: int, held: dict):
        texts = _opened(held)
        found, at, one, number, _ = _candidates(texts, length)
        (n,) = _scattered(one, held.pop(COUNTED, []), buckets, "i")
        n, own = n >> 1, (n & 1).astype(bool)
        stored = n >= least
        if length == 1:
            texts["stored"] = (stored & (n > 0))[number].astype(np.int8)
            yield name, name, NUMBERS, _bytes("i", n[np.searchsorted(one, texts["words"])])
            own &= stored & (n > 0)
            yield from _dealt(name, STRINGS, buckets, "if", one[own], n[own], unit(n[own]))
        else:
            texts["stored"][at[stored[number]]] = length
            some = np.zeros(len(one), np.int64)
            some[number] = at
            own &= stored
            end = some[own]
            yield from _dealt(name, ENTRIES, buckets, "uui", found[-2][end], found[-2][end - 1], one[own], n[own])
        yield name, name, MARKS, zlib.compress(texts["stored"].tobytes(), 1)
        if length <= depth:
            del found, at, one, number, n, own, stored
            _, _, one, _, n = _candidates(texts, length + 1)
            yield from _dealt(name, ASKED, buckets, "i", one, n)

    return work


def _below(buckets: int):
    """Stored strings meet the probabilities of their suffixes and go on to their contexts."""

    def work(bucket: int, held: dict):
        if ENTRIES not in held:
            return
        suffix, context, key, n = _columns([raw for _, raw in held[ENTRIES]], "suui")
        keys, _, p = _columns([raw for _, raw in held[STRINGS]], "sif")
        order = np.argsort(keys)
        below = p[order[np.searchsorted(keys, suffix, sorter=order)]]
        yield from _dealt(bucket, ENTRIES, buckets, "uif", context, key, n, below)

    return work


def _decide(buckets: int):
    """The contexts that become states, with the mass they set free, and the probability of each stored string's last symbol."""

    def work(bucket: int, held: dict):
        if ENTRIES not in held:
            return
        context, key, n, below = _columns([raw for _, raw in held[ENTRIES]], "suif")
        # Sums in one order, so that they come out the same each time.
        order = np.lexsort((key, context))
        context, key, n, below = context[order], key[order], n[order], below[order]
        keys, counts, _ = _columns([raw for _, raw in held[STRINGS]], "sif")
        order = np.argsort(keys)
        one, number = np.unique(context, return_inverse=True)
        total = counts[order[np.searchsorted(keys, one, sorter=order)]].astype(np.float64)
        free = 1 - np.bincount(number, n - DISCOUNT) / total
        above = (n - DISCOUNT) / total[number] + free[number] * below
        gain = np.bincount(number, n * np.log(above / below))
        gain += (total - np.bincount(number, n)) * np.log(np.maximum(free, 1e-12))
        kept = (gain >= MIN_GAIN) & (gain >= MIN_DIVERGENCE * total)
        yield bucket, bucket, STATES, _bytes("sf", one[kept], np.log10(free[kept]))
        yield from _dealt(bucket, STRINGS, buckets, "if", key, n, np.where(kept[number], above, below))

    return work


def _needs(texts: dict, depth: int):
    """(hash, ends, whether as a context) of the stored strings that score the tokens at the given places."""
    found, stored = strings(texts, depth + 1), texts["stored"]
    before = _before(texts)[1]
    for length in range(1, depth + 2):
        at = np.flatnonzero(stored == length)
        if length > 1:
            yield found[length - 1][at], at, False
        # Contexts as long as the stored string or longer do not have the token.
        at = np.flatnonzero((before >= length) & (np.maximum(stored, 1) <= length)) if length <= depth else at[:0]
        yield found[length - 1][at - 1], at, True


def _asked(needs: list[tuple], as_context: bool) -> np.ndarray:
    """The strings that are needed by themselves, or as contexts."""
    return np.concatenate([keys for keys, _, context in needs if context == as_context])


def _wanted(depth: int, buckets: int):
    def work(name: int, held: dict):
        needs = list(_needs(_opened(held), depth))
        for kind in (ASKED, AS_CONTEXT):
            yield from _dealt(name, kind, buckets, "", np.unique(_asked(needs, kind == AS_CONTEXT)))

    return work


def _answer(bucket: int, held: dict):
    """log10 of the probability of each string's last symbol, and of the mass that contexts set free as states."""
    for ask, kind, tables, columns in ((ASKED, ANSWERS, STRINGS, "sif"), (AS_CONTEXT, FREE, STATES, "sf")):
        names, *_, values = _columns([raw for _, raw in held.get(tables, [])], columns)
        order = np.argsort(names)
        names, values = names[order], np.append(values[order], 0.0)
        for source, raw in held.get(ask, []):
            place = _place(names, _columns([raw], "s")[0])
            if kind == ANSWERS:
                yield source, bucket, kind, _bytes("f", np.where(place >= 0, np.log10(values[place]), 0.0))
            else:
                # Most contexts are no states: which of them are, by bits, and then what those set free.
                bits = np.packbits(place >= 0)
                yield source, bucket, kind, len(place).to_bytes(8, "little") + bits.tobytes() + _bytes("f", values[place[place >= 0]])


def _freed(keys: np.ndarray, answers: list[tuple[int, bytes]], buckets: int) -> np.ndarray:
    """What the contexts set free, in the order of the sorted ``keys``."""
    out, raws = np.zeros(len(keys)), dict(answers)
    for number, at in _by_bucket(keys, buckets):
        raw = raws[number]
        n = int.from_bytes(raw[:8], "little")
        end = 8 + -(-n // 8)
        state = np.unpackbits(np.frombuffer(raw[8:end], np.uint8), count=n).astype(bool)
        out[at][state] = _columns([raw[end:]], "f")[0]
    return out


def _score(depth: int, buckets: int, n_tokens: int, unit: Callable):
    def work(name: int, held: dict):
        texts = _opened(held)
        (n,) = _columns([held[NUMBERS][0][1]], "i")
        needs = list(_needs(texts, depth))
        one, place = np.unique(_asked(needs, False), return_inverse=True)
        p = _scattered(one, held.pop(ANSWERS, []), buckets, "f")[0][place]
        one, place = np.unique(_asked(needs, True), return_inverse=True)
        free = _freed(one, held.pop(FREE, []), buckets)[place]
        base = np.log10(unit(n))[texts["ids"]]
        model = base.copy()
        for _, at, as_context in needs:
            if as_context:
                model[at] += free[: len(at)]
                free = free[len(at) :]
            else:
                # The value of the string takes the place of the word's alone; masses are added to either.
                model[at] += p[: len(at)] - base[at]
                p = p[len(at) :]
        sizes = texts["sizes"]
        starts = np.cumsum(sizes) - sizes
        sums = [np.add.reduceat(x, starts) for x in ((n > 0)[texts["ids"]].astype(np.int64), base, model)]
        yield list(zip(texts["docs"], texts["held"].tolist(), sizes.tolist(), sums[0].tolist(), [n_tokens] * len(sizes), sums[1].tolist(), sums[2].tolist()))

    return work


class Parcels:
    """Written parcels, read and deleted by their kind."""

    def __init__(self, frame: DataFrame, label: str):
        self.spark, self.path = frame.sparkSession, new_path(frame.sparkSession, label)
        frame.write.partitionBy("kind").parquet(self.path)

    def of(self, kind: int) -> DataFrame:
        rows = self.spark.read.schema(PARCEL).parquet(self.path).where(F.col("kind") == kind)
        return rows.select("to", "source", "kind", "data")

    def delete(self, *kinds: int) -> None:
        for kind in kinds:
            _delete(self.spark, f"{self.path}/kind={kind}")


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _settle(spark: SparkSession) -> None:
    """Asks the driver to collect frames out of use, so that Spark may delete their shuffles."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def score(docs: DataFrame, depth: int = DEPTH, p_min: float = 0.0, min_count: int = MIN_COUNT) -> DataFrame:
    """One row a document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Strings are stored from ``min_count`` occurrences; ``p_min`` asks for a share of the training tokens besides.
    """
    spark = docs.sparkSession
    texts = written(sliced(docs), "slices")

    def size_of(batch):
        return {"n": [int(pickle.loads(raw)["sizes"].sum()) for raw in batch.column(0).to_pylist()]}

    n_all = by_batch(texts.select("data"), size_of, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(8, -(-n_all // BUCKET_TOKENS))
    rounds = max(1, min(ROUNDS, n_all // ROUND_TOKENS))

    def share(parcels: list[DataFrame], number: int) -> list[DataFrame]:
        """The parcels for a round's slices."""
        return [rows.where(F.pmod("to", F.lit(rounds)) == number) for rows in parcels]

    def kind(parts: list[Parcels], number: int) -> list[DataFrame]:
        return [part.of(number) for part in parts]

    levels, states, marks = [], [], []
    asked = [meet([texts], _ask(1, buckets))]
    before: list[Parcels] = []
    for length in range(1, depth + 2):
        counted = Parcels(meet(asked, _count), "counts")
        del asked
        _settle(spark)
        for part in before:
            part.delete(ASKED)
        if length == 1:
            totals = _columns([bytes(r.data) for r in counted.of(TOTALS).select("data").collect()], "ii")
            n_tokens, n_words = (int(x.sum()) for x in totals)
            least, spread = max(min_count, p_min * n_tokens), n_tokens + 0.5 * (n_words + 1)

            def unit(n):
                return (n + 0.5) / spread

        gathered = []
        for number in range(rounds):
            met = meet(share([texts, *marks, counted.of(COUNTED)], number), _gather(length, depth, buckets, least, unit))
            gathered.append(Parcels(met, "gathered"))
            del met
            _settle(spark)
        counted.delete(COUNTED)
        for part in before:
            part.delete(MARKS)
        marks = kind(gathered, MARKS)
        if length == 1:
            levels.append(reduce(DataFrame.union, kind(gathered, STRINGS)))
            numbers = kind(gathered, NUMBERS)
        else:
            entries = meet([*kind(gathered, ENTRIES), levels[-1]], _below(buckets))
            decided = Parcels(meet([entries, levels[-1]], _decide(buckets)), "decided")
            levels.append(decided.of(STRINGS))
            states.append(decided.of(STATES))
            del entries
            _settle(spark)
            for part in gathered:
                part.delete(ENTRIES)
        asked, before = kind(gathered, ASKED), gathered
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    scored = []
    for number in range(rounds):
        mine = share([texts, *marks], number)
        answers = Parcels(meet([meet(mine, _wanted(depth, buckets)), *levels[1:], *states], _answer), "answers")
        _settle(spark)
        met = meet([*mine, *share(numbers, number), *kind([answers], ANSWERS), *kind([answers], FREE)], _score(depth, buckets, n_tokens, unit), schema)
        scored.append(written(met, "scores"))
        del met
        answers.delete(ANSWERS, FREE)
        _settle(spark)
    return reduce(DataFrame.union, scored)
