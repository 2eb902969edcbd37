"""Packing documents into sequences by vector best fit.

A document is its token ids and an end id; documents longer than a sequence are cut into full pieces and
a last one. A sequence has three capacities: tokens, number of documents and attention cost (the sum of
squared lengths). Pieces go longest first, each to the open sequence with the best score among those
where it fits under every constraint: the largest weighted dot product of the piece's needs with what the
sequence has left (``rule="dot"``), or the smallest weighted norm of what would be left
(``rule="norm"``, the default). Where none fits a new sequence is opened.

All needs depend on the length alone, so the plan is made from the number of pieces of each length,
at most as many numbers as a sequence has tokens whatever the size of the corpus: sequences in the same
state are kept as one group with a count, and a step moves as many of a group as it takes. The plan says
for every length which run of pieces goes where. Pieces are numbered within their length by counting per
task first and adding up the counts, so neither documents nor a hot length pass through one task.

Defined results: a null text is empty and an empty text is the end id alone; a null doc_id or a repeated
one is packed row by row like any other; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ledgerloom.llm import textnum
from ledgerloom.llm.common import written

LENGTH = 2048
MEMO_WORDS = 700_000
SPECIAL = re.compile(rb"<\|")
# Lower-case letters of Latin-1 with ASCII marks after them (no apostrophe), and the letters by which byte-level vocabularies write bytes: printable
# ones stand for themselves, the others are numbered from 256 on in order.
PLAIN = re.compile("([a-z\u00df-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\\[-`{-~]*)")
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    """The array with room for ``size`` entries at least."""
    while len(array) < size:
        array = np.append(array, np.zeros(len(array), array.dtype))
    return array


class WordTokenizer:
    """Token ids of whole texts through a tokenizer that drops white space, word by word.

    Every word (split at 0x20, 0x09-0x0D, a final point or comma after an ASCII letter apart) is encoded
    once and remembered, up to ``MEMO_WORDS`` words; pieces of such a tokenizer never span white space.
    Words are kept in flat arrays and found by a hash; the bytes of each occurrence are compared, and words
    that share a hash with another one are kept by themselves.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    @classmethod
    def shared(cls, path: str) -> "WordTokenizer":
        """The tokenizer of this worker process; it is kept between tasks."""
        store = textnum.process_store()
        if store.get("tokenizer_path") != path:
            store["tokenizer"], store["tokenizer_path"] = cls(path), path
        return store["tokenizer"]

    def clear(self) -> None:
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.clashes: dict[bytes, int] = {}
        self.count = 0
        self.pool, self.ends = np.zeros(1 << 16, np.uint32), np.zeros(1 << 12, np.int64)
        self.letters, self.letter_ends = np.zeros(1 << 16, np.uint8), np.zeros(1 << 12, np.int64)
        self.learn([b".", b","])

    def learn(self, words: list[bytes]) -> None:
        """Encodes words not yet known and adds their ids and bytes to the pools.

        Words of Latin letters are one piece that normalisation only lower-cases, and ASCII marks
        behind them are another, so the merges alone give their ids; all others take the
        tokenizer's full course.
        """
        ids, merge = [], self.tokenizer.model.tokenize
        for word in words:
            text = word.decode()
            plain = PLAIN.fullmatch(text.lower())
            if plain:
                letters, marks = plain.groups()
                found = merge(letters.encode().decode("latin-1").translate(BYTE_LETTERS))
                ids.append([token.id for token in (found + merge(marks) if marks else found)])
            else:
                ids.append(self.tokenizer.encode(text, add_special_tokens=False).ids)
        n, after = self.count, self.count + len(words)
        values = np.fromiter(chain.from_iterable(ids), np.uint32)
        for parts, raw, pool, ends in ((ids, values, "pool", "ends"), (words, np.frombuffer(b"".join(words), np.uint8), "letters", "letter_ends")):
            place = _grown(getattr(self, ends), after + 1)
            place[n + 1 : after + 1] = place[n] + np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
            room = _grown(getattr(self, pool), int(place[after]))
            room[place[n] : place[after]] = raw
            setattr(self, ends, place)
            setattr(self, pool, room)
        self.count = after

    def numbered(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The numbers of the words at the given places; new ones are learnt."""
        if self.count > MEMO_WORDS:
            self.clear()
        if not len(starts):
            return np.zeros(0, np.int64)
        one, at, which = np.unique(textnum.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, one)
        new = np.ones(len(one), bool)
        inside = place < len(self.hashes)
        new[inside] = self.hashes[place[inside]] != one[inside]
        if new.any():
            fresh = self.count + np.arange(np.count_nonzero(new), dtype=np.int32)
            self.learn([data[a:b].tobytes() for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist())])
            self.hashes = np.insert(self.hashes, place[new], one[new])
            self.numbers = np.insert(self.numbers, place[new], fresh)
            place += np.cumsum(new) - new
        number = self.numbers[place][which].astype(np.int64)
        sizes = ends - starts
        same = sizes == self.letter_ends[number + 1] - self.letter_ends[number]
        alike = np.flatnonzero(same)
        if len(alike):
            length = sizes[alike]
            first = np.cumsum(length) - length
            step = np.arange(int(length.sum()))
            mine = data[step + np.repeat(starts[alike] - first, length)]
            kept = self.letters[step + np.repeat(self.letter_ends[number[alike]] - first, length)]
            same[alike] = np.logical_and.reduceat(mine == kept, first)
        for i in np.flatnonzero(~same).tolist():
            word = data[starts[i] : ends[i]].tobytes()
            if word not in self.clashes:
                self.clashes[word] = self.count
                self.learn([word])
            number[i] = self.clashes[word]
        return number

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows one after another, and where each row's begin (one entry more)."""
        if not SPECIAL.search(data.tobytes()):
            data = textnum.LOWER[data]
        starts, ends, first = textnum.word_bounds(data, offsets)
        last, before = data[ends - 1] if len(ends) else data[:0], data[np.maximum(ends - 2, 0)] if len(ends) else data[:0]
        ascii_letter = textnum.LETTER[before] & (before < 0x80) & (ends - starts > 1)
        mark = np.where(ascii_letter & (last == 0x2E), 1, np.where(ascii_letter & (last == 0x2C), 2, 0))
        number = self.numbered(data, starts, ends - (mark > 0))
        # Each word is followed by its point or comma, or by nothing.
        number = np.stack([number, mark - 1], axis=1).ravel()
        from_ = np.where(number >= 0, self.ends[number], 0)
        count = np.where(number >= 0, self.ends[number + 1] - from_, 0)
        place = np.concatenate(([0], np.cumsum(count)))
        ids = self.pool[np.arange(place[-1]) + np.repeat(from_ - place[:-1], count)]
        return ids, place[2 * first]


def pieces(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, and its place among equal lengths.

    The place is (part, nth): the nth piece of its length in task ``part``. ``ids`` has the ids.
    """

    def run(batches):
        tokenizer = WordTokenizer.shared(tokenizer_path)
        seen: dict[int, int] = defaultdict(int)
        part = TaskContext.get().partitionId()
        for batch in batches:
            for low, high, data, offsets in textnum.slices(batch.column(1)):
                ids, place = tokenizer.encode(data, offsets)
                rows = defaultdict(list)
                doc_ids = batch.column(0).slice(low, high - low).to_pylist()
                for doc_id, a, b in zip(doc_ids, place[:-1].tolist(), place[1:].tolist()):
                    own = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
                    for piece, start in enumerate(range(0, len(own), length)):
                        raw = own[start : start + length].tobytes()
                        size = len(raw) // 4
                        for name, value in (("doc_id", doc_id), ("piece", piece), ("start", start), ("length", size), ("ids_crc32", zlib.crc32(raw)), ("part", part), ("nth", seen[size])):
                            rows[name].append(value)
                        seen[size] += 1
                yield pa.RecordBatch.from_pydict({f: pa.array(rows[f], t) for f, t in fields})
            batch = data = offsets = ids = place = own = rows = None
        textnum.give_back()

    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int32()), ("nth", pa.int64())]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def plan(counts: dict[int, int], length: int, max_docs: int, max_cost: int, rule: str = "norm", weights=(1.0, 1.0, 1.0)) -> list[tuple]:
    """Runs (length, first place, end place, first sequence, pieces a sequence, offset of the first).

    ``counts`` has the number of pieces of each length. Pieces ``first + k * per + j`` of a run go to
    sequence ``base + k`` at ``offset + j * length``.
    """
    limits = np.array([length, max_docs, max_cost], float)
    scale = np.array(weights, float)
    # A group of sequences alike: what is left, how many, and their numbers as (base, count) spans.
    left: list[tuple[int, int, int]] = []
    spans: list[list[tuple[int, int]]] = []
    index: dict[tuple[int, int, int], int] = {}
    runs, opened = [], 0

    def put(state: tuple[int, int, int], span: list[tuple[int, int]]) -> None:
        if state not in index:
            index[state] = len(left)
            left.append(state)
            spans.append([])
        spans[index[state]] += span

    for size in sorted(counts, reverse=True):
        todo, place = counts[size], 0
        need = np.array([size, 1, size * size], float)
        while todo:
            live = [i for i, s in enumerate(spans) if s]
            fits = live and (np.array([left[i] for i in live], float) >= need).all(axis=1)
            if not live or not fits.any():
                most = min(length // size, max_docs, max_cost // (size * size))
                per = most if rule == "norm" else 1
                if not most:
                    raise ValueError(f"a piece of {size} tokens exceeds a sequence's capacities")
                put((length, max_docs, max_cost), [(opened, -(-todo // per))])
                opened += -(-todo // per)
                continue
            rest = np.array([left[i] for i in live], float)
            if rule == "dot":
                score = -((rest / limits) * (need / limits) * scale).sum(axis=1)
            else:
                score = ((((rest - need) / limits) ** 2) * scale).sum(axis=1)
            group = live[int(np.where(fits, score, np.inf).argmin())]
            state = left[group]
            # As long as it fits, the sequence just served is the fullest and is served again.
            per = min(state[0] // size, state[1], state[2] // (size * size)) if rule == "norm" else 1
            mine = spans[group]
            spans[group] = []
            moved, other = [], []
            for base, n in mine:
                k = min(n, todo // per)
                if k:
                    runs.append((size, place, place + k * per, base, per, length - state[0]))
                    moved.append((base, k))
                    todo -= k * per
                    place += k * per
                if k < n:
                    other.append((base + k, n - k))
            if moved:
                put((state[0] - per * size, state[1] - per, state[2] - per * size * size), moved)
            if other:
                put(state, other)
            if not moved:
                # Fewer pieces than one sequence takes: the last ones.
                base, n = spans[index[state]].pop()
                runs.append((size, place, place + todo, base, todo, length - state[0]))
                put((state[0] - todo * size, state[1] - todo, state[2] - todo * size * size), [(base, 1)])
                if n > 1:
                    put(state, [(base + 1, n - 1)])
                todo = 0
        live = [i for i, s in enumerate(spans) if s and left[i][0] and left[i][1] and left[i][2]]
        left[:], spans[:] = [left[i] for i in live], [spans[i] for i in live]
        index.clear()
        index.update({s: i for i, s in enumerate(left)})
    return runs


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, max_docs: int | None = None, max_cost: int | None = None, rule: str = "norm") -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset."""
    max_docs, max_cost = max_docs or length, max_cost or length * length
    cut = written(pieces(docs, tokenizer_path, length), "pieces")
    counted = written(cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "counts")
    totals = {r.length: r.n for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = plan(totals, length, max_docs, max_cost, rule)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counted.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    placed = cut.join(shift, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("shift") + F.col("nth")).alias("place")
    )
    table = np.array(sorted(runs), np.int64).reshape(-1, 6)
    # The plan's size depends on the sequence length only.
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def assign(batches):
        table = sent.value
        # Lengths and places in one number, so a run is found by one search.
        keys = (table[:, 0] << 40) + table[:, 1]
        for batch in batches:
            size = batch.column(3).to_numpy()
            place = batch.column(5).to_numpy()
            run = table[np.searchsorted(keys, (size << 40) + place, "right") - 1]
            nth = place - run[:, 1]
            sequence = run[:, 3] + nth // run[:, 4]
            offset = run[:, 5] + nth % run[:, 4] * size
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return placed.mapInArrow(assign, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
