"""Alignment of two tokenizers over the same texts, by lockstep merging of their token ends.

A text with a blank in front is cut by tokenizer A (byte-level merges) and by tokenizer B (merge-type pieces,
``sentencepieces``). Where the bytes of a document's A tokens and of its B tokens both are the text's, the ends
of both are two rising sequences over the same bytes. Equal ends are cuts; they part the tokens into
groups, and the two tokens that end there are a link.

The merge is vectorised over many documents at once, ``PART_BYTES`` of text or one document: a state vector holds an A pointer and a B pointer
for every run, a step compares the ends under all pointers at once, emits a link and a cut where they are
equal, moves on the pointer with the smaller end (both where equal), and runs that reached their ends leave the
vector. A merge of rising sequences can be begun at any value, so a document with many tokens is several
runs, one for every ``RUN`` of its A tokens, and the number of steps does not depend on the longest document.

How often two ids are linked in the whole corpus is counted in Spark. A task sends for every block of documents
(``BLOCK_LINKS`` links or one slice) each distinct pair of ids once with its count; the counts are summed by
pair, the highest for each B id found, and sent back to the blocks that asked, in which the documents'
links are kept as positions in the block's list of pairs. So a frequent pair travels once a block, not once
an occurrence, and no document's links are gathered with another block's.

Defined results: null and empty texts, and texts whose bytes one of the tokenizers does not give back (B reads
U+2581 as a blank), have no tokens: zeros and the empty string. Special tokens' names in texts are plain
text. Rows that repeat a doc_id, null ids and extra columns are rows like any other. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import textnum
from ledgerloom.llm.common import written
from ledgerloom.llm.sentencepieces import PieceModel, slice_rows, text_slices

RUN = 256
BLOCK_LINKS = 1_000_000
# Texts that are aligned at once: the arrays of their tokens take a hundred times as much.
PART_BYTES = 1 << 19
# Words and segments that a worker remembers, each; an executor has a worker with both tokenizers on every core.
MEMO_CHUNKS = 200_000
# A word of Latin letters, with a mark behind it or not: one or two pretokens, to which the merges alone give the ids.
PLAIN = re.compile("( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\\[-`{-~]?)")


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves,
    the others are numbered from 256 on in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """A byte-level tokenizer's ids, word by word; a word is encoded once and remembered.

    In byte-level cutting a single blank between two characters that are not white begins a new word, and a
    single line end between such is one by itself, whatever is around them; so texts are parted there and equal
    parts have equal ids. Only printable ASCII and the letters of two bytes behind Latin-1's marks, none of which
    is white, count as such characters here.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters, names = byte_letters(), self.tokenizer.get_vocab(with_added_tokens=True)
        self.surface = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.surface[i] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
        self.letter_of = {b: c for c, b in letters.items()}
        self.ends_word = np.isin(np.arange(256), np.frombuffer(b".,;:!?", np.uint8))
        # Words' ids are the same few objects over and over: new ones would take more than the tuples.
        self.numbers = list(range(len(self.surface)))
        self.memo: dict[str, tuple[int, ...]] = {}
        # Words whose ids do not give their bytes again.
        self.lossy: set[str] = set()

    @classmethod
    def shared(cls, path: str) -> "ByteLevel":
        """The tokenizer of this worker process; it is kept between tasks."""
        store = textnum.process_store()
        if store.get("byte_level_path") != path:
            store["byte_level"], store["byte_level_path"] = cls(path), path
        return store["byte_level"]

    def _learn(self, words: list[str]) -> None:
        letters, merge, others, number = self.letter_of, self.tokenizer.model.tokenize, [], self.numbers.__getitem__
        for word in words:
            plain = PLAIN.fullmatch(word)
            if not plain:
                others.append(word)
                continue
            body, mark = plain.groups()
            found = merge(body.encode().decode("latin-1").translate(letters))
            self.memo[word] = tuple([number(token.id) for token in (found + merge(mark) if mark else found)])
        for low in range(0, len(others), 10_000):
            some = others[low : low + 10_000]
            for word, one in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                self.memo[word] = tuple(map(number, one.ids))
        self.lossy.update(w for w in words if b"".join(map(self.surface.__getitem__, self.memo[w])) != w.encode())

    def _words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, pa.DictionaryArray]:
        """Where the words of all texts with a blank in front begin and end, where each text's end, and the words."""
        data = (" " + " ".join(texts)).encode()
        raw = np.frombuffer(data, np.uint8)
        sizes = np.fromiter((len(text.encode()) + 1 for text in texts), np.int64, len(texts))
        text_ends = np.cumsum(sizes)
        mark, lead = (raw > 0x20) & (raw < 0x7F), (raw >= 0xC3) & (raw < 0xE0)
        ends_solid, begins_solid = mark.copy(), mark | lead
        ends_solid[1:] |= lead[:-1]
        between = ends_solid[:-2] & begins_solid[2:]
        line_end = between & (raw[1:-1] == 0x0A)
        ascii_letter = textnum.LETTER & (np.arange(256) < 0x80)
        first = np.zeros(len(raw) + 1, bool)
        first[1 : len(raw) - 1] = (between & (raw[1:-1] == 0x20)) | line_end
        first[2 : len(raw)] |= line_end
        # A mark behind a letter begins a pretoken, an apostrophe aside.
        first[1 : len(raw)] |= self.ends_word[raw[1:]] & ascii_letter[raw[:-1]]
        first[0] = True
        first[text_ends] = True
        cuts = np.flatnonzero(first)
        words = pa.Array.from_buffers(pa.string(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int32).tobytes()), pa.py_buffer(data)])
        return cuts, text_ends, words.dictionary_encode()

    def encode_exact(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all texts with a blank in front, where each text's end, and whether they have its bytes."""
        cuts, text_ends, coded = self._words(texts)
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.memo) > MEMO_CHUNKS:
            # What these texts use stays.
            self.memo = {name: self.memo[name] for name in names if name in self.memo}
            self.lossy.intersection_update(self.memo)
        self._learn([name for name in names if name not in self.memo])
        found = list(map(self.memo.__getitem__, names))
        count = np.fromiter(map(len, found), np.int64, len(found))
        pool = np.fromiter(chain.from_iterable(found), np.int32, int(count.sum()))
        start, which = np.cumsum(count) - count, coded.indices.to_numpy()
        runs = count[which]
        place = np.concatenate(([0], np.cumsum(runs)))
        ids = pool[np.arange(place[-1]) + np.repeat(start[which] - place[:-1], runs)]
        text_cuts = np.searchsorted(cuts, text_ends)
        lost = np.fromiter(map(self.lossy.__contains__, names), bool, len(names))[which]
        faithful = np.diff(np.concatenate(([0], np.cumsum(lost)))[np.concatenate(([0], text_cuts))]) == 0
        return ids, place[text_cuts], faithful


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the A and B tokens that end together, over all documents.

    ``ends_a`` and ``ends_b`` are byte ends, rising over the documents laid one after another; ``first_a`` and
    ``first_b`` are the documents' first tokens, one entry more than documents.
    """
    # Runs: every document's A tokens in stretches, and the B tokens that end within a stretch's bytes.
    counts = np.diff(first_a)
    stretches = -(-counts // run)
    nth = np.arange(stretches.sum()) - np.repeat(np.cumsum(stretches) - stretches, stretches)
    a = np.repeat(first_a[:-1], stretches) + nth * run
    a_stop = np.minimum(a + run, np.repeat(first_a[1:], stretches))
    last_end = ends_a[a_stop - 1] if len(a) else a
    b_stop = np.searchsorted(ends_b, last_end, "right")
    before = np.where(a > 0, ends_a[np.maximum(a - 1, 0)], 0) if len(a) else a
    b = np.searchsorted(ends_b, before, "right")
    links_a, links_b = [], []
    while len(a):
        going = (a < a_stop) & (b < b_stop)
        if not going.all():
            a, b, a_stop, b_stop = a[going], b[going], a_stop[going], b_stop[going]
            if not len(a):
                break
        end_a, end_b = ends_a[a], ends_b[b]
        equal = end_a == end_b
        links_a.append(a[equal])
        links_b.append(b[equal])
        step_a, step_b = end_a <= end_b, end_b <= end_a
        a, b = a + step_a, b + step_b
    if not links_a:
        none = np.zeros(0, np.int64)
        return none, none
    found = np.concatenate(links_a)
    order = np.argsort(found)
    return found[order], np.concatenate(links_b)[order]


class Aligner:
    """Tokens, cuts and links of the texts of a slice."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel.shared(path_a), PieceModel.shared(path_b)
        self.size_a = np.fromiter(map(len, self.a.surface), np.int64, len(self.a.surface))
        self.size_b = np.fromiter(map(len, self.b.inner), np.int64, len(self.b.inner))
        # An id with what follows it in a group list: "," within a side, "|" behind the A side, ";" behind the group.
        self.written = pa.array([f"{i}{mark}" for i in range(max(len(self.a.surface), len(self.b.inner))) for mark in ",|;"])

    @classmethod
    def shared(cls, path_a: str, path_b: str) -> "Aligner":
        store = textnum.process_store()
        if store.get("aligner_paths") != (path_a, path_b):
            store["aligner"], store["aligner_paths"] = cls(path_a, path_b), (path_a, path_b)
        return store["aligner"]

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The ids of both sides and the number of each text's; none where a side does not give the text's bytes."""
        sides = [self.a.encode_exact(texts), self.b.encode_exact(texts, MEMO_CHUNKS)]
        good = sides[0][2] & sides[1][2]
        found = []
        for ids, ends, _ in sides:
            counts = np.diff(np.concatenate(([0], ends)))
            found.append((ids if good.all() else ids[np.repeat(good, counts)], np.where(good, counts, 0)))
        return found[0][0].astype(np.int64), found[1][0].astype(np.int64), found[0][1], found[1][1]

    def align(self, texts: list[str]) -> dict:
        """Per text n_a, n_b, n_groups, n_links, groups; over all: the links' pair codes, and where each text's end."""
        flat_a, flat_b, n_a, n_b = self.tokens(texts)
        first_a, first_b = np.concatenate(([0], np.cumsum(n_a))), np.concatenate(([0], np.cumsum(n_b)))
        link_a, link_b = lockstep(np.cumsum(self.size_a[flat_a]), np.cumsum(self.size_b[flat_b]), first_a, first_b)
        place = np.searchsorted(link_a, first_a)
        return {
            "n_a": n_a, "n_b": n_b, "n_groups": np.diff(place), "n_links": np.diff(place), "place": place,
            "codes": (flat_b[link_b] << 32) + flat_a[link_a],
            "groups": self._groups(flat_a, flat_b, link_a, link_b, first_a + first_b),
        }

    def _groups(self, flat_a, flat_b, link_a, link_b, first) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of every text, without the last mark."""
        # A token comes behind all tokens of earlier groups, B tokens behind their group's A tokens.
        group_a = np.searchsorted(link_a, np.arange(len(flat_a)))
        group_b = np.searchsorted(link_b, np.arange(len(flat_b)))
        at_a = np.arange(len(flat_a)) + np.concatenate(([0], link_b + 1))[group_a]
        at_b = np.arange(len(flat_b)) + (link_a + 1)[group_b]
        mark_a, mark_b = np.zeros(len(flat_a), np.int64), np.zeros(len(flat_b), np.int64)
        mark_a[link_a], mark_b[link_b] = 1, 2
        order = np.zeros(len(flat_a) + len(flat_b), np.int64)
        order[at_a], order[at_b] = flat_a * 3 + mark_a, flat_b * 3 + mark_b
        words = pa.ListArray.from_arrays(pa.array(first, pa.int32()), self.written.take(pa.array(order)))
        return [joined[:-1] for joined in pc.binary_join(words, "").to_pylist()]

    def align_in_parts(self, column: pa.Array, keep_groups: bool) -> dict:
        """The same of a slice's texts with the groups' digests, a part of the texts at a time; the groups themselves if asked for."""
        names = ("n_a", "n_b", "n_groups", "n_links", "codes")
        parts: dict[str, list[np.ndarray]] = {name: [] for name in names}
        groups, digests = [], []
        for _, texts in text_slices(column, PART_BYTES):
            found = self.align(texts)
            for name in names:
                parts[name].append(found[name])
            digests += [hashlib.sha256(one.encode()).hexdigest() if one else "" for one in found["groups"]]
            groups += found["groups"] if keep_groups else [None] * len(texts)
        whole = {name: np.concatenate(some) for name, some in parts.items()}
        return whole | {"place": np.concatenate(([0], np.cumsum(whole["n_links"]))), "groups": groups, "groups_sha256": digests}


def aligned(docs: DataFrame, path_a: str, path_b: str, keep_groups: bool = False) -> DataFrame:
    """One row a document, and one a block with its distinct pairs.

    A document's row has its counts, digest (and with ``keep_groups`` the list itself) and its links as
    positions (32-bit numbers) in its block's list of pairs; a long document's links may be spread over rows of
    several blocks, of which only the first has the counts. A block's row has ``pairs`` and ``times``.
    """
    schema = pa.schema(
        [("block", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")),
         ("groups_sha256", pa.string()), ("groups", pa.string()), ("links", pa.binary()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))]
    )

    def run(batches):
        aligner = Aligner.shared(path_a, path_b)
        # Blocks and rows are numbered within the task; the written table fixes them.
        block = row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for low, high in slice_rows(batch.column(1)):
                found = aligner.align_in_parts(batch.column(1).slice(low, high - low), keep_groups)
                doc_ids = batch.column(0).slice(low, high - low).to_pylist()
                place, n = found["place"], len(found["codes"])
                for start in range(0, max(n, 1), BLOCK_LINKS):
                    stop = min(start + BLOCK_LINKS, n)
                    pairs, at, times = np.unique(found["codes"][start:stop], return_inverse=True, return_counts=True)
                    at = at.astype("<i4")
                    rows = {field.name: [] for field in schema}

                    def add(**values):
                        for name, column in rows.items():
                            column.append(values.get(name))

                    for i, doc_id in enumerate(doc_ids):
                        # The counts stand where the document's links begin; without links, in the first block.
                        begins = start <= place[i] < stop if place[i + 1] > place[i] else start == 0
                        a, b = max(int(place[i]), start), min(int(place[i + 1]), stop)
                        if not begins and a >= b:
                            continue
                        links = at[a - start : b - start].tobytes() if b > a else b""
                        if begins:
                            counts = {name: int(found[name][i]) for name in ("n_a", "n_b", "n_groups", "n_links")}
                            add(block=block, row=row + i, doc_id=doc_id, links=links, groups_sha256=found["groups_sha256"][i], groups=found["groups"][i], **counts)
                        else:
                            add(block=block, row=row + i, links=links)
                    if len(pairs):
                        add(block=block, pairs=pairs, times=times)
                    yield pa.RecordBatch.from_pydict(rows, schema=schema)
                    block += 1
                row += high - low
            batch = found = rows = pairs = at = times = None
        textnum.give_back()

    names = "block long, row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, links binary, pairs array<long>, times array<int>"
    return docs.select("doc_id", "text").mapInArrow(run, names)


def pair_counts(rows: DataFrame) -> DataFrame:
    """a, b, count of every linked pair of ids, and whether it is one of its B id's most frequent."""
    asked = rows.where(F.col("pairs").isNotNull()).select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counts = written(asked.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("count")), "counts")
    b = F.shiftright("pair", 32)
    # One row for each B id: at most as many as the vocabulary has.
    best = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    return counts.withColumn("b", b).join(best, "b").select(
        F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("a"), "b", "pair", "count", (F.col("count") == F.col("most")).alias("best")
    )


def align(docs: DataFrame, path_a: str, path_b: str, keep_groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document.

    With ``keep_groups`` the list of groups itself is there too.
    """
    rows = written(aligned(docs, path_a, path_b, keep_groups), "aligned")
    counts = pair_counts(rows).select("pair", "count", "best")
    asked = rows.where(F.col("pairs").isNotNull()).select(F.col("block").alias("asked_by"), F.explode("pairs").alias("pair"))
    # In the order of the pairs, which is that of the positions.
    answers = asked.join(counts, "pair")
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups"]

    def tell(key, left, right):
        order = np.argsort(right["pair"].to_numpy())
        count = right["count"].to_numpy()[order]
        best = right["best"].to_numpy(zero_copy_only=False)[order]
        links = [np.frombuffer(b, "<i4") for b in left["links"].to_pylist()]
        told = {"n_best": [int(best[x].sum()) for x in links], "count_sum": [int(count[x].sum()) for x in links]}
        return pa.table({"row": left["row"], **{name: left[name] for name in kept}, **{k: pa.array(v, pa.int64()) for k, v in told.items()}})

    links = rows.where(F.col("links").isNotNull()).select("block", "row", *kept, "links")
    types = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, n_best long, count_sum long"
    parts = links.groupBy("block").cogroup(answers.groupBy("asked_by")).applyInArrow(tell, types)
    # A document's parts, of which one has its counts; most documents have one part.
    whole = parts.groupBy("row").agg(*[F.max(name).alias(name) for name in kept], F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return whole.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *(["groups"] if keep_groups else []))
