"""SentencePiece encoding and decoding for merge-type vocabularies, by a score-ordered agenda.

A text is normalised as the model says (for the given one: a blank in front, blanks written as U+2581)
and starts as single characters. The agenda holds the pairs of adjacent symbols that form a piece; the
pair with the highest score comes next, the leftmost of equal ones, becomes one symbol, and its pairs with
its new neighbours enter the agenda, until no pair forms a piece. Characters without a piece become
byte pieces. Decoding joins the pieces' bytes, drops the blank put in front and reads the bytes as UTF-8,
U+FFFD for each byte that does not belong to a character.

A pair can only form where some piece has these two characters side by side. A text is cut everywhere
else; no merge crosses such a cut, so the segments' agendas are independent and equal segments have
equal ids. Segments are encoded once and remembered. New segments of up to ``LANE`` characters
run their agendas side by side in numpy: one row a segment, one merge a row and step, rows without a
pair left drop out. Longer ones have a heap of their own, so no text costs more than n log n.

Every text's ids, and the text decoded from them, are compared with the sentencepiece library's, batch by
batch; a difference fails the job. A batch is worked off in slices of about two megabytes, one document
at least.

Defined results: null and empty texts have the end id alone and decode to the empty text. Repeated rows
and ids, null ids and extra columns pass through. U+2581 in a text becomes a blank, as in the library.
An empty table gives no rows. Vocabularies with unused pieces are refused; ones with
user-defined symbols, which the library's interface does not tell, fail the comparison.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm import textnum
from ledgerloom.llm.common import by_batch

LANE = 64
# Widths of the numpy agendas: a segment runs in the narrowest that holds it.
WIDTHS = (4, 8, 12, 16, 24, 32, LANE)
# Rows of one numpy agenda; few enough to stay in a core's cache.
ROWS = 8192
MEMO_SEGMENTS = 400_000
SLICE_BYTES = 2 << 20
BLANK = "▁"


class PieceModel:
    """A merge-type model file: its pieces, the pairs that form them, and the agenda over a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        if any(sp.is_unused(i) for i in range(n)):
            raise ValueError("vocabularies with unused pieces are not supported")
        names = [sp.id_to_piece(i) for i in range(n)]
        self.unknown, self.end = sp.unk_id(), sp.eos_id()
        special = [sp.is_control(i) or sp.is_unknown(i) for i in range(n)]
        is_byte = [sp.is_byte(i) for i in range(n)]
        self.byte_ids = {int(names[i][1:-1], 16): i for i in range(n) if is_byte[i]}
        normal = {names[i]: i for i in range(n) if not special[i] and not is_byte[i]}
        # Bytes of every id as decoded: control ids say nothing.
        self.is_byte = np.array(is_byte)
        self.surface = [
            bytes([int(names[i][1:-1], 16)]) if is_byte[i]
            else sp.decode([i]).encode() if special[i]
            else names[i].replace(BLANK, " ").encode()
            for i in range(n)
        ]
        self.silent = {i for i in range(n) if not self.surface[i]}
        # Bytes of every id within a text: an id's own name, a blank for U+2581.
        self.inner = [b if not s else names[i].encode() for i, (b, s) in enumerate(zip(self.surface, special))]
        # Whether the library takes the blank in front of a text away again.
        self.drops_blank = sp.decode([normal[BLANK]]) == "" if BLANK in normal else False

        # Symbols: the pieces by id, then characters that occur in pieces without being one.
        loose = sorted({c for p in normal for c in p} - set(normal))
        self.symbols = normal | {c: n + k for k, c in enumerate(loose)}
        self.outputs = {s: self._bytes(c) for c, s in self.symbols.items() if s >= n}
        # Better scores have larger priorities, equal scores the same; no piece has -1.
        scores = {i: sp.get_score(i) for i in normal.values()}
        rank = {score: k for k, score in enumerate(sorted(set(scores.values())))}
        self.priority = np.full(n + len(loose) + 1, -1, np.int32)
        for i, score in scores.items():
            self.priority[i] = rank[score]
        self.pairs: dict[tuple[int, int], int] = {}
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                left, right = self.symbols.get(piece[:cut]), self.symbols.get(piece[cut:])
                if left is not None and right is not None:
                    self.pairs[left, right] = i
        self.span = n + len(loose)
        codes = np.array(sorted((a * self.span + b, i) for (a, b), i in self.pairs.items()), np.int64).reshape(-1, 2)
        self.pair_codes, self.pair_merged = codes[:, 0].copy(), codes[:, 1].astype(np.int32)

        # Characters that stand side by side in pieces get a class; a cut is wherever two classes never do.
        beside = {(a, b) for p in normal for a, b in zip(p, p[1:])}
        chars = sorted({c for pair in beside for c in pair})
        classes = {c: k + 1 for k, c in enumerate(chars)}
        self.class_of = np.zeros(0x110000, np.uint16)
        for c, k in classes.items():
            self.class_of[ord(c)] = k
        self.joined = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        self.first_merge = np.full((len(chars) + 1, len(chars) + 1), -1, np.int32)
        for a, b in beside:
            self.joined[classes[a], classes[b]] = True
            self.first_merge[classes[a], classes[b]] = self.pairs.get((self.symbols[a], self.symbols[b]), -1)
        self.symbol_of_class = np.array([-1] + [self.symbols[c] for c in chars], np.int32)
        # Segments' ids are the same few objects over and over: new ones would take more than the tuples.
        self.numbers = np.arange(self.span).astype(object)
        self.memo: dict[str, tuple[int, ...]] = {}
        # Segments whose ids do not give their bytes again.
        self.lossy: set[str] = set()

    @classmethod
    def shared(cls, path: str) -> "PieceModel":
        """The model of this worker process; it is kept between tasks."""
        store = textnum.process_store()
        if store.get("pieces_path") != path:
            store["pieces"], store["pieces_path"] = cls(path), path
        return store["pieces"]

    def _bytes(self, char: str) -> list[int]:
        found = [self.byte_ids.get(b, self.unknown) for b in char.encode()]
        return [self.unknown] if self.unknown in found else found

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text, without an end id."""
        ids, ends = self.encode_flat(texts)
        flat = ids.tolist()
        return [flat[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's end."""
        return self._encode_flat(texts)[:2]

    def encode_exact(self, texts: list[str], most: int = MEMO_SEGMENTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same, and whether each text's ids have the bytes of a blank and the text; about ``most`` segments are remembered."""
        ids, ends, faithful, normal = self._encode_flat(texts, most)
        same = [bool(text) and n.replace(BLANK, " ") == " " + text for n, text in zip(normal, texts)]
        return ids, ends, faithful & np.array(same, bool)

    def _encode_flat(self, texts: list[str], most: int = MEMO_SEGMENTS) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        normal = [self.library.normalize(text) if text else "" for text in texts]
        text_ends = np.cumsum(np.fromiter(map(len, normal), np.int64, len(normal)))
        if not text_ends.any():
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64), np.ones(len(texts), bool), normal
        cuts, coded = self._segments("".join(normal), text_ends)
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.memo) > most:
            # What these texts use stays.
            self.memo = {name: self.memo[name] for name in names if name in self.memo}
            self.lossy.intersection_update(self.memo)
        found = list(map(self.memo.get, names))
        new = [k for k, ids in enumerate(found) if ids is None]
        self._learn([names[k] for k in new])
        for k in new:
            found[k] = self.memo[names[k]]
            if b"".join(map(self.inner.__getitem__, found[k])) != names[k].replace(BLANK, " ").encode():
                self.lossy.add(names[k])
        # The ids of all distinct segments in one pool, from which every occurrence takes its run.
        count = np.fromiter(map(len, found), np.int64, len(found))
        pool = np.fromiter(chain.from_iterable(found), np.int32, int(count.sum()))
        start = np.cumsum(count) - count
        which = coded.indices.to_numpy()
        runs = count[which]
        place = np.concatenate(([0], np.cumsum(runs)))
        ids = pool[np.arange(place[-1]) + np.repeat(start[which] - place[:-1], runs)]
        text_cuts = np.searchsorted(cuts, text_ends)
        faithful = np.ones(len(texts), bool)
        if self.lossy:
            lost = np.fromiter(map(self.lossy.__contains__, names), bool, len(names))[which]
            faithful = np.diff(np.concatenate(([0], np.cumsum(lost)))[np.concatenate(([0], text_cuts))]) == 0
        return ids, place[text_cuts], faithful, normal

    def _segments(self, whole: str, text_ends: np.ndarray) -> tuple[np.ndarray, pa.DictionaryArray]:
        """Where the segments of all texts, laid one after another, begin and end, and the segments."""
        points = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        # The first character of every segment: of a text, or where no piece has the two side by side.
        kinds = self.class_of[points]
        first = np.concatenate(([True], ~self.joined[kinds[:-1], kinds[1:]], [True]))
        first[text_ends] = True
        cuts = np.flatnonzero(first)
        sizes = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
        places = np.concatenate(([0], np.cumsum(sizes, dtype=np.int32)))[cuts].astype(np.int32)
        data = whole.encode()
        segments = pa.Array.from_buffers(pa.string(), len(cuts) - 1, [None, pa.py_buffer(places.tobytes()), pa.py_buffer(data)])
        return cuts, segments.dictionary_encode()

    def _learn(self, segments: list[str]) -> None:
        by_width: dict[int, list[str]] = {w: [] for w in WIDTHS}
        for segment in segments:
            size = len(segment)
            if size == 1:
                symbol = self.symbols.get(segment)
                self.memo[segment] = tuple(self._bytes(segment) if symbol is None else self.outputs.get(symbol, [symbol]))
            elif size > LANE:
                ids = self._written(self._heap_agenda([self.symbols[c] for c in segment]))
                self.memo[segment] = tuple(self.numbers[ids].tolist())
            else:
                by_width[next(w for w in WIDTHS if size <= w)].append(segment)
        for width, some in by_width.items():
            if some:
                self._row_agendas(some, width)

    def _written(self, symbols: list[int]) -> list[int]:
        if not self.outputs:
            return symbols
        return list(chain.from_iterable(self.outputs.get(s, (s,)) for s in symbols))

    def _heap_agenda(self, symbols: list[int]) -> list[int]:
        """One segment's agenda as a heap over a linked list; an entry whose symbols changed is passed over."""
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[int, int, int, int, int]] = []

        def enter(a: int, b: int) -> None:
            if a >= 0 and b >= 0:
                merged = self.pairs.get((symbols[a], symbols[b]))
                if merged is not None:
                    heapq.heappush(agenda, (-int(self.priority[merged]), a, symbols[a], symbols[b], merged))

        for a in range(n - 1):
            enter(a, a + 1)
        while agenda:
            _, a, left, right, merged = heapq.heappop(agenda)
            b = after[a]
            if symbols[a] != left or b < 0 or symbols[b] != right:
                continue
            symbols[a], symbols[b], after[a] = merged, -1, after[b]
            if after[b] >= 0:
                before[after[b]] = a
            enter(before[a], a)
            enter(a, after[a])
        return [s for s in symbols if s >= 0]

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece each pair of symbols forms, -1 for none."""
        codes = left.astype(np.int64) * self.span + right
        at = np.minimum(np.searchsorted(self.pair_codes, codes), len(self.pair_codes) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.pair_codes[at] == codes), self.pair_merged[at], np.int32(-1))

    def _row_agendas(self, segments: list[str], width: int) -> None:
        """The agendas of many short segments at once: every row merges one pair a step and so loses a column."""
        for low in range(0, len(segments), ROWS):
            some = segments[low : low + ROWS]
            sizes = np.fromiter(map(len, some), np.int64, len(some))
            flat = np.frombuffer("".join(some).encode("utf-32-le"), "<u4")
            kinds = np.zeros((len(some), width), np.uint16)
            kinds[np.arange(width) < sizes[:, None]] = self.class_of[flat]
            symbols = self.symbol_of_class.take(kinds)
            merges = self.first_merge[kinds[:, :-1], kinds[:, 1:]]
            rows = np.arange(len(some))
            while True:
                at = self.priority.take(merges, mode="wrap").argmax(axis=1) if merges.shape[1] else np.zeros(len(rows), np.int64)
                made = merges[np.arange(len(rows)), at] if merges.shape[1] else np.full(len(rows), -1, np.int32)
                going = made >= 0
                if not going.all():
                    done = symbols[~going]
                    filled = done >= 0
                    ids, ends = self.numbers[done[filled]].tolist(), np.cumsum(filled.sum(axis=1)).tolist()
                    for r, a, b in zip(rows[~going].tolist(), [0, *ends], ends):
                        self.memo[some[r]] = tuple(self._written(ids[a:b]))
                    rows, at, made, symbols, merges = rows[going], at[going], made[going], symbols[going], merges[going]
                    if not len(rows):
                        break
                each, n = np.arange(len(rows)), len(rows)
                # The pair's first place holds the piece, its second place goes.
                symbols[each, at] = made
                stay = np.ones(symbols.shape, bool)
                stay[each, at + 1] = False
                symbols = symbols[stay].reshape(n, symbols.shape[1] - 1)
                stay = np.ones(merges.shape, bool)
                stay[each, at] = False
                merges = merges[stay].reshape(n, merges.shape[1] - 1)
                left, right = np.flatnonzero(at > 0), np.flatnonzero(at < merges.shape[1])
                here_l, here_r = at[left], at[right]
                found = self._lookup(
                    np.concatenate((symbols[left, here_l - 1], made[right])), np.concatenate((made[left], symbols[right, here_r + 1]))
                )
                merges[left, here_l - 1], merges[right, here_r] = found[: len(left)], found[len(left) :]

    def decode(self, ids: list[int]) -> str:
        """The text of some ids, as the library's ``decode`` gives it."""
        data = b"".join(map(self.surface.__getitem__, ids))
        lead = 0
        if self.drops_blank:
            # The blank in front stands in the first piece that says anything.
            first = next((i for i in ids if self.surface[i]), None)
            lead = int(first is not None and not self.is_byte[first] and first != self.unknown and data[:1] == b" ")
        # Ids that say nothing end a run of bytes like any other piece.
        if self.silent.isdisjoint(ids):
            try:
                return data[lead:].decode()
            except UnicodeDecodeError:
                pass
        return self._repaired(ids, lead)

    def _repaired(self, ids: list[int], lead: int) -> str:
        """Decoding where byte pieces do not form characters: runs of them are read for themselves."""
        parts, run = [], bytearray()

        def close() -> None:
            at = 0
            while at < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        parts.append(run[at : at + size].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    size = 1
                    parts.append("�")
                at += size
            run.clear()

        for i in ids:
            if self.is_byte[i]:
                run += self.surface[i]
            else:
                close()
                parts.append(self.surface[i].decode())
        close()
        return "".join(parts)[lead:]


def slice_rows(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(first row, end row) of slices of about ``size`` bytes each, one row at least."""
    low = 0
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(column), 0))
    ends = np.cumsum(sizes, dtype=np.int64)
    while low < len(column):
        start = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, start + size, "right")))
        yield low, high
        low = high


def text_slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of such slices; a null text is empty."""
    for low, high in slice_rows(column, size):
        yield low, [text or "" for text in column.slice(low, high - low).to_pylist()]


def _checked(batch: pa.RecordBatch, model: PieceModel):
    """(first row, number of rows, ids, decoded texts) of each slice, after comparison with the library's."""
    for low, texts in text_slices(batch.column(1)):
        ids = model.encode(texts)
        expected = model.library.encode(texts, num_threads=1)
        if ids != expected:
            row = next(i for i, one in enumerate(ids) if one != expected[i])
            raise RuntimeError(f"ids differ from the sentencepiece library's: {texts[row][:200]!r}")
        decoded = [model.decode(one) for one in ids]
        if decoded != model.library.decode(ids, num_threads=1):
            raise RuntimeError("decoded texts differ from the sentencepiece library's")
        yield low, len(texts), ids, decoded


def encode(docs: DataFrame, model_path: str, end: bool = True) -> DataFrame:
    """doc_id, ids and the text decoded from them, of every text."""

    def work(batch: pa.RecordBatch):
        model = PieceModel.shared(model_path)
        for low, n, ids, decoded in _checked(batch, model):
            yield {"doc_id": batch.column(0).slice(low, n), "ids": [[*one, model.end] for one in ids] if end else ids, "decoded": decoded}

    return by_batch(docs.select("doc_id", "text"), work, "doc_id long, ids array<int>, decoded string")


def digest(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text with its end id; the ids stay inside the tasks."""

    def work(batch: pa.RecordBatch):
        model = PieceModel.shared(model_path)
        number = [str(i) for i in range(len(model.surface))]
        for low, n, ids, decoded in _checked(batch, model):
            whole = [" ".join(map(number.__getitem__, [*one, model.end])) for one in ids]
            yield {
                "doc_id": batch.column(0).slice(low, n),
                "n_tokens": [len(one) + 1 for one in ids],
                "ids_sha256": [hashlib.sha256(one.encode()).hexdigest() for one in whole],
                "decoded_sha256": [hashlib.sha256(one.encode()).hexdigest() for one in decoded],
            }

    return by_batch(docs.select("doc_id", "text"), work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
