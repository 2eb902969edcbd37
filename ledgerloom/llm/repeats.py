"""Removing repeated byte strings with suffix arrays.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts earlier: in a document with a smaller
doc_id or further left in the same one. Matches never cross documents.

Every window of ``LENGTH`` bytes has an anchor, its k-gram of the smallest hash (the leftmost of equals), and
equal windows have equal anchors. The run of windows with one anchor is a segment of at most
``2 * LENGTH`` bytes, and each window lies in one segment, so segments can be dealt by their anchors:

1. Only a segment's two hashes (anchor, content) and place travel. Of equal segments the first one
   stays; all windows of the others start earlier there. Batches keep one row of equal segments each before
   anything shuffles, and one row for each anchor to ask whether another batch has it, so a passage in a
   third of all documents costs one row a batch. Anchors that occur once end here.
2. An anchor with one content is settled. For the others the first segment of each content is cut out of
   its document and goes to a shard. A shard concatenates its segments in the order of places, builds their
   suffix array by induced sorting and the permuted common prefixes, and so finds every window that starts
   earlier in the shard.
3. Anchors with more than ``VARIANTS`` contents (the rim of a passage that very many documents share) would
   not fit a shard. Their windows are dealt one by one, by a digest of their bytes, and the first of each
   digest stays.

Defined results: a null text is empty. Rows are told apart by doc_id and a hash of the text: rows alike in
both are one document and get equal results, rows with one doc_id and different texts follow each other in
the order of that hash, and null doc_ids come last. Texts shorter than a window lose nothing. An empty
table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import textnum
from ledgerloom.llm.common import by_batch, join_groups, written
from ledgerloom.llm.suffixarray import common_prefixes, suffix_array

LENGTH = 100
GRAM = 24
SHARD_BYTES = 2 << 20
VARIANTS = 4096
LAST = (1 << 63) - 1


def segments(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(row, first window, last window, anchor hash, content hash) of the segments of a slice."""
    n, width = len(data), length - gram + 1
    if n < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    up, down = textnum.powers(n + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(textnum.random_numbers(256, 7)[data] * up[:n], out=sums[1:])
        grams = textnum.mix64((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
        # The smallest hash of each run of ``width``, by smallest-so-far within blocks from both sides. The low
        # bits hold the place, so the leftmost of equals wins and is known.
        bits = np.uint64(max(1, len(grams).bit_length()))
        keys = np.full(-(-len(grams) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
        keys[: len(grams)] = ((grams >> bits) << bits) | np.arange(len(grams), dtype=np.uint64)
        blocks = keys.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = n - length + 1
        anchor = (np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows]) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:windows]
        own = np.flatnonzero(np.arange(windows) + length <= offsets[row + 1])
        anchor, row = anchor[own], row[own]
        new = np.ones(len(own), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
        start = np.flatnonzero(new)
        stop = np.append(start[1:], len(own))[: len(start)] - 1
        first, last, anchor = own[start], own[stop], anchor[start]
        content = (sums[last + length] - sums[first]) * down[first]
        shape = (anchor - first).astype(np.uint64) * np.uint64(1 << 20) + (last - first).astype(np.uint64)
        return row[start], first, last, grams[anchor], textnum.mix64(content + textnum.mix64(shape))


def _order(doc, text, start, *before):
    return np.lexsort((start, text, doc, *before[::-1]))


def candidates(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Of each batch's equal segments one row with ``settled`` false, the first; the others' spans are
    settled. One row an anchor ``asks`` whether other batches have it too; ``shared`` anchors have
    several contents in the batch and need not wait for the answer."""

    def work(batch):
        numbers = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        found = []
        for low, _, data, offsets in textnum.slices(batch.column(2)):
            row, first, last, anchor, content = segments(data, offsets, length, gram)
            base = offsets[row]
            found.append((numbers[0][low + row], numbers[1][low + row], first - base, last - base + length, anchor.view(np.int64), content.view(np.int64)))
        if not found:
            return None
        doc, text, start, end, anchor, content = (np.concatenate(x) for x in zip(*found))
        by = _order(doc, text, start, anchor, content)
        doc, text, start, end, anchor, content = (x[by] for x in (doc, text, start, end, anchor, content))
        settled = np.zeros(len(doc), bool)
        settled[1:] = (anchor[1:] == anchor[:-1]) & (content[1:] == content[:-1])
        # A row given twice is one document: its own places do not count as earlier ones.
        again = np.zeros(len(doc), bool)
        again[1:] = settled[1:] & (doc[1:] == doc[:-1]) & (text[1:] == text[:-1]) & (start[1:] == start[:-1])
        keep = ~again
        columns = [x[keep] for x in (doc, text, start, end, anchor, content, settled)]
        # Rows are in the order of anchors: of each anchor the first row, never a settled one, asks.
        anchor, settled = columns[4], columns[6]
        asks = np.ones(len(anchor), bool)
        asks[1:] = anchor[1:] != anchor[:-1]
        group = np.cumsum(asks) - 1
        shared = np.bincount(group, ~settled, minlength=1)[group] > 1
        names = ("doc", "hash", "start", "end", "anchor", "content", "settled", "asks", "shared")
        return dict(zip(names, (*columns, asks, shared)))

    schema = "doc long, hash long, start int, end int, anchor long, content long, settled boolean, asks boolean, shared boolean"
    return by_batch(docs.select("doc", "hash", "text"), work, schema)


def _cut(pieces: DataFrame, docs: DataFrame) -> DataFrame:
    """The bytes of segments (doc, hash, start, end, anchor, many); the documents meet them once."""
    wanted = pieces.groupBy("doc", "hash").agg(F.collect_set(F.struct("start", "end", "anchor", "many")).alias("pieces"))
    # A row given twice is cut once.
    joined = docs.join(wanted, ["doc", "hash"]).select("doc", "hash", "text", "pieces").dropDuplicates(["doc", "hash"])

    def work(batch):
        out: dict[str, list] = {"doc": [], "hash": [], "start": [], "anchor": [], "many": [], "bytes": []}
        for doc, text_hash, text, spans in zip(*(batch.column(i) for i in range(4))):
            raw, doc, text_hash = text.as_py().encode(), doc.as_py(), text_hash.as_py()
            for span in spans.as_py():
                out["bytes"].append(raw[span["start"] : span["end"]])
                out["doc"].append(doc)
                out["hash"].append(text_hash)
                for name in ("start", "anchor", "many"):
                    out[name].append(span[name])
        return out

    return by_batch(joined, work, "doc long, hash long, start int, anchor long, many boolean, bytes binary")


def _windows(pieces: DataFrame, length: int) -> DataFrame:
    """A digest for each window of the segments."""

    def work(batch):
        out: dict[str, list] = {"doc": [], "hash": [], "start": [], "bytes": []}
        for doc, text_hash, start, raw in zip(*(column.to_pylist() for column in batch.columns)):
            for at in range(len(raw) - length + 1):
                out["bytes"].append(hashlib.blake2b(raw[at : at + length], digest_size=16).digest())
                out["doc"].append(doc)
                out["hash"].append(text_hash)
                out["start"].append(start + at)
        return out

    return by_batch(pieces.select("doc", "hash", "start", "bytes"), work, "doc long, hash long, start int, bytes binary")


def repeated_windows(doc: np.ndarray, text: np.ndarray, start: np.ndarray, parts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(segment, start) of every window that starts earlier among these segments.

    Segments are concatenated in the order of their places, each followed by a 0; bytes count from 1.
    """
    by = _order(doc, text, start)
    sizes = np.array([len(parts[i]) for i in by])
    ends = np.cumsum(sizes + 1)
    joined = np.frombuffer(b"\xff".join(parts[i] for i in by) + b"\xff", np.uint8) + np.uint8(1)
    symbols = np.append(joined.astype(np.int32) + 1, 0)
    # 0xFF occurs in no UTF-8 text; it became 0 above, then 1: a mark smaller than every byte.
    order = suffix_array(symbols)
    shared = common_prefixes(symbols.astype(np.uint8), order, length)
    owner = np.repeat(np.arange(len(by)), sizes + 1)
    whole = np.append(np.arange(len(joined)) + length <= ends[owner] - 1, False)
    order = order[whole[order]]
    if not len(order):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    heads = np.flatnonzero(np.concatenate(([True], shared[order[1:]] < length)))
    first = np.repeat(np.minimum.reduceat(order, heads), np.diff(np.append(heads, len(order))))
    later = np.sort(order[order != first])
    segment = owner[later]
    return by[segment], start[by[segment]] + later - (ends[segment] - 1 - sizes[segment])


def _spans(segment: np.ndarray, at: np.ndarray, length: int):
    """Neighbouring windows of a segment as one span: (segment, start, end)."""
    new = np.ones(len(at), bool)
    new[1:] = (segment[1:] != segment[:-1]) | (at[1:] != at[:-1] + 1)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(at))[: len(heads)] - 1
    return segment[heads], at[heads], at[tails] + length


def shard_spans(pieces: DataFrame, shards: int, length: int) -> DataFrame:
    """Spans (doc, hash, start, end) that each shard's suffix array finds repeated."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        doc, text, start = (table[c].to_numpy() for c in ("doc", "hash", "start"))
        segment, at = repeated_windows(doc, text, start.astype(np.int64), table["bytes"].to_pylist(), length)
        segment, low, high = _spans(segment, at, length)
        columns = [pa.array(doc[segment]), pa.array(text[segment]), pa.array(low, pa.int32()), pa.array(high, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc", "hash", "start", "end"])

    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int")
    return pieces.repartition(shards, shard).groupBy(shard.alias("shard")).applyInArrow(work, "doc long, hash long, start int, end int")


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, variants: int = VARIANTS) -> DataFrame:
    """All spans (doc, hash, start, end) to remove; they may overlap. ``docs`` has doc, hash and text."""
    found = candidates(docs, length, gram)
    # Anchors meet by one row a batch; all other rows are spread evenly and only pass through.
    key = F.when(F.col("asks"), F.col("anchor")).otherwise(F.xxhash64("doc", "hash", "start"))
    asked = found.withColumn("key", key).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("asks", "key")))
    asked = asked.where("settled OR shared OR (asks AND n > 1)").drop("asks", "shared", "key", "n")
    found = written(asked, "segments")
    shared = found.where("NOT settled")
    place = F.struct("doc", "hash", "start", "end")
    firsts = shared.groupBy("anchor", "content").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = written(firsts, "firsts")
    # A passage that all batches have is dealt in parts.
    several = written(firsts.where("n > 1").select(F.struct("anchor", "content").alias("own"), "first", "n"), "several")
    own = shared.select(F.struct("anchor", "content").alias("own"), "doc", "hash", "start", "end")
    later = join_groups(own, several, "own", "n", "doc").where(place != F.col("first")).select("doc", "hash", "start", "end")
    counted = firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1")
    kept = firsts.select("anchor", "first.*").join(counted, "anchor").withColumn("many", F.col("contents") > variants)
    kept = written(kept.drop("contents"), "kept")
    cut = written(_cut(kept, docs), "cut")
    few = kept.where("NOT many")
    total = few.agg(F.sum(F.col("end") - F.col("start"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    in_shards = shard_spans(cut.where("NOT many").drop("many"), shards, length)
    windows = written(_windows(cut.where("many"), length), "windows")
    place = F.struct("doc", "hash", "start")
    earliest = windows.groupBy("bytes").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    rims = windows.join(earliest, "bytes").where(place != F.col("first"))
    rims = rims.select("doc", "hash", "start", (F.col("start") + length).cast("int").alias("end"))
    return found.where("settled").select("doc", "hash", "start", "end").union(later).union(in_shards).union(rims)


def _merged(spans: np.ndarray, size: int) -> np.ndarray:
    """Overlapping and touching spans as one, in order."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    heads = np.flatnonzero(np.concatenate(([True], spans[1:, 0] > reach[:-1])))
    tails = np.append(heads[1:], len(spans)) - 1
    return np.stack([spans[heads, 0], np.minimum(reach[tails], size)], axis=1)


def keyed(docs: DataFrame) -> DataFrame:
    """The documents with the order key ``doc``, the text hash ``hash`` and no nulls in the text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("doc"), F.xxhash64(text).alias("hash"), text.alias("text"))


def remove(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, variants: int = VARIANTS) -> DataFrame:
    """doc_id, the kept bytes, the removed spans and the size of every row."""
    rows = keyed(docs)
    spans = repeated_spans(rows.select("doc", "hash", "text"), length, gram, shard_bytes, variants)
    spans = spans.groupBy("doc", "hash").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = rows.join(spans, ["doc", "hash"], "left").select("doc_id", "text", "spans")

    def work(batch):
        kept, removed, sizes = [], [], []
        for text, spans in zip(batch.column(1), batch.column(2)):
            raw = text.as_py().encode()
            sizes.append(len(raw))
            if not spans.is_valid or not len(spans):
                kept.append(raw)
                removed.append([])
                continue
            values = spans.values
            merged = _merged(np.stack([values.field(0).to_numpy(), values.field(1).to_numpy()], axis=1), len(raw))
            edges = [0, *merged.ravel().tolist(), len(raw)]
            kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            removed.append([{"start": a, "end": b} for a, b in merged.tolist()])
        return {"doc_id": batch.column(0), "n_bytes": sizes, "removed": removed, "kept": kept}

    return by_batch(joined, work, "doc_id long, n_bytes long, removed array<struct<start:int,end:int>>, kept binary")


def digest(removed: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of what ``remove`` returns."""
    return removed.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
