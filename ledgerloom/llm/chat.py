r"""Chat formatting into prefix trees.

A turn becomes ``<|im_start|>role\ntext<|im_end|>\n``. Inside texts and roles ``<|`` is escaped by a backslash
after the ``<`` (one more where there are some already), in roles also line ends and backslashes, so no text
can contain a control string and reading back is exact. Control strings are single tokens.

Conversations that begin with the same turns share those tokens: each distinct beginning is a node, the
nodes below one first turn are a tree, and a tree's tokens are laid out once, depth first. Each node has its
offset in the tree, the position id of its first token (positions run on along the conversation, not
along the layout) and the merged intervals of its ancestors, which are all that its tokens may
attend to besides themselves. Tokens of assistant texts are under the loss mask.

Turns are read in sorted order as a stream, so a conversation needs no more memory than its longest turn
and 16 bytes a turn. The depth-first order is the order of (first conversation with the node in the order
of all paths, depth), so offsets are running sums over sorted ranges and no tree passes through one task.

Defined results: rows are ordered by turn (null last), then role and text; repeated rows are turns of their
own; null roles and texts are empty; rows without conv_id are one conversation without id. An empty table
gives empty results; other columns do not matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import join_groups, written

# The template's control strings and their token ids, above the vocabulary's.
START, END = "<|im_start|>", "<|im_end|>"
START_ID, END_ID = 50257, 50258
LOSS_ROLE = "assistant"


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Template:
    """Turns to token ids and back; ``ranks`` is a byte-level vocabulary file of ranks."""

    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, ranks: str):
        import base64

        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        self.coder = tiktoken.Encoding("ranks", pat_str=self.PATTERN, mergeable_ranks=table, special_tokens={START: START_ID, END: END_ID})

    def encode(self, role: str, text: str) -> tuple[list[int], int, int]:
        """The turn's tokens and the span of its text among them."""
        head = [START_ID, *self.coder.encode_ordinary(escape_role(role) + "\n")]
        body = self.coder.encode_ordinary(escape(text))
        return [*head, *body, END_ID, *self.coder.encode_ordinary("\n")], len(head), len(head) + len(body)

    def decode(self, ids: list[int]) -> str:
        return self.coder.decode_bytes(ids).decode()


def walk(conversations: DataFrame, ranks: str) -> DataFrame:
    """A row for each turn, and one after each conversation (node null) with the path of its nodes.

    A node is the digest of all turns up to its own; ``position`` counts the tokens before the turn.
    """
    fields = [("conv_id", pa.int64()), ("root", pa.binary()), ("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("position", pa.int64()), ("ids", pa.list_(pa.int32())), ("loss_start", pa.int32()), ("loss_end", pa.int32()), ("path", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(ranks)
        current, open_, path, position = None, False, bytearray(), 0
        for batch in batches:
            rows = []
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if open_ and conv != current:
                    rows.append((current, bytes(path[:16]), None, None, len(path) // 16, position, None, None, None, bytes(path)))
                if not open_ or conv != current:
                    current, open_, path, position = conv, True, bytearray(), 0
                role, text, parent = role or "", text or "", bytes(path[-16:])
                coded = role.encode()
                node = hashlib.blake2b(parent + len(coded).to_bytes(8) + coded + text.encode(), digest_size=16).digest()
                ids, low, high = template.encode(role, text)
                if role != LOSS_ROLE:
                    low = high = 0
                path += node
                rows.append((conv, bytes(path[:16]), node, parent or None, len(path) // 16 - 1, position, ids, low, high, None))
                position += len(ids)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)], names=[f for f, _ in fields])
        if open_:
            row = (current, bytes(path[:16]), None, None, len(path) // 16, position, None, None, None, bytes(path))
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, (_, t) in zip(row, fields)], names=[f for f, _ in fields])

    schema = "conv_id long, root binary, node binary, parent binary, depth long, position long, ids array<int>, loss_start int, loss_end int, path binary"
    ordered = conversations.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, schema)


def trees(conversations: DataFrame, ranks: str) -> tuple[DataFrame, DataFrame]:
    """The laid out nodes and the paths of the conversations.

    nodes: tree, node, parent, depth, offset, position, ids, loss_start, loss_end, ancestors (intervals of
    offsets in the tree). paths: conv_id, depth, node, rank; one row a turn.
    """
    turns = written(walk(conversations, ranks), "turns")
    ends = turns.where("node IS NULL").select("conv_id", "path")
    # Equal paths are told apart by conv_id, so the sorted ranges can be cut anywhere.
    ranked = written(ends.orderBy("path", "conv_id").select("conv_id", F.monotonically_increasing_id().alias("rank")), "ranked")
    ranked = ranked.withColumnRenamed("conv_id", "conv")
    rows = turns.where("node IS NOT NULL").join(ranked, F.col("conv_id").eqNullSafe(F.col("conv"))).drop("conv", "path")
    rows = written(rows, "rows")
    content = F.struct("root", "parent", "depth", "position", "ids", "loss_start", "loss_end")
    nodes = rows.groupBy("node").agg(F.min_by(content, "rank").alias("of"), F.min("rank").alias("owner"), F.count(F.lit(1)).alias("shared"))
    nodes = nodes.select("node", "of.*", "owner", "shared", F.size("of.ids").cast("long").alias("length"))
    ranges = nodes.repartitionByRange("owner", "depth").withColumn("part", F.spark_partition_id())
    ranges = written(ranges, "ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = ranges.groupBy("part").agg(F.sum("length").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    inside = Window.partitionBy("part").orderBy("owner", "depth").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranges.join(shift, "part").withColumn("at", F.col("shift") + F.coalesce(F.sum("length").over(inside), F.lit(0)))
    placed = written(placed.drop("part", "shift"), "placed")
    starts = written(placed.groupBy("root").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("n")), "starts")
    laid = join_groups(placed, starts, "root", "n", "node").withColumn("offset", F.col("at") - F.col("start"))
    laid = written(laid.select(F.col("root").alias("tree"), "node", "parent", "depth", "offset", "position", "ids", "loss_start", "loss_end", "owner", "shared", "length"), "laid")
    paths = rows.select("conv_id", "depth", "node", "rank")
    around = ancestors(paths, laid.select("node", "offset", "length", "owner", "shared"))
    return laid.join(around, "node").drop("owner"), paths


def ancestors(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and the merged intervals of its ancestors, read along its first conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, spans = None, []
        for batch in batches:
            found, around = [], []
            for rank, node, offset, length, owner in zip(*(c.to_pylist() for c in batch.columns)):
                if rank != current:
                    current, spans = rank, []
                if owner == rank:
                    found.append(node)
                    around.append([{"start": a, "end": b} for a, b in spans])
                if spans and spans[-1][1] == offset:
                    spans[-1] = (spans[-1][0], offset + length)
                else:
                    spans.append((offset, offset + length))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(around, kind)], names=["node", "ancestors"])

    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    joined = join_groups(paths, nodes, "node", "shared", "rank")
    ordered = joined.repartition("rank").sortWithinPartitions("rank", "depth").select("rank", "node", "offset", "length", "owner")
    return ordered.mapInArrow(run, "node binary, ancestors array<struct<start:bigint,end:bigint>>")


def read_back(nodes: DataFrame, paths: DataFrame, ranks: str) -> DataFrame:
    """What the laid out trees say of each conversation: turns, loss text and length, as digests."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "loss_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template, current, state = Template(ranks), None, None

        def closed():
            n, turns, chars, loss, formatted, tokens = state
            row = (conv_id, n, turns.hexdigest(), chars, loss.hexdigest(), formatted, tokens)
            return pa.RecordBatch.from_arrays([pa.array([v], pa.string() if isinstance(v, str) else pa.int64()) for v in row], names=names)

        conv_id, done = None, []
        for batch in batches:
            done = []
            for conv, rank, ids, low, high in zip(*(c.to_pylist() for c in batch.columns)):
                if rank != current:
                    if state:
                        done.append(closed())
                    current, conv_id, state = rank, conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                turn = template.decode(ids)
                head, _, body = turn.removeprefix(START).removesuffix(END + "\n").partition("\n")
                state[0] += 1
                state[1].update(f"{unescape_role(head)}\n{unescape(body)}\n".encode())
                if high > low:
                    loss = unescape(template.decode(ids[low:high]))
                    state[2] += len(loss)
                    state[3].update(loss.encode())
                state[4] += len(turn)
                state[5] += high - low
            yield from done
        if state:
            yield closed()

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, loss_tokens long"
    joined = join_groups(paths.drop("depth"), nodes.select("node", "position", "ids", "loss_start", "loss_end", "shared"), "node", "shared", "rank")
    ordered = joined.repartition("rank").sortWithinPartitions("rank", "position")
    return ordered.select("conv_id", "rank", "ids", "loss_start", "loss_end").mapInArrow(run, schema)
