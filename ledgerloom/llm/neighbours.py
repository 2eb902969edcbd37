"""Approximate nearest neighbours by robust-pruned directed graphs, one for each shard.

Equal vectors are one class, which stands in the graph once and keeps its ``k + 1`` smallest ids, so copies
neither crowd the graph nor each other. Classes are dealt by hash to shards of about ``SHARD`` vectors. A
shard's graph is grown in batches: a greedy beam search from the middle proposes neighbours for each new
vector, relaxed distance pruning keeps the nearest and drops those that a kept one is ``ALPHA`` times
nearer to, and the edges are added backwards too, pruned again where a vector gets too many. Queries are read in
blocks past the graphs of every shard; a beam search collects the nearest classes, their cosines are computed in double
precision on the original vectors, and the nearest of all shards are the answer.

Distances in the graph are cosine distances (of normalised vectors). Defined results: vectors that are
null, empty, zero or hold null or non-finite components take no part, nor do rows without vec_id; rows that
repeat vec_id and vector count once; a query never finds its own vec_id; vectors of different lengths are
not compared; ties go to the smaller vec_id. With fewer candidates than ``k`` all are returned. An empty
table gives no rows; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import by_batch, written

DEGREE, ALPHA = 32, 1.2
BUILD_BEAM, SEARCH_BEAM = 64, 128
SHARD, BLOCK = 8192, 512
STEP = 4
# Tasks that a search is spread over, bytes of the graphs of one, of the blocks of queries that it goes through and of a file of blocks.
SPREAD, GROUP, PART, FILE = 64, 1 << 26, 1 << 25, 1 << 23
# Tasks that graphs are built in, at most; the driver keeps some kilobytes of each.
BUILDERS = 1 << 14


def beam_search(x: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest vectors found for each query, nearest first, and their distances.

    ``graph`` has the neighbours of each vector, -1 where there are fewer. Every round expands the
    ``STEP`` nearest candidates not yet expanded; a query ends when it has none.
    """
    n, q = len(x), len(queries)
    seen = np.zeros((q, n + 1), bool)
    seen[:, n] = True
    near = np.full((q, beam), n, np.int64)
    far = np.full((q, beam), np.inf, np.float32)
    done = np.ones((q, beam), bool)
    near[:, 0], far[:, 0], done[:, 0] = entry, 1 - queries @ x[entry], False
    seen[:, entry] = True
    active = np.arange(q)
    while len(active):
        rows = np.arange(len(active))[:, None]
        waiting = np.where(done[active], np.inf, far[active])
        some = min(STEP, beam)
        best = np.argpartition(waiting, some - 1, axis=1)[:, :some]
        open_ = np.isfinite(waiting[rows, best])
        done[active[:, None], best] = True
        next_ = np.where(open_[:, :, None], graph[near[active[:, None], best] % n], -1).reshape(len(active), -1)
        next_[next_ < 0] = n
        # An id proposed twice in one round counts once.
        next_.sort(axis=1)
        next_[:, 1:][next_[:, 1:] == next_[:, :-1]] = n
        next_[seen[active[:, None], next_]] = n
        seen[active[:, None], next_] = True
        fresh = next_ < n
        r, c = np.nonzero(fresh)
        distance = np.full(next_.shape, np.inf, np.float32)
        distance[r, c] = 1 - np.einsum("ij,ij->i", queries[active[r]], x[next_[r, c]])
        all_near = np.concatenate((near[active], next_), axis=1)
        all_far = np.concatenate((far[active], distance), axis=1)
        all_done = np.concatenate((done[active], ~fresh), axis=1)
        order = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
        near[active], far[active], done[active] = all_near[rows, order], all_far[rows, order], all_done[rows, order]
        active = active[~(done[active] | ~np.isfinite(far[active])).all(axis=1)]
    order = np.argsort(far, axis=1, kind="stable")
    return np.take_along_axis(near, order, 1), np.take_along_axis(far, order, 1)


def robust_prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each point at most ``degree`` of its candidates (-1: none), near and in different directions."""
    count = len(points)
    good = (candidates >= 0) & (candidates != points[:, None])
    vectors = x[np.where(good, candidates, 0)]
    own = np.where(good, 1 - np.einsum("ijk,ik->ij", vectors, x[points]), np.inf)
    between = 1 - np.matmul(vectors, vectors.transpose(0, 2, 1))
    chosen = np.full((count, degree), -1, np.int64)
    rows = np.arange(count)
    alive = own.copy()
    for slot in range(degree):
        best = alive.argmin(axis=1)
        left = np.isfinite(alive[rows, best])
        if not left.any():
            break
        chosen[left, slot] = candidates[rows, best][left]
        alive[(alpha * between[rows, best] <= own) & left[:, None]] = np.inf
        alive[rows, best] = np.inf
    return chosen


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """Neighbour lists of normalised vectors and the entry vector, the one nearest to the middle."""
    n = len(x)
    graph = np.full((n, degree), -1, np.int64)
    entry = int((x @ x.mean(axis=0)).argmax())
    order = np.random.default_rng(1).permutation(n)
    order = order[order != entry]
    low, size = 0, 1
    while low < len(order):
        batch = order[low : low + size]
        low, size = low + len(batch), min(2 * size, 256, max(1, n // 16))
        near, far = beam_search(x, graph, entry, x[batch], min(beam, n))
        near[~np.isfinite(far)] = -1
        # Vectors of one batch do not see each other yet; a few of them are proposed as well.
        mates = batch[(np.arange(len(batch))[:, None] + np.arange(1, 9)) % len(batch)]
        graph[batch] = robust_prune(x, batch, np.concatenate((near, mates), axis=1), degree, alpha)
        source = np.repeat(batch, degree)
        target = graph[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        heads, first, counts = np.unique(target, return_index=True, return_counts=True)
        wide = np.full((len(heads), degree + int(counts.max(initial=0))), -1, np.int64)
        wide[:, :degree] = graph[heads]
        place = np.arange(len(target)) - np.repeat(first, counts)
        wide[np.repeat(np.arange(len(heads)), counts), degree + place] = source
        filled = (wide >= 0).sum(axis=1)
        full = filled > degree
        packed = np.take_along_axis(wide, np.argsort(wide < 0, axis=1, kind="stable"), 1)
        graph[heads[~full]] = packed[~full][:, :degree]
        for part in range(0, int(full.sum()), 256):
            some = np.flatnonzero(full)[part : part + 256]
            width = int(filled[some].max())
            graph[heads[some]] = robust_prune(x, heads[some], packed[some][:, :width], degree, alpha)
    return graph, entry


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float32)
    return flat.reshape(len(values), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    wide = x.astype(np.float64)
    # Scaled first, so that very large or small components neither overflow nor vanish.
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    return (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)


def valid(embeddings: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part."""
    sound = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return embeddings.select("vec_id", "embedding").where(
        F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & sound & F.exists("embedding", lambda v: v != 0)
    )


def index(vectors: DataFrame, k: int, shard: int = SHARD) -> DataFrame:
    """One row a shard and vector length: ids of the class members, vectors and graph as bytes."""
    place = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    members = vectors.distinct().withColumn("place", place).where(F.col("place") <= k + 1)
    classes = members.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
    classes = written(classes.withColumn("dim", F.size("embedding")), "vectors")
    shards = max(1, -(-classes.count() // shard))
    dealt = classes.withColumn("shard", F.pmod(F.xxhash64("embedding"), F.lit(shards)).cast("int"))

    def build(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        x = _matrix(table["embedding"])
        graph, entry = build_graph(_unit(x))
        members = table["members"].combine_chunks()
        sizes = np.diff(members.offsets.to_numpy())
        ids = members.flatten().to_numpy()
        row = [[key[0].as_py()], [key[1].as_py()], [sizes.astype(np.int32).tobytes()], [ids.tobytes()], [x.tobytes()], [graph.astype(np.int32).tobytes()], [entry]]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds)], names=names)

    names = ["shard", "dim", "sizes", "ids", "x", "graph", "entry"]
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int32()]
    schema = "shard int, dim int, sizes binary, ids binary, x binary, graph binary, entry int"
    # A fixed number of partitions keeps the shards of a small index from being built one after another.
    return written(dealt.repartition(min(2 * shards, BUILDERS), "shard").groupBy("shard", "dim").applyInArrow(build, schema), "graphs")


def search(graphs: DataFrame, queries: DataFrame, k: int, beam: int = SEARCH_BEAM, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found for each query (vec_id, embedding).

    Every task holds some graphs and reads the query blocks past them. Queries are neither copied for each shard nor
    sent through the driver: a planner that takes such copies for one table would broadcast them.
    """
    asked = written(queries.distinct().withColumn("dim", F.size("embedding")), "queries")
    count, numbers = asked.agg(F.count("*"), F.sum("dim")).first()
    blocks = max(1, -(-count // block))
    size = 8 * count + 4 * (numbers or 0)
    # A vector takes 4 bytes in ``sizes``, 4 * dim in ``x`` and 4 * DEGREE in ``graph``.
    made, held = graphs.agg(F.count("*"), F.sum(F.length("sizes").cast("long") * (1 + F.col("dim") + DEGREE))).first()
    groups = max(SPREAD, -(-(held or 0) // GROUP))
    parts = max(min(blocks, -(-SPREAD // max(1, made))), -(-size // PART))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))

    def gather(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        row = [[key[1].as_py()], [table["vec_id"].combine_chunks().to_numpy().tobytes()], [_matrix(table["embedding"]).tobytes()]]
        yield pa.RecordBatch.from_arrays([pa.array(row[0], pa.int32()), pa.array(row[1], pa.binary()), pa.array(row[2], pa.binary())], names=["length", "asked", "q"])

    dealt = asked.repartition(max(parts, -(-size // FILE)), "block")
    packed = written(dealt.groupBy("block", "dim").applyInArrow(gather, "length int, asked binary, q binary"), "blocks")
    # The product goes through a part's blocks in the same order for each graph, so a graph is sent with the first only.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    pairs = graphs.coalesce(groups).hint("shuffle_replicate_nl").crossJoin(packed.coalesce(parts).withColumn("first", first))
    once = [F.when(F.col("first"), F.col(c)).alias(c) for c in ("sizes", "ids", "x", "graph", "entry")]
    now: dict = {}

    def answer(batch):
        shards, dims, sizes, ids, xs, links, entries, lengths, asked_ids, qs = (batch.column(i) for i in range(10))
        for r in range(batch.num_rows):
            dim, of = dims[r].as_py(), (shards[r].as_py(), dims[r].as_py())
            if xs[r].is_valid:
                x = np.frombuffer(xs[r].as_buffer(), np.float32).reshape(-1, dim).copy()
                graph = np.frombuffer(links[r].as_buffer(), np.int32).reshape(len(x), -1).astype(np.int64)
                ends = np.cumsum(np.frombuffer(sizes[r].as_buffer(), np.int32))
                member = np.frombuffer(ids[r].as_buffer(), np.int64).copy()
                now.update(of=of, graph=(x, _unit(x), graph, ends, member, entries[r].as_py()))
            if now.get("of") != of:
                raise ValueError(f"blocks without the graph of shard {of}")
            if lengths[r].as_py() != dim:
                continue
            x, unit, graph, ends, member, entry = now["graph"]
            q = np.frombuffer(qs[r].as_buffer(), np.float32).reshape(-1, dim)
            own = np.frombuffer(asked_ids[r].as_buffer(), np.int64)
            near, far = beam_search(unit, graph, entry, _unit(q), min(beam, len(x)))
            out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
            for i, (some, found) in enumerate(zip(near, np.isfinite(far))):
                some = some[found]
                a, b = q[i].astype(np.float64), x[some].astype(np.float64)
                score = (b @ a) / (np.linalg.norm(a) * np.linalg.norm(b, axis=1))
                start = np.concatenate(([0], ends))[some]
                count = ends[some] - start
                at = np.repeat(start, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                each, score = member[at], np.repeat(score, count)
                score, each = score[each != own[i]], each[each != own[i]]
                top = np.lexsort((each, -score))[:k]
                out["query_id"].append(np.full(len(top), own[i]))
                out["vec_id"].append(each[top])
                out["score"].append(score[top])
            yield {name: np.concatenate(found) for name, found in out.items()}

    found = by_batch(pairs.select("shard", "dim", *once, "length", "asked", "q"), answer, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(embeddings: DataFrame, every: int = 50, k: int = 5, shard: int = SHARD, beam: int = SEARCH_BEAM) -> DataFrame:
    """Neighbours of every row whose vec_id is divisible by ``every``, among all other rows."""
    vectors = valid(embeddings)
    return search(index(vectors, k, shard), vectors.where(F.col("vec_id") % every == 0), k, beam)
