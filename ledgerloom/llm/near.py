"""Near duplicates by circulant MinHash, banding and exact Jaccard verification.

A document's set is its distinct 5-word shingles (words without white space, A-Z lower-cased); fewer
words are one shingle as a whole; no words are the empty set, which is linked with nothing. Two
permutations make all ``ROWS * BANDS`` signature coordinates: the first scatters the shingles, the
second, shifted circularly by k places, gives coordinate k as the smallest image. Documents that agree
on all coordinates of a band share a bucket. With 30 bands of 6 rows a link of similarity 0.85
misses all buckets with a probability of 1e-6, one of 0.8 with 1e-4.

What follows is exact and makes no list of pairs within a bucket:

1. Documents with equal sets are one class with a number of its own; only one of them goes on.
2. Hot buckets, those of at least a ``HOT``-th of all documents, are few and never become rows: each document is
   compared with ``HOT_PIVOTS`` of the best connected members of its hot buckets, and documents linked so are one
   component before anything else is done.
3. In the other buckets that hold several components every document is compared with the smallest one, on full
   sets, and where several components are left with the ``PIVOTS`` members that share most buckets with others.
4. Links found join documents to components. Only buckets of three or more, hot ones too, that still hold several
   components can hide further links. Their documents are compared by prefix filtering: two sets of the
   asked similarity share one of their rarest shingles, so each document is joined on those only. At a
   shingle only documents outside its most frequent component meet the others.

A bucket whose documents are all linked already thus costs no join, and no text is shuffled: its set is, where a filter of
at most ``FILTER_BYTES`` bytes on the ids cannot tell that nothing needs it.

Defined results: null texts and texts without words have no shingles and stand alone. Rows that repeat
a doc_id are documents with the same id, each judged by its own text; component_id is the smallest
doc_id of the component. A null doc_id is a document of its own: linked with
nothing, kept, its component_id null. Empty tables give empty results, other columns do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ledgerloom.llm import textnum
from ledgerloom.llm.common import FILES, by_batch, few, join_groups, written, written_with
from ledgerloom.llm.exact import passing, sent_filter
from ledgerloom.llm.graph import components

WIDTH = 5
ROWS, BANDS = 6, 30
SIMILARITY = (85, 100)
PIVOTS = 4
# A bucket is hot from this share of the documents, and from this many, so there are 60,000 hot ones at most.
HOT, HOT_LEAST, HOT_PIVOTS = 1000, 64, 2
COUNTED = 1 << 14
# Fixed odd multipliers of the second permutation (32 bits).
FIRST, SECOND, THIRD = 0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35


def circulant_signatures(sets: list[np.ndarray], n: int) -> np.ndarray:
    """The first ``n`` coordinates for each of the non-empty sets, as 32-bit numbers."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    scattered = (textnum.mix64(flat ^ np.uint64(textnum.MIX1)) >> np.uint64(32)).astype(np.uint32)
    signature = np.empty((len(sets), n), np.uint32)
    with np.errstate(over="ignore"):
        base = scattered * np.uint32(FIRST)
        step, image, half = np.uint32(FIRST), np.empty_like(base), np.empty_like(base)
        for k in range(n):
            # The second permutation at scattered + k, a shift in the circle of 32-bit numbers.
            np.add(base, np.uint32(int(step) * k & 0xFFFFFFFF), out=image)
            for factor, down in ((SECOND, 15), (THIRD, 13)):
                np.right_shift(image, np.uint32(down), out=half)
                np.bitwise_xor(image, half, out=image)
                np.multiply(image, np.uint32(factor), out=image)
            np.minimum.reduceat(image, starts, out=signature[:, k])
    return signature


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` coordinates."""
    n, bands = len(signature), signature.shape[1] // rows
    factors = textnum.random_numbers(rows, 23) | np.uint64(1)
    with np.errstate(over="ignore"):
        parts = signature.astype(np.uint64).reshape(n, bands, rows) * factors
        keys = textnum.mix64(parts.sum(axis=2, dtype=np.uint64) + textnum.random_numbers(bands, 29))
    return keys.view(np.int64)


def _mark(text):
    """A hash of the text; with the doc_id it tells rows with different texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _all_sets(column: pa.Array):
    for _, _, data, offsets in textnum.slices(column):
        hashes, rows = textnum.words(data, offsets)
        yield textnum.shingles(hashes, rows, WIDTH)


def signatures(docs: DataFrame, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """doc_id, mark (a hash of the text), n_shingles, digest of the set (null if empty) and the band keys of every row."""

    def work(batch):
        counts, digests, keys = [], [], []
        for sets in _all_sets(batch.column(1)):
            full = [i for i, s in enumerate(sets) if len(s)]
            counts += map(len, sets)
            mine: list = [None] * len(sets)
            marks: list = [None] * len(sets)
            if full:
                for i, key in zip(full, band_keys(circulant_signatures([sets[i] for i in full], rows * bands), rows)):
                    mine[i] = key
                    marks[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
            digests += marks
            keys += mine
        return {"doc_id": batch.column(0), "mark": batch.column(2), "n_shingles": counts, "digest": digests, "bands": keys}

    return by_batch(docs.select("doc_id", "text", _mark("text").alias("mark")), work, "doc_id long, mark long, n_shingles long, digest binary, bands array<long>")


def shingle_sets(docs: DataFrame, sent: Broadcast, n_bits: int) -> DataFrame:
    """doc_id, mark and the sorted set, as bytes, of the rows that the filter sent may have.

    Filter and sets are one function, so that a task keeps one Python worker.
    """

    def work(batch):
        some = batch.filter(pa.array(passing(batch.column(3).to_numpy(), sent, n_bits)))
        items = [s.tobytes() for sets in _all_sets(some.column(1)) for s in sets]
        return {"doc_id": some.column(0), "mark": some.column(2), "items": items}

    rows = docs.select("doc_id", "text", _mark("text").alias("mark")).withColumn("hash", F.xxhash64("doc_id", "mark"))
    return by_batch(rows, work, "doc_id long, mark long, items binary")


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; a pair's sets meet in one row."""
    low, high = similarity
    first = pairs.join(sets.select(F.col("id").alias("a"), F.col("items").alias("left")), "a")
    both = first.join(sets.select(F.col("id").alias("b"), F.col("items").alias("right")), "b")

    def work(batch):
        kept = []
        for left, right in zip(batch.column(2), batch.column(3)):
            x, y = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
            if len(x) > len(y):
                x, y = y, x
            place = np.minimum(np.searchsorted(y, x), len(y) - 1)
            common = int((y[place] == x).sum())
            kept.append(high * common >= low * (len(x) + len(y) - common))
        mask = pa.array(kept, pa.bool_())
        return {"a": batch.column(0).filter(mask), "b": batch.column(1).filter(mask)}

    return by_batch(both.select("a", "b", "left", "right"), work, "a long, b long")


def _could(x: str, y: str, similarity: tuple[int, int]):
    """Whether two set sizes allow the similarity."""
    return similarity[1] * F.least(x, y) >= similarity[0] * F.greatest(x, y)


def _pivots(members: DataFrame, similarity: tuple[int, int], n: int | None = None) -> DataFrame:
    """Pairs of the members of each bucket with its ``PIVOTS`` best connected ones, across components only.

    A document from which many copies were made shares more buckets with them than they share with each
    other, so it links a group that its smallest document left in pieces. At most ``PIVOTS`` pairs a member.
    """
    mixed = members.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("size")).where("x <> y")
    open_ = written(few(members.join(mixed.select("key", "size"), "key"), n and 8 * n), "mixed")
    degrees = open_.groupBy("id").agg(F.sum("size").alias("degree"))
    ranked = open_.join(degrees, "id").withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("degree"), "id")))
    pivots = ranked.where(F.col("rank") <= PIVOTS).groupBy("key", "size").agg(F.collect_list(F.struct("id", "n", "component")).alias("pivots"))
    met = join_groups(open_.drop("size"), written(few(pivots, n and 8 * n), "chosen"), "key", "size", "id").withColumn("pivot", F.explode("pivots"))
    met = met.where((F.col("component") != F.col("pivot.component")) & _could("n", "pivot.n", similarity))
    return met.select(F.greatest("id", "pivot.id").alias("a"), F.least("id", "pivot.id").alias("b")).distinct()


def _hot_keys(same: DataFrame, total: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all hot buckets, sorted, and how many documents at least have each.

    A task counts its documents, ``COUNTED`` at a time, and leaves out keys that fewer than half of the asked share of
    them have, so a sum misses at most half of that share, and no hot key is missed.
    """

    def counted(parts: list[np.ndarray], rows: int) -> pa.RecordBatch:
        one, n = np.unique(np.concatenate(parts), return_counts=True)
        often = n >= max(1, rows // (2 * HOT))
        return pa.RecordBatch.from_pydict({"key": one[often], "n": n[often]})

    def work(batches):
        parts, rows = [], 0
        for batch in batches:
            parts.append(batch.column(0).flatten().to_numpy(zero_copy_only=False))
            rows += len(batch)
            if rows >= COUNTED:
                yield counted(parts, rows)
                parts, rows = [], 0
        if rows:
            yield counted(parts, rows)

    total = same.count() if total is None else total
    # Of many documents together few keys are often enough.
    lists = same.select("bands").coalesce(max(FILES // 2, -(-total // COUNTED)))
    counts = lists.mapInArrow(work, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    found = counts.where(F.col("n") >= max(HOT_LEAST, total // HOT) / 2).orderBy("key").collect()
    return np.array([r.key for r in found], np.int64), np.array([r.n for r in found], np.int64)


def _hits(bands: pa.Array, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All keys of the lists, the list of each, and its place among the hot keys and whether it is one."""
    keys = bands.flatten().to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(bands)), pc.list_value_length(bands).to_numpy())
    if not len(hot):
        return keys, owner, np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    place = np.minimum(np.searchsorted(hot, keys), len(hot) - 1)
    return keys, owner, place, hot[place] == keys


def _hot_pairs(same: DataFrame, hot: np.ndarray, counts: np.ndarray, similarity: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of every document with the ``HOT_PIVOTS`` pivots that it shares most hot buckets with.

    The pivot of a hot bucket is its member whose hot buckets are largest in sum. One row a bucket and batch
    asks for it; the pivots, one a bucket, travel with the tasks.
    """
    low, high = similarity

    def best(batch):
        _, owner, place, hit = _hits(batch.column(2), hot)
        ids, sizes = (batch.column(i).to_numpy() for i in range(2))
        owner, place = owner[hit], place[hit]
        degree = np.bincount(owner, counts[place], minlength=len(ids)).astype(np.int64)
        order = np.lexsort((ids[owner], -degree[owner], place))
        first = np.ones(len(order), bool)
        first[1:] = place[order][1:] != place[order][:-1]
        chosen = owner[order][first]
        return {"place": place[order][first], "degree": degree[chosen], "id": ids[chosen], "n": sizes[chosen]}

    offered = by_batch(same.select("id", "n", "bands"), best, "place long, degree long, id long, n long")
    offered = offered.groupBy("place").agg(F.max(F.struct("degree", (-F.col("id")).alias("minus"), "n")).alias("best"))
    pivots, pivot_sizes = np.zeros(len(hot), np.int64), np.zeros(len(hot), np.int64)
    for row in offered.collect():
        pivots[row.place], pivot_sizes[row.place] = -row.best.minus, row.best.n

    def pair(batch):
        _, owner, place, hit = _hits(batch.column(2), hot)
        ids, sizes = (batch.column(i).to_numpy() for i in range(2))
        owner, place = owner[hit], place[hit]
        n, m = sizes[owner], pivot_sizes[place]
        could = (ids[owner] != pivots[place]) & (high * np.minimum(n, m) >= low * np.maximum(n, m))
        owner, pivot = owner[could], pivots[place[could]]
        both, shared = np.unique(np.stack([owner, pivot]), axis=1, return_counts=True)
        order = np.lexsort((both[1], -shared, both[0]))
        owner, pivot = both[:, order]
        rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
        owner, pivot = owner[rank < HOT_PIVOTS], pivot[rank < HOT_PIVOTS]
        return {"a": np.maximum(ids[owner], pivot), "b": np.minimum(ids[owner], pivot)}

    return by_batch(same.select("id", "n", "bands"), pair, "a long, b long").distinct()


def _parted(rows: DataFrame, hot: np.ndarray) -> DataFrame:
    """id, n and component with the keys of hot buckets and the others apart."""

    def work(batch):
        keys, owner, _, hit = _hits(batch.column(3), hot)

        def lists(chosen):
            ends = np.concatenate(([0], np.cumsum(np.bincount(owner[chosen], minlength=len(batch)))))
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys[chosen]))

        return {"id": batch.column(0), "n": batch.column(1), "component": batch.column(2), "cold": lists(~hit), "hot": lists(hit)}

    return by_batch(rows.select("id", "n", "component", "bands"), work, "id long, n long, component long, cold array<long>, hot array<long>")


def _with_component(rows: DataFrame, found: DataFrame | None) -> DataFrame:
    """The rows with their component, a document without links being its own."""
    if found is None:
        return rows.withColumn("component", F.col("id"))
    joined = rows.join(found.withColumnRenamed("node", "id"), "id", "left")
    return joined.withColumn("component", F.coalesce("component", "id"))


def _joined(found: DataFrame | None, links: DataFrame, n: int) -> DataFrame:
    """The components when further links are known; those found so far go on as stars."""
    links, counted = written_with(few(links, n), "linked", F.count(F.lit(1)).alias("n"))
    if found is not None:
        if not counted["n"]:
            return found
        links = links.union(found.select(F.col("node").alias("a"), F.col("component").alias("b")))
    return written(few(components(links, n), n), "components")


def _members(parted: DataFrame) -> DataFrame:
    """The members of buckets with several components, one row a bucket, with size and smallest document of the bucket.

    No bucket here is hot, so each may meet in one task; buckets cross the network once.
    """
    buckets = parted.select("id", "n", "component", F.explode("cold").alias("key"))
    own = Window.partitionBy("key")
    ends = {"size": F.count(F.lit(1)), "first": F.min("id"), "x": F.min("component"), "y": F.max("component")}
    found = buckets.withColumns({name: f.over(own) for name, f in ends.items()}).where("x <> y").drop("x", "y")
    first = F.col("id") == F.col("first")
    of_first = {"n_first": F.max(F.when(first, F.col("n"))), "c_first": F.max(F.when(first, F.col("component")))}
    return found.withColumns({name: f.over(own) for name, f in of_first.items()})


def _hot_open(hot_docs: DataFrame, found: DataFrame | None, n: int | None = None) -> DataFrame:
    """id and component of the documents whose hot buckets still hold several components."""
    labelled = written(few(_with_component(hot_docs, found), n), "hot")
    ends = labelled.select("component", F.explode("hot").alias("key")).groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    keys = np.array(sorted(r.key for r in ends.where("x <> y").select("key").collect()), np.int64)

    def work(batch):
        _, owner, _, hit = _hits(batch.column(2), keys)
        at = pa.array(np.unique(owner[hit]))
        return {"id": batch.column(0).take(at), "component": batch.column(1).take(at)}

    return by_batch(labelled.select("id", "component", "hot"), work, "id long, component long")


def _open(members: DataFrame) -> DataFrame:
    """id and component of the members (key, id, component) of buckets of three or more with several components."""
    mixed = members.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("n"))
    return members.join(mixed.where("x <> y AND n > 2").select("key"), "key", "left_semi").select("id", "component")


def _rest(open_ids: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs of the documents (id, component) that buckets with several components may still hide, by prefix filtering."""
    low, high = similarity

    def explode(batch):
        ids, items = [], []
        for key, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
            one = np.frombuffer(raw.as_buffer(), np.int64)
            items.append(one)
            ids.append(np.full(len(one), key, np.int64))
        return {"id": np.concatenate(ids), "item": np.concatenate(items)} if ids else None

    items = by_batch(sets.join(open_ids, "id", "left_semi").select("id", "items"), explode, "id long, item long")
    items = written(items, "items")
    counts = items.groupBy("item").agg(F.count(F.lit(1)).alias("n_docs"))
    n = F.count(F.lit(1)).over(Window.partitionBy("id"))
    place = F.row_number().over(Window.partitionBy("id").orderBy("n_docs", "item"))
    # A set of n items shares at least one of its first n - ceil(s n) + 1 with every similar set.
    prefix = items.join(counts, "item").withColumns({"place": place, "n": n})
    prefix = prefix.where((F.col("place") <= F.col("n") - F.ceil(F.col("n") * low / high) + 1) & (F.col("n_docs") > 1))
    prefix = written(prefix.join(open_ids, "id").select("item", "id", "component", "n", (F.col("n") - F.col("place")).alias("after")), "prefix")
    # Rows of an item's most frequent component meet only those of others, so a passage that all copies of
    # a text share costs nothing.
    held = prefix.groupBy("item", "component").agg(F.count(F.lit(1)).alias("rows")).groupBy("item")
    held = held.agg(F.max_by("component", F.struct("rows", "component")).alias("most"), F.count(F.lit(1)).alias("components"))
    few = prefix.join(held.where("components > 1"), "item").where("component <> most")
    left = few.select("item", "most", F.col("id").alias("b"), F.col("component").alias("cb"), F.col("n").alias("nb"), F.col("after").alias("rb"))
    right = prefix.select("item", F.col("id").alias("a"), F.col("component").alias("ca"), F.col("n").alias("na"), F.col("after").alias("ra"))
    # At the first item that two sets share, what follows in both must suffice for the similarity. Rare
    # items come first, so a set with too many items of its own meets none of the others.
    enough = (low + high) * (1 + F.least("ra", "rb")) >= low * (F.col("na") + F.col("nb"))
    once = (F.col("ca") == F.col("most")) | (F.col("cb") < F.col("ca"))
    return left.join(right, "item").where(once & enough & _could("na", "nb", similarity)).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _sets_of(docs: DataFrame, same: DataFrame, ids: DataFrame, n: int | None = None) -> DataFrame:
    """The written sets of the classes ``ids``; texts that no class needs are passed over where they lie, and no text is shuffled."""
    needed = written(few(same.join(ids.distinct(), "id", "left_semi").select("doc_id", "mark", "id"), n), "needed")
    held = sent_filter(needed.select(F.xxhash64("doc_id", "mark").alias("hash")))
    found = shingle_sets(docs, *held).join(needed, ["doc_id", "mark"]).select("id", "items")
    return written(few(found.dropDuplicates(["id"]), n and 4 * n), "sets")


def _classes(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """One row a document: doc_id, mark, n_shingles, component_id and kept."""
    signed, counted = written_with(signatures(docs, rows, bands), "signed", F.count(F.lit(1)).alias("n"))
    n_docs = counted["n"]
    full = signed.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    same = full.groupBy("digest").agg(
        F.min(F.struct("doc_id", "mark")).alias("one"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.count(F.lit(1)).alias("rows")
    )
    # The numbers are fixed by writing them; one doc_id may stand in several classes.
    same = written(few(same.select("digest", "one.doc_id", "one.mark", "n", "bands", "rows", F.monotonically_increasing_id().alias("id")), n_docs), "same")
    n = same.count()
    hot, counts = _hot_keys(same, n)
    found = sets = None
    if len(hot):
        parts = written(few(_hot_pairs(same, hot, counts, similarity), n), "hot_pairs")
        sets = _sets_of(docs, same, parts.select(F.col("a").alias("id")).union(parts.select("b")), n)
        found = _joined(None, confirmed(parts, sets, similarity), n)
    parted = _parted(_with_component(same, found), hot)
    if len(hot):
        parted = written(few(parted, n), "parted")
    members = written(few(_members(parted), n and 8 * n), "members")
    pairs = members.where((F.col("component") != F.col("c_first")) & _could("n", "n_first", similarity))
    pairs = written(few(pairs.select(F.col("id").alias("a"), F.col("first").alias("b")).distinct(), n), "pairs")
    open_members = members.where("size > 2").select("key", "id", "n")
    needed = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(open_members.select("id"))
    if len(hot):
        hot_docs = written(few(parted.where(F.size("hot") > 0).select("id", "hot", "component"), n), "hot_docs")
        needed = needed.union(_hot_open(hot_docs.drop("component"), found, n).select("id"))
        sets = sets.union(_sets_of(docs, same, needed.join(sets.select("id"), "id", "left_anti"), n))
    else:
        sets = _sets_of(docs, same, needed, n)
    found = _joined(found, confirmed(pairs, sets, similarity), n)
    pivots = written(few(_pivots(_with_component(open_members, found), similarity, n), n), "pivots")
    found = _joined(found, confirmed(pivots, sets, similarity), n)
    open_ids = _open(_with_component(open_members, found))
    if len(hot):
        open_ids = open_ids.union(_hot_open(hot_docs.drop("component"), found, n))
    open_ids = written(few(open_ids.distinct(), n), "open")
    found = _joined(found, confirmed(_rest(open_ids, sets, similarity), sets, similarity), n)
    named = found.withColumnRenamed("node", "id").join(same.select("id", "digest", "doc_id"), "id")
    labels = written(few(named.groupBy("component").agg(F.min("doc_id").alias("label"), F.count(F.lit(1)).alias("size")), n), "labels")
    named = join_groups(named, labels, "component", "size", "id").select("digest", "label")
    result = same.join(named, "digest", "left").select("digest", "rows", F.coalesce("label", "doc_id").alias("component"))
    # Sets that very many rows have are dealt in parts; rows without a set meet nothing.
    joined = join_groups(full.drop("bands"), written(few(result, n), "classes"), "digest", "rows", "doc_id").drop("rows")
    alone = signed.where("digest IS NULL OR doc_id IS NULL").drop("bands").withColumn("component", F.lit(None).cast("long"))
    joined = joined.unionByName(alone)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return joined.select("doc_id", "mark", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def classes(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id and kept."""
    return _classes(docs, similarity, rows, bands).drop("mark")


def deduplicate(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """The rows whose document stays, with all their columns.

    Only ids and text hashes of dropped rows are joined. They are written first, so the planner knows their
    size: while it allows a broadcast no text is shuffled, beyond that the rows meet them by a shuffle.
    """
    dropped = _classes(docs, similarity).where("NOT kept").select(F.col("doc_id").alias("dropped"), F.col("mark").alias("dropped_mark"))
    dropped = written(dropped.distinct(), "dropped")
    return docs.join(dropped, (docs["doc_id"] == dropped["dropped"]) & (_mark(docs["text"]) == dropped["dropped_mark"]), "left_anti")
