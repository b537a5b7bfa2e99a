"""SimHash near-duplicates with BK-trees.

Fingerprints of 64 bits are deduplicated; each distinct one goes to one shard for every choice of some of its bit
blocks. Two fingerprints that differ in few bits agree on at least one such choice, so every link lies within a
shard. A shard has a BK-tree: children are keyed by their integer Hamming distance to the parent, and a search
follows only edges within the radius of the query's distance. Trees and searches of many shards run together
over numpy arrays. A shard above the limit is cut into chunks, whose trees are sent to the other chunks of the
shard in pairs. A shard returns a spanning forest of its links, never all pairs; components of all
links are then found on the whole graph. Trees aren't broadcast: together they hold the fingerprints of all
documents, which would have to pass through the driver; shards are shuffled instead.

Nulls and edge cases: a null or empty text, or one of white space only, has fingerprint zero, linked like any
other; a text with fewer words than a shingle is one shingle; documents with equal ids and texts are alike; ids
may be of any type that has an order; a document whose id is null takes part, but a component is named by its smallest id that isn't null, and has none
if all are. Very long texts are hashed whole, a part of the shingles at a time. Columns other than those asked
for are kept by `keep_one` and ignored by `near_duplicates`.

`keep_one` asks for Jaccard similarity instead of a number of bits: its candidates come from the BK-trees and from
MinHash buckets, and each is verified by the exact sets of word shingles. Documents without an id are told apart by
their texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.components import components
from . import linededup
from .common import cut, join_named, maybe_in, ship, text_of

#: Shards above so many fingerprints are cut into chunks of half as many.
LIMIT = 1024
#: Up to so many large shards their list (key and count) is broadcast; beyond it Spark joins by shuffling.
MAX_BROADCAST = 100_000
SLICE = 1 << 17
#: MinHash of `similar_texts`: at similarity 0.8 twelve bands of four minima hold 99.8 % of the pairs.
BANDS, ROWS = 12, 4
#: A bucket of up to so many texts compares all pairs at once.
ALL_PAIRS = 4
_numbers = np.random.default_rng(42).integers(0, 1 << 64, (2, BANDS * ROWS), np.uint64)
FLIPS, ODDS = list(_numbers[0]), list(_numbers[1] | np.uint64(1))


def _hashes(text: str | None, shingle: int, seed: int = 42) -> Iterator[np.ndarray]:
    """XXH64 of the shingles, a part at a time; nothing for a text without words."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and ASCII white space
    if not words:
        return
    if len(words) < shingle:
        words, shingle = [b" ".join(words)], 1
    grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    hashes = map(partial(xxhash.xxh64_intdigest, seed=seed), grams)
    while len(part := np.fromiter(islice(hashes, SLICE), np.uint64)):
        yield part


def _majority(parts: Iterable[np.ndarray]) -> int:
    n, ones = 0, np.zeros(64, np.int64)
    for part in parts:
        n += len(part)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def simhash(text: str | None, shingle: int, seed: int = 42) -> int:
    """The fingerprint: a bit is set if over half of the shingles' XXH64 have it."""
    return _majority(_hashes(text, shingle, seed))


def fingerprints(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """doc_id and the fingerprint fp, a long with the 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([simhash(t.as_py(), shingle) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    ship(docs.sparkSession)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("fp", T.LongType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


class Forest:
    """BK-trees over the fingerprints x, one for each value of tree."""

    def __init__(self, x: np.ndarray, tree: np.ndarray):
        self.x = x
        self.roots: dict[int, int] = {}
        keys, kids = [], []
        # Level by level: the first of a group becomes a node; the rest split by their distance to it.
        rest, group, first_level = np.arange(len(x)), tree.astype(np.int64), True
        while len(rest):
            _, first, place = np.unique(group, return_index=True, return_inverse=True)
            node = rest[first]
            if first_level:
                self.roots = dict(zip(group[first].tolist(), node.tolist(), strict=True))
            else:
                keys.append(group[first])
                kids.append(node)
            parent = node[place]
            inner = np.ones(len(rest), bool)
            inner[first] = False
            rest, parent = rest[inner], parent[inner]
            group, first_level = parent * 65 + np.bitwise_count(x[rest] ^ x[parent]), False
        key, kid = (np.concatenate(a) if a else np.empty(0, np.int64) for a in (keys, kids))
        order = np.argsort(key)
        self.key, self.kid = key[order], kid[order]

    def search(self, q: np.ndarray, tree: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a query's place and a member within the radius in its tree."""
        roots = np.array([self.roots.get(t, -1) for t in tree.tolist()], np.int64)
        work = [(np.flatnonzero(roots >= 0), roots[roots >= 0])]
        at: list[np.ndarray] = []
        to: list[np.ndarray] = []
        while work:
            i, node = work.pop()
            if len(i) > SLICE:
                work += [(i[k : k + SLICE], node[k : k + SLICE]) for k in range(0, len(i), SLICE)]
                continue
            d = np.bitwise_count(q[i] ^ self.x[node]).astype(np.int64)
            near = d <= radius
            at.append(i[near])
            to.append(node[near])
            low = np.searchsorted(self.key, node * 65 + np.maximum(d - radius, 0))
            n = np.searchsorted(self.key, node * 65 + np.minimum(d + radius, 64), "right") - low
            if n.any():
                spread = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
                work.append((np.repeat(i, n), self.kid[spread]))
        return np.concatenate(at), np.concatenate(to)


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n places the smallest place it is linked to, directly or not."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links(left: list, right: list, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of shards: within each left list, or between the components of a left and a right list."""
    size = np.array([len(x) for x in left])
    x = np.concatenate([np.asarray(v, np.int64) for v in left]).view(np.uint64)
    tree = np.repeat(np.arange(len(left)), size)
    forest = Forest(x, tree)
    own = spanning(len(x), *forest.search(x, tree, radius))
    single = np.array([r is None for r in right])
    here = np.flatnonzero((own != np.arange(len(x))) & single[tree])
    a, b = [x[here]], [x[own[here]]]
    if not single.all():
        y = np.concatenate([np.asarray(v, np.int64) for v in right if v is not None]).view(np.uint64)
        of = np.repeat(np.flatnonzero(~single), [len(v) for v in right if v is not None])
        other = spanning(len(y), *Forest(y, of).search(y, of, radius))
        i, j = forest.search(y, of, radius)
        pairs = np.unique(np.stack([other[i], own[j]]), axis=1)
        a.append(y[pairs[0]])
        b.append(x[pairs[1]])
    return np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)


def _blocks(n: int, radius: int) -> list[tuple[int, int]]:
    """(masks of the chosen bits, place) of each choice of blocks that a linked pair may agree on."""
    cuts = [round(64 * i / n) for i in range(n + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [(sum(c), k) for k, c in enumerate(combinations(masks, n - radius))]


def _choices(n: int, radius: int) -> list[tuple[int, int]]:
    """More blocks make smaller shards and more copies: the fewest with which at most about 64 of n random
    fingerprints share a shard, and no more than twice the radius."""
    for blocks in range(radius + 1, 2 * radius + 1):
        choices = _blocks(blocks, radius)
        if n <= 64 << min(mask.bit_count() for mask, _ in choices):
            break
    return choices


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def links(fps: DataFrame, radius: int = 4) -> DataFrame:
    """a, b: links between distinct fingerprints (column fp) that hold together all that are within the radius."""
    n = fps.count()
    choices = _choices(n, radius)
    keyed = fps.select(
        "fp",
        F.explode(
            F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits")) for m, k in choices])
        ).alias("key"),
    ).select("key.k", "key.bits", "fp")
    large = cut(keyed.groupBy("k", "bits").count().where(F.col("count") > LIMIT))
    chunks = (2 * F.col("count") / LIMIT).cast("int") + 1
    large = large.select("k", "bits", chunks.alias("chunks"))
    n_large = large.count()
    if n_large:
        known = F.broadcast(large) if n_large <= MAX_BROADCAST else large
        keyed = keyed.join(known, ["k", "bits"], "left")
    else:
        keyed = keyed.withColumn("chunks", F.lit(None).cast("int"))
    chunk = F.coalesce(F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"), F.lit(0))
    shards = keyed.groupBy("k", "bits", "chunks", chunk.alias("chunk")).agg(F.collect_list("fp").alias("own"))
    if n_large:
        shards = cut(shards.where((F.size("own") > 1) | F.col("chunks").isNotNull()))
        pairs = shards.where("chunks is not null")
        left = pairs.withColumn("other", F.explode(F.sequence("chunk", F.col("chunks") - 1))).where("other > chunk")
        right = pairs.select("k", "bits", F.col("chunk").alias("other"), F.col("own").alias("far"))
        # Each pair is a row of two chunks; they are dealt out evenly, since the pairs of a shard meet by its key.
        across = left.join(right, ["k", "bits", "other"]).select("own", "far")
        work = shards.where(F.size("own") > 1).select("own", F.lit(None).cast("array<bigint>").alias("far")).union(across)
    else:
        work = shards.where(F.size("own") > 1).select("own", F.lit(None).cast("array<bigint>").alias("far"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(a) + (len(b) if b.is_valid else 0) for a, b in zip(batch.column(0), batch.column(1))])
            part = np.cumsum(sizes) // (SLICE // 8)
            for p in np.unique(part):
                rows = np.flatnonzero(part == p)
                some = batch.slice(rows[0], len(rows))
                left = [v.values.to_numpy() for v in some.column(0)]
                right = [v.values.to_numpy() if v.is_valid else None for v in some.column(1)]
                a, b = _links(left, right, radius)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    ship(fps.sparkSession)
    return work.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 5, radius: int = 4) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable over links of fingerprints within the radius)."""
    prints = cut(fingerprints(docs, shingle))
    first = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = cut(components(links(first.select("fp"), radius)).withColumnRenamed("node", "fp"))
    linked = cut(first.join(roots, "fp"))  # a fingerprint without links is named by its own documents
    names = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    named = join_named(linked, names, "root").select("fp", "component_id")
    named = cut(named.union(first.join(roots, "fp", "left_anti").select("fp", F.col("first").alias("component_id"))))
    return join_named(prints, named, "fp").select("doc_id", "fp", "component_id")


def _bands(parts: list[np.ndarray]) -> np.ndarray:
    """A bucket for each band of a few minima of the shingles' hashes."""
    import xxhash

    if not parts:
        parts = [np.zeros(1, np.uint64)]
    minima = [min(int(((part ^ flip) * odd).min()) for part in parts) for flip, odd in zip(FLIPS, ODDS)]
    rows = np.array(minima, np.uint64).reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), seed=band) for band, r in enumerate(rows)], np.uint64).view(np.int64)


def sketches(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """id (a text's hash), fp and the MinHash buckets of each distinct text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, buckets = [], []
            for t in batch.column(1):
                parts = list(_hashes(t.as_py(), shingle))
                fps.append(_majority(parts))
                buckets.append(_bands(parts).tolist())
            fps = pa.array(np.array(fps, np.uint64).view(np.int64))
            columns = [batch.column(0), fps, pa.array(buckets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "fp", "buckets"])

    ship(docs.sparkSession)
    rows = docs.select(F.xxhash64(text_of()).alias("id"), "text").mapInArrow(run, "id long, fp long, buckets array<long>")
    return rows.dropDuplicates(["id"])


def _sets(docs: DataFrame, needed: DataFrame, shingle: int) -> DataFrame:
    """id and the set of shingle hashes of the texts asked for; a text without words has one shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                parts = list(_hashes(batch.column(1)[k].as_py(), shingle)) or [np.zeros(1, np.uint64)]
                values = pa.array(np.unique(np.concatenate(parts)).view(np.int64))
                sets = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), sets], names=["id", "set"])

    ship(docs.sparkSession)
    texts = maybe_in(docs.select(F.xxhash64(text_of()).alias("id"), "text"), "id", needed)
    texts = texts.dropDuplicates(["id"]).join(needed, "id", "left_semi")
    return texts.select("id", "text").mapInArrow(run, "id long, set array<long>")


def similar_texts(docs: DataFrame, shingle: int = 5, radius: int = 4, similarity: float = 0.8) -> DataFrame:
    """node, root: the components of texts (by hash) linked where their sets of word shingles have at least the Jaccard
    similarity.

    Candidates are fingerprints within the radius, by BK-trees, and texts that share a MinHash bucket: at
    similarity 0.8 fingerprints differ in ten bits on average, where bit blocks select nothing."""
    every = cut(sketches(docs, shingle))
    first = cut(every.groupBy("fp").agg(F.min("id").alias("first")))
    a, b = first.select(F.col("fp").alias("a"), F.col("first").alias("i")), first.select(F.col("fp").alias("b"), F.col("first").alias("j"))
    near = links(first.select("fp"), radius).distinct().join(a, "a").join(b, "b").select("i", "j")
    near = near.union(join_named(every, first, "fp").select("id", "first")).toDF("i", "j").where("i != j")
    near = near.select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b"))
    keyed = every.select("id", F.explode("buckets").alias("bucket")).select("bucket", "id")
    return linededup.roots_in_buckets(keyed, lambda needed: _sets(docs, needed, shingle), similarity, ALL_PAIRS, near)


def keep_one(docs: DataFrame, shingle: int = 5, radius: int = 4, similarity: float = 0.8) -> DataFrame:
    """One document of each component of similar texts, with the columns of ``docs``: that with the smallest id,
    then the smallest text hash; ids that are null come last. Rows with equal id and text are one document."""
    roots = similar_texts(docs, shingle, radius, similarity).withColumnRenamed("node", "text_id")
    text_id = F.xxhash64(text_of())
    named = docs.select("doc_id", text_id.alias("text_id")).distinct().join(roots, "text_id", "left")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_id")
    first = named.groupBy(F.coalesce("root", "text_id").alias("root")).agg(F.min(order).alias("f"))
    kept = cut(first.select(F.col("f.doc_id").alias("__kept"), F.col("f.text_id").alias("__kept_text")))
    rows = docs.withColumn("__text", text_id)
    here = rows["doc_id"].eqNullSafe(kept["__kept"]) & (rows["__text"] == kept["__kept_text"])
    return rows.join(kept, here, "left_semi").dropDuplicates(["doc_id", "__text"]).drop("__text")
