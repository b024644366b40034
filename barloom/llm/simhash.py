"""SimHash near-duplicates, joined exactly through vantage-point trees.

A fingerprint has 64 bits. Two fingerprints at most ``max_bits`` apart agree on at least one of
``max_bits + 1`` groups of bits. There is one tree for each group. Its upper nodes measure distances
inside the group, where linked fingerprints are equally far from every vantage point, so no link
crosses a boundary there. Once a group no longer splits the sample, nodes measure the distance of whole
fingerprints, and the triangle bound sends a fingerprint to both sides of a boundary that lies within
``max_bits`` of it. The trees are fitted on the driver to about ``sample`` distinct fingerprints (chosen by
their hashes), so their size does not grow with the data. Shards do: a leaf that the whole table would fill with
more than ``SHARD`` fingerprints is dealt into several shards by a hash of the bits of its tree's group, on which
linked fingerprints agree, and larger tables take more and wider groups (:func:`groups_for`). Every fingerprint is
routed and every pair of each shard compared.

Whole-fingerprint nodes need fingerprints that stand in clusters: the distances of unrelated ones are 32 give or take 4,
so a boundary with a margin of 4 on both sides would copy nearly all of them (figures in the README).

A shard of more than ``block`` fingerprints is cut into blocks, and pairs of blocks are compared in
separate tasks. A task returns a spanning forest of the links it found, never all pairs.

Defined results: a null or empty text has fingerprint 0 and links like any other; repeated rows each get
a row; a null id never becomes a component id while the component has another; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.columns import free_names
from barloom.llm.graph import components
from barloom.llm.sampling import hashed_sample
from barloom.session import stage

BITS = 64
CHUNK = 1 << 16
SHARD = 512
FULL = np.uint64(2**64 - 1)


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """The fingerprint of one text, as an unsigned number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space count
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    starts, ends = starts[:len(words) - k + 1], ends[k - 1:]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for i in range(0, len(starts), CHUNK):
        pairs = zip(starts[i:i + CHUNK].tolist(), ends[i:i + CHUNK].tolist())
        hashes = np.array([digest(joined[s:e], seed) for s, e in pairs], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """``doc_id, text_key, fp`` for each row; ``text_key`` tells rows of one id with different texts apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(marks.view(np.int64))], ["doc_id", "text_key", "fp"])

    given = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    schema = T.StructType([given.schema["doc_id"], T.StructField("text_key", T.LongType()), T.StructField("fp", T.LongType())])
    return given.mapInArrow(run, schema)


def masks(groups: int, max_bits: int) -> list[int]:
    """Bit masks of which linked fingerprints agree on at least one."""
    edges = np.linspace(0, BITS, groups + 1).astype(int)
    parts = [((1 << int(b - a)) - 1) << int(a) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, groups - max_bits)]


def groups_for(total: int, max_bits: int) -> int:
    """How many groups of bits, so that the bits of ``groups - max_bits`` of them tell ``total`` fingerprints apart well:
    at most about 500 random ones share them."""
    groups = max_bits + 1
    while groups < 2 * max_bits and total >> (BITS * (groups - max_bits) // groups) > 500:
        groups += 1
    return groups


class Forest:
    """Vantage-point trees, one for each mask, as flat nodes.

    A leaf has shards for its part of ``total`` fingerprints; they are numbered through.
    """

    def __init__(self, sample: np.ndarray, groups: int, max_bits: int, leaf: int, total: int = 0):
        self.nodes: list[tuple] = []  # mask, vantage point, threshold, margin, left, right; a child < 0 is leaf -1 - child
        self.leaves: list[tuple] = []  # mask, first shard, number of shards
        self.shards, self.max_bits, self.leaf = 0, max_bits, leaf
        self.share = max(1.0, total / max(1, len(sample)))
        self.random = np.random.default_rng(7)
        self.roots = [self._grow(sample, np.uint64(m)) for m in masks(groups, max_bits)]

    def _leaf(self, sample: np.ndarray, mask: np.uint64) -> int:
        shards = max(1, int(len(sample) * self.share / SHARD))
        self.leaves.append((mask, self.shards, shards))
        self.shards += shards
        return -len(self.leaves)

    def _grow(self, sample: np.ndarray, mask: np.uint64) -> int:
        if len(sample) <= self.leaf:
            return self._leaf(sample, mask)
        found = self._split(sample, mask, 0) or self._split(sample, FULL, self.max_bits)
        if not found:
            return self._leaf(sample, mask)
        at, distance = len(self.nodes), found[-1]
        mask_used, vantage, limit, margin = found[:4]
        self.nodes.append(())
        left = self._grow(sample[distance - margin <= limit], mask)
        right = self._grow(sample[distance + margin > limit], mask)
        self.nodes[at] = (mask_used, vantage, limit, margin, left, right)
        return at

    def _split(self, sample: np.ndarray, mask: np.uint64, margin: int):
        """The candidate whose larger side, copies included, is smallest; none if it keeps 0.8 of the sample."""
        best, most = None, 0.8 * len(sample)
        for vantage in self.random.choice(sample, min(8, len(sample)), replace=False):
            distance = np.bitwise_count((sample ^ vantage) & mask).astype(np.int64)
            limit = int(np.median(distance))
            for t in (limit - 1, limit):
                larger = max(np.sum(distance - margin <= t), np.sum(distance + margin > t))
                if larger < most:
                    best, most = (mask, vantage, t, margin, distance), larger
        return best

    def route(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices into ``fps`` and the shards they go to."""
        rows, shards, todo = [], [], [(r, np.arange(len(fps))) for r in self.roots]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            if node < 0:
                mask, first, number = self.leaves[-1 - node]
                mixed = (fps[at] & mask) * np.uint64(0x9E3779B97F4A7C15)
                mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)  # high groups have only high bits so far
                rows.append(at)
                shards.append(first + ((mixed ^ mixed >> np.uint64(32)) % np.uint64(number)).astype(np.int64))
                continue
            mask, vantage, limit, margin, left, right = self.nodes[node]
            distance = np.bitwise_count((fps[at] ^ vantage) & mask).astype(np.int64)
            todo += [(left, at[distance - margin <= limit]), (right, at[distance + margin > limit])]
        return (np.concatenate(rows), np.concatenate(shards)) if rows else (np.empty(0, np.int64),) * 2


def spanning_links(a: np.ndarray, b: np.ndarray | None, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside ``a``, or between ``a`` and ``b``."""
    fps = a if b is None else np.concatenate([a, b])
    parent, shift, other = np.arange(len(fps)), 0 if b is None else len(a), a if b is None else b
    step = max(1, (1 << 21) // max(1, len(other)))
    for i in range(0, len(a), step):
        x, y = np.nonzero(np.bitwise_count(a[i:i + step, None] ^ other[None, :]) <= max_bits)
        _join(parent, x + i, y + shift)
    child = np.flatnonzero(parent != np.arange(len(fps)))
    return fps[child], fps[parent[child]]


def _join(parent: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Merge the sets of x[i] and y[i]; afterwards every entry is its root."""
    while len(x):
        x, y = parent[x], parent[y]
        apart = x != y
        x, y = x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := parent[parent], parent):
            parent[:] = up


def links(reps: DataFrame, max_bits: int = 4, groups: int | None = None, sample: int = 16_384, leaf: int = 64,
          block: int = 8_192) -> DataFrame:
    """Links ``a, b`` whose components are those of all fingerprint pairs at most ``max_bits`` apart.

    ``reps`` has distinct ``fp``. More ``groups`` than ``max_bits + 1`` make more and finer trees.
    """
    spark, total = reps.sparkSession, reps.count()
    drawn = hashed_sample(reps.select("fp"), ["fp"], sample).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    forest = Forest(np.sort(drawn), groups or groups_for(total, max_bits), max_bits, leaf, total)
    shared = spark.sparkContext.broadcast(forest)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            rows, shards = shared.value.route(fps.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(shards), pa.array(fps[rows])], ["shard", "fp"])

    routed = reps.select("fp").mapInArrow(route, "shard long, fp long")
    large = stage(routed.groupBy("shard").agg(F.ceil(F.count("*") / block).alias("blocks")).where("blocks > 1"), "large-shards")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    placed = routed.join(large, "shard", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
    spread = placed.select("shard", "fp", own.alias("own"), F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("with"))
    keyed = spread.select("shard", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "fp")

    def compare(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().astype(np.int64).view(np.uint64)
        own, i, j = (table.column(c).to_numpy() for c in ("own", "i", "j"))
        first = own == i
        a, b = spanning_links(fps[first], None if i[0] == j[0] else fps[~first], max_bits)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return keyed.groupBy("shard", "i", "j").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4,
                    seed: int = 42, **tree) -> DataFrame:
    """``doc_id, text_key, fp, root, component_id`` for each row.

    ``root`` is the component as a fingerprint, ``component_id`` the smallest id in it.
    """
    marked = stage(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    reps = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-classes")
    found = components(links(reps, max_bits, **tree))
    rooted = reps.join(found, reps.fp == found.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(smallest, "root").select("fp", "root", "component_id")
    return marked.join(classes, "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each component, that with the smallest id (null last, then the smallest text hash); all columns as they came."""
    of_id, of_key, text_key = free_names(docs, "id", "key", "text_key")
    classes = stage(near_duplicates(docs, id_col, text_col, **options), "classes")
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_key")
    kept = stage(classes.groupBy("root").agg(F.min(order).alias("k")).select(
        F.col("k.doc_id").alias(of_id), F.col("k.text_key").alias(of_key)), "kept")
    mine = kept.toDF("kept_id", "kept_key")
    repeated = classes.groupBy("doc_id", "text_key").count().where("count > 1").join(
        mine, F.col("kept_id").eqNullSafe(F.col("doc_id")) & (F.col("kept_key") == F.col("text_key")), "left_semi")
    joined = docs.withColumn(text_key, F.xxhash64(text_col)).join(
        kept, F.col(id_col).eqNullSafe(F.col(of_id)) & (F.col(text_key) == F.col(of_key)))
    if not repeated.isEmpty():  # a kept row that the table holds more than once
        joined = joined.dropDuplicates([of_id, of_key])
    return joined.select(*[f"`{c}`" for c in docs.columns])
