"""Approximate nearest neighbours by inner product, with a forest of random-projection trees.

The largest inner product becomes the smallest distance after one more coordinate lifts every vector to the
length of the longest, so trees split space by the median projection on random directions. The trees are
fitted on the driver to about ``sample`` vectors (chosen by their hashes, and about 64 MB of them at most),
which bounds the forest; every vector is then routed to its leaf in each tree. A query, scaled to the longest
length (which leaves the order of inner products as it is), walks all trees through one priority queue ordered by how far it lies from the splits passed over, until it has ``probes``
leaves. All vectors of those leaves are scored exactly in double precision.

Equal vectors are one class: a class keeps its ``k + 1`` smallest ids (limited before the shuffle), which is
all a result can need, so neither a vector nor a query that a third of the rows share piles up. A leaf with
more than ``block`` vectors or queries is cut into blocks, and pairs of blocks are scored in separate tasks.

Defined results: null vectors and ids, vectors with null or non-finite components, zero vectors and vectors
of another than the commonest length (ties: the shorter) take no part; rows that repeat an id and its vector
count once; a query never finds its own id; other columns are ignored; fewer candidates give fewer rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from barloom.llm.sampling import hashed_sample
from barloom.session import stage

ROUTED = "cell int, query boolean, k1 long, k2 long, rep long, vector binary"
FOUND = "q1 long, q2 long, k1 long, k2 long, rep long, score double"


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


class Forest:
    """Random-projection trees as flat nodes; a child below 0 is leaf -1 - child."""

    def __init__(self, sample: np.ndarray, trees: int, leaf: int, longest: float):
        self.longest, self.leaf, self.leaves = longest, leaf, 0
        self.random = np.random.default_rng(11)
        self.directions: list[np.ndarray] = []
        self.limits: list[float] = []
        self.children: list[tuple[int, int]] = []
        lifted = self.lift(sample)
        self.roots = [self._grow(lifted) for _ in range(trees)]
        self.directions = np.array(self.directions).reshape(len(self.limits), sample.shape[1] + 1)
        self.limits = np.array(self.limits)
        self.children = np.array(self.children, np.int64).reshape(-1, 2)

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Vectors with the coordinate that makes them as long as the longest."""
        return np.column_stack([x, np.sqrt(np.maximum(self.longest**2 - (x**2).sum(axis=1), 0))])

    def _grow(self, x: np.ndarray) -> int:
        if len(x) > self.leaf:
            for _ in range(4):  # a direction that does not part the vectors is drawn anew
                direction = self.random.normal(size=x.shape[1])
                direction /= np.linalg.norm(direction)
                along = x @ direction
                limit = float(np.median(along))
                low = along < limit
                if low.any():
                    at = len(self.limits)
                    self.directions.append(direction)
                    self.limits.append(limit)
                    self.children.append((0, 0))
                    self.children[at] = (self._grow(x[low]), self._grow(x[~low]))
                    return at
        self.leaves += 1
        return -self.leaves

    def route(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every vector in each tree; a vector is compared with the nodes on its way alone."""
        lifted = self.lift(x)
        node = np.tile(np.array(self.roots, np.int64), (len(x), 1))
        while (inner := node >= 0).any():
            row, tree = np.nonzero(inner)
            at = node[row, tree]
            low = np.einsum("ij,ij->i", lifted[row], self.directions[at]) < self.limits[at]
            node[row, tree] = self.children[at, np.where(low, 0, 1)]
        return (-1 - node).astype(np.int32)

    def search(self, query: np.ndarray, probes: int) -> list[int]:
        """The first leaves that a queue shared by all trees gives for a query."""
        query = query / np.abs(query).max()
        query = query * (self.longest / np.linalg.norm(query))  # the limits are those of vectors as long as the longest
        margin = self.directions[:, :-1] @ query - self.limits if len(self.limits) else np.empty(0)
        queue, found = [(0.0, root) for root in self.roots], []
        while queue and len(found) < probes:
            passed, node = heapq.heappop(queue)
            while node >= 0:
                near, far = (0, 1) if margin[node] < 0 else (1, 0)
                heapq.heappush(queue, (max(passed, abs(margin[node])), int(self.children[node, far])))
                node = int(self.children[node, near])
            found.append(-1 - node)
        return found


def _vectors(column, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, size)


def _best(query: np.ndarray, data: np.ndarray, rough: np.ndarray, order: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best rows by score, then by ``order``; ``rough`` scores choose which are scored row by row."""
    if len(rough) > k:
        limit = np.partition(rough, len(rough) - k)[len(rough) - k]
        at = np.flatnonzero(rough >= limit - 1e-9 * max(1.0, float(np.abs(rough).max())))
    else:
        at = np.arange(len(rough))
    score = (data[at] * query).sum(axis=1)
    chosen = np.lexsort((order[at], -score))[:k]
    return at[chosen], score[chosen]


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", trees: int = 8,
           sample: int = 16_384, leaf: int = 512, probes: int = 36, block: int = 8_192) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``vectors`` that ``is_query`` (on ``vec_id``) selects."""
    doubles = F.col(vector_col).cast("array<double>")
    given = vectors.select(F.col(id_col).cast("long").alias("vec_id"), doubles.alias("vector")).where(
        F.col("vec_id").isNotNull() & usable(F.col("vector")))
    given = given.select("vec_id", F.xxhash64("vector").alias("k1"), F.xxhash64(F.lit(1), "vector").alias("k2"), "vector")
    common = given.groupBy(F.size("vector").alias("size")).agg(
        F.count("*").alias("n"), F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))).alias("longest"))
    common = common.orderBy(F.desc("n"), "size").first()
    if common is None:
        return given.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    size = common["size"]
    given = given.where(F.size("vector") == size)
    order = W.partitionBy("k1", "k2").orderBy("vec_id")
    ids = given.select("vec_id", "k1", "k2").distinct()
    kept = ids.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    classes = stage(kept.groupBy("k1", "k2").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "vector-classes")
    first = classes.select("k1", "k2", F.col("ids")[0].alias("vec_id"))
    reps = stage(given.join(first, ["vec_id", "k1", "k2"]).dropDuplicates(["k1", "k2"]).select(
        "k1", "k2", F.col("vec_id").alias("rep"), "vector"), "vectors")
    asked = ids.where(is_query)
    query_classes = reps.join(asked.select("k1", "k2").distinct(), ["k1", "k2"])

    limit = max(1, min(sample, (64 << 20) // (8 * size)))
    drawn = hashed_sample(reps, ["k1", "k2"], limit).select("k1", "vector").toArrow().sort_by("k1")["vector"].combine_chunks()
    forest = Forest(np.asarray(drawn.flatten(), np.float64).reshape(-1, size), trees, leaf, float(common["longest"]))
    shared = vectors.sparkSession.sparkContext.broadcast(forest)

    def route(querying: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for begin in range(0, whole.num_rows, 1024):
                    batch = whole.slice(begin, 1024)
                    x = np.asarray(batch.column(3).flatten(), np.float64).reshape(-1, size)
                    if querying:
                        found = [shared.value.search(q, probes) for q in x]
                        rows, cells = np.repeat(np.arange(len(x)), [len(f) for f in found]), np.concatenate(found)
                    else:
                        rows, cells = np.repeat(np.arange(len(x)), trees), shared.value.route(x).ravel()
                    packed = pa.array([v.tobytes() for v in x], pa.binary())
                    at = pa.array(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cells.astype(np.int32)), pa.array(np.full(len(rows), querying)), batch.column(0).take(at),
                         batch.column(1).take(at), batch.column(2).take(at), packed.take(at)],
                        ["cell", "query", "k1", "k2", "rep", "vector"])
        return run

    columns = ["k1", "k2", "rep", "vector"]
    routed = reps.select(columns).mapInArrow(route(False), ROUTED).unionByName(query_classes.select(columns).mapInArrow(route(True), ROUTED))
    routed = stage(routed, "routed-vectors")
    sizes = routed.groupBy("cell").agg(  # a row for each leaf of the forest
        F.ceil(F.count_if(~F.col("query")) / block).alias("rows"), F.ceil(F.count_if("query") / block).alias("asks"))
    own = F.xxhash64("k2", "k1")
    i, j = F.pmod(own, F.greatest("rows", F.lit(1))), F.pmod(own, F.greatest("asks", F.lit(1)))

    def everywhere(n: str) -> Column:
        return F.sequence(F.lit(0).cast("long"), F.col(n) - 1)

    blocks = routed.join(F.broadcast(sizes.where("rows > 0 and asks > 0")), "cell")
    blocks = blocks.withColumn("other", F.explode(F.when(F.col("query"), everywhere("rows")).otherwise(everywhere("asks"))))
    blocks = blocks.select("cell", F.when(F.col("query"), F.col("other")).otherwise(i).alias("i"),
                           F.when(F.col("query"), j).otherwise(F.col("other")).alias("j"), "query", *columns)

    def score(rows: pa.Table) -> pa.Table:
        asks = rows.column("query").to_numpy()
        at = {name: rows.column(name).to_numpy() for name in ("k1", "k2", "rep")}
        x = _vectors(rows.column("vector"), size)
        asked_at, data_at = np.flatnonzero(asks), np.flatnonzero(~asks)
        data, out = x[data_at], []
        step = max(1, (1 << 21) // max(1, len(data)))
        for begin in range(0, len(asked_at), step):
            some = asked_at[begin:begin + step]
            for q, rough in zip(some, x[some] @ data.T):
                best, value = _best(x[q], data, rough, at["rep"][data_at], k + 1)
                n = len(best)
                chosen = data_at[best]
                out.append((np.full(n, at["k1"][q]), np.full(n, at["k2"][q]), at["k1"][chosen], at["k2"][chosen], at["rep"][chosen], value))
        columns = [np.concatenate(c) for c in zip(*out)] if out and len(data) else [np.empty(0, np.int64)] * 5 + [np.empty(0)]
        return pa.table(columns, ["q1", "q2", "k1", "k2", "rep", "score"])

    scored = blocks.groupBy("cell", "i", "j").applyInArrow(score, FOUND)
    # a query class meets at most probes x blocks lists of k + 1 classes; equal entries from several trees fold
    best = scored.groupBy("q1", "q2").agg(F.slice(F.sort_array(F.collect_set(
        F.struct((-F.col("score")).alias("minus"), "rep", "k1", "k2"))), 1, k + 1).alias("best")).select("q1", "q2", F.inline("best"))
    near = best.join(classes, ["k1", "k2"]).select("q1", "q2", "minus", F.explode("ids").alias("vec_id"))
    near = near.groupBy("q1", "q2").agg(F.slice(F.sort_array(F.collect_set(F.struct("minus", "vec_id"))), 1, k + 1).alias("near"))
    answers = asked.withColumnRenamed("vec_id", "query_id").join(
        near, (F.col("k1") == F.col("q1")) & (F.col("k2") == F.col("q2")))
    mine = F.slice(F.filter("near", lambda n: n.vec_id != F.col("query_id")), 1, k)
    return answers.select("query_id", F.posexplode(mine).alias("pos", "n")).select(
        "query_id", (F.col("pos") + 1).alias("rank"), F.col("n.vec_id").alias("vec_id"), (-F.col("n.minus")).alias("score"))
