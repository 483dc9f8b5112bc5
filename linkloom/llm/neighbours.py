"""Approximate nearest neighbours by a forest of random-projection trees.

The trees are fitted on a bounded sample, and every vector is filed in one leaf of each. A
query walks all trees at once through one priority queue, nearest boundary first; the
vectors of the leaves it reaches are ranked by exact distance."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, shuffle_partitions

#: Vectors that the trees are fitted on, at most (about).
SAMPLE = 20_000
TREES = 16
#: Sample vectors in a leaf.
LEAF = 40
#: Random directions that a node chooses from.
DRAWN = 16
#: Leaves that a query reads.
READ = 180
#: Vectors of a leaf that one task compares at once; larger leaves are split.
CHUNK = 20_000


@dataclass
class Forest:
    """Complete binary trees: node i of a tree has the children 2i + 1 and 2i + 2."""

    depth: int
    directions: np.ndarray  # trees, nodes, dimensions
    bounds: np.ndarray  # trees, nodes

    @classmethod
    def fitted(cls, sample: np.ndarray, depth: int, trees: int = TREES, seed: int = 3) -> Forest:
        rng = np.random.default_rng(seed)
        nodes = 2**depth - 1
        directions = np.zeros((trees, nodes, sample.shape[1]))
        bounds = np.zeros((trees, nodes))
        for t in range(trees):
            held = {0: np.arange(len(sample))}
            for i in range(nodes):
                own = held.pop(i)
                # Of several random directions, the one along which the vectors spread most.
                drawn = rng.standard_normal((DRAWN, sample.shape[1]))
                drawn /= np.linalg.norm(drawn, axis=1, keepdims=True)
                spread = (sample[own] @ drawn.T).var(0) if len(own) else np.zeros(DRAWN)
                directions[t, i] = drawn[spread.argmax()]
                along = sample[own] @ directions[t, i]
                bounds[t, i] = np.median(along) if len(own) else 0.0
                held[2 * i + 1], held[2 * i + 2] = own[along < bounds[t, i]], own[along >= bounds[t, i]]
        return cls(depth, directions, bounds)

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree, numbered over all trees."""
        out = np.empty((len(vectors), len(self.bounds)), np.int64)
        for t in range(len(self.bounds)):
            at = np.zeros(len(vectors), np.int64)
            for _ in range(self.depth):
                along = np.einsum("ij,ij->i", vectors, self.directions[t, at])
                at = 2 * at + 1 + (along >= self.bounds[t, at])
            out[:, t] = (t << self.depth) + at - (2**self.depth - 1)
        return out

    def search(self, query: np.ndarray, read: int = READ) -> list[int]:
        """The first leaves that the queue over all trees yields: a subtree waits with the
        largest distance from the query to a boundary on the way to it."""
        along = self.directions @ query - self.bounds
        nodes = 2**self.depth - 1
        queue = [(0.0, t, 0) for t in range(len(self.bounds))]
        out: list[int] = []
        while queue and len(out) < read:
            far, t, i = heapq.heappop(queue)
            while i < nodes:
                margin = along[t, i]
                right = margin >= 0
                heapq.heappush(queue, (max(far, abs(margin)), t, 2 * i + 1 + (not right)))
                i = 2 * i + 1 + right
            out.append((t << self.depth) + i - nodes)
        return out


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def nearest(df: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = 10, read: int = READ) -> DataFrame:
    """For each row that `queries` holds for, its k nearest other rows: query_id, rank, the
    neighbour's key and score, its Euclidean distance in double precision.

    Ties go to the smaller key. Vectors that are null, zero or hold null or non-finite components
    take no part, nor do those whose length is not the most frequent one (of equally
    frequent lengths, the smallest). Rows with null keys take no part. Equal vectors are filed
    and compared as one that stands for its k + 1 smallest keys, which is all a result can
    name; so a vector that very many rows have costs no more than another. With few vectors
    the trees have one leaf and the search is exact. An empty table gives no rows."""
    rows = df.where(F.col(key).isNotNull() & usable(F.col(vector))).select(F.col(key).alias("id"), F.col(vector).alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    kind, vectors_kind = df.schema[key].dataType.simpleString(), df.schema[vector].dataType.simpleString()
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.size("v") == (common["n"] if common else 0))
    first = Window.partitionBy("v").orderBy("id")
    ranked = rows.dropDuplicates(["v", "id"]).withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
    distinct = ranked.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    distinct = checkpointed(distinct.select(F.col("ids")[0].alias("rep"), "v", "ids"))
    total = distinct.count()
    drawn = distinct.select("v").sample(False, min(1.0, SAMPLE / max(total, 1)), seed=5) if total > SAMPLE else distinct.select("v")
    sample = np.array([r[0] for r in drawn.collect()], float).reshape(-1, common["n"] if common else 1)
    depth = max(0, int(np.log2(max(1, len(sample) / LEAF))))
    forest = df.sparkSession.sparkContext.broadcast(Forest.fitted(sample, depth))  # TREES * SAMPLE / LEAF vectors

    asking = rows.where("asks").select("id", "v").join(distinct.select("v", "rep"), "v").select("id", "rep")
    asked = distinct.join(asking.select("rep").distinct(), "rep", "left_semi")

    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            leaves = forest.value.leaves(np.array(b.column(1).to_pylist(), float))
            for t in range(leaves.shape[1]):
                yield pa.record_batch([pa.array(leaves[:, t]), *b.columns], names=["leaf", "rep", "v", "ids"])

    def asking_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, v in enumerate(b.column(1).to_pylist()):
                leaves = forest.value.search(np.array(v), read)
                one = b.slice(i, 1).take(pa.array([0] * len(leaves)))
                yield pa.record_batch([pa.array(leaves, pa.int64()), *one.columns], names=["leaf", "rep", "v", "ids"])

    schema = f"leaf bigint, rep {kind}, v {vectors_kind}, ids array<{kind}>"
    index = distinct.mapInArrow(filed, schema)
    wanted = asked.mapInArrow(asking_leaves, schema)
    # Leaves of more vectors than a task should hold are split; queries go to every part. The
    # counts are one row for each leaf, of which there are at most 2 * TREES * SAMPLE / LEAF.
    chunks = F.broadcast(index.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks")))
    index = index.join(chunks, "leaf").withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")))
    wanted = wanted.join(chunks, "leaf").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    both = wanted.select("leaf", "chunk", F.lit(0).alias("side"), "rep", "v", "ids").unionByName(index.select("leaf", "chunk", F.lit(1).alias("side"), "rep", "v", "ids"))
    both = both.repartition(shuffle_partitions(df.sparkSession), "leaf", "chunk").sortWithinPartitions("leaf", "chunk", "side", "rep")

    def ranked_leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, q_reps, q_vectors, reps, vectors, ids = None, [], [], [], [], []

        def done() -> Iterator[pa.RecordBatch]:
            if not q_reps or not reps:
                return
            held, order = np.array(vectors), np.arange(len(reps))
            out: list[tuple] = []
            for q, v in zip(q_reps, q_vectors, strict=True):
                far = np.sqrt(((held - np.array(v)) ** 2).sum(1))
                best = order
                if len(order) > k + 1:  # with all that tie with the last
                    best = np.flatnonzero(far <= np.partition(far, k)[k])
                best = sorted(best.tolist(), key=lambda i: (far[i], reps[i]))[: k + 1]
                out += [(q, reps[i], float(far[i]), ids[i]) for i in best]
            yield pa.record_batch([pa.array(x, c) for x, c in zip(zip(*out, strict=True), arrow, strict=True)], names=["q", "rep", "score", "ids"])

        arrow: list = []
        for b in batches:
            arrow[:] = [b.schema.field(3).type, b.schema.field(3).type, pa.float64(), b.schema.field(5).type]
            for leaf, chunk, side, rep, v, own in zip(*[b.column(i).to_pylist() for i in range(6)], strict=True):
                if at != (leaf, chunk):
                    yield from done()
                    at, q_reps, q_vectors, reps, vectors, ids = (leaf, chunk), [], [], [], [], []
                if side:
                    if q_reps:
                        reps.append(rep)
                        vectors.append(v)
                        ids.append(own)
                else:
                    q_reps.append(rep)
                    q_vectors.append(v)
        yield from done()

    found = both.mapInArrow(ranked_leaf, f"q {kind}, rep {kind}, score double, ids array<{kind}>")
    found = found.dropDuplicates(["q", "rep"]).select("q", "score", F.explode("ids").alias(key))
    best = Window.partitionBy("q").orderBy("score", key)
    found = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r")
    # A query's equals share its result, each without itself.
    lists = found.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("score", key))).alias("near"))
    out = asking.join(lists.withColumnRenamed("q", "rep"), "rep")
    near = F.slice(F.filter("near", lambda x: x[key] != F.col("id")), 1, k)
    out = out.select(F.col("id").alias("query_id"), F.posexplode(near).alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col(f"x.{key}").alias(key), "x.score")


def op8_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    """The 10 nearest of every row whose vec_id is divisible by 100, against all rows."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(rows, F.col("vec_id") % 100 == 0)


#: All pairs. With so few vectors that the trees have no more than READ leaves, as in the smaller tables, every
#: leaf is read and the search is exact; beyond that a test measures recall.
OP8_SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), d AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.v, c.v) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score FROM d QUALIFY rank <= 10
"""
