"""Exact search for the highest inner products, by a KD-tree for each shard of the vectors.

A task cuts its rows into shards and grows a tree over each: median splits of the widest component, a tight bounding box a
node. Trees are written once. Queries go to all trees in blocks; a query walks a tree best box first and stops where no box
can reach the score of its kth best. That score is handed on: from leaf to leaf, from tree to tree of a task, and, by a first
pass that looks into one leaf of each tree, from every task to all others."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillon.llm.common import hand_back, stored, stored_parts, table, unstore
from quillon.llm.vectors import matrix, whole, width

K = 5
SHARD_ROWS, LEAF_ROWS = 16_384, 128
#: Queries that are on the driver and on the workers at once; there is a pass for each block of them.
BLOCK_QUERIES = 4096


def shape(n: int, leaf: int = LEAF_ROWS) -> tuple[list[tuple[int, int]], list[int]]:
    """Of a tree over n points its nodes' ranges, parents first, and their left children (0: a leaf; the right one follows)."""
    nodes, left = [(0, n)], []
    for a, b in nodes:  # grows while it is read
        left.append(len(nodes) if b - a > leaf else 0)
        if left[-1]:
            nodes += [(a, (a + b) // 2), ((a + b) // 2, b)]
    return nodes, left


def grown(ids: np.ndarray, points: np.ndarray, leaf: int = LEAF_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids and points in the order of the leaves, and the least and greatest corner of each node's box."""
    nodes, left = shape(len(ids), leaf)
    order = np.arange(len(ids))
    low, high = (np.zeros((len(nodes), points.shape[1]), np.int32) for _ in range(2))
    for i, (a, b) in enumerate(nodes):
        own = points[order[a:b]]
        low[i], high[i] = own.min(0), own.max(0)
        if left[i] and points.shape[1]:
            order[a:b] = order[a:b][np.argpartition(own[:, int((high[i] - low[i]).argmax())], (b - a) // 2)]
    return ids[order], points[order], low, high


class Search:
    """The best k of each query of a block over all trees that it has seen."""

    def __init__(self, own: np.ndarray, vectors: np.ndarray, floor: np.ndarray, k: int):
        self.own, self.vectors, self.k = own, vectors.astype(np.float64), k
        self.kth = floor.astype(np.float64)  # nothing below it is wanted
        self.best: list[list[tuple[float, int]]] = [[] for _ in own]  # heaps of (score, -id), the worst first
        self.leaves = 0

    def walk(self, ids: np.ndarray, points: np.ndarray, low: np.ndarray, high: np.ndarray, leaf: int = LEAF_ROWS, most_leaves: int | None = None) -> None:
        nodes, left = shape(len(ids), leaf)
        reach = np.maximum(self.vectors, 0) @ high.astype(np.float64).T + np.minimum(self.vectors, 0) @ low.astype(np.float64).T
        points = points.astype(np.float64)
        for q in np.flatnonzero(reach[:, 0] >= self.kth):
            own, x, bound = self.own[q], self.vectors[q], reach[q].tolist()
            open_, seen = [(-bound[0], 0)], 0
            while open_ and -open_[0][0] >= self.kth[q] and seen != most_leaves:
                node = heapq.heappop(open_)[1]
                if left[node]:
                    for child in (left[node], left[node] + 1):
                        if bound[child] >= self.kth[q]:
                            heapq.heappush(open_, (-bound[child], child))
                    continue
                a, b = nodes[node]
                score = points[a:b] @ x
                at = np.flatnonzero((score >= self.kth[q]) & (ids[a:b] != own))
                self.take(q, score[at], ids[a:b][at])
                seen += 1
            self.leaves += seen

    def take(self, q: int, score: np.ndarray, ids: np.ndarray) -> None:
        best = self.best[q]
        for j in np.lexsort((ids, -score))[: self.k]:
            new = (float(score[j]), -int(ids[j]))
            if len(best) < self.k:
                heapq.heappush(best, new)
            else:
                heapq.heappushpop(best, new)
        if len(best) == self.k:
            self.kth[q] = max(self.kth[q], best[0][0])


TREE = "ids binary, points binary, low binary, high binary"
_NUMBERS = {"ids": np.int64, "points": np.int32, "low": np.int32, "high": np.int32}


def _trees(n: int):
    """mapInArrow over (key, _v): a row for each shard of the task's rows."""

    def tree(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        made = grown(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in made], list(_NUMBERS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows = [], 0
        for b in batches:
            for start in range(0, b.num_rows, SHARD_ROWS):
                some = b.slice(start, SHARD_ROWS)
                if rows + some.num_rows > SHARD_ROWS:
                    yield tree(parts)
                    parts, rows = [], 0
                parts.append((some.column(0).to_numpy(), matrix(some.column(1), n).astype(np.int32)))
                rows += some.num_rows
        if rows:
            yield tree(parts)
        hand_back()

    return run


def _pass(block, n: int, k: int, first: bool):
    """mapInArrow over trees. first: one leaf of each, the kth score of each query; else the best of all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, vectors, floor = block.value
        s = Search(own, vectors, floor, k)
        for b in batches:
            for row in range(b.num_rows):
                t = {c: np.frombuffer(b.column(c)[row].as_buffer(), kind) for c, kind in _NUMBERS.items()}
                shaped = [t[c].reshape(-1, n) if n else np.zeros((len(t["ids"]) if c == "points" else len(shape(len(t["ids"]))[0]), 0)) for c in ("points", "low", "high")]
                s.walk(t["ids"], *shaped, most_leaves=1 if first else None)
        if first:
            full = [q for q, best in enumerate(s.best) if len(best) == k]
            yield pa.RecordBatch.from_pydict({"q": pa.array(full, pa.int32()), "kth": pa.array([s.kth[q] for q in full], pa.float64())})
        else:
            rows = [(q, -i, int(score)) for q, best in enumerate(s.best) for score, i in best]
            yield pa.RecordBatch.from_pydict({c: pa.array([r[j] for r in rows], kind) for j, (c, kind) in enumerate((("q", pa.int32()), ("found", pa.int64()), ("score", pa.int64())))})
        hand_back()

    return run


def _blocks(queries: DataFrame, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    held: list = []

    def block() -> tuple[np.ndarray, np.ndarray]:
        return np.array([r[0] for r in held], np.int64), np.array([r[1] for r in held], np.int32).reshape(len(held), n)

    for r in queries.toLocalIterator():
        held.append(r)
        if len(held) == BLOCK_QUERIES:
            yield block()
            held = []
    if held:
        yield block()


def top(vectors: DataFrame, queries: DataFrame, k: int = K, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For each row of queries the k rows of vectors with the highest inner products: query_id, rank (from 1), key, score.

    Both tables have key and vector; components count as floor(256 * x). Ties go to the smaller id. Rows that bear the
    query's id are not found; repeated rows are each found, and repeated queries each answered. Rows without an id, with
    a null vector or with null or non-finite components take no part, and neither do vectors of another length than that
    of the least id of vectors. With fewer than k rows all are returned; empty tables give an empty one."""
    both = [whole(df.select(F.col(key).cast("long").alias("_k"), F.col(vector).alias("_x")).filter("_k IS NOT NULL"), "_x", "_v").select("_k", "_v") for df in (vectors, queries)]
    n = width(both[0], "_k", "_v")
    rows, asked = (df.filter(F.size("_v") == n) for df in both)
    trees, asked = stored(rows.mapInArrow(_trees(n), TREE), "trees"), stored(asked, "queries")
    out = stored_parts(_answers(trees, asked, n, k, key), "found")
    unstore(trees)
    unstore(asked)
    return out


def _answers(trees: DataFrame, asked: DataFrame, n: int, k: int, key: str) -> Iterator[DataFrame]:
    """The result, block by block of queries."""
    spark = trees.sparkSession
    yield spark.createDataFrame([], f"query_id long, rank int, {key} long, score long")
    for own, x in _blocks(asked, n):
        least = np.full(len(own), -np.inf)
        sent = spark.sparkContext.broadcast((own, x, least))
        firsts = trees.mapInArrow(_pass(sent, n, k, True), "q int, kth double").groupBy("q").agg(F.max("kth").alias("kth"))
        for r in firsts.collect():  # a row a query of the block at most
            least[r["q"]] = r["kth"]
        sent.destroy()
        sent = spark.sparkContext.broadcast((own, x, least))
        found = trees.mapInArrow(_pass(sent, n, k, False), "q int, found long, score long")
        best = found.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "found"))).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(i, int(o)) for i, o in enumerate(own)], "q int, query_id long")
        yield best.join(F.broadcast(names), "q").select("query_id", "rank", F.col("found").alias(key), "score")
        sent.destroy()


def query(spark, sf_dir: str) -> DataFrame:
    """op13: the five highest inner products for every row of embeddings whose id is divisible by 50."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top(rows, rows.filter("vec_id % 50 = 0"))


ORACLE_SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT q.vec_id AS query_id, (row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, e.v) DESC, e.vec_id))::INTEGER AS rank,
       e.vec_id, list_dot_product(q.v, e.v)::BIGINT AS score
FROM e q JOIN e ON q.vec_id % 50 = 0 AND e.vec_id <> q.vec_id
QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, e.v) DESC, e.vec_id) <= 5
"""
