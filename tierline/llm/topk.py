"""Exact top-k by inner product with a KD-tree for each shard of the vectors.

Shards are dealt by hash of the id and hold a bounded number of vectors. A shard's tree splits at the
median of its widest dimension and keeps the tight bounding box of every node. A query goes through a
tree best-first by the most that any point of a box can score, and stops at the first box below its
kth score. It visits one shard first; the kth score found there travels with it to all others.

Points and queries of a shard come to a task as one sorted stream, points first, so a task holds one
shard and a batch of queries at a time.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import cut

_LONG = np.iinfo("int64")


class Tree:
    """A KD-tree over whole-number vectors, given in the order that settles ties."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.exact = not len(points) or float(np.abs(points.astype("float64")).max()) ** 2 * points.shape[1] < 2**52
        values = points.astype("float64") if self.exact else points
        order, nodes = np.arange(len(points)), []
        waiting = [(0, len(points), -1)]
        while waiting:
            start, end, parent = waiting.pop()
            own = values[order[start:end]]
            number, low, high = len(nodes), own.min(axis=0), own.max(axis=0)
            nodes.append([low, high, start, end, order[start:end].min(), []])
            if parent >= 0:
                nodes[parent][5].append(number)
            if end - start > leaf:
                axis, middle = int(np.argmax(high.astype("float64") - low)), (end - start) // 2
                order[start:end] = order[start:end][np.argpartition(own[:, axis], middle)]
                waiting += [(start, start + middle, number), (start + middle, end, number)]
        self.order, self.values, self.nodes = order, values[order], nodes
        self.low, self.high = (np.array([n[i] for n in nodes], "float64") for i in (0, 1))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and node, the most that a point of its box can score."""
        if not self.exact or float(np.abs(queries).max(initial=0)) * float(np.abs(self.values).max()) * queries.shape[1] >= 2**52:
            return np.full((len(queries), len(self.nodes)), np.inf)
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, query: np.ndarray, bounds: np.ndarray, k: int, least: float, before: int) -> tuple[np.ndarray, list]:
        """Places and scores of the best ``k``, those no better than score ``least`` at place ``before`` left out."""
        heap = [(-bounds[0], 0)]
        places, scores = np.zeros(0, "int64"), np.zeros(0, "float64" if np.isfinite(bounds[0]) else object)
        query = query.astype(scores.dtype)
        while heap:
            bound, number = heapq.heappop(heap)
            if -bound < least:
                break
            _, _, start, end, first, below = self.nodes[number]
            if -bound == least and first >= before:
                continue
            if below:
                for child in below:
                    heapq.heappush(heap, (-bounds[child], child))
                continue
            own = self.values[start:end].astype(scores.dtype, copy=False) @ query
            places, scores = np.concatenate([places, self.order[start:end]]), np.concatenate([scores, own])
            kept = np.flatnonzero((scores > least) | ((scores == least) & (places < before)))
            kept = kept[np.lexsort((places[kept], -scores[kept]))][:k]
            places, scores = places[kept], scores[kept]
            if len(kept) == k:
                least, before = scores[-1], int(places[-1]) + 1
        return places, [max(_LONG.min, min(_LONG.max, int(s))) for s in scores]


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """id, vector as floor(scale * x), copies; vectors with a missing or non-finite component are left out."""
    vector = F.col(f"`{vector_col}`")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    rows = vectors.where(vector.isNotNull() & (F.size(vector) > 0) & finite)
    rows = rows.select(F.col(f"`{id_col}`").alias("id"), F.transform(vector, lambda x: F.floor(x.cast("double") * float(scale)).cast("long")).alias("vector"))
    return rows.groupBy("id", "vector").agg(F.count(F.lit(1)).alias("copies"))


def _walk(stream: DataFrame, k: int, leaf: int, shards: int) -> DataFrame:
    """Candidates of each query in the shard it is sent to; ``stream`` holds points (kind 0) and queries (kind 1)."""
    id_type = stream.schema["id"].dataType.simpleString()

    def run(batches):
        shard, held, trees = None, [], None

        def plant() -> dict[int, tuple]:
            grown = {}
            if held:
                points = pa.Table.from_batches(held)
                sizes = np.array([len(v) for v in points.column("vector").to_pylist()])
                for size in np.unique(sizes):
                    own = points.filter(pa.array(sizes == size)).combine_chunks()
                    values = own.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, size)
                    ids = own.column("id").combine_chunks()
                    grown[int(size)] = Tree(values, leaf), ids, own.column("copies").to_numpy(), values
            return grown

        def answer(rows: pa.RecordBatch):
            out = {n: [] for n in names}
            vectors = [np.array(v, "int64") for v in rows.column("vector").to_pylist()]
            for size in {len(v) for v in vectors} & trees.keys():
                tree, ids, copies, values = trees[size]
                own = [i for i, v in enumerate(vectors) if len(v) == size]
                bounds = tree.bounds(np.array([vectors[i] for i in own], "float64"))
                known = np.array([i for i in ids.to_pylist() if i is not None], dtype=object if id_type == "string" else None)
                for i, bound in zip(own, bounds):
                    query, floor, floor_id = rows.column("id")[i].as_py(), rows.column("floor")[i].as_py(), rows.column("floor_id")[i].as_py()
                    before = len(ids) if floor_id is None else int(np.searchsorted(known, floor_id, "right"))
                    places, scores = tree.search(vectors[i], bound, k + 1, -np.inf if floor is None else floor, before)
                    for place, score in zip(places.tolist(), scores):
                        candidate = ids[place].as_py()
                        left = int(copies[place]) - (candidate == query and bool((values[place] == vectors[i]).all()))
                        if left:
                            for n, v in zip(names, (query, rows.column("key")[i].as_py(), candidate, score, left)):
                                out[n].append(v)
            return pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in zip(names, (kind, pa.string(), kind, pa.int64(), pa.int64()))], names)

        for batch in batches:
            kind = batch.column("id").type
            marks = np.array([batch.column("shard").to_numpy(), batch.column("kind").to_numpy()]).T
            edges = [0, *(np.flatnonzero((np.diff(marks, axis=0) != 0).any(axis=1)) + 1).tolist(), len(batch)]
            for start, end in zip(edges, edges[1:]):
                if end == start:
                    continue
                if marks[start][0] != shard:
                    shard, held, trees = marks[start][0], [], None
                part = batch.slice(start, end - start)
                if marks[start][1] == 0:
                    held.append(part)
                    continue
                if trees is None:
                    trees, held = plant(), []
                for at in range(0, len(part), 256):
                    yield answer(part.slice(at, 256))

    names = ["query", "key", "candidate", "score", "copies"]
    dealt = stream.repartition(shards, "shard").sortWithinPartitions("shard", "kind", F.col("id").asc_nulls_last())
    return dealt.mapInArrow(run, f"query {id_type}, key string, candidate {id_type}, score long, copies long")


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024,
    shard_rows: int = 1 << 14, leaf: int = 256,
) -> DataFrame:
    """query_id, rank, ``id_col`` and score of the ``k`` best other rows for each row that ``is_query`` holds for.

    Ties go to the smaller id, null ids last. ``is_query`` is an expression on ``id_col``. A row that is
    there several times is that many queries and candidates, and only itself is not its own candidate.
    Vectors that are null or empty, or hold a null or non-finite component, take no part; vectors of
    different length are not compared. A score beyond a long is the nearest long. Other columns are left
    out, whatever their names; an empty table gives no rows.
    """
    points = cut(whole_vectors(vectors, id_col, vector_col, scale), "vectors")
    shards = max(1, -(-points.count() // shard_rows))
    home = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    none = [F.lit(None).cast(t) for t in ("string", "long")]
    as_points = points.select(home.alias("shard"), F.lit(0).alias("kind"), "id", "vector", "copies", none[0].alias("key"), none[1].alias("floor"), F.lit(None).cast(points.schema["id"].dataType).alias("floor_id"))
    asked = points.withColumn(id_col, F.col("id")).where(is_query).drop(*[c for c in [id_col] if c != "id"])
    asked = asked.select("id", "vector", "copies", F.md5(F.concat_ws(",", F.col("vector").cast("array<string>")).cast("binary")).alias("key"))

    def best(found: DataFrame) -> DataFrame:
        entries = found.withColumn("n", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))))
        order = Window.partitionBy("query", "key").orderBy(F.col("score").desc(), F.col("candidate").asc_nulls_last())
        return entries.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    first = asked.select(home.alias("shard"), F.lit(1).alias("kind"), "id", "vector", "copies", "key", none[1].alias("floor"), F.lit(None).cast(points.schema["id"].dataType).alias("floor_id"))
    near = cut(_walk(as_points.unionByName(first), k, leaf, shards), "home")
    kth = best(near).where(F.col("rank") == k).select(F.col("query").alias("id"), "key", F.col("score").alias("floor"), F.col("candidate").alias("floor_id"))
    others = F.array_remove(F.sequence(F.lit(0), F.lit(shards - 1)), home)
    rest = asked.join(kth, ["id", "key"], "left").withColumn("shard", F.explode(others))
    rest = rest.select("shard", F.lit(1).alias("kind"), "id", "vector", "copies", "key", "floor", "floor_id")
    far = _walk(as_points.unionByName(rest), k, leaf, shards)
    found = best(near.unionByName(far)).join(asked.select(F.col("id").alias("query"), "key", F.col("copies").alias("asked")), ["query", "key"])
    found = found.withColumn("n", F.explode(F.sequence(F.lit(1), F.col("asked").cast("int"))))
    return found.select(F.col("query").alias("query_id"), "rank", F.col("candidate").alias(id_col), "score")
