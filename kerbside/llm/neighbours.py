"""Nearest neighbours by a block matrix join of 8-bit vectors."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.frames import record_batch, stage
from kerbside.session import ship_package

#: Rows and columns of the products that are in memory at once.
TILE_QUERIES, TILE_CANDIDATES = 256, 4096


def usable(vector: Column) -> Column:
    """Not null, not zero, all components there and finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


class Quantised:
    """Vectors as 8-bit integers times a scale, with the norms that bound the error."""

    def __init__(self, vectors: np.ndarray) -> None:
        scale = np.abs(vectors).max(axis=1) / 127
        # the smallest scale whose inverse is finite; what it can't express is in the residual
        self.scale = np.maximum(scale, 1e-300)
        self.values = np.rint(vectors / self.scale[:, None]).astype(np.int8)
        near = self.values * self.scale[:, None]
        self.norm = np.linalg.norm(near, axis=1)
        self.residual = np.linalg.norm(vectors - near, axis=1)
        self.square = (vectors**2).sum(axis=1)
        # sums of 8-bit products are exact in floats as long as they stay below 2**24
        self.kind = np.float32 if vectors.shape[1] * 127 * 127 < 2**24 else np.float64

    def bounds(self, rows: slice, other: Quantised, columns: slice) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the squared distances of a tile.

        With a = a' + e and b = b' + f, a.b differs from a'.b' by at most
        |e||b'| + |a'||f| + |e||f|; a little is added for rounding.
        """
        product = self.values[rows].astype(self.kind) @ other.values[columns].astype(self.kind).T
        product = product.astype(np.float64) * self.scale[rows, None] * other.scale[columns]
        error = self.residual[rows, None] * (other.norm[columns] + other.residual[columns]) + self.norm[rows, None] * other.residual[columns]
        whole = self.square[rows, None] + other.square[columns]
        middle, slack = whole - 2 * product, 2 * error + 1e-9 * whole
        return middle - slack, middle + slack


def distances(query: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, summed component by component."""
    total = np.zeros(len(candidates))
    for d in range(len(query)):
        total += (candidates[:, d] - query[d]) ** 2
    return np.sqrt(total)


def nearest(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> Iterator[tuple[int, int, float]]:
    """query id, vector id and distance of the k nearest vectors to each query.

    In a tile, a candidate survives if its lower bound does not exceed the k-th
    smallest upper bound of its query, or the worst of the k in the query's heap.
    Survivors are measured on the original vectors and pushed on the heap.
    """
    left, right = Quantised(queries), Quantised(vectors)
    for top in range(0, len(query_ids), TILE_QUERIES):
        rows = slice(top, min(top + TILE_QUERIES, len(query_ids)))
        heaps: list[list[tuple[float, int]]] = [[] for _ in range(rows.start, rows.stop)]  # worst first: both negated
        for at in range(0, len(ids), TILE_CANDIDATES):
            columns = slice(at, min(at + TILE_CANDIDATES, len(ids)))
            lower, upper = left.bounds(rows, right, columns)
            other = query_ids[rows, None] != ids[columns]
            upper[~other] = np.inf
            keep = min(k, upper.shape[1])
            limit = np.partition(upper, keep - 1, axis=1)[:, keep - 1]
            worst = np.array([h[0][0] ** 2 * (1 + 1e-9) if len(h) == k else np.inf for h in heaps])
            alive = other & (lower <= np.minimum(limit, worst)[:, None])
            for row, heap in enumerate(heaps):
                found = np.flatnonzero(alive[row]) + at
                if not len(found):
                    continue
                far = distances(queries[top + row], vectors[found])
                if len(found) > k:
                    best = np.lexsort((ids[found], far))[:k]
                    found, far = found[best], far[best]
                for j, d in zip(found, far, strict=True):
                    entry = (-float(d), -int(ids[j]))
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
        for row, heap in enumerate(heaps):
            for d, i in heap:
                yield int(query_ids[top + row]), -i, -d


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


RESULT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
RANKED = pa.schema([("query_id", pa.int64()), ("rank", pa.int32()), ("vec_id", pa.int64()), ("score", pa.float64())])


def search(
    embeddings: DataFrame, is_query: Column, k: int = 10, query_block: int = 4096, candidate_block: int = 16384
) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest vectors of each query.

    ``embeddings`` has vec_id and embedding; queries are its rows under
    ``is_query``. Every query meets every other vector of its length: both sides
    are dealt into blocks of bounded size by a hash of the id, and each pair of
    blocks is one group. Only k rows for each query leave a group.

    Null, zero and non-finite vectors and null ids take no part. Of several rows
    with one id the smallest vector counts. Ties go to the smaller id; queries
    with fewer than k candidates get all, lone ones no rows. Other columns are not read.
    """
    spark = embeddings.sparkSession
    ship_package(spark)
    vectors = embeddings.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).groupBy(F.col("vec_id").cast("long").alias("vec_id"))
    vectors = stage(vectors.agg(F.min("embedding").alias("embedding")), "vectors")
    told = vectors.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q")).first()
    n_c, n_q = max(1, -(-told["n"] // candidate_block)), max(1, -(-told["q"] // query_block))
    vectors = vectors.withColumn("dim", F.size("embedding"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), "vec_id"), F.lit(n)).cast("int")
    queries = vectors.where(is_query).select("vec_id", "embedding", "dim", F.lit(True).alias("asks"), own(n_q, 1).alias("q"), every(n_c).alias("c"))
    candidates = vectors.select("vec_id", "embedding", "dim", F.lit(False).alias("asks"), every(n_q).alias("q"), own(n_c, 2).alias("c"))

    def pair(key: tuple, group: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        asks = group.column("asks").to_numpy()
        ids, matrix = group.column("vec_id").to_numpy(), _matrix(group.column("embedding"), dim)
        rows = list(nearest(ids[asks], matrix[asks], ids[~asks], matrix[~asks], k)) if asks.any() and not asks.all() else []
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(RESULT.types)], schema=RESULT)

    found = queries.unionByName(candidates).groupBy("dim", "q", "c").applyInArrow(pair, "query_id long, vec_id long, score double")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One heap at a time: the rows of a query come one after the other."""
        at, heap, rows = None, [], []

        def ranked() -> list[tuple[int, int, int, float]]:
            return [(at, n + 1, -i, -d) for n, (d, i) in enumerate(sorted(heap, reverse=True))]

        for batch in batches:
            for query, i, d in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if query != at:
                    rows += ranked()
                    at, heap = query, []
                if len(heap) < k:
                    heapq.heappush(heap, (-d, -i))
                elif (-d, -i) > heap[0]:
                    heapq.heapreplace(heap, (-d, -i))
            if rows:
                yield record_batch(rows, RANKED)
                rows = []
        if heap:
            yield record_batch(ranked(), RANKED)

    found = found.repartition("query_id").sortWithinPartitions("query_id")
    return found.mapInArrow(merge, "query_id long, rank int, vec_id long, score double")
