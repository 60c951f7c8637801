"""Approximate nearest neighbours by collision-counting hashing.

Each of several random projections gives a sorted array of the vectors' values.
A query's window in each array is centred on its own value; a vector collides
with the query where it lies in the window. Windows grow by virtual rehashing
(each round multiplies their width) and vectors that collide in at least a
threshold share of the arrays are verified by their exact distance.

A search stops by a distance bound. The difference of two vectors at distance d
has a projection of about d / sqrt(dimensions) times a standard normal number, so
once windows are as wide as REACH of that for the k-th best distance found so
far, a vector nearer than that has very probably reached the threshold, and been
verified. Close neighbours end a search soon; where all are about equally far, as
for random vectors of many dimensions, many are verified. With exact=True, all are.

Vectors are dealt into blocks of bounded size by a hash of their id, queries into
batches; each block has its own arrays and answers every batch, a task for each block
and batch, and only each block's best are merged. Every vector is indexed.

Cases: vectors that are null, empty, zero or hold null or non-finite components
take no part, nor do null ids; vectors of other lengths than the query's are no
candidates; equal distances go to the smaller id; a repeated id is one query (its
smallest vector) and as many candidates; very long vectors are read whole; no
vectors or no queries give no rows; fewer candidates than k give fewer rows;
further columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemart.llm.shared import stored

#: Half the first windows' width in standard deviations of the values.
FIRST = 0.5
#: Vectors of a block; arrays; threshold share of collisions; growth of windows.
BLOCK, ARRAYS, SHARE, GROWTH = 24_576, 24, 0.75, 1.3
#: Queries of a batch.
BATCH = 4_096
#: Numbers of a block's vectors at most, so that longer vectors have smaller blocks.
NUMBERS = 1 << 23
#: Half the windows' width at which a search stops, in standard deviations of the k-th best vector's projections.
REACH = 1.4


class Block:
    """The sorted arrays of a block's vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seed: int = 5):
        self.ids, self.vectors = ids, vectors
        dims = vectors.shape[1]
        directions = np.random.default_rng(seed).normal(size=(dims, ARRAYS))
        self.directions = directions / np.linalg.norm(directions, axis=0)
        values = np.ascontiguousarray((vectors @ self.directions).T)
        self.order = np.argsort(values, axis=1, kind="stable")
        self.sorted = np.take_along_axis(values, self.order, axis=1)
        self.spread = values.std(axis=1) + 1e-12
        self.unit = dims**-0.5
        self.squares = (vectors * vectors).sum(axis=1)

    def nearest(self, query_id: int, query: np.ndarray, k: int, exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of the k nearest that were verified."""
        found, at = np.empty(0), np.empty(0, np.int64)
        for new in [np.arange(len(self.ids))] if exact else self.collisions(query, lambda: found[k - 1] if len(found) >= k else None):
            new = new[self.ids[new] != query_id]
            squares = self.squares[new] + query @ query - 2 * (self.vectors[new] @ query)
            # Products round; what they leave in doubt is measured exactly.
            if len(new) > k:
                doubt = 1e-9 * (self.squares[new].max() + query @ query)
                new = new[squares <= np.partition(squares, k - 1)[k - 1] + doubt]
            gaps = self.vectors[new] - query
            found, at = np.concatenate([found, np.sqrt((gaps * gaps).sum(axis=1))]), np.concatenate([at, new])
            best = np.lexsort((self.ids[at], found))[:k]
            found, at = found[best], at[best]
        return self.ids[at], found

    def collisions(self, query: np.ndarray, bound: Callable[[], float | None]) -> Iterator[np.ndarray]:
        """The vectors that reach the threshold in each round; bound() is the k-th best distance, or None."""
        centre, n = query @ self.directions, len(self.ids)
        counts, verified = np.zeros(n, np.int64), np.zeros(n, bool)
        low = np.array([np.searchsorted(array, c) for array, c in zip(self.sorted, centre, strict=True)])
        high, half = low.copy(), FIRST * self.spread
        while True:
            entered = []
            for j, (array, order) in enumerate(zip(self.sorted, self.order, strict=True)):
                a, b = np.searchsorted(array, (centre[j] - half[j], centre[j] + half[j] + 1e-12))
                entered += [order[a : low[j]], order[high[j] : b]]
                low[j], high[j] = min(a, low[j]), max(b, high[j])
            counts += np.bincount(np.concatenate(entered), minlength=n)
            new = np.flatnonzero((counts >= SHARE * ARRAYS) & ~verified)
            verified[new] = True
            yield new
            farthest = bound()
            if (low == 0).all() and (high == n).all() or farthest is not None and (half >= REACH * self.unit * farthest).all():
                return
            wider = half * GROWTH
            # The last round goes no further than it has to.
            half = wider if farthest is None else np.maximum(half, np.minimum(wider, REACH * self.unit * farthest))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v array<double>) of the vectors that take part."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.coalesce(fine, F.lit(False)))


def search(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK, batch: int = BATCH, exact: bool = False) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each vector for which is_query (a Column of id) holds."""
    rows = usable(vectors, id_col, vector_col)
    n, dims = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    blocks = max(1, -(-n // max(1, min(block, NUMBERS // max(dims, 1)))))
    number = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    queries = rows.where(is_query).groupBy("id", F.size("v").alias("dims")).agg(F.min("v").alias("v"))
    queries = stored(queries.groupBy("id").agg(F.min_by(F.struct("dims", "v"), "v").alias("q")).select("id", "q.dims", "q.v"), "queries")
    batches = max(1, -(-queries.count() // batch))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = rows.select(F.size("v").alias("dims"), number.alias("block"), every(batches).alias("batch"), F.lit(0).alias("asks"), "id", "v")
    asked = queries.select("dims", every(blocks).alias("block"), F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int").alias("batch"), F.lit(1).alias("asks"), "id", "v")
    # Numbered, not hashed: no two cells share a task while others have none.
    cell = F.col("block") * F.lit(batches) + F.col("batch")
    dealt = candidates.unionByName(asked).repartitionById(blocks * batches, cell).drop("batch").sortWithinPartitions("dims", "block", "asks")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, index, ids, parts = None, None, [], []
        for batch in batches:
            dims, block_of, asks = (batch.column(i).to_numpy() for i in range(3))
            numbers, lists = batch.column(3).to_numpy(), batch.column(4)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(dims)
            edges = np.flatnonzero(np.r_[True, (dims[1:] != dims[:-1]) | (block_of[1:] != block_of[:-1]) | (asks[1:] != asks[:-1]), True])
            found = ([], [], [], [])
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                own = values[ends[a] - dims[a] : ends[b - 1]].reshape(b - a, dims[a])
                if held != (dims[a], block_of[a]):
                    held, index, ids, parts = (dims[a], block_of[a]), None, [], []
                if not asks[a]:
                    ids.append(numbers[a:b])
                    parts.append(own)
                elif ids:
                    index = index or Block(np.concatenate(ids), np.concatenate(parts))
                    for query_id, query in zip(numbers[a:b], own, strict=True):
                        near, distances = index.nearest(query_id, query, k, exact)
                        found[0].append(np.full(len(near), query_id))
                        found[1].append(near)
                        found[2].append(distances)
            if found[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found[0]).astype(np.int64)), pa.array(np.concatenate(found[1]).astype(np.int64)), pa.array(np.concatenate(found[2]).astype(np.float64))], names=["query_id", "vec_id", "score"])

    near = dealt.mapInArrow(answer, "query_id long, vec_id long, score double")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
