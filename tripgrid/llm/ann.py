"""Approximate nearest neighbours by collision counting (operator 7).

Vectors are dealt to blocks; a block keeps, for each of ``PROJECTIONS`` random
directions, its vectors' projections as a sorted array. Around the query's own
projection a window is opened in every array, and widened round by round
(virtual rehashing: no array is built anew, radius R only moves the borders). A
vector's collisions are the windows that hold it. One that reaches the
threshold is verified: its exact cosine is computed, in double precision, on
the original vector. The threshold is such that a vector within distance R
reaches it with probability ``1 - MISS``; a block's search ends when the k-th
best verified distance is at most R. If fewer than k candidates exist, the last
round, whose windows hold everything, finds them all. There is no cap on
candidates.

Every vector is in exactly one block, and every query visits all blocks; a
block's index is in memory, queries stream past it in batches. The blocks'
best k are merged by an ordinary ranking.

Defined results: a vector that is null, empty, zero or holds a null or a
non-finite component takes no part, nor does a row with a null id; every other
row counts, also rows with the same id or the same vector: each is a candidate
of all rows but itself, and each that asks gets its own ranks; vectors are
compared with those of the same length only; ties go to the smaller id; an empty table, or one
without queries, gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import materialize

PROJECTIONS = 64
HALF_WINDOW = 1.0  # at R = 1, in units of a projection's spread
GROWTH = 1.25
FIRST_RADIUS = 0.05
MISS = 0.04
BLOCK_ROWS = 8192
QUERY_BATCH = 256
SEED = 7


def _threshold() -> int:
    """Largest count that a vector at distance R reaches with probability 1 - MISS."""
    p = math.erf(HALF_WINDOW / math.sqrt(2))
    below, count = 0.0, 0
    while True:
        below += math.comb(PROJECTIONS, count) * p**count * (1 - p) ** (PROJECTIONS - count)
        if below > MISS:
            return count
        count += 1


def _radii() -> np.ndarray:
    """Radii of the rounds; unit vectors are at most 2 apart, the last round holds everything."""
    rounds = math.ceil(math.log(2 / FIRST_RADIUS, GROWTH)) + 1
    return np.append(FIRST_RADIUS * GROWTH ** np.arange(rounds), np.inf)


class Index:
    """The sorted projections of one block."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.rows, self.ids = rows, ids
        # A power of two leaves every product exact and keeps squares in range.
        self.vectors = vectors / np.exp2(np.floor(np.log2(np.abs(vectors).max(axis=1, keepdims=True))))
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        directions = np.random.Generator(np.random.PCG64(SEED)).standard_normal((vectors.shape[1], PROJECTIONS))
        self.directions = directions
        projected = (self.vectors / self.norms[:, None]) @ directions
        self.order = np.argsort(projected, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(projected, self.order.T, axis=0).T.copy()
        self.threshold, self.radii = _threshold(), _radii()

    def search(self, rows: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(ids, cosines)`` of the best k found for each query, best first."""
        scaled = queries / np.exp2(np.floor(np.log2(np.abs(queries).max(axis=1, keepdims=True))))
        norms = np.sqrt((scaled * scaled).sum(axis=1))
        centres = (scaled / norms[:, None]) @ self.directions
        reach = HALF_WINDOW * self.radii
        low = np.stack([np.searchsorted(s, (c[:, None] - reach).ravel(), side="left") for s, c in zip(self.sorted, centres.T, strict=True)])
        high = np.stack([np.searchsorted(s, (c[:, None] + reach).ravel(), side="right") for s, c in zip(self.sorted, centres.T, strict=True)])
        shape = (PROJECTIONS, len(rows), len(reach))
        low, high = low.reshape(shape), high.reshape(shape)
        for q in range(len(rows)):
            yield self._search_one(rows[q], scaled[q], norms[q], low[:, q], high[:, q], k)

    def _search_one(self, own, query, norm, low, high, k):
        n = len(self.ids)
        collisions = np.zeros(n, dtype=np.int64)
        open_ = self.rows != own  # not yet verified; the query itself never is
        found_ids, found = np.empty(0, dtype=np.int64), np.empty(0)
        left, right = low[:, 0], low[:, 0]
        for t, radius in enumerate(self.radii):
            lo, hi = low[:, t], high[:, t]
            if (hi - lo).sum() < self.threshold:
                continue  # no vector can have enough collisions yet
            entered = [self.order[j, a:b] for j in range(PROJECTIONS) for a, b in ((lo[j], left[j]), (right[j], hi[j])) if a < b]
            left, right = lo, hi
            if entered:
                collisions += np.bincount(np.concatenate(entered), minlength=n)
            new = np.flatnonzero(open_ & (collisions >= self.threshold))
            if len(new):
                open_[new] = False
                cosines = (self.vectors[new] * query).sum(axis=1) / (self.norms[new] * norm)
                found_ids, found = np.append(found_ids, self.ids[new]), np.append(found, cosines)
                best = np.lexsort((found_ids, -found))[:k]
                found_ids, found = found_ids[best], found[best]
            if len(found) == k and math.sqrt(max(0.0, 2 - 2 * found[-1])) <= radius:
                break
        return found_ids, found


_FOUND = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _search_blocks(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, index = None, None
        gathered: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            dim, number, role, row, ids = (c.to_numpy() for c in batch.columns[:5])
            vectors = batch.column(5)
            starts = np.flatnonzero(np.append(True, (dim[1:] != dim[:-1]) | (number[1:] != number[:-1]) | (role[1:] != role[:-1])))
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(dim)], strict=True):
                if e == s:
                    continue
                rows = vectors.slice(s, e - s).flatten().to_numpy(zero_copy_only=False).reshape(e - s, -1).astype(np.float64)
                if (dim[s], number[s]) != block:
                    block, index, gathered = (dim[s], number[s]), None, []
                if role[s] == 0:
                    gathered.append((row[s:e], ids[s:e], rows))
                    continue
                if not gathered and index is None:
                    continue  # queries of a block without vectors
                if index is None:
                    index = Index(*(np.concatenate([g[i] for g in gathered]) for i in range(3)))
                    gathered = []
                for a in range(0, e - s, QUERY_BATCH):
                    out: list[tuple] = []
                    asking = range(s + a, min(e, s + a + QUERY_BATCH))
                    answers = index.search(row[asking], rows[a : a + QUERY_BATCH], k)
                    for q, (found_ids, found) in zip(asking, answers, strict=True):
                        out.extend((row[q], ids[q], i, c) for i, c in zip(found_ids.tolist(), found.tolist(), strict=True))
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], schema=_FOUND)

    return run


def nearest_neighbours(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest by cosine of every row that ``is_query`` marks.

    ``is_query`` is an expression over the column ``id``.
    """
    vector = F.col(vector_col).cast("array<double>")
    usable = (
        F.col("id").isNotNull()
        & (F.size("vector") > 0)
        & F.forall("vector", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
        & F.exists("vector", lambda x: x != 0)
    )
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), vector.alias("vector")).where(usable)
    # Rows are told apart by a number that is stored before it is used.
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    blocks = max(1, math.ceil(rows.count() / BLOCK_ROWS))
    columns = [F.size("vector").alias("dim"), "block", "role", "row", "id", "vector"]
    placed = rows.select("*", F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"), F.lit(0).alias("role"))
    asked = rows.where(is_query).select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block"), F.lit(1).alias("role"))
    together = placed.select(*columns).unionByName(asked.select(*columns))
    # One partition for each block and length, give or take hash collisions.
    dealt = together.repartition(max(2 * blocks, 1), "dim", "block").sortWithinPartitions("dim", "block", "role", "row")
    found = dealt.mapInArrow(_search_blocks(k), "query_row bigint, query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
