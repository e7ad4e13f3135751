"""Exact top-k inner products with Fagin's threshold algorithm.

Vectors are turned into integers, floor(scale * x), numbered and dealt by a hash of
their number into blocks; queries are dealt likewise, and every pair of a query block and a
candidate block is one group.  In a group each dimension has the candidates in
order of their component.  A query reads all lists in parallel from the end that
its own component favours, scores whatever it meets for the first time, and stops
when the threshold, the score of a vector made of the components last read,
cannot beat its k-th result (it must be strictly smaller, as a tie may still win
by its id) or when every candidate has been met, so a group never scores more
than its full product.  The k best of each block are merged.

Edge cases: rows whose id or vector is null, or whose vector holds a null or a
non-finite component, take no part; rows that share an id are candidates each, a
query meets no row of its own id, and queries that share an id are answered
together by the best of all their pairs; vectors meet vectors of the same length
only; fewer than k candidates give fewer results; ties go to the smaller id; an
empty table gives no rows; other columns are not read.  Scores are exact; a result
beyond 64 bits stops the search with an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from acqlens.llm.common import stored

FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def integer_vectors(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v array<long>) of the rows that take part."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & F.coalesce(fine, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v")))


class SortedLists:
    """A block of vectors with two sorted lists a dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        across = np.ascontiguousarray(self.vectors.T)
        self.lists = np.stack([np.argsort(-across, axis=1, kind="stable"),   # largest first
                               np.argsort(across, axis=1, kind="stable")])   # smallest first
        self.exact = np.abs(self.vectors).max(initial=0)
        self.floats = self.vectors.astype(float)
        self.singles = self.vectors.astype(np.float32)

    def _scores(self, rows, query: np.ndarray) -> np.ndarray:
        bound = self.bound(query)
        if bound < 2 ** 24:  # products and sums of singles are exact
            return (self.singles.take(rows, axis=0) @ query.astype(np.float32)).astype(np.int64)
        if bound < 2 ** 53:  # of doubles
            return (self.floats.take(rows, axis=0) @ query.astype(float)).astype(np.int64)
        if bound < 2 ** 63:
            return self.vectors[rows] @ query
        return self.vectors[rows].astype(object) @ query.astype(object)

    def bound(self, query: np.ndarray) -> int:
        """No score or threshold of ``query`` is larger."""
        return int(self.exact) * int(np.abs(query).max(initial=0)) * max(1, len(query))

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and scores of the k best, the query's own id left out."""
        n = len(self.ids)
        seen = np.zeros(n, bool)
        seen[np.searchsorted(self.ids, query_id):np.searchsorted(self.ids, query_id, "right")] = True
        use = np.flatnonzero(query)
        weight = query[use]
        end = (weight < 0).astype(np.intp)
        wide = self.bound(query) >= 2 ** 63
        top, scores = np.zeros(0, np.int64), np.zeros(0, object if wide else np.int64)
        at, step = 0, 4
        while True:
            part = self.lists[end, use, at:at + step]
            before = seen.copy()
            seen[part] = True
            if not len(use):  # a query of zeros has no lists: all tie
                seen[:] = True
            rows = np.flatnonzero(seen != before)
            value = self._scores(rows, query)
            if len(top) == k:  # a tie may still win by its id
                hope = np.flatnonzero(value >= scores[-1])
                rows, value = rows[hope], value[hope]
            both, value = np.concatenate([top, rows]), np.concatenate([scores, value])
            by_row = np.argsort(both)
            top, scores = both[by_row], value[by_row]
            order = np.argsort(-scores, kind="stable")[:k]  # in row order, which is id order
            top, scores = top[order], scores[order]
            if seen.all():
                return top, scores
            last = self.vectors[part[:, -1], use]
            threshold = int((last.astype(object) * weight.astype(object)).sum() if wide else (last * weight).sum())
            if len(top) == k and threshold < scores[-1]:
                return top, scores
            at, step = at + step, step * 2


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024,
          block_rows: int = 16_384, query_rows: int = 2_048, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score); ``is_query`` is a condition on ``vec_id``."""
    made = stored(integer_vectors(vectors, scale, id_col, vector_col)
                  .withColumn("row", F.monotonically_increasing_id()), "vectors")
    queries = made.where(is_query)
    blocks = max(1, -(-made.count() // block_rows))
    q_blocks = max(1, -(-queries.count() // query_rows))
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = made.select("vec_id", "v", F.size("v").alias("width"), dealt(blocks).alias("block"),
                       each(q_blocks).alias("q_block"))
    right = queries.select("vec_id", "v", F.size("v").alias("width"), each(blocks).alias("block"),
                           dealt(q_blocks).alias("q_block"))
    key = ["width", "block", "q_block"]

    def run(candidates: pa.Table, asked: pa.Table) -> pa.Table:
        if not candidates.num_rows or not asked.num_rows:
            return FOUND.empty_table()
        width = candidates.column("width")[0].as_py()
        lists = SortedLists(candidates.column("vec_id").to_numpy(), _matrix(candidates.column("v"), width))
        out = []
        for q, v in zip(asked.column("vec_id").to_pylist(), _matrix(asked.column("v"), width)):
            rows, scores = lists.best(q, v, k)
            if scores.dtype == object and any(abs(x) >= 2 ** 63 for x in scores):
                raise OverflowError(f"a score of query {q} does not fit 64 bits")
            out.append((np.full(len(rows), q), lists.ids[rows], scores))
        return pa.table([np.concatenate(c).astype(np.int64) for c in zip(*out)], schema=FOUND)

    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
