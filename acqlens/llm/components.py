"""Connected components of an edge table.

Each task first contracts its own edges with union-find, which keeps one edge a
node; the rest is alternating large-star and small-star steps on DataFrames until
the edges stop changing.  No task and not the driver ever holds a component: a
hub's edges are joined to their minimum, a join that adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from acqlens.llm.common import stored


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the task's edges, in blocks; gives (node, smallest root)."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    def flush() -> pa.RecordBatch:
        pairs = [(x, r) for x in list(parent) if (r := find(x)) != x]
        parent.clear()
        a, b = zip(*pairs) if pairs else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                          ["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > 1_000_000:
            yield flush()
    yield flush()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) with root the smallest id reachable, for nodes of ``edges``
    (columns a, b long) other than the roots themselves."""
    now = stored(edges.select("a", "b").mapInArrow(_contract, "a long, b long").distinct(), "edges")
    before = None
    while True:
        both = now.union(now.select("b", "a"))
        # the keys of the minima are expressions, so that these are shuffled again
        # and lie in a stage of their own: only then a hub's edges can be split
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").bitwiseXOR(F.lit(0)).alias("n"), F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, F.col("a") == F.col("n")).select(
            F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").bitwiseXOR(F.lit(0)).alias("n"), "m")
        small = large.join(low, F.col("a") == F.col("n"))
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            small.select("a", F.col("m").alias("b")))
        now = stored(small.where("a <> b").distinct(), "edges")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = mark
