"""Embedding near-duplicates by epsilon grid order join.

Vectors of equal components become one row; each is scaled to length one, so that
a cosine of c or more means a distance of at most epsilon = sqrt(2 - 2 c).  Their
coordinates on the leading principal dimensions (of the commonest width; others
keep their first coordinates) are cut into grid cells of side epsilon, and all
rows are sorted by cell, dimension by dimension.  The sequence is cut into
intervals, and each interval has the box of its coordinates.

Sequences are joined recursively: first as tables, a pair of intervals being
replaced by the pairs of their parts as long as the boxes are no further apart
than epsilon, then, in a task for each pair of lowest intervals, by halving.  A
pair of boxes that is provably further apart is skipped.  In what remains the
cosines are computed, each row's links are counted and linked rows are merged;
no pair ever leaves the task.

Orthonormal coordinates never lengthen a distance, so skipping loses no link: the
join is exact up to rounding, and a cosine within 1e-9 of the limit is computed
again from the vectors as they are given.

Edge cases: a vector that is null, empty, all zero or holds a null or non-finite
component links with nothing and is its own component; vectors of different
lengths do not link; a row without id links with nothing and keeps a null
component; rows that share an id count as vectors of their own but are one node,
so their links join; equal vectors are linked; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from acqlens.llm.common import stored
from acqlens.llm.components import components

_NEAR = 1e-9
#: coordinates that principal directions are taken from
_LEAD = 512
#: an interval of a level has 16 of the level below
_STEP = 4


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, width, v): the vector as bytes of doubles, null if it takes no part."""
    for batch in batches:
        made: list[bytes | None] = []
        for value in batch.column(1):
            x = None
            if value.is_valid and not value.values.null_count:
                x = value.values.cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False) + 0.0  # -0.0 is 0.0
                if not (np.isfinite(x).all() and x.any()):
                    x = None
            made.append(None if x is None else x.tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(m) // 8 if m else 0 for m in made], pa.int32()),
             pa.array(made, pa.binary())], ["id", "width", "v"])


def _units(vectors: list[bytes]) -> np.ndarray:
    x = np.stack([np.frombuffer(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares stay finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _second_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        if batch.num_rows:
            u = _units([v.as_py() for v in batch.column(0)])[:, :_LEAD]
            total = u.T @ u + (0 if total is None else total)
    if total is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
            ["i", "row"])


def _principal(classes: DataFrame, dims: int) -> tuple[int, np.ndarray | None]:
    """The commonest width and the principal directions of its vectors' first
    ``_LEAD`` coordinates.  Their second moments, summed on the executors, are all
    that reaches the driver."""
    width = classes.groupBy("width").count().orderBy(F.col("count").desc(), "width").first()
    if width is None:
        return 0, None
    lead = min(width["width"], _LEAD)
    sums = (classes.where(F.col("width") == width["width"]).select("v")
            .mapInArrow(_second_moments, "i int, row array<double>")
            .select("i", F.posexplode("row").alias("k", "x")).groupBy("i", "k").agg(F.sum("x").alias("x")))
    matrix = np.zeros((lead, lead))
    for i, k, x in sums.toLocalIterator():
        matrix[i, k] = x
    _, directions = np.linalg.eigh((matrix + matrix.T) / 2)
    return width["width"], np.ascontiguousarray(directions[:, ::-1][:, :dims])


def _coordinates(u: np.ndarray, basis: tuple[int, np.ndarray | None], dims: int) -> np.ndarray:
    if u.shape[1] == basis[0]:
        p = u[:, :len(basis[1])] @ basis[1]
    else:
        p = u[:, :dims]
    return np.pad(p, ((0, 0), (0, dims - p.shape[1])))


def _gridded(basis: tuple[int, np.ndarray | None], dims: int, epsilon: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column(2).to_numpy()
            cells = np.zeros((batch.num_rows, dims), np.int32)
            for w in np.unique(widths):
                rows = np.flatnonzero(widths == w)
                u = _units([batch.column(3)[int(i)].as_py() for i in rows])
                cells[rows] = np.floor(_coordinates(u, basis, dims) / epsilon)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(np.ascontiguousarray(c)) for c in cells.T]],
                ["id", "copies", "width", "v", *[f"cell{k}" for k in range(dims)]])

    return run


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the rows of each width in a sorted partition."""
    partition, width, at = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        numbers = []
        for w in batch.column(2).to_pylist():
            if w != width:
                width, at = w, 0
            numbers.append(at)
            at += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(batch.num_rows, partition), pa.int32()), pa.array(numbers, pa.int64()),
             *batch.columns[:4]], ["part", "nth", "id", "copies", "width", "v"])


def _intervals(rows: DataFrame, interval_bytes: int) -> DataFrame:
    """The sequence cut into intervals of one width and at most ``interval_bytes`` of
    doubles, whatever partitions it is sorted in: intervals are numbered through,
    and a row's place is its number in its interval."""
    before = Window.partitionBy("width").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    size = F.greatest(F.lit(1).cast("long"), F.lit(interval_bytes).cast("long") / (8 * F.col("width"))).cast("long")
    parts = (rows.groupBy("part", "width").agg(F.count("*").alias("n"))
             .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))))
    widths = (parts.groupBy("width").agg(F.ceil(F.sum("n") / F.first(size)).alias("k"))
              .withColumn("first", F.coalesce(F.sum("k").over(
                  Window.orderBy("width").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    starts = parts.join(widths, "width").select("part", "width", "start", "first")
    at = F.col("start") + F.col("nth")
    return rows.join(starts, ["part", "width"]).select(
        (F.col("first") + F.floor(at / size)).alias("interval"), (at % size).alias("place"),
        "id", "copies", "width", "v")


def _boxes(basis: tuple[int, np.ndarray | None], dims: int):
    """(interval, low, high): of the rows of a batch that lie in an interval."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            intervals = batch.column(0).to_numpy()
            out = []
            for i in np.unique(intervals):
                rows = np.flatnonzero(intervals == i)
                p = _coordinates(_units([batch.column(1)[int(r)].as_py() for r in rows]), basis, dims)
                out.append((int(i), p.min(axis=0), p.max(axis=0)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()),
                 *[pa.array([list(o[k]) for o in out], pa.list_(pa.float64())) for k in (1, 2)]],
                ["interval", "low", "high"])

    return run


class _Tree:
    """An interval's rows, halved until ``leaf`` rows: boxes of the coordinates."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, raw: list[bytes], basis, dims: int):
        self.ids, self.copies, self.raw = ids, copies, raw
        self.u = _units(raw)
        self.p = _coordinates(self.u, basis, dims)
        self.links = np.zeros(len(ids), np.int64)
        self.boxes: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def box(self, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        found = self.boxes.get((start, stop))
        if found is None:
            p = self.p[start:stop]
            found = self.boxes[start, stop] = p.min(axis=0), p.max(axis=0)
        return found


def _far(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], epsilon: float) -> bool:
    gap = np.maximum(np.maximum(b[0] - a[1], a[0] - b[1]), 0)
    return float(gap @ gap) > epsilon * epsilon + _NEAR


def _cosine(a: bytes, b: bytes) -> float:
    x, y = np.frombuffer(a, np.float64), np.frombuffer(b, np.float64)
    return float(x @ y) / (math.sqrt(float(x @ x)) * math.sqrt(float(y @ y)))


class _Join:
    """Joins two intervals (or one with itself): link counts and merged rows."""

    def __init__(self, a: _Tree, b: _Tree, least: float, epsilon: float, leaf: int):
        self.a, self.b, self.least, self.epsilon, self.leaf = a, b, least, epsilon, leaf
        self.same = a is b
        self.shift = 0 if self.same else len(a.ids)
        self.root = np.arange(len(a.ids) + (0 if self.same else len(b.ids)))

    def join(self, a0: int, a1: int, b0: int, b1: int) -> None:
        if _far(self.a.box(a0, a1), self.b.box(b0, b1), self.epsilon):
            return
        if max(a1 - a0, b1 - b0) <= self.leaf:
            self.compare(a0, a1, b0, b1)
            return
        halves = lambda x, y: [(x, y)] if y - x <= self.leaf else [(x, (x + y) // 2), ((x + y) // 2, y)]
        for p in halves(a0, a1):
            for q in halves(b0, b1):
                if not self.same or p <= q:
                    self.join(*p, *q)

    def compare(self, a0: int, a1: int, b0: int, b1: int) -> None:
        cosine = self.a.u[a0:a1] @ self.b.u[b0:b1].T
        hit = cosine >= self.least + _NEAR
        for i, k in zip(*np.nonzero((cosine >= self.least - _NEAR) & ~hit)):
            hit[i, k] = _cosine(self.a.raw[a0 + i], self.b.raw[b0 + k]) >= self.least
        once = self.same and a0 == b0
        if once:
            np.fill_diagonal(hit, False)
        if not hit.any():
            return
        self.a.links[a0:a1] += hit @ self.b.copies[b0:b1]
        if not once:
            self.b.links[b0:b1] += hit.T @ self.a.copies[a0:a1]
        i, k = np.nonzero(hit)
        i, k = i + a0, k + b0 + self.shift
        while True:
            x, y = self.root[i], self.root[k]
            differ = x != y
            if not differ.any():
                return
            i, k = i[differ], k[differ]
            low, high = np.minimum(x, y)[differ], np.maximum(x, y)[differ]
            np.minimum.at(self.root, high, low)
            while (up := self.root[self.root]).tobytes() != self.root.tobytes():
                self.root = up

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        ids = self.a.ids if self.same else np.concatenate([self.a.ids, self.b.ids])
        a, b = ids, ids[self.root]
        return a[a != b], b[a != b]


_FOUND = pa.schema([("kind", pa.int32()), ("interval", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _joined(basis, dims: int, least: float, epsilon: float, leaf: int):
    """Rows of kind 0: (interval, place, links); of kind 1: an edge (a, b)."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        x, y = key[0].as_py(), key[1].as_py()
        # a pair of an interval with itself has its rows on the left only
        left, right = (t.sort_by("place") for t in (left, left if x == y else right))
        if left.column("width")[0].as_py() != right.column("width")[0].as_py():
            return _FOUND.empty_table()
        tree = lambda t: _Tree(t.column("id").to_numpy(), t.column("copies").to_numpy(),
                               t.column("v").to_pylist(), basis, dims)
        a = tree(left)
        b = a if x == y else tree(right)
        found = _Join(a, b, least, epsilon, leaf)
        found.join(0, len(a.ids), 0, len(b.ids))
        parts = []
        for interval, t, side in [(x, a, left), (y, b, right)][:1 if a is b else 2]:
            rows = np.flatnonzero(t.links)
            parts.append((np.zeros(len(rows), np.int32), np.full(len(rows), interval),
                          side.column("place").to_numpy()[rows], t.links[rows]))
        p, q = found.edges()
        parts.append((np.ones(len(p), np.int32), np.zeros(len(p), np.int64), p, q))
        return pa.table([np.concatenate(c) for c in zip(*parts)], schema=_FOUND)

    return run


def _above(level: int):
    """The interval of a level that a lowest interval lies in."""
    return F.shiftright("interval", _STEP * level)


def _candidates(boxes: DataFrame, dims: int, epsilon: float) -> DataFrame:
    """Pairs (a, b), a <= b, of lowest intervals that are not provably distant."""
    low = [F.min(F.col("low")[k]).alias(f"low{k}") for k in range(dims)]
    high = [F.max(F.col("high")[k]).alias(f"high{k}") for k in range(dims)]
    levels, level = [], 0
    while True:
        table = stored(boxes.groupBy(_above(level).alias("i"), _above(level + 1).alias("up")).agg(*low, *high), "boxes")
        levels.append(table)
        if table.count() <= 1:
            break
        level += 1
    pairs = levels[-1].select(F.col("i").alias("a"), F.col("i").alias("b"))
    for table in reversed(levels[:-1]):
        side = lambda x: table.select(
            F.col("up").alias(f"{x}_up"), F.col("i").alias(x),
            *[F.col(f"{e}{k}").alias(f"{x}_{e}{k}") for e in ("low", "high") for k in range(dims)])
        gaps = [F.greatest(F.col(f"q_low{k}") - F.col(f"p_high{k}"), F.col(f"p_low{k}") - F.col(f"q_high{k}"), F.lit(0.0))
                for k in range(dims)]
        apart = sum((g * g for g in gaps), F.lit(0.0))
        pairs = (pairs.join(side("p"), F.col("a") == F.col("p_up")).join(side("q"), F.col("b") == F.col("q_up"))
                 .where((F.col("p") <= F.col("q")) & (apart <= epsilon * epsilon + _NEAR))
                 .select(F.col("p").alias("a"), F.col("q").alias("b")))
        pairs = stored(pairs, "pairs")
    return pairs


def near_vectors(vectors: DataFrame, least: float = 0.9, dims: int = 8, interval_bytes: int = 8 << 20,
                 partition_bytes: int = 64 << 20, leaf: int = 256, id_col: str = "vec_id",
                 vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component): one row a row of ``vectors``."""
    epsilon = math.sqrt(max(0.0, 2 - 2 * least))
    rows = stored(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
                  .mapInArrow(_packed, "id long, width int, v binary"), "vectors")
    part = rows.where("id IS NOT NULL AND v IS NOT NULL")
    classes = stored(part.groupBy("width", "v").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
                     .select("id", "copies", "width", "v"), "classes")
    basis = _principal(classes, dims)
    size = classes.agg(F.sum(8 * F.col("width").cast("long"))).first()[0] or 0
    cells = [f"cell{k}" for k in range(dims)]
    order = ["width", *cells, "id", "v"]
    schema = "id long, copies long, width int, v binary"
    gridded = stored(classes.mapInArrow(_gridded(basis, dims, epsilon),
                                        schema + "".join(f", {c} int" for c in cells)), "gridded")
    sorted_rows = stored(gridded.repartitionByRange(max(1, -(-size // partition_bytes)), "width", *cells, "id")
                         .sortWithinPartitions(*order)
                         .mapInArrow(_numbered, "part int, nth long, " + schema), "sorted")
    sequence = stored(_intervals(sorted_rows, interval_bytes), "sequence")
    boxes = stored(sequence.select("interval", "v").mapInArrow(
        _boxes(basis, dims), "interval long, low array<double>, high array<double>"), "boxes")
    pairs = _candidates(boxes, dims, epsilon)

    row = ["place", "id", "copies", "width", "v"]
    side = lambda x, of: (of.join(sequence.withColumnRenamed("interval", x), x)
                          .select(*[F.col(c).alias(c) for c in ("a", "b", *row)]))
    found = stored(side("a", pairs).groupBy("a", "b")
                   .cogroup(side("b", pairs.where("a <> b")).groupBy("a", "b"))
                   .applyInArrow(_joined(basis, dims, least, epsilon, leaf),
                                 "kind int, interval long, a long, b long"), "found")
    links = found.where("kind = 0").groupBy("interval", F.col("a").alias("place")).agg(F.sum("b").alias("links"))
    linked = stored(sequence.join(links, ["interval", "place"], "left")
                    .select("width", "v", F.col("id").alias("first"),
                            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "linked")
    members = stored(rows.join(linked, ["width", "v"], "left").select("id", "first", "n_links"), "members")
    copies = members.where("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b"))
    groups = components(found.where("kind = 1").select("a", "b").unionByName(copies))
    return (members.join(groups, F.col("id") == F.col("node"), "left")
            .select(F.col("id").alias("vec_id"),
                    F.when(F.col("id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).alias("n_links"),
                    F.coalesce("root", "id").alias("component")))


def vector_report(vectors: DataFrame, **options) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links, component_id and kept."""
    return near_vectors(vectors, **options).select(
        "vec_id", "n_links", F.col("component").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.col("component")).alias("kept"))
