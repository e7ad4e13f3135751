"""Token-ID output: best-fit-decreasing packing into id matrices.

Each task tokenizes its documents and packs them in shards of bounded size, so
no token is shuffled.  Documents longer than a row are cut into pieces without
loss.  Pieces go, longest first, to the row with the smallest residual that
still holds them; a segment tree over residual capacities finds it in log2(row
length) steps.  A shard is written as binary matrices: ``input_ids`` (rows of
``max_len`` little-endian ids, padded), per row the cumulative segment lengths
``cu_seqlens`` and the bit mask ``position_resets`` of the places where the
position starts again at 0, and the (document, piece) of every segment.

The table goes through Spark's Parquet writer into the shared folder, so a lost
executor only repeats its own shards and half-written files never show.

Edge cases: null or empty text is the end id alone; null ids are carried; repeated
rows are documents of their own; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from acqlens.llm.common import shared_folder, slices
from acqlens.llm.tokens import default_tokenizer, encoder

MATRIX = ("shard string, first_row long, n_rows int, row_length int, id_bytes int, "
          "input_ids binary, cu_seqlens array<array<int>>, position_resets binary, "
          "doc_ids array<array<long>>, pieces array<array<int>>")
ROWS = ("sequence_id string, n_segments int, n_tokens long, ids_crc32 long, "
        "doc_ids array<long>, pieces array<int>, cu_seqlens array<int>, resets array<int>")


class CapacityTree:
    """Segment tree over residual capacities 0..size; a leaf counts rows."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, by: int) -> None:
        at = capacity + self.leaves
        while at:
            self.count[at] += by
            at >>= 1

    def smallest(self, need: int) -> int:
        """The smallest capacity >= need that some row has, or -1."""
        count, at = self.count, need + self.leaves
        if count[at]:
            return need
        while at > 1:
            if not at & 1 and count[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if count[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return -1


def best_fit_decreasing(lengths: list[int], size: int) -> list[list[int]]:
    """Rows as lists of indexes into ``lengths`` (each at most ``size``)."""
    tree, rows, by_room = CapacityTree(size), [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        room = tree.smallest(lengths[i])
        if room < 0:
            row, room = len(rows), size
            rows.append([])
        else:
            row = by_room[room].pop()
            tree.add(room, -1)
        rows[row].append(i)
        left = room - lengths[i]
        if left:
            by_room.setdefault(left, []).append(row)
            tree.add(left, 1)
    return rows


def _matrices(shard: str, cuts: list, max_len: int, kind: np.dtype, pad: int,
              block_rows: int) -> Iterator[dict]:
    rows = best_fit_decreasing([len(c[2]) for c in cuts], max_len)
    for first in range(0, len(rows), block_rows):
        part = rows[first:first + block_rows]
        ids = np.full((len(part), max_len), pad, kind)
        resets = np.zeros((len(part), max_len), bool)
        ends = []
        for r, row in enumerate(part):
            ends.append([0])
            for i in row:
                at = ends[-1][-1]
                ids[r, at:at + len(cuts[i][2])] = cuts[i][2]
                resets[r, at] = True
                ends[-1].append(at + len(cuts[i][2]))
        yield {"shard": shard, "first_row": first, "n_rows": len(part), "row_length": max_len,
               "id_bytes": kind.itemsize, "input_ids": ids.tobytes(), "cu_seqlens": ends,
               "position_resets": np.packbits(resets).tobytes(),
               "doc_ids": [[cuts[i][0] for i in row] for row in part],
               "pieces": [[cuts[i][1] for i in row] for row in part]}


def write_matrices(docs: DataFrame, path: str, max_len: int = 2048, tokenizer: str | None = None,
                   end_id: int = 0, pad_id: int = 0, shard_tokens: int = 1 << 22,
                   block_rows: int = 512, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Tokenize, pack and write ``docs`` as Parquet rows of binary matrices.

    ``shard_tokens`` bounds what a task holds (one document may exceed it).
    """
    file = tokenizer or default_tokenizer()
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        enc = encoder(file)
        kind = np.dtype("<u2" if enc.vocabulary <= 1 << 16 else "<u4")
        task, number, cuts, held = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            for block in _matrices(f"{task:06d}-{number:05d}", cuts, max_len, kind, pad_id,
                                   block_rows):
                yield pa.RecordBatch.from_pylist([block], SCHEMA)

        for batch in batches:
            for part in slices(batch, 256):
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc, ids in zip(part.column(0).to_pylist(), enc.encode_many(texts)):
                    ids = np.frombuffer(ids + end, "<u4").astype(kind)
                    cuts += [(doc, k, ids[s:s + max_len])
                             for k, s in enumerate(range(0, len(ids), max_len))]
                    held += len(ids)
                    if held >= shard_tokens:
                        yield from flush()
                        number, cuts, held = number + 1, [], 0
        if cuts:
            yield from flush()

    wide = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    wide.mapInArrow(run, MATRIX).write.option("compression", "zstd").parquet(path)


SCHEMA = pa.schema([
    ("shard", pa.string()), ("first_row", pa.int64()), ("n_rows", pa.int32()),
    ("row_length", pa.int32()), ("id_bytes", pa.int32()), ("input_ids", pa.binary()),
    ("cu_seqlens", pa.list_(pa.list_(pa.int32()))), ("position_resets", pa.binary()),
    ("doc_ids", pa.list_(pa.list_(pa.int64()))), ("pieces", pa.list_(pa.list_(pa.int32())))])

_ROWS = pa.schema([
    ("sequence_id", pa.string()), ("n_segments", pa.int32()), ("n_tokens", pa.int64()),
    ("ids_crc32", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("pieces", pa.list_(pa.int32())),
    ("cu_seqlens", pa.list_(pa.int32())), ("resets", pa.list_(pa.int32()))])


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """One row a packed sequence, from the written matrices: its segments, the
    CRC of its ids as 32-bit integers (without padding) and the places where
    the position starts again, as the bit mask has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                shape = (block["n_rows"], block["row_length"])
                ids = np.frombuffer(block["input_ids"], f"<u{block['id_bytes']}").reshape(shape)
                bits = np.frombuffer(block["position_resets"], np.uint8)
                resets = np.unpackbits(bits, count=shape[0] * shape[1]).reshape(shape)
                yield pa.RecordBatch.from_pylist([{
                    "sequence_id": f"{block['shard']}-{block['first_row'] + r:06d}",
                    "n_segments": len(ends) - 1, "n_tokens": ends[-1],
                    "ids_crc32": zlib.crc32(ids[r, :ends[-1]].astype("<u4").tobytes()),
                    "doc_ids": block["doc_ids"][r], "pieces": block["pieces"][r],
                    "cu_seqlens": ends, "resets": np.flatnonzero(resets[r]).tolist(),
                } for r, ends in enumerate(block["cu_seqlens"])], _ROWS)

    return spark.read.schema(MATRIX).parquet(path).mapInArrow(run, ROWS)


def id_matrices(docs: DataFrame, **options) -> DataFrame:
    """Write the matrices of ``docs`` to the shared folder and read them back."""
    path = shared_folder(docs.sparkSession, "idmatrix")
    write_matrices(docs, path, **options)
    return read_rows(docs.sparkSession, path)
