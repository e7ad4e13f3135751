"""Line dedup over levelled sorted runs of line hashes.

``LineRuns`` is the state: tables of distinct line hashes, each sorted and
bucketed by hash, on levels as in a log-structured merge tree.  A new batch is
reduced to one row a line, merge-anti-joined with every run in turn (buckets
meet buckets, the runs are never shuffled) and its unseen hashes become a run on
level 0; hashes that are already there leave only their count.  Whenever a level
holds ``fanout`` runs they are merged into one run of the next level, so n
batches leave O(log n) runs.

``dedup_lines`` feeds the documents in batches of falling id.  The batch in which
a line is first seen then holds the largest id with that line, which is the
keeper; after the last batch, lines of at least ``min_docs`` documents lose all
other occurrences.

A line's key is the line without ASCII white space at both ends and with A-Z
lower-cased; lines are compared by the 128-bit digest of the key.

Edge cases: null or empty text is one empty line; a null id counts as smaller
than any other; rows that share an id count as documents of their own, and all
rows with the keeper's id keep the line; keys shorter than ``min_chars`` code
points always stay; an empty table gives no rows.  All columns are passed on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from acqlens.llm.common import bucketed, free_name, shared_folder, slices, stored, utf8

BLANK = b" \t\n\x0b\x0c\r"
NO_ID = -(1 << 63)


def line_digest(line: bytes, min_chars: int) -> bytes | None:
    """Digest of the line's key; None where the key is too short to count."""
    key = line.strip(BLANK).lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return hashlib.md5(key, usedforsecurity=False).digest()


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(line, doc) once a document and key, for keys that are long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1000, 1):
                lines, ids = [], []
                for doc, text in zip(part.column(0).to_pylist(), utf8(part.column(1))):
                    found = {line_digest(x, min_chars) for x in text.split(b"\n")} - {None}
                    lines += found
                    ids += [doc] * len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lines, pa.binary()), pa.array(ids, pa.int64())], ["line", "doc"])

    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.col(text_col).alias("text")).mapInArrow(run, "line binary, doc long")


class LineRuns:
    """Levelled sorted runs (line, keeper, n) in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = 3):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []
        self.seen: list[DataFrame] = []  # (line, n) of lines that a later batch met again

    def _run(self, rows: DataFrame) -> DataFrame:
        return bucketed(rows.repartition(self.buckets, "line"), "line_run", "line")

    def add(self, batch: DataFrame) -> None:
        """``batch``: (line, doc) rows of documents that no earlier batch had."""
        lines = batch.groupBy("line").agg(F.max("doc").alias("keeper"), F.count("*").alias("n"))
        unseen, runs = lines, [r for level in self.levels for r in level]
        for run in runs:
            unseen = unseen.join(run.select("line"), "line", "left_anti")
        unseen = self._run(unseen)
        if runs:
            path = shared_folder(self.spark, "seen")
            (lines.join(unseen.select("line"), "line", "left_anti").select("line", "n")
             .write.option("compression", "zstd").parquet(path))
            self.seen.append(self.spark.read.schema("line binary, n long").parquet(path))
        self._place(unseen, 0)

    def _place(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            merged = self.levels[level][0]
            for other in self.levels[level][1:]:
                merged = merged.unionByName(other)
            self.levels[level] = []
            self._place(self._run(merged), level + 1)

    def repeated(self, min_docs: int) -> DataFrame:
        """(line, keeper) of the lines that at least ``min_docs`` documents hold."""
        parts = [r for level in self.levels for r in level]
        parts += [s.withColumn("keeper", F.lit(None).cast("long")) for s in self.seen]
        rows = parts[0].select("line", "keeper", "n")
        for other in parts[1:]:
            rows = rows.unionByName(other.select("line", "keeper", "n"))
        return (rows.groupBy("line").agg(F.max("keeper").alias("keeper"), F.sum("n").alias("n"))
                .where(F.col("n") >= min_docs).select("line", "keeper"))


def _rewrite(docs: DataFrame, text_col: str, min_chars: int, counts: bool) -> DataFrame:
    """The last column of ``docs`` holds digests: lines with these go."""
    out = StructType(docs.schema.fields[:-1])
    names = out.names[:]
    if counts:
        out = out.add("n_lines", LongType()).add("n_dropped", LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            for part in slices(batch, 1000, at):
                texts, n_lines, n_dropped = [], [], []
                for text, null, drop in zip(utf8(part.column(at)), part.column(at).is_null().to_pylist(),
                                            part.column(part.num_columns - 1).to_pylist()):
                    lines = text.split(b"\n")
                    n_lines.append(len(lines))
                    if drop:
                        gone = set(drop)
                        kept = [x for x in lines if line_digest(x, min_chars) not in gone]
                        text = b"\n".join(kept)
                        n_dropped.append(len(lines) - len(kept))
                    else:
                        n_dropped.append(0)
                    texts.append(None if null else text.decode())
                columns = [pa.array(texts, part.column(at).type) if i == at
                           else part.column(i) for i in range(len(names))]
                if counts:
                    columns += [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, out.names)

    return docs.mapInArrow(run, out)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 20, min_docs: int = 3, batches: int = 4,
                fanout: int = 3, counts: bool = False) -> DataFrame:
    """``docs`` with the text's repeated lines removed; with ``counts`` also the
    columns ``n_lines`` (before) and ``n_dropped``."""
    spark = docs.sparkSession
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    edges = docs.select(F.percentile_approx(
        key, [k / batches for k in range(1, batches)], 1000).alias("e")).first()["e"] or []
    path = shared_folder(spark, "lines")
    number = F.lit(0)
    for e in sorted(set(edges)):
        number = number + (F.col("doc") <= e).cast(IntegerType())
    (line_hashes(docs, id_col, text_col, min_chars).withColumn("batch", number)
     .write.partitionBy("batch").option("compression", "zstd").parquet(path))
    lines = spark.read.schema("line binary, doc long, batch int").parquet(path)
    runs = LineRuns(spark, fanout)
    for b in range(len(set(edges)) + 1):  # falling ids: batch 0 holds the largest
        runs.add(lines.where(F.col("batch") == b).select("line", "doc"))
    doc, drop = free_name(docs, "llm_doc"), free_name(docs, "llm_drop")
    # stored, so that the join reads two shuffles and a frequent line can be split
    repeated = stored(runs.repeated(min_docs), "repeated")
    drops = (lines.join(repeated, "line").where("doc <> keeper")
             .groupBy(F.col("doc").alias(doc)).agg(F.collect_list("line").alias(drop)))
    joined = docs.join(drops, key == F.col(doc), "left").select(*docs.columns, drop)
    return _rewrite(joined, text_col, min_chars, counts)


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                **options) -> DataFrame:
    """Per document: lines before, lines dropped, SHA-256 of what is left."""
    kept = dedup_lines(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                                   F.col(text_col).alias("text")), counts=True, **options)
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"))
