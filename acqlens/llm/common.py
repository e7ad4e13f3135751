"""Shared helpers: the folder all executors see, stored intermediate tables,
byte access to Arrow columns, word hashes."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, the folder that the driver and
    all executors share.  The setting is read from the session; only a local
    session that has none (tests) uses a scratch folder, anywhere else that is an
    error.  Whoever set the folder empties it: results are lazy and may still read
    from it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, so a
    lost executor costs no recomputation before this point.  The shuffle files of
    the write go when it is done, as nothing reads them again."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The values of a string column as bytes, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection that spreads every bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: what this worker process remembers, by the work that it is for
_CACHES: dict[str, list] = {}
_NOW: list[str] = []


def remembered(work: str, cache):
    """``cache``, a dict (or anything with ``clear``) kept in this process for
    ``work``; see ``working``."""
    _CACHES.setdefault(work, []).append(cache)
    return cache


def working(work: str) -> None:
    """Says what this process works on from now on.  Workers go from stage to stage,
    and what they remember for other work than this is dropped."""
    if _NOW == [work]:
        return
    for other, caches in _CACHES.items():
        if other != work:
            for cache in caches:
                cache.clear()
    if _NOW:
        trim()
    _NOW[:] = [work]


def trim() -> None:
    """Hands the memory that this process has freed back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


class WordHashes(dict):
    """word bytes -> 64-bit hash, remembered up to ``keep`` bytes of words and
    entries (about 140 a word and its length)."""

    def __init__(self, keep: int = 64 << 20):
        super().__init__()
        self.keep, self.held = keep, 0

    def __missing__(self, word: bytes) -> int:
        self.held += 140 + len(word)
        if self.held > self.keep:
            self.clear()
            self.held = 140 + len(word)
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def clear(self) -> None:
        super().clear()
        self.held = 0

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), U64, len(words))


#: one table of word hashes a process, whoever asks
WORD_HASHES = remembered("word hashes", WordHashes())


def slices(batch: pa.RecordBatch, rows: int = 256, text: int | None = None,
           size: int = 4 << 20):
    """Views of a batch of at most ``rows`` rows, which bounds what a task holds;
    with ``text``, a column's index, also of at most ``size`` bytes of it (one
    row may have more)."""
    if text is None:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(lengths):
        if i > start and (i - start >= rows or held + n > size):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if lengths:
        yield batch.slice(start)


def stretches(text: bytes, size: int = 1 << 20):
    """``text`` cut at blanks into parts of about ``size`` bytes."""
    at = 0
    while len(text) - at > size:
        cut = text.find(b" ", at + size)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:] if at else text


def bucketed(df: DataFrame, name: str, column: str) -> DataFrame:
    """Store ``df`` bucketed and sorted by ``column`` in the shared folder: joins
    and groupings on it move only the other side.  As many buckets as shuffle
    partitions, so rows that a shuffle on the column has dealt stay together.
    The catalog only lends the buckets: its entry goes at once, the files stay."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}"
    (df.write.format("parquet").bucketBy(buckets, column).sortBy(column)
     .option("compression", "zstd").option("path", shared_folder(spark, name)).saveAsTable(table))
    rows = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return rows
