"""Sources and sinks (S1, S3-S10): readers with explicit schemas and the
write patterns of the reference (append, replace, replace a range, reload
from a watermark, keyed update) on plain parquet directories.

Plain parquet has no DELETE/MERGE, so every rewrite produces a *new version
directory* next to the old one and returns its path; the old version is
never overwritten while it is being read.  ``current_version`` finds the
newest complete version (a version is complete once its _SUCCESS marker
exists), so a job lost halfway leaves the previous version in force and a
rerun is idempotent.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.lender import apply_reload
from .sheets import read_sheet  # noqa: F401  (S4)

_VERSION = re.compile(r"^v(\d{6,})$")


# Whole-table scans.
def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None,
               **options) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str, lower_bound,
              upper_bound, num_partitions: int, **options) -> DataFrame:
    """Database table, read by ``num_partitions`` tasks that each take a range of
    ``partition_column`` (without these one task would read it all).
    Credentials come from the caller's options, the library holds none.
    Filters and column choices are pushed to the database."""
    return (spark.read.format("jdbc").option("url", url).option("dbtable", table)
            .option("partitionColumn", partition_column).option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound)).option("numPartitions", num_partitions)
            .options(**options).load())


# S3: CSV dimension with renames.
def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             renames: dict[str, str] | None = None) -> DataFrame:
    reader = spark.read.option("header", True)
    df = reader.schema(schema).csv(path) if schema is not None else reader.csv(path)
    return df.withColumnsRenamed(renames) if renames else df


# ---------------------------------------------------------------- versions
# Versions are listed through the Hadoop FileSystem of the table root, so the
# same code works on HDFS, object stores and local disks.
def _fs(spark: SparkSession, root: str):
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _version_names(spark: SparkSession, root: str, complete_only: bool) -> list[str]:
    fs, path = _fs(spark, root)
    if not fs.exists(path):
        return []
    names = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if st.isDirectory() and _VERSION.match(name):
            if not complete_only or fs.exists(spark._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                names.append(name)
    return sorted(names, key=lambda n: int(n[1:]))


def current_version(spark: SparkSession, root: str) -> str | None:
    """Newest complete version (its _SUCCESS marker exists), or None."""
    v = _version_names(spark, root, complete_only=True)
    return f"{root.rstrip('/')}/{v[-1]}" if v else None


def _next_version(spark: SparkSession, root: str) -> str:
    taken = [int(n[1:]) for n in _version_names(spark, root, complete_only=False)]
    return f"{root.rstrip('/')}/v{(max(taken) + 1) if taken else 1:06d}"


def read_current(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame | None:
    cur = current_version(spark, root)
    if cur is None:
        return None if schema is None else spark.createDataFrame([], schema)
    return spark.read.parquet(cur)


def _write_version(df: DataFrame, root: str, partition_by: list[str] | None = None) -> str:
    path = _next_version(df.sparkSession, root)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


# Append.  New files are added to the current version with Spark's own
# append: the output committer publishes them only when the job commits, so a
# failed job adds nothing; cost is proportional to the new rows only.
def append(df: DataFrame, root: str, partition_by: list[str] | None = None) -> str:
    cur = current_version(df.sparkSession, root)
    if cur is None:
        return _write_version(df, root, partition_by)
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(cur)
    return cur


# Append that may be run again.  The rows of a batch are stored under its id,
# by overwriting that one partition, and a marker is set once Spark has committed
# them: a batch that is published already is not written again, one that a lost
# job left half done is written anew.
def append_batch(df: DataFrame, root: str, batch: str, batch_col: str = "batch_id") -> str:
    spark = df.sparkSession
    cur = current_version(spark, root) or _empty_version(spark, root)
    marker = f"{cur}/_batches/{batch}"
    if not _exists(spark, marker):
        (df.withColumn(batch_col, F.lit(batch)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(batch_col).parquet(cur))
        _touch(spark, marker)
    return cur


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def _empty_version(spark: SparkSession, root: str) -> str:
    path = _next_version(spark, root)
    _touch(spark, f"{path}/_SUCCESS")
    return path


# Replace the whole table.
def replace(df: DataFrame, root: str, partition_by: list[str] | None = None) -> str:
    return _write_version(df, root, partition_by)


# Replace a range of a column, then append (as one new version).
def replace_range(old: DataFrame, new: DataFrame, col: str, lo, hi) -> DataFrame:
    """Old rows outside [lo, hi] plus all new rows.  Unlike dynamic partition
    overwrite this also removes old years for which no new rows came."""
    inside = F.coalesce(F.col(col).between(lo, hi), F.lit(False))  # a null is in no range
    return old.where(~inside).unionByName(new)


def replace_range_table(new: DataFrame, root: str, col: str, lo, hi,
                        partition_by: list[str] | None = None) -> str:
    spark = new.sparkSession
    old = read_current(spark, root)
    out = new if old is None else replace_range(old, new, col, lo, hi)
    return _write_version(out, root, partition_by)


# S7 in place: only the partitions of the replaced values are written.
def replace_partitions(new: DataFrame, root: str, col: str, values: list) -> str:
    """Replace the partitions ``values`` of the current version, which is partitioned
    by ``col``: dynamic partition overwrite for those that have new rows, and removal
    of old ones that have none.  The files of other partitions, and of rows without
    a value, are not touched.  A new row of another partition stops the job before
    anything is published.  A job lost half way is mended by running it again;
    readers that must not see a half-replaced range use ``replace_range_table``,
    which writes a new version."""
    spark = new.sparkSession
    cur = current_version(spark, root) or _empty_version(spark, root)
    outside = F.raise_error(F.concat(F.lit(f"row outside {values[0]} to {values[-1]}: "),
                                     F.coalesce(F.col(col).cast("string"), F.lit("null"))))
    kept = F.when(F.col(col).isin(values), F.col(col)).otherwise(outside.cast(new.schema[col].dataType))
    written = Observation("partitions")
    (new.withColumn(col, kept).observe(written, F.collect_set(F.col(col).cast("string")).alias("values"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(col).parquet(cur))
    have = set(written.get["values"])
    fs, path = _fs(spark, cur)
    for value in values:
        old = spark._jvm.org.apache.hadoop.fs.Path(path, f"{col}={value}")
        if str(value) not in have and fs.exists(old):
            fs.delete(old, True)
    return cur


def replace_years(new: DataFrame, root: str, year_col: str, lo: int, hi: int) -> str:
    """``replace_partitions`` for the years ``lo`` to ``hi``."""
    return replace_partitions(new, root, year_col, list(range(lo, hi + 1)))


# Reload from a watermark.  A watermark at or after the stored maximum
# deletes nothing, so the new rows are appended; an earlier one deletes the
# stored rows after it, which plain parquet can only do by writing the kept
# rows and the new ones as a new version (the loaded tables are aggregates —
# centre x account x month — far smaller than the ledgers they come from).
# Rerunning a finished reload with the same watermark yields the same table.
def reload_table(new_rows: DataFrame, root: str, watermark: _dt.date, date_col: str = "Date",
                 skip_empty: bool = False) -> str | None:
    spark = new_rows.sparkSession
    if skip_empty and new_rows.isEmpty():
        return current_version(spark, root)
    top = stored_max(spark, root, date_col)
    if top is None or watermark >= top:
        return append(new_rows, root)
    stored = read_current(spark, root)
    return _write_version(apply_reload(stored, new_rows, watermark, date_col), root)


def stored_max(spark: SparkSession, root: str, date_col: str = "Date"):
    """The stored high-water mark (None for an empty table)."""
    cur = read_current(spark, root)
    return None if cur is None else cur.agg(F.max(date_col)).first()[0]


# Keyed update written as a new version.
def update_table(root: str, source: DataFrame, key: str, assignments: dict[str, str]) -> str:
    from ..operators.acquisitions import keyed_update
    spark = source.sparkSession
    target = read_current(spark, root)
    if target is None:
        raise ValueError(f"no table at {root} to update")
    return _write_version(keyed_update(target, source, key, assignments), root)


# CSV export of a result.
def export_csv(df: DataFrame, path: str, order_by: list[str] | None = None) -> None:
    """O1 + S10: ordering happens here, at the sink, and nowhere upstream."""
    out = df.orderBy(*order_by) if order_by else df
    out.write.mode("overwrite").option("header", True).csv(path)
