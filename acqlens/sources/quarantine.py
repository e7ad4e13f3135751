"""Records that cannot be read go to a rejects table, written in
the same pass as the rows that can.

A frame to be checked carries a column ``_reject`` (file, reason, record), null
for rows that are fine.  ``sheets.read_sheet`` and ``read_csv`` add it for
records that cannot be cut into cells, ``cast_or_reject`` for cells that cannot
be read as their type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.cleaning import amount_or_zero
from .sheets import REJECT, REJECT_TYPE
from .tables import current_version, replace


def read_csv(spark: SparkSession, path: str, schema: StructType, renames: dict[str, str] | None = None) -> DataFrame:
    """S3: typed CSV with its header on the first line; a record with another
    number of cells or a cell that is not of its type is rejected."""
    corrupt = "_corrupt_record"
    typed = StructType(schema.fields).add(corrupt, "string")
    df = (spark.read.schema(typed).option("header", True).option("mode", "PERMISSIVE").option("escape", '"')
          .option("columnNameOfCorruptRecord", corrupt).csv(path))
    bad = F.col(corrupt).isNotNull()
    reject = F.when(bad, F.struct(F.col("_metadata.file_path").alias("file"), F.lit("malformed record").alias("reason"),
                                  F.col(corrupt).alias("record")))
    out = df.select(*[F.when(~bad, F.col(f"`{f.name}`")).alias(f.name) for f in schema.fields], reject.alias(REJECT))
    return out.withColumnsRenamed(renames) if renames else out


def cast_or_reject(df: DataFrame, types: dict[str, str], amounts: list[str] | None = None,
                   required: list[str] | None = None, file_col: str | None = None) -> DataFrame:
    """Text columns as their types.  A row is rejected, for the first reason that
    holds, if a ``required`` cell is blank or a cell that is not blank cannot be
    read; cells of ``amounts`` follow the sentinel rule ('x' and blank are 0).
    ``file_col`` holds the row's file and is no cell of it."""
    amounts = amounts or []
    q = lambda c: F.col("`" + c.replace("`", "``") + "`")
    blank = lambda c: F.trim(F.coalesce(q(c).cast("string"), F.lit(""))) == ""
    value = {c: amount_or_zero(q(c), "x", t) if c in amounts else F.trim(q(c).cast("string")).try_cast(t)
             for c, t in types.items()}
    reasons = [F.when(blank(c), F.lit(f"no {c}")) for c in required or []]
    reasons += [F.when(~blank(c) & value[c].isNull(), F.lit(f"unreadable {c}")) for c in types]
    columns = [c for c in df.columns if c not in (REJECT, file_col)]
    before = F.col(REJECT) if REJECT in df.columns else F.lit(None).cast(REJECT_TYPE)
    record = F.to_csv(F.struct(*[q(c).alias(c) for c in columns]), {"quoteAll": "true", "escape": '"'})
    reason = F.coalesce(*reasons) if reasons else F.lit(None).cast("string")
    reject = F.coalesce(before, F.when(reason.isNotNull(), F.struct(
        (q(file_col) if file_col else F.lit(None).cast("string")).alias("file"), reason.alias("reason"),
        record.alias("record"))))
    marked = df.select(*[q(c) for c in columns], reject.alias(REJECT))
    return marked.select(*[(value[c] if c in types else q(c)).alias(c) for c in columns], REJECT)


def write_checked(df: DataFrame, root: str) -> str:
    """One write of accepted rows and rejects, as a new version of ``root``."""
    return replace(df.withColumn("rejected", F.col(REJECT).isNotNull()), root, ["rejected"])


def _current(spark: SparkSession, root: str, rejected: bool) -> DataFrame:
    cur = current_version(spark, root)
    if cur is None:
        raise ValueError(f"no table at {root}")
    return spark.read.parquet(cur).where(F.col("rejected").cast("string") == str(rejected).lower()).drop("rejected")


def read_accepted(spark: SparkSession, root: str) -> DataFrame:
    """The rows that were fine; the rejects' files are not read."""
    return _current(spark, root, False).drop(REJECT)


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """(file, reason, record) of each rejected record."""
    return _current(spark, root, True).select(f"{REJECT}.*")
