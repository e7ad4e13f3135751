"""Sheet extracts, CSV text whose header stands below banner rows.

The text is read by the block, however large a file is.  Cells may hold line
breaks inside quotes, so a block can begin in the middle of a record: the quotes
of each block are counted first (one small row a block), which tells every block
whether it begins inside quotes.  Blocks that begin outside quotes and have no
line with an open quote, the common case, are one record a line and are not
moved.  Only the lines of other blocks are shuffled, by block, and joined to
records; what is left at the ends of such blocks is chained from block to block.

A record with more cells than the header, and one whose quotes do not close, are
rejected with file and reason instead of being cut down.  A quote belongs to the
cells of RFC 4180: it encloses a cell and is doubled inside one.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

REJECT = "_reject"
REJECT_TYPE = "struct<file: string, reason: string, record: string>"


def header_names(spark: SparkSession, files: list[str], header_row: int) -> list[str]:
    """The cells of row ``header_row`` of the first file, which is read up to there."""
    if not files:
        raise ValueError("no files to read a header from")
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(min(files))
    conf = spark._jsc.hadoopConfiguration()
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
            codec.createInputStream(stream) if codec is not None else stream, "UTF-8"))
        rows = csv.reader(iter(lambda: (line + "\n") if (line := reader.readLine()) is not None else None, None))
        for n, row in enumerate(rows):
            if n == header_row:
                return [c.lstrip("﻿") if i == 0 else c for i, c in enumerate(row)]
    finally:
        stream.close()
    raise ValueError(f"no header on row {header_row} of {min(files)}")


def _records(spark: SparkSession, path: str, max_lines: int) -> DataFrame:
    """(file, at, row, record, closed): the records of the files, ``row`` being the
    record's number in the file's first block, from 0, and null in later ones."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"))
    lines = lines.withColumn("quotes", F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (lines.groupBy("file", "block")
              .agg(F.sum("quotes").alias("_n"), F.max(F.col("quotes") % 2).alias("_open"), F.min("at").alias("first"))
              .withColumn("inside", F.coalesce(F.sum("_n").over(before), F.lit(0)) % 2)
              .select("file", "block", "first", "inside", ((F.col("inside") == 0) & (F.col("_open") == 0)).alias("plain")))
    marked = lines.join(blocks, ["file", "block"])
    row = lambda n: F.when(F.col("block") == 0, n)
    plain = marked.where("plain").select("file", "at", row(F.col("at") - F.col("first")).alias("row"),
                                         F.col("value").alias("record"), F.lit(True).alias("closed"))

    # lines of blocks with open quotes: a line continues a record if the quotes
    # before it are odd in number
    order = Window.partitionBy("file", "block").orderBy("at")
    earlier = F.coalesce(F.sum("quotes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    broken = (marked.where(~F.col("plain")).withColumn("starts", (F.col("inside") + earlier) % 2 == 0)
              .withColumn("number", F.sum(F.col("starts").cast("long")).over(
                  order.rowsBetween(Window.unboundedPreceding, 0))))
    # of a record that does not end, only the first lines are gathered
    start = F.min("at").over(Window.partitionBy("file", "block", "number"))
    broken = broken.withColumn("start", start)
    parts = broken.groupBy("file", "block", "number", "inside").agg(
        F.min("at").alias("at"), F.count(F.lit(1)).alias("n"), F.sum("quotes").alias("quotes"),
        F.array_sort(F.collect_list(F.when(F.col("at") - F.col("start") < max_lines, F.struct("at", "value"))))
         .alias("lines"))
    # number 0 goes on from an earlier block
    odd = (F.col("quotes") + F.when(F.col("number") == 0, F.col("inside")).otherwise(0)) % 2 == 1
    parts = parts.withColumn("open", odd)
    text = lambda c: F.array_join(F.transform(c, lambda x: x["value"]), "\n")
    whole = parts.where(~F.col("open") & (F.col("number") > 0)).select(
        "file", "at", row(F.col("number") - 1).alias("row"), text(F.col("lines")).alias("record"),
        (F.col("n") <= max_lines).alias("closed"))
    ends = Window.partitionBy("file").orderBy("block", "number")
    chain = F.sum((F.col("number") > 0).cast("long")).over(ends.rowsBetween(Window.unboundedPreceding, 0))
    chained = (parts.where(F.col("open") | (F.col("number") == 0)).withColumn("chain", chain)
               .withColumn("nth", F.row_number().over(ends))
               .groupBy("file", "chain")
               .agg(F.min("at").alias("at"), F.min(F.struct("nth", row(F.col("number") - 1).alias("row"))).alias("head"),
                    F.sum("n").alias("n"), F.sum("quotes").alias("quotes"),
                    F.array_sort(F.collect_list(F.when(F.col("nth") - F.col("chain") < max_lines,
                                                       F.struct("nth", "lines")))).alias("pieces"))
               .select("file", "at", F.col("head.row").alias("row"),
                       F.array_join(F.transform("pieces", lambda p: text(p["lines"])), "\n").alias("record"),
                       ((F.col("n") <= max_lines) & (F.col("quotes") % 2 == 0)).alias("closed")))
    return plain.unionByName(whole).unionByName(chained)


def _cells(record: Column) -> Column:
    """The record's cells with every quoted part masked, enough to count them."""
    return F.split(F.regexp_replace(record, '"[^"]*"', "q"), ",", -1)


def read_sheet(spark: SparkSession, path: str, header_row: int = 0, renames: dict[str, str] | None = None,
               rejects: bool = False, max_lines: int = 1000, file_col: str | None = None) -> DataFrame:
    """CSV extract of a sheet whose header is on row ``header_row`` (from 0); what
    stands above it is skipped.  Each file has its own banner, which lies with the
    header in its first split; the header is taken from the first file and must be
    the same in all.  Columns are text; blank
    lines are no rows, cells that a record lacks at its end are null.

    A record that cannot be read whole (surplus cells that are not blank, quotes
    that do not close within ``max_lines`` lines, another header) stops the load;
    with ``rejects`` it is a row of nulls whose column ``_reject`` has file, reason
    and record, and null elsewhere (``quarantine.write_checked`` stores both).
    ``file_col`` adds the file that a row comes from.
    """
    files = list(spark.read.text(path).inputFiles())
    cells_of_header = header_names(spark, files, header_row)
    names = [c or f"_c{i}" for i, c in enumerate(cells_of_header)]
    record = F.regexp_replace("record", "\r$", "")
    rows = _records(spark, path, max_lines).withColumn("record", record).where(
        F.coalesce(F.col("row") >= header_row, F.lit(True)) & (F.trim("record") != ""))
    is_header = F.coalesce(F.col("row") == header_row, F.lit(False))
    cells = _cells(F.col("record"))
    surplus = F.trim(F.array_join(F.slice(cells, len(names) + 1, F.greatest(F.size(cells), F.lit(1))), "")) != ""
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    parsed = F.from_csv("record", schema, {"escape": '"', "maxCharsPerColumn": "-1"})
    same = F.from_csv(F.regexp_replace("record", "^﻿", ""), schema, {"escape": '"'})
    header = F.array(*[F.coalesce(same[n], F.lit("")) for n in names]) == F.array(*[F.lit(c) for c in cells_of_header])
    reason = (F.when(~F.col("closed"), "quotes that do not close")
               .when(is_header & ~header, "another header")
               .when(~is_header & surplus, "surplus cells"))
    rows = rows.withColumn("_reason", reason).where(~is_header | F.col("_reason").isNotNull())
    if not rejects:
        stop = F.raise_error(F.concat_ws(": ", "_reason", "file", "record"))
        rows = rows.withColumn("record", F.when(F.col("_reason").isNull(), F.col("record")).otherwise(stop.cast("string")))
    out = rows.select("file", (F.when(F.col("_reason").isNull(), parsed) if rejects else parsed).alias("r"),
                      F.when(F.col("_reason").isNotNull(), F.struct(
                          "file", F.col("_reason").alias("reason"), "record")).alias(REJECT))
    out = out.select(*[F.col("r")[n].alias(n) for n in names], *([F.col("file").alias(file_col)] if file_col else []),
                     *([REJECT] if rejects else []))
    return out.withColumnsRenamed(renames) if renames else out
