"""Move-in comparison between a current-year and a prior-year window."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import pick_per_key, ratio_half_up
from .occupancy import storage_product

CONTRACT_COLS = ["con_entity", "cus_firstname", "cus_lastname", "det_movein", "det_enddate", "esc_product"]


def first_per_contract(df: DataFrame, key: str = "con_pk", order: list[str] | None = None) -> DataFrame:
    """One row per contract.  Spark has no arrival order, so the first
    row is the smallest by ``order`` (default: all columns), through a
    partially aggregated ``min``: a contract with many rows is never sorted
    in one task."""
    cols = [c for c in df.columns if c != key]
    order_cols = [F.col(c) for c in (order or cols)]
    return pick_per_key(df, [key], order_cols, cols, latest=False)


def with_person_key(df: DataFrame) -> DataFrame:
    """Person key from entity and names; the raw names do not leave the job.
    Each part goes in with its length, a null as ``n``, so that no two people
    share a key because a part is missing."""
    parts = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("n"))
             for c in ("con_entity", "cus_firstname", "cus_lastname")]
    pk = F.sha2(F.concat_ws("|", *parts), 256)
    return df.withColumn("person_key", pk).drop("cus_firstname", "cus_lastname")


def window_contracts(moves: DataFrame, start: _dt.date, end: _dt.date, label: str,
                     exclude_before_dedupe: bool = False, keep_null_product: bool = False) -> DataFrame:
    """Contracts moving in within [start, end] (both ends included), first row
    per contract, U-box excluded (before or after the deduplication, as the
    two sources of the reference differ)."""
    w = moves.where(F.col("det_movein").between(F.lit(start), F.lit(end)))
    keep = storage_product(F.col("esc_product"), keep_null_product)
    if exclude_before_dedupe:
        w = first_per_contract(w.where(keep))
    else:
        w = first_per_contract(w).where(keep)
    w = w.withColumn("same_day", F.col("det_movein") == F.col("det_enddate"))
    return with_person_key(w).withColumn("window", F.lit(label))


def compare_windows(moves: DataFrame, cy: tuple[_dt.date, _dt.date], ly: tuple[_dt.date, _dt.date]) -> DataFrame:
    cur = window_contracts(moves, cy[0], cy[1], "cy")
    prev = window_contracts(moves, ly[0], ly[1], "ly", exclude_before_dedupe=True)
    return cur.unionByName(prev)


def counts_by_day(contracts: DataFrame) -> DataFrame:
    """A10: contracts per move-in date and window (value counts)."""
    return contracts.groupBy("window", "det_movein").agg(F.count(F.lit(1)).alias("count"))


def same_day_share(moves: DataFrame) -> DataFrame:
    """Rows, same-day move-in/out rows and their share (6 places)."""
    same = F.col("det_movein") == F.col("det_enddate")
    agg = moves.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(same).alias("n_same_day"))
    return agg.withColumn("share_same_day", ratio_half_up(F.col("n_same_day"), F.col("n_rows"), 6))
