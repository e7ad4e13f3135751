"""Same-store occupancy metrics for month, quarter and trailing twelve
months, this year and last year, in one pass over the panel."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fiscal
from ..functions.stats import exact_median

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's report.
SHARE_THRESHOLD = 0.85
# Lower edges of the ten occupancy buckets (bucket 1 has no lower edge).
BUCKET_LOWER = [0.775, 0.80, 0.825, 0.85, 0.875, 0.90, 0.925, 0.95, 0.975]
# Upper edges as the reference wrote them (they leave gaps between buckets).
LITERAL_UPPER = [0.7749, 0.7999, 0.8249, 0.8499, 0.8749, 0.8999, 0.9249, 0.9499, 0.9749, 1.0]
# ---------------------------------------------------------------------------

# Periods whose top bucket the reference ends at 1 (fixed value).
CAPPED_PERIODS = ("month", "month_ly", "ttm_ly")

# Periods relative to the anchor month: (name, first month back, last month back).
PERIODS = [("month", 0, 0), ("quarter", 0, 2), ("ttm", 0, 11),
           ("month_ly", 12, 12), ("quarter_ly", 12, 14), ("ttm_ly", 12, 23)]


def occupancy_panel(rooms_occ: DataFrame, rooms_total: DataFrame, centres: DataFrame,
                    entity_info: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """Same-store panel: entities whose cost centre is on the list (minus
    exclusions); occupied rooms left-joined to total rooms on (entity,
    month); nulls 0; occupancy = occupied / total, 0 when total is 0."""
    cs = centres.select(F.col("profit_center").alias("Cost Center"))
    if exclude:
        cs = cs.where(~F.col("Cost Center").isin(list(exclude)))
    ents = entity_info.join(cs, "Cost Center", "left_semi").select("MEntity")
    occ = rooms_occ.select("MEntity", "Date", F.col("Amount").alias("occ")).join(ents, "MEntity", "left_semi")
    tot = rooms_total.select("MEntity", "Date", F.col("Amount").alias("total"))
    p = occ.join(tot, ["MEntity", "Date"], "left")
    o, t = F.coalesce(F.col("occ"), F.lit(0)), F.coalesce(F.col("total"), F.lit(0))
    return p.select("MEntity", "Date", o.alias("occ"), t.alias("total"),
                    F.coalesce(F.try_divide(o, t), F.lit(0.0)).alias("occupancy"))


def tag_periods(panel: DataFrame, anchor: _dt.date) -> DataFrame:
    """Each panel row once per period containing its month (at most three),
    computed arithmetically: no join against a period table."""
    back = fiscal.month_diff(F.col("Date"), F.lit(anchor))
    tags = F.array_compact(F.array(*[F.when(back.between(lo, hi), F.lit(name)) for name, lo, hi in PERIODS]))
    lo_date = fiscal.py_add_months(anchor, -23)
    return (panel.where(F.col("Date").between(F.lit(lo_date), F.lit(anchor)))
                 .select("*", F.explode(tags).alias("period")))


def per_entity(panel: DataFrame, anchor: _dt.date) -> DataFrame:
    """Occupied and total rooms summed per (period, entity), then the ratio."""
    tagged = tag_periods(panel, anchor)
    ent = tagged.groupBy("period", "MEntity").agg(F.sum("occ").alias("occ"), F.sum("total").alias("total"))
    return ent.withColumn("occupancy", F.coalesce(F.try_divide(F.col("occ"), F.col("total")), F.lit(0.0)))


def samestore_metrics(panel: DataFrame, anchor: _dt.date, threshold: float = SHARE_THRESHOLD,
                      denominator: int | None = None) -> DataFrame:
    """Weighted occupancy (sum occupied / sum total), exact median of the
    per-entity occupancy, share of entities at or above ``threshold``.

    The share divides by the entities of the period unless ``denominator``
    is given (the reference divides by a fixed list size).
    """
    ent = per_entity(panel, anchor)
    base = ent.groupBy("period").agg(
        F.count(F.lit(1)).alias("n_entities"),
        F.sum("occ").alias("_occ"), F.sum("total").alias("_tot"),
        F.count_if(F.col("occupancy") >= F.lit(threshold)).alias("n_at_threshold"))
    med = exact_median(ent, ["period"], "occupancy", "_median")
    den = F.lit(denominator) if denominator is not None else F.col("n_entities")
    out = base.join(med, "period", "left")
    return out.select(
        "period", "n_entities",
        F.try_divide(F.col("_occ").cast("double"), F.col("_tot").cast("double")).alias("weighted_occ"),
        F.col("_median").alias("median_occ"),
        "n_at_threshold",
        F.try_divide(F.col("n_at_threshold"), den).alias("share_at_threshold"))


def bucket_conditions(x: Column, cap_top: bool = False, literal_edges: bool = False) -> list[Column]:
    if literal_edges:
        conds = [x <= LITERAL_UPPER[0]]
        for lo, hi in zip(BUCKET_LOWER, LITERAL_UPPER[1:]):
            conds.append((x >= lo) & (x <= hi) if (hi != 1.0 or cap_top) else (x >= lo))
        return conds
    edges = BUCKET_LOWER
    conds = [x < edges[0]]
    for lo, hi in zip(edges, edges[1:]):
        conds.append((x >= lo) & (x < hi))
    conds.append((x >= edges[-1]) & (x <= 1.0) if cap_top else (x >= edges[-1]))
    return conds


def samestore_histogram(panel: DataFrame, anchor: _dt.date, capped: Collection[str] = (),
                        literal_edges: bool = False) -> DataFrame:
    """Ten-bucket histogram of per-entity occupancy per period (one pass,
    ten conditional counts).  Default buckets are contiguous and half-open,
    the top one uncapped; ``literal_edges`` reproduces the reference's gaps,
    ``capped`` names the periods whose top bucket ends at 1."""
    ent = per_entity(panel, anchor)
    conds = bucket_conditions(F.col("occupancy"), False, literal_edges)
    if capped:
        top = bucket_conditions(F.col("occupancy"), True, literal_edges)[-1]
        conds[-1] = F.when(F.col("period").isin(list(capped)), top).otherwise(conds[-1])
    return ent.groupBy("period").agg(
        *[F.count_if(c).alias(f"bucket_{i}") for i, c in enumerate(conds, start=1)])
