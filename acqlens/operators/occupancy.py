"""Occupancy and forecasts: X17 actual occupancy, X18 group occupancy, X19
forecast splice / latest vintage / capacity / listed forecasts."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fiscal
from ..functions.stats import avg_money_half_up, pick_per_key, ratio_half_up, salted_join

# Fixed value: the product excluded from storage occupancy (compared
# case-insensitively; the sources spell it "UBOX" and "Ubox").
EXCLUDED_PRODUCT = "UBOX"


def storage_product(product: Column, keep_null: bool = False) -> Column:
    """Q19: product is not U-box; a null product is dropped unless kept."""
    cond = F.upper(product) != EXCLUDED_PRODUCT
    return F.coalesce(cond, F.lit(keep_null))


def _fiscal_cols(d: Column) -> list[Column]:
    return [fiscal.fiscal_year(d).alias("fiscal_year"), fiscal.fiscal_month(d).alias("fiscal_month"),
            fiscal.fiscal_quarter(d).alias("fiscal_quarter"), fiscal.month_abbr(d).alias("month_abbr")]


def actual_occupancy(unit_mix: DataFrame, acq_list: DataFrame, as_of: _dt.date,
                     keep_null_product: bool = False) -> DataFrame:
    """Units and occupied units by month x entity x product for included
    entities, U-box excluded, up to the first of the month before ``as_of``."""
    last = fiscal.py_prev_month_start(as_of)
    listed = acq_list.where(F.col("Include").try_cast("boolean")).select("MEntity")
    um = (unit_mix.where(storage_product(F.col("unm_product"), keep_null_product)
                         & (F.col("Date") <= F.lit(last)))
                  .join(listed, "MEntity", "left_semi"))
    agg = um.groupBy("Date", "MEntity", "unm_product").agg(
        F.sum("unm_numunits").alias("unm_numunits"), F.sum("unm_occunits").alias("unm_occunits"))
    return agg.select("Date", "MEntity", "unm_product", "unm_numunits", "unm_occunits",
                      *_fiscal_cols(F.col("Date")))


def group_occupancy(actual: DataFrame, acq_list: DataFrame) -> DataFrame:
    """Total and occupied rooms per month x acquisition group, with the
    number of distinct entities of the group.

    One grouping-sets aggregate yields both levels from a single pass over
    the occupancy rows: (month, group) room sums and per-group distinct
    entities.  The group count is then attached to the month rows with a
    window partitioned by group, whose partitions hold one row per month
    plus one (bounded by the calendar, not by the data).
    """
    keys = ["Date", "Group", "fiscal_year", "fiscal_month", "fiscal_quarter", "month_abbr"]
    j = actual.join(acq_list.select("MEntity", "Group"), "MEntity")
    both = j.groupingSets([keys, ["Group"]], *keys).agg(
        F.sum("unm_numunits").alias("Total_Rooms"), F.sum("unm_occunits").alias("Occupied_Rooms"),
        F.countDistinct("MEntity").alias("_n"), F.grouping_id().alias("_gid"))
    group_level = F.col("_gid") != 0
    n = F.max(F.when(group_level, F.col("_n"))).over(Window.partitionBy("Group"))
    return (both.withColumn("n_entities", n).where(~group_level)
                .select(*keys, "Total_Rooms", "Occupied_Rooms", "n_entities"))


def occupancy_mix(unit_mix: DataFrame, entities: DataFrame, month: _dt.date,
                  min_date: _dt.date | None = None) -> DataFrame:
    """X19a (actual part): one month by entity x product x climate: average
    rent rate, total and occupied units, occupied share (each rounded to 2;
    the share from integer sums, half-up)."""
    um = unit_mix.where((F.col("Date") == F.lit(month)) & storage_product(F.col("unm_product")))
    if min_date is not None:
        um = um.where(F.col("Date") >= F.lit(min_date))
    # the key list goes in as it is: a distinct here would keep AQE from
    # splitting a hot entity (see ledger.restrict_ledger)
    um = um.join(entities.select("MEntity"), "MEntity", "left_semi")
    agg = um.groupBy("Date", "MEntity", F.col("unm_product").alias("product"),
                     F.col("unm_climate").alias("climate")).agg(
        avg_money_half_up(F.col("unm_rentrate"), 2).alias("rent_rate"),
        F.sum("unm_numunits").alias("total_units"),
        F.sum("unm_occunits").alias("occ_units"))
    return agg.withColumn("occ_pct", ratio_half_up(F.col("occ_units"), F.col("total_units"), 2))


def forecast_splice(unit_mix: DataFrame, forecast: DataFrame, as_of: _dt.date,
                    min_date: _dt.date | None = None) -> DataFrame:
    """Last month's actual mix for entities with a forecast, followed by
    forecast rows strictly after the latest actual date (all of them when
    there is no actual row).  Columns are matched by name; absent ones null."""
    month = fiscal.py_prev_month_start(as_of)
    actual = occupancy_mix(unit_mix, forecast, month, min_date)
    # the actual part is one month: whether it has a row decides the cut
    latest = (unit_mix.where((F.col("Date") == F.lit(month)) & storage_product(F.col("unm_product")))
              .join(forecast.select("MEntity"), "MEntity", "left_semi").select(F.max("Date")).scalar())
    if min_date is not None and min_date > month:
        latest = F.lit(None).cast("date")
    fc = forecast.where(latest.isNull() | (F.col("FC_Date") > latest))
    return actual.unionByName(fc, allowMissingColumns=True)


def latest_vintage(forecast: DataFrame, min_rows: int = 2) -> DataFrame:
    """Per entity all rows of its greatest Start_Date; entities whose
    latest vintage has fewer than ``min_rows`` rows are dropped.

    Two aggregates (rows per vintage, then the latest vintage per entity) and
    one salted join back: no window buffers a whole entity, and an entity
    holding a large share of the forecast rows is spread over many join tasks.
    """
    per_vintage = forecast.groupBy("MEntity", "Start_Date").agg(F.count(F.lit(1)).alias("n"))
    latest = pick_per_key(per_vintage, ["MEntity"], [F.col("Start_Date")], ["Start_Date", "n"])
    keep = latest.where(F.col("n") >= min_rows).select("MEntity", "Start_Date")
    rows = salted_join(forecast, keep, ["MEntity", "Start_Date"])
    return rows.select("ID", "MEntity", "Start_Date", F.col("FC_Date").alias("MONTH"), "FC_Occ",
                       *_fiscal_cols(F.col("FC_Date")))


def forecast_capacity(latest: DataFrame, actual: DataFrame, acq_list: DataFrame) -> DataFrame:
    """Latest forecast with the entity's total rooms in its latest
    actual month (summed over products) and its acquisition group."""
    rooms = actual.groupBy("MEntity", "Date").agg(F.sum("unm_numunits").alias("Total_Rooms"))
    last = pick_per_key(rooms, ["MEntity"], [F.col("Date")], ["Total_Rooms"])
    grp = acq_list.select("MEntity", "Group")
    j = salted_join(latest.join(grp, "MEntity", "left"), last, ["MEntity"], "left")
    return j.select("ID", "MEntity", "MONTH", F.col("FC_Occ").alias("Forecasted_Rooms"), "Group",
                    F.col("fiscal_year").alias("FY"), F.col("fiscal_month").alias("FM"),
                    F.col("fiscal_quarter").alias("Quarter"), F.col("month_abbr").alias("Month1"),
                    "Total_Rooms")


def forecast_group_entities(latest: DataFrame, acq_list: DataFrame) -> DataFrame:
    """Distinct entities with a forecast per acquisition group."""
    listed = latest.select("MEntity").distinct().join(acq_list.select("MEntity", "Group"), "MEntity")
    return listed.groupBy("Group").agg(F.countDistinct("MEntity").alias("n_entities"))


def listed_forecasts(forecast: DataFrame, acq_list: DataFrame, as_of: _dt.date | None = None) -> DataFrame:
    """X19d: forecast rows of entities on the list; with ``as_of`` only
    vintages starting after the first of the month before it."""
    out = forecast.join(acq_list.select("MEntity"), "MEntity", "left_semi")
    if as_of is not None:
        out = out.where(F.col("Start_Date") > F.lit(fiscal.py_prev_month_start(as_of)))
    return out
