"""Acquisition list: X6 included centres, X12 new acquisitions, X13
enrichment, X14 maintenance, X15 list cut-off, X26 lookups, X27 cohorts,
X28 cohort presence flags."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fiscal
from ..functions.cleaning import clean_key, long_key
from ..functions.stats import pick_per_key


def included_centres(acq: DataFrame, key_col: str = "Profit_Center",
                     include_col: str = "Include", min_len: int = 3) -> DataFrame:
    """Included acquisitions with a usable profit-centre key.

    Key text is cleaned (``"7000000001.0"`` -> ``"7000000001"``), stubs of
    ``min_len`` characters or fewer are dropped.  Duplicate keys are reported
    by ``quality.duplicate_keys`` (the reference stops the job on them).
    """
    pc = clean_key(F.col(key_col))
    # the flag may be stored as boolean, 1/0 or Yes/No; quality.unreadable_flags
    # lists what is none of these
    out = (acq.where(F.col(include_col).try_cast("boolean") & F.col(key_col).isNotNull())
              .withColumn("profit_center", pc)
              .where(F.col("profit_center").isNotNull() & long_key(F.col("profit_center"), min_len)))
    return out.select("profit_center", "MEntity", "Group")


def new_acquisitions(deals: DataFrame, current: DataFrame, date_col: str = "Close_of_Escrow",
                     base_fy: int = 2015, base_q: int = 4) -> DataFrame:
    """Deals closed strictly after the current list's latest close date.

    The high-water mark is a scalar subquery (evaluated once, no join); an
    empty current list keeps every deal.  The group number is computed from
    the fiscal year and quarter closed for any quarter.
    """
    hwm = current.select(F.max(date_col)).scalar()
    fresh = deals.where(hwm.isNull() | (F.col(date_col) > hwm))
    return fresh.withColumn("Group", fiscal.group_number(F.col("FY_Closed"), F.col("Quarter_Closed"),
                                                         base_fy, base_q))


def latest_entity_record(master: DataFrame, key: str = "MEntity") -> DataFrame:
    """Latest record per entity; a null close date sorts last (open wins);
    ties broken by the record id."""
    order = [F.col("DATE_CLOSED").isNull(), F.col("DATE_CLOSED"), F.col("RECORD_ID")]
    payload = [c for c in master.columns if c != key]
    return pick_per_key(master, [key], order, payload, latest=True)


def enrich_acquisitions(new: DataFrame, master: DataFrame, index_match: DataFrame,
                        entity_info: DataFrame, real_additions: DataFrame,
                        unmatched_is_abutting: bool = False, strict: bool = True) -> DataFrame:
    """Latest entity record, index match, entity info and construction
    type for new acquisitions; remote / abutting / include flags.

    District, MCO, entity and position are the deal sheet's; the entity record
    only gives the name.  ``strict``: a latest record that is not open and
    unexpired stops the job (``quality.unexpected_values`` lists them).

    Sources are first cut to the new entities (left semi joins, the
    reference's ``IN`` lists).  Clashing columns keep both copies with the
    suffixes ``_newlist`` and ``_graph``.
    """
    keys = new.select("MEntity")          # semi-join keys; repeats are harmless
    latest = latest_entity_record(master.join(keys, "MEntity", "left_semi"))
    name = F.col("ENTITY_NAME")
    if strict:
        current = (F.col("STATUS") == "O") & (F.col("DATE_EXPIRATION") == F.lit(_dt.date(9999, 12, 31)))
        stop = F.raise_error(F.concat(F.lit("latest record of an entity is not open: "), F.col("MEntity")))
        name = F.when(F.coalesce(current, F.lit(False)), name).otherwise(stop.cast("string"))
    dlr = latest.select("MEntity", name.alias("ENTITY_NAME"))
    graph = (index_match.join(keys, "MEntity", "left_semi")
                        .withColumn("Remote", F.col("Parent MEntity").isNotNull())
                        .join(entity_info.select("MEntity", "CBSA", "Cost Center"), "MEntity", "left"))
    clash = [c for c in graph.columns if c in new.columns and c != "MEntity"]
    left = new.join(dlr, "MEntity", "left")
    left = left.select(*[F.col(c).alias(f"{c}_newlist") if c in clash else F.col(c) for c in left.columns])
    right = graph.select(*[F.col(f"`{c}`").alias(f"{c}_graph") if c in clash else F.col(f"`{c}`")
                           for c in graph.columns])
    m = left.join(right, "MEntity", "left")
    matched = F.col("Remote").isNotNull()
    abut = F.col("Abutting").isNotNull()
    if unmatched_is_abutting:
        abut = abut | ~matched
    m = (m.withColumn("Abutting", abut)
          .withColumn("Remote", F.coalesce(F.col("Remote"), F.lit(False)))
          .withColumn("Include", ~(F.col("Remote") | F.col("Abutting"))))
    ra = real_additions.select("MEntity", "Construction_Type")
    m = m.join(ra, "MEntity", "left")
    deal = lambda c: F.col(f"{c}_newlist" if c in clash else c)
    return m.select(
        "Group", "Close_of_Escrow", "ENTITY_NAME",
        deal("District").alias("DISTRICT_NO"), deal("MCO").alias("MCO_NUM"), deal("Entity").alias("Entity"),
        F.col("`Cost Center`").alias("Profit_Center"),
        deal("Address").alias("Address"), deal("City").alias("City"), deal("State").alias("State"),
        deal("Latitude").alias("LOC_LATITUDE"), deal("Longitude").alias("LOC_LONGITUDE"),
        "CBSA", deal("Purchase_Price").cast("long").alias("Purchase_Price"),
        deal("Property_Description").alias("Property_Description"),
        F.col("`Simple Owner`").alias("Simple_Owner"),
        "Include", F.col("Construction_Type").alias("Type"), "MEntity",
        F.col("`Parent MEntity`").alias("Parent_MEntity"), "Abutting", "Remote",
    )


def keyed_update(target: DataFrame, source: DataFrame, key: str,
                 assignments: dict[str, str], order: list[Column] | None = None) -> DataFrame:
    """``UPDATE t SET c = s.c FROM t JOIN s ON key`` as a left join.

    The source is reduced to one row per key first (deterministically, by
    ``order`` or by the assigned values).  A matched null overwrites; rows
    without a match keep their values.
    """
    src_cols = list(dict.fromkeys(assignments.values()))
    values = [F.col(f"`{c}`").alias(f"_s_{i}") for i, c in enumerate(src_cols)]
    ordering = order or [F.col(f"`{c}`") for c in src_cols]
    src = source.select(F.col(key), *values, *[o.alias(f"_ord{i}") for i, o in enumerate(ordering)])
    src = pick_per_key(src, [key], [F.col(f"_ord{i}") for i in range(len(ordering))],
                       [f"_s_{i}" for i in range(len(src_cols))])
    # the key is an expression, so the join shuffles the source again and AQE can
    # split a target partition that holds a hot key
    src = src.withColumn("_matched", F.lit(True)).withColumn(key, F.when(F.col("_matched"), F.col(key)))
    j = target.join(src, key, "left")
    out = []
    for c in target.columns:
        if c in assignments:
            s = F.col(f"_s_{src_cols.index(assignments[c])}")
            out.append(F.when(F.col("_matched"), s).otherwise(F.col(f"`{c}`")).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return j.select(*out)


def maintain_list(acq_list: DataFrame, master: DataFrame, index_match: DataFrame,
                  entity_info: DataFrame, real_additions: DataFrame) -> DataFrame:
    """Refresh name and position (open entity records only), owner,
    CBSA and profit centre, and construction type on the acquisition list."""
    open_recs = master.where(F.col("STATUS") == "O")
    out = keyed_update(acq_list, open_recs, "MEntity",
                       {"ENTITY_NAME": "ENTITY_NAME", "LOC_LATITUDE": "LOC_LATITUDE",
                        "LOC_LONGITUDE": "LOC_LONGITUDE"},
                       order=[F.col("RECORD_ID")])
    out = keyed_update(out, index_match, "MEntity", {"Simple_Owner": "Simple Owner"})
    out = keyed_update(out, entity_info, "MEntity", {"CBSA": "CBSA", "Profit_Center": "Cost Center"})
    return keyed_update(out, real_additions, "MEntity", {"Type": "Construction_Type"})


def list_cutoff(acq: DataFrame, as_of: _dt.date, date_col: str = "Close_of_Escrow") -> DataFrame:
    """Acquisitions closed up to the last day of the month before ``as_of``."""
    return acq.where(F.col(date_col) <= fiscal.prev_month_end(as_of))


def first_value_per_key(dim: DataFrame, key: str, value: str, alias: str | None = None) -> DataFrame:
    """Keyed scalar lookup, first match wins (smallest value: deterministic)."""
    return dim.groupBy(F.col(f"`{key}`").alias(key)).agg(F.min(F.col(f"`{value}`")).alias(alias or value))


def centre_lookup(centres: DataFrame, hierarchy: DataFrame, acq_list: DataFrame) -> DataFrame:
    """Owner area by cost centre, entity by profit centre and type from
    the list, for each centre of ``centres`` (column profit_center)."""
    owner = first_value_per_key(hierarchy, "Cost Center", "Hierarchy Area", "owner_area") \
        .withColumnRenamed("Cost Center", "profit_center")
    ent = first_value_per_key(hierarchy, "Profit_Center", "MEntity", "hierarchy_mentity") \
        .withColumnRenamed("Profit_Center", "profit_center")
    lst = acq_list.select(clean_key(F.col("Profit_Center")).alias("profit_center"), "Type") \
                  .where(F.col("profit_center").isNotNull())
    typ = first_value_per_key(lst, "profit_center", "Type", "type")
    base = centres.select("profit_center").distinct()
    return (base.join(owner, "profit_center", "left")
                .join(ent, "profit_center", "left")
                .join(typ, "profit_center", "left"))


def quarter_cohorts(acq: DataFrame, base_fy: int = 2015, base_q: int = 4) -> DataFrame:
    """Distinct profit centres per acquisition group, nulls removed,
    labelled from the group number itself (no positional naming)."""
    pc = clean_key(F.col("Profit_Center"))
    c = (acq.select(F.col("Group"), pc.alias("profit_center"))
            .where(F.col("Group").isNotNull() & F.col("profit_center").isNotNull())
            .distinct())
    return c.withColumn("grp_name", fiscal.group_label_of_number(F.col("Group"), base_fy, base_q))


def cohort_presence(cohort: DataFrame, entity_of: DataFrame, occupancy_keys: DataFrame,
                    forecast_keys: DataFrame) -> DataFrame:
    """Per cohort member: has an entity, has occupancy, has a forecast.

    ``entity_of``: profit_center -> MEntity; the key tables hold MEntity.
    Flags are left joins to distinct keys, never per-member queries.
    """
    occ = occupancy_keys.select("MEntity").distinct().withColumn("has_occupancy", F.lit(True))
    fc = forecast_keys.select("MEntity").distinct().withColumn("has_forecast", F.lit(True))
    m = cohort.join(entity_of, "profit_center", "left")
    m = m.join(occ, "MEntity", "left").join(fc, "MEntity", "left")
    return m.select(
        "Group", "grp_name", "profit_center", "MEntity",
        F.col("MEntity").isNotNull().alias("has_entity"),
        F.coalesce("has_occupancy", F.lit(False)).alias("has_occupancy"),
        F.coalesce("has_forecast", F.lit(False)).alias("has_forecast"),
    )
