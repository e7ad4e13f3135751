import datetime as dt
from decimal import Decimal as D

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from acqlens.functions.stats import exact_median, ratio_half_up
from acqlens.operators import occupancy as O
from acqlens.operators import samestore as SS

UM = ("MEntity string, Date date, unm_product string, unm_climate string, unm_numunits long, "
      "unm_occunits long, unm_rentrate decimal(18,2)")


def _acq(spark):
    return spark.createDataFrame([("M1", True, 1), ("M2", False, 2)], "MEntity string, Include boolean, Group int")


def test_actual_occupancy_excludes_ubox(spark):
    um = spark.createDataFrame([
        ("M1", dt.date(2020, 9, 1), "STORAGE", "C", 10, 8, D("1.00")),
        ("M1", dt.date(2020, 9, 1), "UBOX", "C", 10, 8, D("1.00")),
        ("M1", dt.date(2020, 9, 1), "Ubox", "C", 10, 8, D("1.00")),
        ("M1", dt.date(2020, 9, 1), None, "C", 10, 8, D("1.00")),
        ("M1", dt.date(2020, 10, 1), "STORAGE", "C", 10, 8, D("1.00")),    # after the last full month
        ("M2", dt.date(2020, 9, 1), "STORAGE", "C", 10, 8, D("1.00")),     # not included
    ], UM)
    out = O.actual_occupancy(um, _acq(spark), dt.date(2020, 10, 15)).collect()
    assert [(r.MEntity, r.unm_product, r.unm_numunits, r.fiscal_quarter) for r in out] == [("M1", "STORAGE", 10, 2)]
    kept = O.actual_occupancy(um, _acq(spark), dt.date(2020, 10, 15), keep_null_product=True).count()
    assert kept == 2


def test_mix_and_splice(spark):
    um = spark.createDataFrame([
        ("M1", dt.date(2020, 9, 1), "STORAGE", "C", 3, 1, D("1.00")),
        ("M1", dt.date(2020, 9, 1), "STORAGE", "C", 5, 2, D("2.01")),
        ("M1", dt.date(2020, 9, 1), "STORAGE", "N", 0, 0, D("2.00")),      # zero units
    ], UM)
    fc = spark.createDataFrame([(1, "M1", dt.date(2020, 7, 1), dt.date(2020, 9, 1), 0.9),
                                (2, "M1", dt.date(2020, 7, 1), dt.date(2020, 10, 1), 0.91)],
                               "ID long, MEntity string, Start_Date date, FC_Date date, FC_Occ double")
    mix = {r.climate: r for r in O.occupancy_mix(um, fc, dt.date(2020, 9, 1)).collect()}
    assert mix["C"].rent_rate == 1.51 and mix["C"].total_units == 8 and mix["C"].occ_pct == 0.38
    assert mix["N"].occ_pct is None
    spl = O.forecast_splice(um, fc, dt.date(2020, 10, 15)).collect()
    assert sorted(r.ID for r in spl if r.ID is not None) == [2]          # FC date equal to last actual excluded
    none = O.forecast_splice(um.where("false"), fc, dt.date(2020, 10, 15)).count()
    assert none == 2                                                     # no actual: keep all forecasts


def test_latest_vintage(spark):
    fc = spark.createDataFrame([
        (1, "M1", dt.date(2020, 1, 1), dt.date(2020, 2, 1), 1.0),
        (2, "M1", dt.date(2020, 4, 1), dt.date(2020, 5, 1), 1.0),
        (3, "M1", dt.date(2020, 4, 1), dt.date(2020, 6, 1), 1.0),
        (4, "M2", dt.date(2020, 1, 1), dt.date(2020, 2, 1), 1.0),
        (5, "M2", dt.date(2020, 1, 1), dt.date(2020, 3, 1), 1.0),
        (6, "M2", dt.date(2020, 4, 1), dt.date(2020, 5, 1), 1.0),          # latest has one row
    ], "ID long, MEntity string, Start_Date date, FC_Date date, FC_Occ double")
    assert sorted(r.ID for r in O.latest_vintage(fc).collect()) == [2, 3]


def test_ratio_half_up(spark):
    df = spark.createDataFrame([(29, 200), (1, 8), (2, 3), (0, 5), (3, 0)], "a long, b long")
    got = [r.x for r in df.select(ratio_half_up("a", "b", 2).alias("x")).collect()]
    assert got == [0.15, 0.13, 0.67, 0.0, None]


def test_exact_median_matches_pandas_with_hot_value(spark):
    rng = np.random.default_rng(7)
    vals = list(rng.uniform(0.5, 1.1, 3000))
    vals += [1.0] * 1500                                  # one value holds a third of the rows
    groups = ["a"] * len(vals) + ["b"] * 4
    vals += [0.1, 0.4, 0.2, 0.3]
    pdf = pd.DataFrame({"g": groups, "v": vals})
    df = spark.createDataFrame(pdf)
    got = {r.g: r.median for r in exact_median(df, ["g"], "v").collect()}
    want = pdf.groupby("g").v.median().to_dict()
    for k in want:
        assert abs(got[k] - want[k]) < 1e-12


def test_samestore_metrics_and_buckets(spark):
    anchor = dt.date(2020, 9, 1)
    occs = [0.0, 0.77495, 0.85, 0.975, 1.0, 1.02]
    rows = [(f"M{i}", anchor, int(o * 100000), 100000) for i, o in enumerate(occs)]
    rows.append(("M9", anchor, 10, 0))                                  # zero rooms -> occupancy 0
    panel = spark.createDataFrame(rows, "MEntity string, Date date, occ long, total long") \
                 .withColumn("occupancy", F.coalesce(F.try_divide("occ", "total"), F.lit(0.0)))
    m = {r.period: r for r in SS.samestore_metrics(panel, anchor).collect()}
    assert m["month"].n_entities == 7 and m["month"].n_at_threshold == 4
    assert m["month"].median_occ == 0.85
    h = {r.period: r for r in SS.samestore_histogram(panel, anchor).collect()}["month"]
    counts = [h[f"bucket_{i}"] for i in range(1, 11)]
    assert counts == [3, 0, 0, 0, 1, 0, 0, 0, 0, 3] and sum(counts) == 7   # contiguous: all counted
    lit = {r.period: r for r in SS.samestore_histogram(panel, anchor, literal_edges=True, capped=SS.CAPPED_PERIODS).collect()}
    lit_counts = [lit["month"][f"bucket_{i}"] for i in range(1, 11)]
    assert sum(lit_counts) == 5          # .77495 falls in the gap, 1.02 above the cap
    assert set(m) == {"month", "quarter", "ttm"}                         # no rows last year


def test_occupancy_panel(spark):
    occ = spark.createDataFrame([("M1", dt.date(2020, 9, 1), 5.0), ("M2", dt.date(2020, 9, 1), 5.0),
                                 ("M3", dt.date(2020, 9, 1), 5.0)], "MEntity string, Date date, Amount double")
    tot = spark.createDataFrame([("M1", dt.date(2020, 9, 1), 10.0), ("M2", dt.date(2020, 9, 1), 0.0)],
                                "MEntity string, Date date, Amount double")
    centres = spark.createDataFrame([("C1",), ("C2",), ("C3",), ("C4",)], "profit_center string")
    info = spark.createDataFrame([("M1", "C1"), ("M2", "C2"), ("M3", "C3")], "MEntity string, `Cost Center` string")
    p = {r.MEntity: r.occupancy for r in SS.occupancy_panel(occ, tot, centres, info, exclude=["C4"]).collect()}
    assert p == {"M1": 0.5, "M2": 0.0, "M3": 0.0}


def test_share_with_fixed_denominator(spark):
    anchor = dt.date(2020, 9, 1)
    panel = spark.createDataFrame([("M1", anchor, 90, 100), ("M2", anchor, 50, 100)],
                                  "MEntity string, Date date, occ long, total long") \
                 .withColumn("occupancy", F.col("occ") / F.col("total"))
    default = {r.period: r.share_at_threshold for r in SS.samestore_metrics(panel, anchor).collect()}
    fixed = {r.period: r.share_at_threshold for r in SS.samestore_metrics(panel, anchor, denominator=537).collect()}
    assert default["month"] == 0.5 and fixed["month"] == 1 / 537
