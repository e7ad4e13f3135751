import datetime as dt

import pytest

from acqlens.operators import acquisitions as A
from acqlens.operators import quality as Q

ACQ = "MEntity string, Profit_Center string, Group int, Close_of_Escrow date, Include boolean, Type string"


def test_included_centres(spark):
    acq = spark.createDataFrame([
        ("M1", "7000000001.0", 1, dt.date(2020, 1, 1), True, "A"),   # float text key
        ("M2", "7000000002", 2, dt.date(2020, 2, 1), True, "A"),
        ("M3", None, 2, dt.date(2020, 2, 1), True, "A"),             # null key
        ("M4", "700", 2, dt.date(2020, 2, 1), True, "A"),            # stub
        ("M5", "7000000005", 2, dt.date(2020, 2, 1), False, "A"),    # not included
        ("M6", "7000000002.0", 3, dt.date(2020, 3, 1), True, "A"),   # duplicate after cleaning
    ], ACQ)
    c = A.included_centres(acq)
    assert sorted(r.profit_center for r in c.collect()) == ["7000000001", "7000000002", "7000000002"]
    dups = Q.duplicate_keys(c, "profit_center").collect()
    assert [(d.key, d.detail) for d in dups] == [("7000000002", "rows=2")]
    with pytest.raises(ValueError):
        Q.raise_on_findings(Q.duplicate_keys(c, "profit_center"), "duplicate profit centres")


DEALS = "MEntity string, Name string, Close_of_Escrow date, FY_Closed int, Quarter_Closed int"


def test_new_acquisitions(spark):
    deals = spark.createDataFrame([
        ("M1", "a", dt.date(2020, 5, 1), 2021, 1),
        ("M2", "b", dt.date(2020, 6, 30), 2021, 1),     # equal to the list maximum: excluded
        ("M3", "c", dt.date(2020, 10, 2), 2021, 3),     # newer
    ], DEALS)
    cur = spark.createDataFrame([("X", dt.date(2020, 6, 30))], "MEntity string, Close_of_Escrow date")
    new = A.new_acquisitions(deals, cur).collect()
    assert [(r.MEntity, r.Group) for r in new] == [("M3", 24)]
    empty = spark.createDataFrame([], "MEntity string, Close_of_Escrow date")
    assert A.new_acquisitions(deals, empty).count() == 3
    none_newer = spark.createDataFrame([("X", dt.date(2021, 1, 1))], "MEntity string, Close_of_Escrow date")
    assert A.new_acquisitions(deals, none_newer).count() == 0


MASTER = ("RECORD_ID long, MEntity string, ENTITY_NAME string, MCO_NUM string, STATUS string, "
          "DATE_CLOSED date, DATE_EXPIRATION date, LOC_LATITUDE double, LOC_LONGITUDE double")


def _sources(spark):
    master = spark.createDataFrame([
        (1, "M1", "old", "1", "C", dt.date(2019, 1, 1), dt.date(2019, 1, 1), 1.0, 1.0),
        (2, "M1", "open", "1", "O", None, dt.date(9999, 12, 31), 2.0, 2.0),   # open record wins
        (3, "M2", "m2", "2", "C", dt.date(2019, 1, 1), dt.date(2020, 1, 1), 3.0, 3.0),
    ], MASTER)
    im = spark.createDataFrame([
        ("M1", None, None, "Owner A", "D1", "S1"),
        ("M2", "M1", "Yes", "Owner B", "D2", "S2"),      # remote and abutting
    ], "MEntity string, `Parent MEntity` string, Abutting string, `Simple Owner` string, District string, State string")
    ei = spark.createDataFrame([("M1", "C1", "7000000001"), ("M2", "C2", "7000000002")],
                               "MEntity string, CBSA string, `Cost Center` string")
    ra = spark.createDataFrame([("M1", "NEW BUILD")], "MEntity string, Construction_Type string")
    return master, im, ei, ra


def test_enrichment_flags(spark):
    master, im, ei, ra = _sources(spark)
    deal = ("D9", "MCO9", "E9", "1 Main Street", "Town", 4.5, -7.5, "flat")
    new = spark.createDataFrame([("M1", "a", dt.date(2020, 1, 1), 2020, 4, "CA", 10, 20, *deal),
                                 ("M2", "b", dt.date(2020, 1, 1), 2020, 4, "NV", 10, 20, *deal),
                                 ("M9", "c", dt.date(2020, 1, 1), 2020, 4, "AZ", 10, 20, *deal)],
                                DEALS + ", State string, Purchase_Price long, Group int, District string, MCO string, "
                                "Entity string, Address string, City string, Latitude double, Longitude double, "
                                "Property_Description string")
    with pytest.raises(Exception, match="latest record of an entity is not open: M2"):
        A.enrich_acquisitions(new, master, im, ei, ra).collect()
    enriched = A.enrich_acquisitions(new, master, im, ei, ra, strict=False)
    assert len(enriched.columns) == 22
    out = {r.MEntity: r for r in enriched.collect()}
    # the deal sheet's values, not the entity record's or the graph's
    assert (out["M1"].DISTRICT_NO, out["M1"].MCO_NUM, out["M1"].Entity, out["M1"].LOC_LATITUDE) == ("D9", "MCO9", "E9", 4.5)
    assert out["M1"].ENTITY_NAME == "open" and out["M1"].Include and out["M1"].Type == "NEW BUILD"
    assert out["M1"].State == "CA" and out["M1"].Profit_Center == "7000000001"
    assert out["M2"].Remote and out["M2"].Abutting and not out["M2"].Include
    assert not out["M9"].Abutting and out["M9"].Include                 # unmatched: not abutting
    lit = {r.MEntity: r for r in A.enrich_acquisitions(new, master, im, ei, ra, unmatched_is_abutting=True, strict=False).collect()}
    assert lit["M9"].Abutting and not lit["M9"].Include


def test_keyed_update(spark):
    target = spark.createDataFrame([("M1", "x", 1), ("M2", "y", 2), ("M3", "z", 3)], "MEntity string, c string, n int")
    source = spark.createDataFrame([("M1", None), ("M2", "b"), ("M2", "a")], "MEntity string, v string")
    out = {r.MEntity: r.c for r in A.keyed_update(target, source, "MEntity", {"c": "v"}).collect()}
    assert out == {"M1": None, "M2": "b", "M3": "z"}      # matched null overwrites; max wins for dups


def test_latest_entity_and_expected_values(spark):
    master, *_ = _sources(spark)
    latest = A.latest_entity_record(master)
    got = {r.MEntity: r.RECORD_ID for r in latest.collect()}
    assert got == {"M1": 2, "M2": 3}
    bad = Q.unexpected_values(latest, "MEntity", {"DATE_EXPIRATION": dt.date(9999, 12, 31), "STATUS": "O"})
    assert sorted((r.key, r.detail) for r in bad.collect()) == [
        ("M2", "DATE_EXPIRATION=2020-01-01"), ("M2", "STATUS=C")]
    nulls = spark.createDataFrame([("M1", None)], "MEntity string, STATUS string")
    assert Q.unexpected_values(nulls, "MEntity", {"STATUS": "O"}).count() == 1   # null differs


def test_cohorts_and_presence(spark):
    acq = spark.createDataFrame([
        ("M1", "7000000001.0", 20, dt.date(2020, 1, 1), True, "A"),
        ("M2", "7000000002", 20, dt.date(2020, 1, 1), True, "A"),
        ("M3", None, 21, dt.date(2020, 1, 1), True, "A"),
    ], ACQ)
    cohorts = A.quarter_cohorts(acq)
    assert sorted((r.Group, r.grp_name, r.profit_center) for r in cohorts.collect()) == [
        (20, "F20_Q3", "7000000001"), (20, "F20_Q3", "7000000002")]
    occ = spark.createDataFrame([("M1",)], "MEntity string")
    fc = spark.createDataFrame([("M2",)], "MEntity string")
    ent = A.included_centres(acq).select("profit_center", "MEntity")
    flags = {r.profit_center: (r.has_entity, r.has_occupancy, r.has_forecast)
             for r in A.cohort_presence(cohorts, ent, occ, fc).collect()}
    assert flags == {"7000000001": (True, True, False), "7000000002": (True, False, True)}


def test_data_presence(spark):
    centres = spark.createDataFrame([("P1",), ("P2",)], "profit_center string")
    cash = spark.createDataFrame([("P1", dt.date(2020, 1, 1), "Group", "ALL", 5.0),
                                  ("P2", dt.date(2020, 1, 1), "Group", "ALL", 0.0),
                                  ("P2", dt.date(2020, 1, 1), "Local", "ALL", 3.0)],
                                 "`PROFIT CENTER` string, MONTH date, CURRENCY string, SPLIT string, "
                                 "`NET OPERATING INCOME` double")
    out = {r.profit_center: (r.has_data, r.na_key, r.flag) for r in Q.data_presence(centres, cash).collect()}
    assert out == {"P1": (True, "P1", "P1"), "P2": (False, None, "Error: P2")}


def test_centres_without_data_and_missing_lines(spark):
    centres = spark.createDataFrame([("P1",), ("P2",)], "profit_center string")
    facts = spark.createDataFrame([("P1", 1)], "profit_center string, x int")
    info = spark.createDataFrame([("P2", "WEST")], "profit_center string, area string")
    got = [(r.profit_center, r.area) for r in Q.centres_without_data(centres, facts, info=info).collect()]
    assert got == [("P2", "WEST")]
    chart = spark.createDataFrame([("A1", "SALES")], "account string, line_item string")
    missing = Q.missing_line_items(chart, ["SALES", "UTILITIES"]).collect()
    assert [(r.key, r.detail) for r in missing] == [("UTILITIES", "no account")]


def test_include_flag_as_number_or_text(spark):
    for flag_type, yes, no in (("int", 1, 0), ("string", "Yes", "No")):
        acq = spark.createDataFrame([("M1", "7000000001", 1, dt.date(2020, 1, 1), yes, "A"),
                                     ("M2", "7000000002", 1, dt.date(2020, 1, 1), no, "A")],
                                    f"MEntity string, Profit_Center string, Group int, Close_of_Escrow date, "
                                    f"Include {flag_type}, Type string")
        assert [r.MEntity for r in A.included_centres(acq).collect()] == ["M1"], flag_type
