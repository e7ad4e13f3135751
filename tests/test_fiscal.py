import datetime as dt

from pyspark.sql import functions as F

from acqlens.functions import fiscal


def _py_fiscal(d: dt.date):
    # month rules of the reference scripts, written plainly
    fy = d.year if d.month <= 3 else d.year + 1
    fm = d.month - 3 if d.month >= 4 else d.month + 9
    fq = {1: 4, 2: 4, 3: 4, 4: 1, 5: 1, 6: 1, 7: 2, 8: 2, 9: 2, 10: 3, 11: 3, 12: 3}[d.month]
    return fy, fm, fq


def test_fiscal_edges(spark):
    days = ["2019-03-31", "2019-04-01", "2019-06-30", "2019-07-01", "2019-12-31", "2020-01-01",
            "2020-03-31", "2020-04-01", "2020-06-30", "2020-07-01", "2020-12-31", "2021-01-01", "2024-07-01"]
    df = spark.createDataFrame([(d,) for d in days], "s string").select(F.to_date("s").alias("d"))
    got = df.select("d", fiscal.fiscal_year("d").alias("fy"), fiscal.fiscal_month("d").alias("fm"),
                    fiscal.fiscal_quarter("d").alias("fq")).collect()
    for r in got:
        assert (r.fy, r.fm, r.fq) == _py_fiscal(r.d), r


def test_fiscal_every_day_1990_2040(spark):
    start = dt.date(1990, 1, 1)
    n = (dt.date(2040, 12, 31) - start).days + 1
    df = spark.range(n).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    out = df.select("d", fiscal.fiscal_year("d").alias("fy"), fiscal.fiscal_month("d").alias("fm"),
                    fiscal.fiscal_quarter("d").alias("fq"),
                    fiscal.calendar_year(fiscal.fiscal_year("d"), F.month("d")).alias("cy"))
    bad = 0
    for r in out.toLocalIterator():
        if (r.fy, r.fm, r.fq) != _py_fiscal(r.d) or r.cy != r.d.year:
            bad += 1
    assert bad == 0


def test_as_of_anchors(spark):
    df = spark.range(1).select(
        fiscal.prev_month_start(dt.date(2020, 11, 9)).alias("a"),
        fiscal.prev_month_end(dt.date(2020, 11, 9)).alias("b"),
        fiscal.prev_month_end(dt.date(2020, 3, 31)).alias("c"),
        fiscal.prev_month_start(dt.date(2020, 1, 1)).alias("d"),
        fiscal.prev_month_end(dt.date(2020, 3, 1)).alias("e"),
        fiscal.month_start(dt.date(2020, 11, 9)).alias("f"))
    r = df.first()
    assert r.a == dt.date(2020, 10, 1) and r.b == dt.date(2020, 10, 31)
    assert r.c == dt.date(2020, 2, 29) and r.d == dt.date(2019, 12, 1)
    assert r.e == dt.date(2020, 2, 29) and r.f == dt.date(2020, 11, 1)
    assert fiscal.fiscal_years_of(dt.date(2020, 11, 9)) == (2020, 2021)
    assert fiscal.fiscal_years_of(dt.date(2021, 2, 1)) == (2020, 2021)


def test_group_numbers_and_labels(spark):
    df = spark.createDataFrame([(2015, 4), (2020, 3), (2023, 4), (2016, 1)], "fy int, fq int")
    out = df.select(fiscal.group_number("fy", "fq").alias("g"), fiscal.group_label("fy", "fq").alias("l"))
    got = {(r.g, r.l) for r in out.collect()}
    assert got == {(1, "F15_Q4"), (20, "F20_Q3"), (33, "F23_Q4"), (2, "F16_Q1")}
    back = spark.range(1, 34).select(F.col("id").alias("g"), fiscal.group_label_of_number(F.col("g")).alias("l"))
    labels = {r.g: r.l for r in back.collect()}
    assert labels[1] == "F15_Q4" and labels[20] == "F20_Q3" and labels[33] == "F23_Q4"
    assert len(set(labels.values())) == 33           # one-to-one
    disp = spark.range(1).select(fiscal.display_label(F.lit("F20_Q3")).alias("x")).first().x
    assert disp == "FY20 Q3"


def test_calendar_dimension(spark):
    cal = fiscal.fiscal_calendar(spark, "2019-01-15", "2020-06-01").collect()
    assert len(cal) == 18
    first = min(cal, key=lambda r: r.month)
    assert first.month == dt.date(2019, 1, 1) and first.month_abbr == "Jan" and first.fiscal_quarter == 4


def test_date_helpers(spark):
    from acqlens.functions.cleaning import amount_or_zero, clean_key
    df = spark.createDataFrame([("2020-03-15", "2021-01-02", "7000000001.0", "x"),
                                ("not a date", "2020-03-01", " ", "12.345"),
                                (None, "2019-12-31", None, None)],
                               "a string, b string, k string, c string")
    out = df.select(fiscal.parse_date("a").alias("a"), F.to_date("b").alias("b"), "k", "c").select(
        "a", "b",
        fiscal.month_diff("a", "b").alias("md"),                       # F6
        fiscal.month_abbr("b").alias("abbr"),                          # F7
        fiscal.first_of_month(F.year("b"), F.month("b")).alias("fom"),  # F8
        fiscal.shift_months("b", -11).alias("ttm_start"),              # F12
        clean_key("k").alias("key"), amount_or_zero("c").alias("amt")).collect()
    r0, r1, r2 = out
    assert r0.a == dt.date(2020, 3, 15) and r0.md == 10 and r0.abbr == "Jan"
    assert r0.fom == dt.date(2021, 1, 1) and r0.ttm_start == dt.date(2020, 2, 2)
    assert r0.key == "7000000001" and str(r0.amt) == "0.00"
    assert r1.a is None and r1.md is None and r1.key is None and str(r1.amt) == "12.35"
    assert r2.key is None and str(r2.amt) == "0.00"
