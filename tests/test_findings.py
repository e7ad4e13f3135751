"""Inputs that once gave wrong values, lost rows or doubled amounts."""
import datetime as dt
import re
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from acqlens.functions import cleaning as C
from acqlens.functions import stats
from acqlens.operators import acquisitions as A
from acqlens.operators import ledger as L
from acqlens.operators import lender as LD
from acqlens.operators import movein as MV
from acqlens.operators import quality as Q
from acqlens.operators import samestore as SS
from acqlens.operators import statement as S
from acqlens.plans import queries as QP
from acqlens.sources import tables as T

SF = "/root/testdata/sf0.001"


def test_keys_held_as_numbers(spark):
    df = spark.createDataFrame([(7000010790.0, "7.00001079E9"), (12.0, "12.0"), (None, " ")], "n double, s string")
    got = [(r.n, r.s) for r in df.select(C.clean_key("n").alias("n"), C.clean_key("s").alias("s")).collect()]
    assert got == [("7000010790", "7000010790"), ("12", "12"), (None, None)]
    acq = spark.createDataFrame([("M1", 7000010790.0, 1, "Yes"), ("M2", 7000010791.0, 1, "maybe")],
                                "MEntity string, Profit_Center double, Group int, Include string")
    assert [r.profit_center for r in A.included_centres(acq).collect()] == ["7000010790"]
    assert [r.detail for r in Q.unreadable_flags(acq, "MEntity", "Include").collect()] == ["Include=maybe"]


def test_unreadable_amounts_stay_visible(spark):
    cells = ["1,234.50", "(500.00)", "$12", "#REF!", "x", "X ", "", " ", None, "3.5"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    got = [r.a for r in df.select(C.amount_or_zero("c").alias("a")).collect()]
    assert got == [None] * 4 + [D("0.00")] * 5 + [D("3.50")]
    sheet = spark.createDataFrame([("A1", "#REF!", "2")], "Account string, `2020-01-01` string, `2020-02-01` string")
    assert [tuple(r) for r in LD.unreadable_amounts(sheet, ["Account"], "Account").collect()] == [
        ("unreadable amount", "A1", "2020-01-01=#REF!")]


def test_a_column_that_is_no_month_stops_the_load(spark):
    assert C.date_columns_after(["2020-04-01 budget", "2020-04-01", "2020-05-01 00:00:00"], None) == [
        "2020-04-01", "2020-05-01 00:00:00"]
    sheet = spark.createDataFrame([("1", "2", "d", "l", "5")],
                                  "SAP string, Account_Number string, Description string, `Line Item` string, "
                                  "`2020-04-01 budget` string")
    with pytest.raises(ValueError, match="2020-04-01 budget"):
        LD.load_trends(sheet)


def test_blank_keys_are_dropped_after_cleaning(spark):
    sheet = spark.createDataFrame([("  ", "1", "d", "l", "5"), ("7", " ", "d", "l", "5"), ("8", "1", "d", "l", "5")],
                                  "SAP string, Account_Number string, Description string, `Line Item` string, "
                                  "`2020-04-01` string")
    assert [r.SAP_Number for r in LD.load_trends(sheet).collect()] == ["8"]


def test_rates_are_averaged_before_rounding(spark):
    df = spark.createDataFrame([(D("1.0050"),), (D("1.0040"),)], "r decimal(18,4)")
    for places, want in ((2, 1.0), (1, 1.0), (0, 1.0), (4, 1.0045)):
        assert df.select(stats.avg_money_half_up("r", places).alias("x")).first()["x"] == want
    one = spark.createDataFrame([(D("1.5000"),)], "r decimal(18,4)")
    assert one.select(stats.avg_money_half_up("r", 1).alias("x")).first()["x"] == 1.5


def test_fractional_rooms(spark):
    df = spark.createDataFrame([(90.6, 100.9), (0.6, 0.9), (1.0, 0.0)], "a double, b double")
    got = [r.x for r in df.select(stats.ratio_half_up("a", "b", 6).alias("x")).collect()]
    assert got == [0.897919, 0.666667, None]
    panel = spark.createDataFrame([("e", dt.date(2020, 1, 1), 90.6, 100.9, 0.9)],
                                  "MEntity string, Date date, occ double, total double, occupancy double")
    row = {r.period: r for r in SS.samestore_metrics(panel, dt.date(2020, 1, 1)).collect()}["month"]
    assert row.weighted_occ == row.median_occ == 90.6 / 100.9  # not rounded


def test_cap_of_the_top_bucket_per_period(spark):
    rows = [("e", m, 11.0, 10.0, 1.1) for m in (dt.date(2020, 1, 1), dt.date(2019, 1, 1))]
    panel = spark.createDataFrame(rows, "MEntity string, Date date, occ double, total double, occupancy double")
    got = {r.period: r.bucket_10 for r in SS.samestore_histogram(
        panel, dt.date(2020, 1, 1), capped=SS.CAPPED_PERIODS, literal_edges=True).collect()}
    assert got == {"month": 0, "quarter": 1, "ttm": 1, "month_ly": 0, "quarter_ly": 1, "ttm_ly": 0}


def test_rows_without_range_or_date_are_kept(spark):
    old = spark.createDataFrame([(None, 1), (2020, 2), (2015, 3)], "fy int, v int")
    new = spark.createDataFrame([(2020, 9)], "fy int, v int")
    assert sorted(r.v for r in T.replace_range(old, new, "fy", 2019, 2020).collect()) == [1, 3, 9]
    stored = spark.createDataFrame([(None, 1), (dt.date(2020, 3, 1), 2), (dt.date(2020, 1, 1), 3)], "Date date, v int")
    fresh = spark.createDataFrame([(dt.date(2020, 3, 1), 9)], "Date date, v int")
    assert sorted(r.v for r in LD.apply_reload(stored, fresh, dt.date(2020, 2, 1)).collect()) == [1, 3, 9]


def test_accounts_listed_twice(spark):
    raw = spark.createDataFrame([("1", "SALES"), ("1 ", "SALES "), ("2", "SUPPLIES")], "account string, line_item string")
    led = spark.createDataFrame([("c", "1", dt.date(2020, 1, 1), D("-100.00"))],
                                "profit_center string, account string, month date, amount decimal(18,2)")
    assert [r.amount for r in L.line_item_amounts(led, L.chart_of_accounts(raw)).collect()] == [D("100.00")]
    two = raw.union(spark.createDataFrame([("2", "SALES")], raw.schema))
    assert [r.key for r in Q.account_conflicts(two).collect()] == ["2"]
    with pytest.raises(Exception, match="account on two lines: 2"):
        L.chart_of_accounts(two).collect()


def test_a_centre_listed_twice_stops_the_portfolio(spark):
    chart = L.chart_of_accounts(spark.createDataFrame([("1", "SALES")], "account string, line_item string"))
    led = spark.createDataFrame([("c", "1", dt.date(2020, 5, 1), D("-100.00"))],
                                "profit_center string, account string, month date, amount decimal(18,2)")
    one = spark.createDataFrame([("c", "M", 1)], "profit_center string, MEntity string, Group int")
    assert S.portfolio_statement(led, chart, one, dt.date(2020, 6, 15)).count() == 24
    with pytest.raises(Exception, match="profit centre listed twice: c"):
        S.portfolio_statement(led, chart, one.union(one), dt.date(2020, 6, 15)).collect()


def test_person_keys_with_missing_parts_differ(spark):
    df = spark.createDataFrame([("E", None, "X"), ("E", "X", None), ("E", "X", "n"), ("E|1:X", None, None)],
                               "con_entity string, cus_firstname string, cus_lastname string")
    assert MV.with_person_key(df).select("person_key").distinct().count() == 4


def test_messages_count_all_findings(spark):
    many = spark.range(57).select(F.lit("c").alias("check"), F.col("id").cast("string").alias("key"), F.lit("d").alias("detail"))
    with pytest.raises(ValueError, match="57 findings, the first 20"):
        Q.raise_on_findings(many, "stop")


def test_versions_beyond_six_digits(spark, tmp_path):
    for n, v in ((999_999, 1), (1_000_000, 2)):
        spark.range(v).write.parquet(f"{tmp_path}/v{n:06d}")
    assert T.current_version(spark, str(tmp_path)).endswith("v1000000")
    with pytest.raises(ValueError, match="no table at"):
        T.update_table(f"{tmp_path}/none", spark.range(1), "id", {})


def test_sheet_with_banner_rows(spark, tmp_path):
    (tmp_path / "s.csv").write_text('Report,,\nprinted today,,\n,,\nSAP,"Line, Item",2020-01-01\n1,"a, b",5\n\n2,c,x\n')
    got = T.read_sheet(spark, str(tmp_path / "s.csv"), header_row=3, renames={"SAP": "sap"})
    assert got.columns == ["sap", "Line, Item", "2020-01-01"]
    assert sorted(map(tuple, got.collect())) == [("1", "a, b", "5"), ("2", "c", "x")]


def test_median_of_any_range(spark):
    df = spark.createDataFrame([("a", -1e12), ("a", 3.0), ("a", 1e12), ("b", 5.0), ("b", 5.0)], "g string, v double")
    assert {r.g: r.median for r in stats.exact_median(df, ["g"], "v").collect()} == {"a": 3.0, "b": 5.0}


WINDOWED = ["occupancy_mix", "forecast_splice", "actual_occupancy", "group_occupancy", "forecast_capacity", "cohort_gaps",
            "portfolio_statement", "group_statement", "statement_cutoff", "statement_range_replace", "ledger_unpivot",
            "samestore_metrics", "samestore_histogram", "samestore_histogram_literal", "lender_adjustment_load"]


@pytest.mark.parametrize("name", WINDOWED)
def test_date_window_reaches_the_scan(spark, name):
    plan = QP.REGISTRY[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*(GreaterThan|LessThan)[A-Za-z]*\(l_shipdate", plan), plan


def test_oracle_notices_a_missing_expense_line(spark, monkeypatch):
    import duckdb
    from acqlens.plans.oracle import SQL
    c = duckdb.connect()
    for t in "supplier part lineitem".split():
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    total = lambda rows: round(sum(v for line, v in rows if line == "TOTAL OPERATING EXPENSE"), 2)
    want = total(c.execute(f"select line_item, value from ({SQL['income_statement']})").fetchall())
    got = lambda: total(QP.REGISTRY["income_statement"](spark, SF).select("line_item", "value").collect())
    assert got() == want
    monkeypatch.setattr(S, "EXPENSE_PARTS", S.EXPENSE_PARTS[:-1])
    assert got() != want


def test_oracle_shares_no_value_with_the_code():
    import acqlens.plans as plans
    for name in ("oracle", "oracle_bindings", "oracle_values"):
        text = open(f"{plans.__path__[0]}/{name}.py").read()
        assert not re.search(r"^\s*(from|import) .*(operators|functions|queries|sources)", text, re.M), name
