import datetime as dt
import os
from decimal import Decimal as D

from acqlens.operators import lender as LD
from acqlens.operators import movein as MV
from acqlens.sources import tables as T

SHEET = "SAP string, Account_Number string, Description string, `Line Item` string, " \
        "`2020-02-01` string, `2020-03-01` string, `2020-04-01` string"


def _sheet(spark):
    return spark.createDataFrame([
        ("7000000001.0", "40010", "d", "STORAGE INCOME", "1.50", "x", ""),
        (None, "40011", "d", "SALES", "1", "1", "1"),               # null key dropped
        ("7000000002", None, "d", "SALES", "1", "1", "1"),          # null account dropped
        ("7000000003", "40012.0", "d", "SALES", "2", "abc", "3"),
    ], SHEET)


def test_trend_load_watermark_and_sentinels(spark):
    out = LD.load_trends(_sheet(spark), dt.date(2020, 2, 1))
    got = sorted(((r.SAP_Number, r.Account_Number, r.Date, r.Amount) for r in out.collect()), key=lambda r: r[:3])
    assert got == [("7000000001", "40010", dt.date(2020, 3, 1), D("0.00")),
                   ("7000000001", "40010", dt.date(2020, 4, 1), D("0.00")),
                   ("7000000003", "40012", dt.date(2020, 3, 1), None),
                   ("7000000003", "40012", dt.date(2020, 4, 1), D("3.00"))]
    assert LD.load_trends(_sheet(spark)).count() == 6


def test_ubox_and_adjustment_loads(spark):
    ub = spark.createDataFrame([
        ("7000000001", "U-BOX ONE-WAY DELIVERY INCOME", "5", "x"),
        ("7000000001", "OTHER", "5", "5"),
        (None, "U-BOX LOCAL DELIVERY INCOME", "5", "5"),
    ], "`#` string, Account string, `2020-03-01` string, `2020-04-01` string")
    out = LD.load_ubox(ub, dt.date(2020, 3, 1)).collect()
    assert [(r.SAP_Number, r.Account_Number, r.Date, r.Amount) for r in out] == [
        ("7000000001", "52152", dt.date(2020, 4, 1), D("0.00"))]
    adj = spark.createDataFrame([
        ("7000000001", "40010", "ADJ", dt.date(2020, 3, 1), 1.0, 0.5, 0.5, 0.5),
        ("7000000001", "40010", "ADJ", dt.date(2020, 4, 1), 2.0, 1.0, 1.0, 0.5),
        (None, "40010", "ADJ", dt.date(2020, 4, 1), 2.0, 1.0, 1.0, 0.5)],
        "SAP string, Account string, `Line Item` string, `Final Month` date, `Final Adjustment` double, "
        "`Storage Adjustment` double, `U-Move Adjustment` double, `Storage Split` double")
    a = LD.load_adjustments(adj, dt.date(2020, 3, 1)).collect()
    assert [(r.SAP_Number, r.Date, r.Total_Adjustment) for r in a] == [("7000000001", dt.date(2020, 4, 1), D("2.00"))]


def test_reload_is_idempotent_on_versions(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "trends")
    first = LD.load_trends(_sheet(spark))
    v1 = T.reload_table(first, root, dt.date(2020, 1, 1))
    assert T.stored_max(spark, root) == dt.date(2020, 4, 1)
    # rerun an older watermark: rows after it are replaced, not doubled
    again = LD.load_trends(_sheet(spark), dt.date(2020, 2, 1))
    v2 = T.reload_table(again, root, dt.date(2020, 2, 1))
    v3 = T.reload_table(again, root, dt.date(2020, 2, 1))
    assert v1 != v2 != v3 and T.current_version(spark, root) == v3
    a = sorted(map(tuple, spark.read.parquet(v2).collect()))
    b = sorted(map(tuple, spark.read.parquet(v3).collect()))
    assert a == b and len(a) == 6
    # an equal or later watermark deletes nothing
    later = T.reload_table(first.where("false"), root, dt.date(2021, 1, 1))
    assert spark.read.parquet(later).count() == 6


def test_range_replace(spark, tmpdir_path):
    old = spark.createDataFrame([(2019, 1), (2020, 2), (2021, 3)], "fiscal_year int, v int")
    new = spark.createDataFrame([(2020, 20)], "fiscal_year int, v int")
    out = sorted(map(tuple, T.replace_range(old, new, "fiscal_year", 2020, 2021).collect()))
    assert out == [(2019, 1), (2020, 20)]                  # 2021 removed though no new rows came
    root = os.path.join(tmpdir_path, "stmt")
    T.replace(old, root, partition_by=["fiscal_year"])
    p = T.replace_range_table(new, root, "fiscal_year", 2020, 2021, partition_by=["fiscal_year"])
    assert sorted((r.fiscal_year, r.v) for r in spark.read.parquet(p).collect()) == [(2019, 1), (2020, 20)]


def test_append_and_csv(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "t")
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    T.append(df, root)
    p = T.append(df, root)
    assert spark.read.parquet(p).count() == 2
    out = os.path.join(tmpdir_path, "csv")
    T.export_csv(df, out)
    assert T.read_csv(spark, out, renames={"v": "value"}).columns == ["k", "value"]


def test_rollups(spark):
    trends = spark.createDataFrame([
        ("P1", "A1", "x", "L1", dt.date(2020, 1, 1), D("1.00")),
        ("P1", "A2", "x", "L1", dt.date(2020, 1, 1), D("2.00")),
        ("P2", "A1", "x", "L1", dt.date(2020, 1, 1), D("4.00"))],
        "SAP_Number string, Account_Number string, Account_Description string, Line_Item string, "
        "Date date, Amount decimal(18,2)")
    accts = spark.createDataFrame([("A1",)], "account string")
    centres = spark.createDataFrame([("P1",)], "profit_center string")
    r = LD.trend_rollup(trends, accts, centres).collect()
    assert [(x.Line_Item, x.value) for x in r] == [("L1", D("1.00"))]


def test_movein(spark):
    rows = [
        ("C1", "E1", "a", "b", dt.date(2020, 3, 8), dt.date(2020, 3, 8), "STORAGE"),
        ("C1", "E1", "a", "b", dt.date(2020, 3, 9), dt.date(2020, 4, 1), "STORAGE"),   # duplicate contract
        ("C2", "E1", "c", "d", dt.date(2020, 3, 17), dt.date(2020, 4, 1), "Ubox"),
        ("C3", "E2", "e", "f", dt.date(2020, 3, 18), dt.date(2020, 4, 1), "STORAGE"),  # outside window
        ("C4", "E2", "g", "h", dt.date(2020, 3, 10), dt.date(2020, 4, 1), None),       # null product
    ]
    mv = spark.createDataFrame(rows, "con_pk string, con_entity string, cus_firstname string, cus_lastname string, "
                                     "det_movein date, det_enddate date, esc_product string")
    w = MV.window_contracts(mv, dt.date(2020, 3, 8), dt.date(2020, 3, 17), "cy").collect()
    assert [(r.con_pk, r.det_movein, r.same_day) for r in w] == [("C1", dt.date(2020, 3, 8), True)]
    assert "cus_firstname" not in MV.window_contracts(mv, dt.date(2020, 3, 8), dt.date(2020, 3, 17), "cy").columns
    s = MV.same_day_share(mv).first()
    assert (s.n_rows, s.n_same_day, s.share_same_day) == (5, 1, 0.2)
    by_day = MV.counts_by_day(MV.window_contracts(mv, dt.date(2020, 3, 1), dt.date(2020, 3, 31), "cy",
                                                  keep_null_product=True))
    assert {(r.det_movein, r["count"]) for r in by_day.collect()} == {
        (dt.date(2020, 3, 8), 1), (dt.date(2020, 3, 18), 1), (dt.date(2020, 3, 10), 1)}


def test_nothing_after_the_watermark(spark, tmpdir_path):
    out = LD.load_trends(_sheet(spark), dt.date(2020, 4, 1))
    assert out.count() == 0 and out.columns == ["SAP_Number", "Account_Number", "Account_Description",
                                                "Line_Item", "Date", "Amount"]
    root = os.path.join(tmpdir_path, "t")
    T.reload_table(LD.load_trends(_sheet(spark)), root, dt.date.min)
    wm = T.stored_max(spark, root)
    v = T.reload_table(LD.load_trends(_sheet(spark), wm), root, wm, skip_empty=True)
    assert spark.read.parquet(v).count() == 6


def test_update_table_and_ordered_export(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "list")
    lst = spark.createDataFrame([("M1", "x"), ("M2", "y")], "MEntity string, Simple_Owner string")
    v1 = T.replace(lst, root)
    src = spark.createDataFrame([("M2", "Owner B"), ("M3", "Owner C")], "MEntity string, `Simple Owner` string")
    v2 = T.update_table(root, src, "MEntity", {"Simple_Owner": "Simple Owner"})
    assert v1 != v2 and T.current_version(spark, root) == v2
    got = {r.MEntity: r.Simple_Owner for r in spark.read.parquet(v2).collect()}
    assert got == {"M1": "x", "M2": "Owner B"}
    out = os.path.join(tmpdir_path, "ordered")
    T.export_csv(spark.read.parquet(v2).coalesce(1), out, order_by=["MEntity"])
    back = [r.MEntity for r in T.read_csv(spark, out).collect()]
    assert back == ["M1", "M2"]


def test_readers_and_empty_tables(spark, tmpdir_path):
    from acqlens.functions import fiscal
    root = os.path.join(tmpdir_path, "none")
    assert T.current_version(spark, root) is None and T.stored_max(spark, root) is None
    empty = T.read_current(spark, root, schema="Date date, Amount decimal(18,2)")
    assert empty.count() == 0 and empty.columns == ["Date", "Amount"]
    df = spark.createDataFrame([(dt.date(2020, 4, 30),)], "d date")
    p = os.path.join(tmpdir_path, "p")
    df.write.parquet(p)
    got = fiscal.with_fiscal_columns(T.read_table(spark, p), "d").first()
    assert (got.fiscal_year, got.fiscal_month, got.fiscal_quarter, got.month_abbr) == (2021, 1, 1, "Apr")
