import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from acqlens.operators import ledger as L
from acqlens.operators import statement as S
from acqlens.operators.ledger import BASE_LINES, INCOME_LINES, NOT_REPORTED

LEDGER_SCHEMA = "profit_center string, account string, month date, amount decimal(18,2)"


def _chart(spark):
    # one account per base line, a trailing blank on the lease line, one unreported account
    raw = [(f"A{i}", n + (" " if n == "THIRD PARTY LEASE" else "")) for i, n in enumerate(BASE_LINES, start=1)]
    raw.append(("A99", NOT_REPORTED))
    return L.chart_of_accounts(spark.createDataFrame(raw, "account string, line_item string"))


def test_chart_trims_and_signs(spark):
    chart = {r.account: r for r in _chart(spark).collect()}
    assert "A99" not in chart
    assert chart["A10"].line_item == "THIRD PARTY LEASE" and chart["A10"].sign == -1
    assert chart["A3"].line_item == "COST OF SALES" and chart["A3"].sign == 1
    assert sum(1 for r in chart.values() if r.sign == -1) == len(INCOME_LINES)


def test_income_statement_rules(spark):
    m1, m2, m3 = dt.date(2020, 4, 1), dt.date(2020, 5, 1), dt.date(2020, 6, 1)
    rows = []
    # month 1: every base line has an amount (ledger sign: income negative)
    for i, n in enumerate(BASE_LINES, start=1):
        amt = D(-100 - i) if n in INCOME_LINES else D(10 + i)
        rows.append(("P1", f"A{i}", m1, amt))
    rows.append(("P1", "A99", m1, D("5000.00")))            # unreported account: ignored
    # month 2: only storage income
    rows.append(("P1", "A1", m2, D("-250.00")))
    # month 3: revenue equals expense -> NOI 0 -> dropped
    rows += [("P1", "A1", m3, D("-40.00")), ("P1", "A11", m3, D("40.00"))]
    led = spark.createDataFrame(rows, LEDGER_SCHEMA)
    st = S.income_statement(led, _chart(spark))
    got = {(r.date, r.line_item): r.value for r in st.collect()}
    assert {d for d, _ in got} == {m1, m2}
    assert sum(1 for d, _ in got if d == m1) == 24
    v = lambda n, m=m1: got[(m, n)]
    assert v("STORAGE INCOME") == D("101.00")
    assert v("COST OF SALES") == D("13.00")
    assert v("NET SALES") == D("102.00") - D("13.00")
    assert v("INTERCOMPANY RENT") == 0
    assert v("U-BOX INCOME") == D("105") + D("106") + D("107")
    assert v("U-BOX DELIVERY INCOME") == D("107")
    rev = v("STORAGE INCOME") + v("NET SALES") + v("MISCELLANEOUS INCOME") + v("U-BOX INCOME") \
        + v("U-MOVE NET COMMISSION") + v("THIRD PARTY LEASE")
    assert v("TOTAL REVENUE") == rev
    exp = sum(D(10 + i) for i in range(11, 22))
    assert v("TOTAL OPERATING EXPENSE") == exp
    assert v("NET OPERATING INCOME") == rev - exp
    assert v("STORAGE INCOME", m2) == D("250.00") and v("SALES", m2) == 0
    assert v("NET OPERATING INCOME", m2) == D("250.00")


def test_normalize_ledger(spark):
    cols = ["FISCAL_YEAR", "PROFIT_CENTER", "GL_ACCOUNT"] + [f"GC_PER_{n}" for n in range(1, 13)] + ["LC_PER_1"]
    vals = [2021, "P1", "A1"] + [D(n) for n in range(1, 13)] + [D(999)]
    vals[3 + 4] = None                                   # period 5 is null
    schema = ", ".join(f"`{c}` decimal(18,2)" if c.startswith(("GC", "LC")) else
                       (f"`{c}` int" if c == "FISCAL_YEAR" else f"`{c}` string") for c in cols)
    wide = spark.createDataFrame([tuple(vals)], schema)
    out = {r.month: r.amount for r in L.normalize_ledger(wide).collect()}
    assert len(out) == 12 and "LC_PER_1" not in L.normalize_ledger(wide).columns
    assert out[dt.date(2020, 4, 1)] == D(1)              # period 1 -> April of FY-1
    assert out[dt.date(2021, 1, 1)] == D(10)             # period 10 -> January of FY
    assert out[dt.date(2021, 3, 1)] == D(12)
    assert out[dt.date(2020, 8, 1)] is None
    assert len(L.normalize_ledger(wide, keep_null=False).collect()) == 11


def test_normalize_ledger_by_position(spark):
    # the older layout: months 4 to 12, then 1 to 3, at positions 11 to 22
    names = (["ID", "PROFIT CENTER", "SRC", "CO", "CURR", "MEntity", "ACCOUNT", "DESCRIPTION", "X9", "X10"]
             + [f"LC.P {n}" for n in range(1, 13)] + ["X23", "X24", "Fiscal Year"])
    schema = ", ".join(f"`{c}` " + ("decimal(18,2)" if c.startswith("LC") else "int" if c == "Fiscal Year" else "string")
                       for c in names)
    row = ["-"] * 10 + [D(n) for n in range(1, 13)] + ["-", "-", 2021]
    row[1], row[5], row[6], row[7], row[14] = "P1", "M1", "A1", None, None
    wide = spark.createDataFrame([tuple(row)], schema)
    months = list(zip(wide.columns[10:22], [*range(4, 13), 1, 2, 3]))
    out = L.normalize_ledger(wide, "Fiscal Year", "PROFIT CENTER", "ACCOUNT", extra_ids=["MEntity", "DESCRIPTION"],
                             month_columns=months)
    assert out.columns == ["fiscal_year", "profit_center", "account", "MEntity", "DESCRIPTION", "month", "amount"]
    got = {r.month: r.amount for r in out.collect()}
    assert got == {dt.date(2020 + (m < 4), m, 1): None if m == 8 else D(n)
                   for n, m in enumerate([*range(4, 13), 1, 2, 3], start=1)}
    assert {(r.fiscal_year, r.profit_center, r.account, r.MEntity) for r in out.collect()} == {(2021, "P1", "A1", "M1")}


def test_dense_line_items(spark):
    amounts = spark.createDataFrame([
        ("P1", dt.date(2020, 1, 1), "SALES", D("1.00")),
        ("P1", dt.date(2020, 3, 1), "STORAGE INCOME", D("2.00")),   # starts two months late
        ("P1", dt.date(2020, 5, 1), "STORAGE INCOME", D("3.00")),   # inner gap in April
    ], "profit_center string, month date, line_item string, amount decimal(18,2)")
    out = S.dense_line_items(amounts, dt.date(2020, 6, 1))
    got = {(r.month, r.line_item): r.amount for r in out.collect()}
    assert len(got) == 6 * len(BASE_LINES)
    assert got[(dt.date(2020, 1, 1), "STORAGE INCOME")] == 0
    assert got[(dt.date(2020, 4, 1), "STORAGE INCOME")] == 0
    assert got[(dt.date(2020, 5, 1), "STORAGE INCOME")] == D("3.00")
    assert got[(dt.date(2020, 6, 1), "PERSONNEL")] == 0


def test_portfolio_and_group_statement(spark):
    chart = _chart(spark)
    led = spark.createDataFrame([
        ("7000000001", "A1", dt.date(2019, 3, 1), D("-1.00")),     # FY2019: outside the two years
        ("7000000001", "A1", dt.date(2019, 4, 1), D("-10.00")),
        ("7000000001", "A1", dt.date(2020, 11, 1), D("-20.00")),   # the as-of month: kept
        ("7000000001", "A1", dt.date(2020, 12, 1), D("-30.00")),   # after it: dropped
        ("7000000002", "A1", dt.date(2020, 5, 1), D("-7.00")),
    ], LEDGER_SCHEMA)
    centres = spark.createDataFrame([("7000000001", "M1", 20), ("7000000002", "M2", 21)],
                                    "profit_center string, MEntity string, Group int")
    p = S.portfolio_statement(led, chart, centres, dt.date(2020, 11, 9))
    months = {r.date for r in p.collect()}
    assert months == {dt.date(2019, 4, 1), dt.date(2020, 11, 1), dt.date(2020, 5, 1)}
    r = p.where((F.col("line_item") == "STORAGE INCOME") & (F.col("profit_center") == "7000000001")
                & (F.col("date") == dt.date(2019, 4, 1))).first()
    assert (r.grp_name, r.grp_num, r.fiscal_year, r.fiscal_month, r.MEntity) == ("F20_Q3", 20, 2020, 1, "M1")
    g = S.group_statement(p).where(F.col("line_item") == "NET OPERATING INCOME").collect()
    assert {(x.grp_name, x.quarter, x.val_thousands) for x in g if x.date == dt.date(2020, 5, 1)} == \
        {("FY20 Q4", 1, D("0.00700"))}


def test_operations_start(spark):
    st = spark.createDataFrame([
        (dt.date(2020, 1, 1), "P1", "NET OPERATING INCOME", D("0.00")),
        (dt.date(2020, 2, 1), "P1", "NET OPERATING INCOME", D("5.00")),
        (dt.date(2020, 3, 1), "P1", "NET OPERATING INCOME", D("6.00"))],
        "date date, profit_center string, line_item string, value decimal(18,2)")
    assert S.operations_start(st).first().start_month == dt.date(2020, 2, 1)


def test_operations_start_from_ledger(spark):
    led = spark.createDataFrame([
        ("P1", "A1", dt.date(2020, 1, 1), D("-1.00")), ("P1", "A11", dt.date(2020, 1, 1), D("-1.00")),
        ("P1", "A1", dt.date(2020, 2, 1), D("-3.00")), ("P2", "A1", dt.date(2020, 3, 1), D("0.00"))],
        LEDGER_SCHEMA)
    got = {r.profit_center: r.start_month for r in S.operations_start_from_ledger(led, _chart(spark)).collect()}
    assert got == {"P1": dt.date(2020, 1, 1)}
