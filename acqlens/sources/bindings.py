"""Test-table bindings: the driver's TPC-H-style tables re-read as the domain
tables the operators expect (ledger, chart, acquisition list, unit mix,
forecast, entity master, move-ins, lender sheets, rooms).

Every binding is a projection or aggregate over the given parquet tables, so
its work grows with them.  The same derivations are written in SQL in
``acqlens.plans.oracle`` for the DuckDB cross-check.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fiscal
from ..functions.stats import from_cents, to_cents
from ..operators.ledger import BASE_LINES, INCOME_LINES, NOT_REPORTED

# Binding constants (ours, not the reference's).
AS_OF = _dt.date(2000, 10, 15)          # "today" for every as-of rule
BASE_FY, BASE_Q = 1995, 4               # group 1 = FY1995 Q4 (Jan-Mar 1995)
CENTRE_BASE = 7000000000                # profit centre = CENTRE_BASE + suppkey
ACCOUNT_BASE = 40000                    # account = ACCOUNT_BASE + partkey
ACCOUNT_SLOTS = 25                      # partkey % 25 -> chart slot; 21..24 not reported
ENTITY_PER_CUSTOMER = 15                # forecast / entity-master entity = custkey div 15
INCOME_SLOTS = [BASE_LINES.index(n) for n in INCOME_LINES]
# The source chart carries one line name with a trailing blank.
RAW_CHART_NAMES = [n + " " if n == "THIRD PARTY LEASE" else n for n in BASE_LINES]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def in_months(df: DataFrame, column: str, lo: _dt.date | None, hi: _dt.date | None) -> DataFrame:
    """Rows from month ``lo`` to month ``hi`` (both included, None: open), as
    bounds on the raw column, so that they reach the scan."""
    if lo is not None:
        df = df.where(F.col(column) >= F.lit(lo))
    if hi is not None:
        df = df.where(F.col(column) < F.lit(fiscal.py_add_months(hi, 1)))
    return df


def month_of(c) -> "F.Column":
    return F.trunc(F.to_date(F.col(c) if isinstance(c, str) else c), "MM")


def product_of(flag: str = "l_returnflag", status: str = "l_linestatus") -> "F.Column":
    f, s = F.col(flag), F.col(status)
    return (F.when((f == "R") & (s == "O"), "Ubox").when(f == "R", "UBOX")
             .when(f == "A", "STORAGE").otherwise("PARKING"))


# B1: ledger_long(profit_center, account, month, amount), ledger sign.
def ledger_long(spark: SparkSession, sf_dir: str, lo: _dt.date | None = None,
                hi: _dt.date | None = None) -> DataFrame:
    li = in_months(table(spark, sf_dir, "lineitem"), "l_shipdate", lo, hi)
    amt = F.col("l_extendedprice").cast("decimal(18,2)")
    slot = F.col("l_partkey") % ACCOUNT_SLOTS
    return li.select(
        (F.lit(CENTRE_BASE) + F.col("l_suppkey")).cast("string").alias("profit_center"),
        (F.lit(ACCOUNT_BASE) + F.col("l_partkey")).cast("string").alias("account"),
        month_of("l_shipdate").alias("month"),
        F.when(slot.isin(INCOME_SLOTS), -amt).otherwise(amt).alias("amount"),
    )


# B1w: ledger_wide(FISCAL_YEAR, PROFIT_CENTER, GL_ACCOUNT, GC_PER_1..12, LC_PER_1..12).
def ledger_wide(spark: SparkSession, sf_dir: str, lo: _dt.date | None = None,
                hi: _dt.date | None = None) -> DataFrame:
    led = (ledger_long(spark, sf_dir, lo, hi).withColumn("_fm", fiscal.fiscal_month(F.col("month")))
                                     .withColumn("_c", to_cents(F.col("amount"))))
    gc = [F.sum(F.when(F.col("_fm") == n, F.col("_c"))).alias(f"GC_PER_{n}") for n in range(1, 13)]
    wide = (led.groupBy(fiscal.fiscal_year(F.col("month")).alias("FISCAL_YEAR"),
                        F.col("profit_center").alias("PROFIT_CENTER"),
                        F.col("account").alias("GL_ACCOUNT"))
               .agg(*gc))
    periods = [from_cents(F.col(f"GC_PER_{n}")).cast("decimal(18,2)") for n in range(1, 13)]
    return wide.select("FISCAL_YEAR", "PROFIT_CENTER", "GL_ACCOUNT",
                       *[p.alias(f"GC_PER_{n}") for n, p in enumerate(periods, start=1)],
                       # local-currency copies, dropped by the normaliser
                       *[p.alias(f"LC_PER_{n}") for n, p in enumerate(periods, start=1)])


# B2: raw chart of accounts (account, line_item) read off `part`.  Every
# 40th account is listed twice, once with a trailing blank.
def chart_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    slot = F.col("p_partkey") % ACCOUNT_SLOTS
    name = F.element_at(F.array(*[F.lit(n) for n in RAW_CHART_NAMES]), (slot + 1).cast("int"))
    account = (F.lit(ACCOUNT_BASE) + F.col("p_partkey")).cast("string")
    listed = F.when(F.col("p_partkey") % 40 == 0, F.array(account, F.concat(account, F.lit(" ")))) \
              .otherwise(F.array(account))
    return part.select(
        F.explode(listed).alias("account"),
        F.when(slot < len(BASE_LINES), name).otherwise(F.lit(NOT_REPORTED)).alias("line_item"),
    )


# The lender's chart: as the ledger's, but the largest parts' accounts are one
# line on.
def lender_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    slot = (F.col("p_partkey") + F.when(F.col("p_size") == 50, 1).otherwise(0)) % ACCOUNT_SLOTS
    name = F.element_at(F.array(*[F.lit(n) for n in RAW_CHART_NAMES]), (slot + 1).cast("int"))
    return part.select((F.lit(ACCOUNT_BASE) + F.col("p_partkey")).cast("string").alias("account"),
                       F.when(slot < len(BASE_LINES), name).otherwise(F.lit(NOT_REPORTED)).alias("line_item"))


# Acquisition list.  Close of escrow = ship date of the supplier's first
# order (smallest order key, then earliest ship date).
def acquisitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    # (order key, ship day) packed into one order-preserving long so the
    # minimum is a plain hash aggregate: day offset in [0, 100000) covers
    # 1833..2106, order keys up to 9e13 fit.
    day = F.datediff(F.to_date("l_shipdate"), F.lit(_dt.date(1970, 1, 1))) + 50000
    first = (li.groupBy("l_suppkey")
               .agg(F.min(F.col("l_orderkey") * 100000 + day).alias("_f"))
               .select(F.col("l_suppkey").alias("s_suppkey"),
                       F.date_add(F.lit(_dt.date(1970, 1, 1)), (F.col("_f") % 100000 - 50000).cast("int"))
                        .alias("Close_of_Escrow")))
    sup = table(spark, sf_dir, "supplier")
    nat = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    s = sup.join(first, "s_suppkey").join(nat, "s_nationkey", "left")
    key = F.col("s_suppkey")
    pc = (F.lit(CENTRE_BASE) + key).cast("string")
    return s.select(
        key.cast("string").alias("MEntity"),
        F.when(key % 17 == 0, F.lit(None).cast("string"))
         # a numeric key as a double prints it, and as a spreadsheet does
         .when(key % 6 == 0, F.concat(F.substring(pc, 1, 1), F.lit("."), F.substring(pc, 2, 9), F.lit("E9")))
         # stub keys, which are no centres
         .when(key % 19 == 0, (key % 100).cast("string"))
         .when(key % 2 == 0, F.concat(pc, F.lit(".0"))).otherwise(pc).alias("Profit_Center"),
        fiscal.group_of_date(F.col("Close_of_Escrow"), BASE_FY, BASE_Q).alias("Group"),
        "Close_of_Escrow",
        # as text; one spelling is no flag at all
        F.when(key % 23 == 0, F.lit("maybe")).when(F.col("s_acctbal") > 0, F.lit("Yes"))
         .otherwise(F.lit("No")).alias("Include"),
        F.col("n_name").alias("Type"),
        F.col("s_name").alias("Name"),
        F.col("s_nationkey").cast("string").alias("State"),
        (F.col("s_acctbal") * 1000).cast("long").alias("Purchase_Price"),
    )


# B3 (deals sheet): every supplier's deal with fiscal year / quarter closed.
def closed_deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    acq = acquisitions(spark, sf_dir)
    c = F.col("Close_of_Escrow")
    k = F.col("MEntity").cast("long")
    return acq.select("MEntity", "Name", "Close_of_Escrow",
                      fiscal.fiscal_year(c).alias("FY_Closed"),
                      fiscal.fiscal_quarter(c).alias("Quarter_Closed"),
                      "State", "Purchase_Price",
                      (k % 40).cast("string").alias("District"), (k % 31).cast("string").alias("MCO"),
                      F.concat(F.lit("E"), F.col("MEntity")).alias("Entity"),
                      F.concat((k % 999).cast("string"), F.lit(" Main Street")).alias("Address"),
                      F.concat(F.lit("City of "), F.col("Type")).alias("City"),
                      (k % 90).cast("double").alias("Latitude"), (k % 180 * -0.5).alias("Longitude"),
                      F.concat((k % 4 + 1).cast("string"), F.lit(" floors")).alias("Property_Description"))


# Unit mix archive.
def unit_mix(spark: SparkSession, sf_dir: str, lo: _dt.date | None = None,
             hi: _dt.date | None = None) -> DataFrame:
    li = in_months(table(spark, sf_dir, "lineitem"), "l_shipdate", lo, hi)
    units = F.col("l_quantity").cast("long")
    return li.select(
        F.col("l_suppkey").cast("string").alias("MEntity"),
        month_of("l_shipdate").alias("Date"),
        product_of().alias("unm_product"),
        F.when(F.col("l_linestatus") == "O", "CLIMATE").otherwise("STANDARD").alias("unm_climate"),
        units.alias("unm_numunits"),
        F.greatest(F.lit(0).cast("long"), units - F.col("l_suppkey") % 11).alias("unm_occunits"),
        # four places: price less discount
        (F.col("l_extendedprice").cast("decimal(14,2)") * (1 - F.col("l_discount").cast("decimal(4,2)")))
        .cast("decimal(18,4)").alias("unm_rentrate"),
    )


# Forecast vintages.
def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("ID"),
        F.floor(F.col("o_custkey") / ENTITY_PER_CUSTOMER).cast("string").alias("MEntity"),
        F.trunc(F.to_date("o_orderdate"), "quarter").alias("Start_Date"),
        month_of("o_orderdate").alias("FC_Date"),
        F.col("o_totalprice").alias("FC_Occ"),
    )


# Entity master (many records per entity; open records have no close date).
def entity_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey", "c_acctbal")
    j = o.join(c, "o_custkey")
    is_open = F.col("o_orderstatus") == "O"
    d = F.to_date("o_orderdate")
    return j.select(
        F.col("o_orderkey").alias("RECORD_ID"),
        F.floor(F.col("o_custkey") / ENTITY_PER_CUSTOMER).cast("string").alias("MEntity"),
        F.col("c_name").alias("ENTITY_NAME"),
        F.col("c_nationkey").cast("string").alias("MCO_NUM"),
        F.col("o_orderstatus").alias("STATUS"),
        # some closed records lack their date and pass for the latest
        F.when(~is_open & (F.col("o_orderkey") % 13 != 0), d).alias("DATE_CLOSED"),
        F.when(is_open, F.lit(_dt.date(9999, 12, 31))).otherwise(F.date_add(d, 365)).alias("DATE_EXPIRATION"),
        (F.col("c_acctbal") / 100).alias("LOC_LATITUDE"),
        (F.col("c_nationkey") * -1.5).alias("LOC_LONGITUDE"),
    )


# Graph "Index Match" / "Entity Info" / "Real Additions" read off `supplier`.
def index_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        k.cast("string").alias("MEntity"),
        F.when(k % 7 == 3, (k - 1).cast("string")).alias("Parent MEntity"),
        F.when(k % 11 == 5, F.lit("Yes")).alias("Abutting"),
        F.concat(F.lit("Owner "), (k % 4).cast("string")).alias("Simple Owner"),
        (k % 50).cast("string").alias("District"),
        F.col("s_nationkey").cast("string").alias("State"),
        (k % 7).cast("string").alias("MCO"),
        F.concat(F.lit("G"), k.cast("string")).alias("Entity"),
    )


def entity_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        k.cast("string").alias("MEntity"),
        F.concat(F.lit("CBSA-"), (k % 37).cast("string")).alias("CBSA"),
        (F.lit(CENTRE_BASE) + k).cast("string").alias("Cost Center"),
    )


def real_additions(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    # suppliers with a negative balance have no construction record
    return (s.where(F.col("s_acctbal") >= 0)
             .select(k.cast("string").alias("MEntity"),
                     F.when(k % 3 == 0, "NEW BUILD").otherwise("CONVERSION").alias("Construction_Type")))


# Cost-centre hierarchy: every supplier centre, owner area from its region.
def cost_centre_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
    r = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    j = s.join(n, "s_nationkey", "left").join(r, "n_regionkey", "left")
    pc = (F.lit(CENTRE_BASE) + F.col("s_suppkey")).cast("string")
    return j.select(pc.alias("Cost Center"), pc.alias("Profit_Center"),
                    F.col("s_suppkey").cast("string").alias("MEntity"),
                    F.col("r_name").alias("Hierarchy Area"))


# Lender trend rows (long) = ledger joined to the chart.  The lender's own
# accounts are 50: each stands for the ledger accounts that share its slot.
LENDER_ACCOUNTS = 50


def lender_long(spark: SparkSession, sf_dir: str, lo: _dt.date | None = None,
                hi: _dt.date | None = None) -> DataFrame:
    """The chart is cut to the lender's accounts, at most 99 by the remainder below,
    and broadcast: a shuffle by 50 accounts would put each account whole into a task."""
    led = ledger_long(spark, sf_dir, lo, hi).withColumn("account", (
        F.lit(ACCOUNT_BASE + LENDER_ACCOUNTS)
        + (F.col("account").cast("long") - ACCOUNT_BASE) % LENDER_ACCOUNTS).cast("string"))
    chart = (chart_raw(spark, sf_dir).where(F.col("line_item") != NOT_REPORTED)
             .select(F.trim("account").alias("account"), F.rtrim("line_item").alias("line_item"))
             .where(F.col("account").isin([str(ACCOUNT_BASE + n) for n in range(1, 2 * LENDER_ACCOUNTS)])).distinct())
    return (led.join(F.broadcast(chart), "account")
               .select(F.col("profit_center").alias("SAP_Number"),
                       F.col("account").alias("Account_Number"),
                       F.rtrim("line_item").alias("Line_Item"),
                       F.col("month").alias("Date"),
                       F.col("amount").alias("Amount")))


# The month columns of the lender sheets: every month of the data (column names
# are needed to plan; the bounds are one aggregate), after ``after`` if given.
def sheet_months(spark: SparkSession, sf_dir: str, after: _dt.date | None = None) -> list[_dt.date]:
    li = table(spark, sf_dir, "lineitem")
    lo, hi = li.agg(F.min("l_shipdate"), F.max("l_shipdate")).select(
        *[F.to_date(F.col(c)) for c in ("min(l_shipdate)", "max(l_shipdate)")]).first()
    if lo is None:
        return []
    first = _dt.date(lo.year, lo.month, 1)
    n = (hi.year - lo.year) * 12 + hi.month - lo.month + 1
    months = [fiscal.py_add_months(first, k) for k in range(n)]
    return [m for m in months if after is None or m > after]


# Ledger rows that one task makes sheet rows of: the tasks grow in number with
# the data, not in memory.
SHEET_TASK_ROWS = 250_000


def sheet_tasks(spark: SparkSession, sf_dir: str) -> int:
    return max(1, -(-table(spark, sf_dir, "lineitem").count() // SHEET_TASK_ROWS))


def _by_month(rows: DataFrame, keys: list[str], amount, months: list[_dt.date], tasks: int, broken=None) -> DataFrame:
    """One row per key with a column of text a month, as a spreadsheet extract holds
    it: "x" where there is no amount, "#REF!" where ``broken`` holds.  Summed by
    month first, as cents; the text of all months is one expression over an array.
    The rows are dealt by their keys into ``tasks`` before both aggregates, whose
    tables (the second has a sum a month in each row) hold a task's keys only."""
    if not months:
        return rows.select(*keys).repartition(tasks, *keys).distinct()
    first = months[0]
    at = (F.year("Date") - first.year) * 12 + F.month("Date") - first.month
    dealt = rows.select(*keys, at.alias("_at"), to_cents(amount).alias("_cents")).repartition(tasks, *keys)
    sums = dealt.groupBy(*keys, "_at").agg(F.sum("_cents").alias("_sum"))
    wide = sums.groupBy(*keys).pivot("_at", list(range(len(months)))).agg(F.max("_sum"))
    text = lambda c: F.coalesce(from_cents(c).cast("string"), F.lit("x"))
    cell = text if broken is None else lambda c: F.when(broken & c.isNotNull(), "#REF!").otherwise(text(c))
    cells = F.transform(F.array(*[F.col(f"`{i}`") for i in range(len(months))]), cell)
    return wide.select(*keys, cells.alias("_cells")).select(
        *keys, *[F.col("_cells")[i].alias(m.isoformat()) for i, m in enumerate(months)])


# B6 wide: the trends sheet, one text column per month named by its date.  The
# rows are those of the whole data, whichever months are asked for: a sheet
# lists its accounts once.
def lender_trends_wide(spark: SparkSession, sf_dir: str, after: _dt.date | None = None,
                       keys_only: bool = False) -> DataFrame:
    lon = lender_long(spark, sf_dir)
    months = [] if keys_only else sheet_months(spark, sf_dir, after)
    # a broken reference, as sheets have them
    broken = (F.substring("SAP_Number", -1, 1) == "4") & (F.col("Line_Item") == "UTILITIES")
    wide = _by_month(lon, ["SAP_Number", "Account_Number", "Line_Item"], F.col("Amount"), months,
                     sheet_tasks(spark, sf_dir), broken)
    # Float-text centre keys, a missing and a blank key, as the sheet extract has them.
    k = F.col("SAP_Number")
    return wide.select(
        F.when(F.substring(k, -1, 1) == "9", F.lit(None).cast("string"))
         .when(F.substring(k, -1, 1) == "8", F.lit("  "))
         .when(F.substring(k, -1, 1) == "2", F.concat(k, F.lit(".0"))).otherwise(k).alias("SAP"),
        F.col("Account_Number"),
        F.col("Line_Item").alias("Description"),
        F.col("Line_Item").alias("Line Item"),
        *[F.col(f"`{m.isoformat()}`") for m in months])


# The u-box delivery sheet: delivery income by centre, two account rows.
def lender_ubox_wide(spark: SparkSession, sf_dir: str, after: _dt.date | None = None) -> DataFrame:
    lon = lender_long(spark, sf_dir).where(F.col("Line_Item").isin("U-BOX DELIVERY INCOME", "U-BOX OTHER INCOME"))
    acct = (F.when(F.col("Line_Item") == "U-BOX DELIVERY INCOME", "U-BOX ONE-WAY DELIVERY INCOME")
             .otherwise("U-BOX LOCAL DELIVERY INCOME"))
    return _by_month(lon.withColumn("Account", acct).withColumnRenamed("SAP_Number", "#"), ["#", "Account"],
                     -F.col("Amount"), sheet_months(spark, sf_dir, after), sheet_tasks(spark, sf_dir))


# The adjustments sheet: one row per centre and month with three adjustments.
def lender_adjustments_sheet(spark: SparkSession, sf_dir: str, lo: _dt.date | None = None) -> DataFrame:
    lon = lender_long(spark, sf_dir, lo)
    storage = F.sum(F.when(F.col("Line_Item") == "STORAGE INCOME", F.col("Amount")))
    umove = F.sum(F.when(F.col("Line_Item") == "U-MOVE NET COMMISSION", F.col("Amount")))
    agg = lon.groupBy("SAP_Number", "Date").agg(
        F.coalesce(storage, F.lit(0)).alias("Storage Adjustment"),
        F.coalesce(umove, F.lit(0)).alias("U-Move Adjustment"))
    return agg.select(
        F.when(F.substring("SAP_Number", -1, 1) != "9", F.col("SAP_Number")).alias("SAP"),
        F.lit("40010").alias("Account"),
        F.lit("LENDER ADJUSTMENT").alias("Line Item"),
        F.col("Date").alias("Final Month"),
        (F.col("Storage Adjustment") + F.col("U-Move Adjustment")).alias("Final Adjustment"),
        "Storage Adjustment", "U-Move Adjustment",
        F.lit(0.5).alias("Storage Split"))


# The adjustments sheet as CSV text, a file a year, as a spreadsheet program saves
# it: three banner rows, the header, cells with quotes and line breaks; by value
# also surplus cells, dates and amounts that cannot be read.
BANNER = ['Lender adjustments,"draft, not final"', "", '"All amounts',  'in dollars"']
EXTRACT_HEADER = ["SAP", "Account", "Line Item", "Final Month", "Final Adjustment", "Storage Adjustment",
                  "U-Move Adjustment", "Storage Split"]
EXTRACT_HEADER_ROW = 3


def adjustments_extract(spark: SparkSession, sf_dir: str, path: str) -> None:
    sheet = lender_adjustments_sheet(spark, sf_dir)
    digit, month = F.substring("SAP", -1, 1), F.month("Final Month")
    when = lambda d, m: F.coalesce((digit == d) & (month == m), F.lit(False))
    text = F.when(month == 6, F.lit('"LENDER ""ADJUSTMENT"",\nsecond line"')).otherwise(F.col("Line Item"))
    cells = [F.coalesce("SAP", F.lit("")), "Account", text,
             F.when(when("3", 2), "n/a").otherwise(F.col("Final Month").cast("string")),
             F.when(when("4", 3), "#REF!").when(F.col("Final Adjustment") == 0, "x")
              .otherwise(F.col("Final Adjustment").cast("string")),
             *[F.col(c).cast("string") for c in ("Storage Adjustment", "U-Move Adjustment", "Storage Split")]]
    line = F.concat(F.concat_ws(",", *cells),
                    F.when(when("5", 4), ",late,entry").when(F.coalesce(digit == "6", F.lit(False)), ",,").otherwise(""))
    year = F.year("Final Month").alias("year")
    rows = sheet.select(year, F.lit(1).alias("at"), line.alias("line"))
    top = F.lit("\n".join([*BANNER, ",".join(EXTRACT_HEADER)]))
    heads = sheet.select(year).distinct().select("year", F.lit(0).alias("at"), top.alias("line"))
    (rows.unionByName(heads).repartition("year").sortWithinPartitions("year", "at")
     .select("year", "line").write.partitionBy("year").text(path))


# Old-to-new account conversion: accounts of parts up to size 40 are mapped, to
# the account of the same slot 50 further on.
def account_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    acct = (F.lit(ACCOUNT_BASE) + F.col("p_partkey")).cast("string")
    return (part.where(F.col("p_size") <= 40)
                .select(acct.alias("old_account"),
                        (F.lit(ACCOUNT_BASE + 50) + F.col("p_partkey")).cast("string").alias("ledger_account")))


# Move-in/out contracts (one row per order line: contract keys repeat).
def movein(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_suppkey", "l_shipdate", "l_returnflag", "l_linestatus")
    j = o.join(li, "o_orderkey")
    return j.select(
        F.col("o_orderkey").cast("string").alias("con_pk"),
        F.col("l_suppkey").cast("string").alias("con_entity"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("cus_firstname"),
        F.col("o_orderpriority").alias("cus_lastname"),
        F.to_date("o_orderdate").alias("det_movein"),
        F.to_date("l_shipdate").alias("det_enddate"),
        product_of().alias("esc_product"),
    )


# Rooms per entity and month (total and occupied), in quarters of a room.
def rooms(spark: SparkSession, sf_dir: str, lo: _dt.date | None = None, hi: _dt.date | None = None) -> DataFrame:
    um = unit_mix(spark, sf_dir, lo, hi)
    return (um.groupBy("MEntity", "Date")
              .agg((F.sum("unm_numunits") + F.lit(0.5)).alias("total"),
                   (F.sum("unm_occunits") + F.lit(0.25)).alias("occ")))


# Same-store centre list: centres of suppliers with a positive balance.
def samestore_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return (s.where(F.col("s_acctbal") > 0)
             .select((F.lit(CENTRE_BASE) + F.col("s_suppkey")).cast("string").alias("profit_center")))


# Cash trend: the income statement's NOI per centre and month, in two currencies
# and splits; a third of the centres are only there in the local currency.
def cash_trend(spark: SparkSession, sf_dir: str, noi: DataFrame) -> DataFrame:
    """``noi``: profit_center, month, amount."""
    k = F.col("profit_center").cast("long")
    return noi.select(F.col("profit_center").alias("PROFIT CENTER"), F.col("month").alias("MONTH"),
                      F.when(k % 3 == 0, F.lit("Local")).otherwise(F.lit("Group")).alias("CURRENCY"),
                      F.when(F.month("month") % 2 == 0, F.lit("ALL")).otherwise(F.lit("HALF")).alias("SPLIT"),
                      F.col("amount").alias("NET OPERATING INCOME"))
