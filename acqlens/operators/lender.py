"""Lender ledgers: X21 sheet loads (trends, u-box delivery, adjustments),
S8 reload from a watermark, X23 roll-ups."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import (amount_or_zero, clean_key, column_date, date_columns_after, undated_columns,
                                  unreadable_amount)
from ..functions.stats import sum_money

# ---------------------------------------------------------------------------
# Fixed values of the u-box delivery sheet.
UBOX_ACCOUNTS = ["U-BOX ONE-WAY DELIVERY INCOME", "U-BOX LOCAL DELIVERY INCOME"]
UBOX_ACCOUNT_NUMBER = "52152"
# ---------------------------------------------------------------------------

AMOUNT = "decimal(18,2)"


def _q(c: str):
    return F.col(f"`{c}`")


def _months(sheet: DataFrame, ids: list[str], watermark: _dt.date | None) -> list[str]:
    """The month columns after the watermark; a column that is neither an id nor
    a month stops the load rather than being skipped."""
    if odd := undated_columns(sheet.columns, ids):
        raise ValueError(f"columns that are no month: {odd}")
    return date_columns_after(sheet.columns, watermark)


def _melt_months(df: DataFrame, ids: list[str], months: list[str]) -> DataFrame:
    """Wide month columns -> (Date, Amount); the month is a literal per
    column, the cell text goes through the sentinel rule ('x' -> 0, blank ->
    0, unreadable text -> null).  The cells are only cast once they are rows: one
    expression instead of one a month, which the JIT would not compile."""
    if not months:   # nothing after the watermark: no rows, same columns
        return df.select(*[_q(i) for i in ids], F.lit(None).cast("date").alias("Date"),
                         F.lit(None).cast(AMOUNT).alias("Amount")).where(F.lit(False))
    cells = F.array(*[F.struct(F.lit(column_date(m)).alias("Date"), _q(m).cast("string").alias("_cell")) for m in months])
    rows = df.select(*[_q(i) for i in ids], F.inline(cells))
    return rows.select(*[_q(i) for i in ids], "Date", amount_or_zero(F.col("_cell"), "x", AMOUNT).alias("Amount"))


def trend_accounts(sheet: DataFrame) -> DataFrame:
    """The cleaned account numbers of a trends sheet, off its key columns alone."""
    keys = sheet.select(clean_key(_q("SAP")).alias("SAP"), clean_key(_q("Account_Number")).alias("Account_Number"))
    return keys.where(F.col("SAP").isNotNull() & F.col("Account_Number").isNotNull()).select("Account_Number").distinct()


TREND_IDS = ["SAP", "Account_Number", "Description", "Line Item"]


def _keyed_trends(sheet: DataFrame) -> DataFrame:
    """The sheet's rows that have a centre and an account, both cleaned."""
    return (sheet.withColumn("SAP", clean_key(_q("SAP")))
                 .withColumn("Account_Number", clean_key(_q("Account_Number")))
                 .where(_q("SAP").isNotNull() & _q("Account_Number").isNotNull()))


def load_trends(sheet: DataFrame, watermark: _dt.date | None = None, accounts: DataFrame | None = None,
                centres: DataFrame | None = None) -> DataFrame:
    """X21 trends: 4 id columns + months after the watermark (chosen at plan
    time, before the unpivot); null centre or account dropped; keys cleaned.
    Lists of ``accounts`` (account) and ``centres`` (profit_center) also cut the
    sheet before it is unpivoted, a row a join instead of one a month."""
    months = _months(sheet, TREND_IDS, watermark)
    df = _keyed_trends(sheet)
    # key lists go into the semi joins as they are (see ledger.restrict_ledger)
    if accounts is not None:
        listed = accounts.select(F.col("account").alias("Account_Number"))
        df = df.join(listed.hint("shuffle_hash"), "Account_Number", "left_semi")
    if centres is not None:
        df = df.join(centres.select(F.col("profit_center").alias("SAP")), "SAP", "left_semi")
    long = _melt_months(df, TREND_IDS, months)
    return long.select(F.col("SAP").alias("SAP_Number"), "Account_Number",
                       F.col("Description").alias("Account_Description"),
                       F.col("`Line Item`").alias("Line_Item"), "Date", "Amount")


def basis_from_sheet(sheet: DataFrame, conversion: DataFrame, watermark: _dt.date | None = None,
                     old_col: str = "old_account", new_col: str = "ledger_account") -> DataFrame:
    """X11 straight from the trends sheet: its rows get their ledger account before
    they are unpivoted.  Equal to ``ledger.lender_basis_ledger`` of ``load_trends``.
    The conversion is hashed: a sort would hold the wide rows of a few accounts whole."""
    months = _months(sheet, TREND_IDS, watermark)
    conv = conversion.select(F.col(old_col).cast("string").alias("Account_Number"),
                             F.col(new_col).cast("string").alias("_account"))
    df = _keyed_trends(sheet).join(conv.hint("shuffle_hash"), "Account_Number", "left")
    long = _melt_months(df, ["SAP", "_account", "Line Item"], months)
    return long.select(F.col("SAP").alias("profit_center"), F.col("_account").alias("account"),
                       F.col("`Line Item`").alias("line_item"), F.col("Date").alias("month"),
                       F.col("Amount").alias("amount"))


def load_ubox(sheet: DataFrame, watermark: _dt.date | None = None) -> DataFrame:
    """X21 u-box: the two delivery-income accounts, constant account number."""
    months = _months(sheet, ["#", "Account"], watermark)
    df = (sheet.withColumn("#", clean_key(_q("#")))
               .where(F.col("Account").isin(UBOX_ACCOUNTS) & _q("#").isNotNull()))
    long = _melt_months(df, ["#", "Account"], months)
    return long.select(F.col("`#`").alias("SAP_Number"), F.lit(UBOX_ACCOUNT_NUMBER).alias("Account_Number"),
                       F.col("Account").alias("Account_Description"), "Date", "Amount")


def load_adjustments(sheet: DataFrame, watermark: _dt.date | None = None) -> DataFrame:
    """X21 adjustments: null centre dropped, eight columns renamed, dates
    after the watermark."""
    df = sheet.where(clean_key(_q("SAP")).isNotNull())
    out = df.select(
        clean_key(_q("SAP")).alias("SAP_Number"),
        clean_key(_q("Account")).alias("Account_Number"),
        _q("Line Item").alias("Account_Description"),
        _q("Final Month").cast("date").alias("Date"),
        _q("Final Adjustment").cast(AMOUNT).alias("Total_Adjustment"),
        _q("Storage Adjustment").cast(AMOUNT).alias("Storage_Adjustment"),
        _q("U-Move Adjustment").cast(AMOUNT).alias("UMove_Adjustment"),
        _q("Storage Split").cast("double").alias("Storage_Split"))
    if watermark is not None:
        out = out.where(F.col("Date") > F.lit(watermark))
    return out


def unreadable_amounts(sheet: DataFrame, ids: list[str], key: str) -> DataFrame:
    """Findings: cells of month columns that hold text but no amount."""
    months = _months(sheet, ids, None)
    cells = F.array(*[F.struct(F.lit(m).alias("month"), _q(m).cast("string").alias("cell")) for m in months])
    bad = sheet.select(_q(key).alias("key"), F.inline(cells)).where(unreadable_amount(F.col("cell"), "x", AMOUNT))
    return bad.select(F.lit("unreadable amount").alias("check"), F.col("key").cast("string").alias("key"),
                      F.concat_ws("=", "month", "cell").alias("detail"))


def apply_reload(stored: DataFrame, new_rows: DataFrame, watermark: _dt.date,
                 date_col: str = "Date") -> DataFrame:
    """S8 as a state transition: when ``watermark`` precedes the stored
    maximum, stored rows after it are deleted; then the new rows are
    appended.  An equal or later watermark deletes nothing, and a stored row
    without a date is never deleted."""
    stored_max = stored.select(F.max(date_col)).scalar()
    keep = stored.where(stored_max.isNull() | (F.lit(watermark) >= stored_max)
                        | F.col(date_col).isNull() | (F.col(date_col) <= F.lit(watermark)))
    return keep.unionByName(new_rows)


def trend_rollup(trends: DataFrame, accounts: DataFrame | None = None, centres: DataFrame | None = None) -> DataFrame:
    """X23 trends: listed accounts and centres, summed by (Date, Line_Item).  Lists
    that ``load_trends`` has applied need not be given again."""
    t = trends
    if accounts is not None:
        t = t.join(accounts.select(F.col("account").alias("Account_Number")), "Account_Number", "left_semi")
    if centres is not None:
        t = t.join(centres.select(F.col("profit_center").alias("SAP_Number")), "SAP_Number", "left_semi")
    return t.groupBy("Date", "Line_Item").agg(sum_money("Amount").alias("value"))


def adjustment_rollup(adjustments: DataFrame, centres: DataFrame) -> DataFrame:
    """X23 adjustments: listed centres, total adjustment by (Date, description)."""
    a = adjustments.join(centres.select(F.col("profit_center").alias("SAP_Number")),
                         "SAP_Number", "left_semi")
    return a.groupBy("Date", "Account_Description").agg(sum_money("Total_Adjustment").alias("total_adjustment"))


def ubox_rollup(ubox: DataFrame, centres: DataFrame) -> DataFrame:
    """X23 u-box: listed centres, amount by (Date, description)."""
    u = ubox.join(centres.select(F.col("profit_center").alias("SAP_Number")),
                  "SAP_Number", "left_semi")
    return u.groupBy("Date", "Account_Description").agg(sum_money("Amount").alias("value"))
