"""General-ledger operators: X1 normalise, X2 chart of accounts, X3 line-item
amounts, X11 lender-basis ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fiscal
from ..functions.cleaning import _sql_name, drop_matching
from ..functions.stats import from_cents, to_cents

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's statement layout.
# Base statement lines, in ledger-chart order (21 lines).
BASE_LINES = [
    "STORAGE INCOME",
    "SALES",
    "COST OF SALES",
    "MISCELLANEOUS INCOME",
    "U-BOX STORAGE INCOME",
    "U-BOX OTHER INCOME",
    "U-BOX DELIVERY INCOME",
    "U-MOVE NET COMMISSION",
    "INTERCOMPANY RENT",
    "THIRD PARTY LEASE",
    "PERSONNEL",
    "REPAIRS AND MAINTENANCE/GENERAL",
    "UTILITIES",
    "TELEPHONE",
    "ADVERTISING",
    "SUPPLIES",
    "RENT-EQUIPMENT/LAND AND BLDGS",
    "LIABILITY INSURANCE",
    "PROPERTY TAX",
    "BAD DEBT EXPENSE",
    "OTHER OPERATING EXPENSE",
]
# Lines whose ledger sign is flipped for presentation (income is negative in
# the ledger).  Cost of sales is not flipped.
INCOME_LINES = [
    "STORAGE INCOME",
    "SALES",
    "MISCELLANEOUS INCOME",
    "U-BOX STORAGE INCOME",
    "U-BOX OTHER INCOME",
    "U-BOX DELIVERY INCOME",
    "U-MOVE NET COMMISSION",
    "INTERCOMPANY RENT",
    "THIRD PARTY LEASE",
]
# Chart value marking an account that is not reported.
NOT_REPORTED = "NOT USED FOR LENDER REPORTING"
# ---------------------------------------------------------------------------


def line_no_of(line_item) -> "F.Column":
    """Position (1-based) of a base line, null for unknown text."""
    expr = None
    for i, name in enumerate(BASE_LINES, start=1):
        cond = F.rtrim(line_item) == name
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def chart_of_accounts(raw: DataFrame, account_col: str = "account",
                      line_col: str = "line_item") -> DataFrame:
    """Reportable accounts -> (account, line_item, line_no, sign).

    Names are right-trimmed (a trailing blank in one line name is a known
    defect of the source file); ``sign`` is -1 for the income set.  An account
    listed several times counts once; one that is on two lines stops the job
    (``quality.account_conflicts`` lists them).  A row without a line, or with
    one that is no statement line, reports nothing
    (``quality.accounts_without_line`` lists them).

    The lines are compared by their numbers, so the aggregate is a hash
    aggregate; the account leaves it as an expression, so that a join on it
    shuffles the chart again and AQE can split a ledger partition that holds a
    hot account.
    """
    line = F.rtrim(F.col(line_col))
    code = F.when(line == NOT_REPORTED, F.lit(0)).otherwise(line_no_of(F.col(line_col)))
    per = (raw.select(F.trim(F.col(account_col).cast("string")).alias("account"), code.alias("_code"))
              .where(F.col("_code").isNotNull())
              .groupBy("account").agg(F.min("_code").alias("line_no"), F.max("_code").alias("_hi")))
    stop = F.raise_error(F.concat(F.lit("account on two lines: "), F.col("account"))).cast("string")
    chart = per.select(F.when(F.col("line_no") == F.col("_hi"), F.col("account")).otherwise(stop).alias("account"),
                       "line_no").where(F.col("_hi") > 0)
    return chart.select(
        "account",
        F.element_at(F.array(*[F.lit(n) for n in BASE_LINES]), F.col("line_no")).alias("line_item"),
        "line_no",
        F.when(F.col("line_no").isin([BASE_LINES.index(n) + 1 for n in INCOME_LINES]), F.lit(-1))
         .otherwise(F.lit(1)).alias("sign"),
    )


def normalize_ledger(wide: DataFrame, fiscal_year_col: str = "FISCAL_YEAR",
                     centre_col: str = "PROFIT_CENTER", account_col: str = "GL_ACCOUNT",
                     period_prefix: str = "GC_PER_", drop_pattern: str = "LC",
                     extra_ids: list[str] | None = None, keep_null: bool = True,
                     month_columns: list[tuple[str, int]] | None = None) -> DataFrame:
    """Wide fiscal periods 1..12 -> one row per (centre, account, month).

    Period n of fiscal year FY is calendar month ((n + 2) % 12) + 1 of
    FY - 1 for April..December and of FY for January..March.  A layout that
    tells its periods by position (the older ledger) is given as
    ``month_columns``, pairs of a column and its calendar month; prefix and
    drop pattern then play no part.
    """
    by_name = month_columns is None
    df = drop_matching(wide, drop_pattern) if drop_pattern and by_name else wide
    ids = [fiscal_year_col, centre_col, account_col] + list(extra_ids or [])
    periods = ([(c, int(c[len(period_prefix):])) for c in df.columns if c.startswith(period_prefix)]
               if by_name else [(_sql_name(c), (m + 8) % 12 + 1) for c, m in month_columns])
    # One (period, amount) struct per wide column, exploded in place: the
    # period number is a literal, so no per-row parsing of column names.
    cells = F.array(*[F.struct(F.lit(n).alias("period"), F.col(c).alias("amount")) for c, n in periods])
    long = df.select(*[F.col(i) for i in ids], F.inline(cells))
    if not keep_null:
        long = long.where(F.col("amount").isNotNull())
    n = F.col("period")
    cal_m = (n + 2) % 12 + 1
    fy = F.col(fiscal_year_col).cast("int")
    return long.select(
        fy.alias("fiscal_year"),
        F.col(centre_col).cast("string").alias("profit_center"),
        F.col(account_col).cast("string").alias("account"),
        *[F.col(e) for e in (extra_ids or [])],
        fiscal.first_of_month(fiscal.calendar_year(fy, cal_m), cal_m).alias("month"),
        F.col("amount"),
    )


def restrict_ledger(ledger: DataFrame, centres: DataFrame | None = None,
                    chart: DataFrame | None = None, fiscal_years: list[int] | DataFrame | None = None,
                    centre_col: str = "profit_center", account_col: str = "account",
                    year_col: str = "fiscal_year") -> DataFrame:
    """Keep ledger rows of listed centres / reportable accounts / fiscal years,
    of a long ledger or, with its column names, of the wide one: before X1 a join
    sees one row instead of twelve.

    Lists are joins (left semi), never SQL text; a literal list of fiscal years
    reaches the scan as a pushed filter, one that is a table (``fiscal_year``)
    prunes the partitions of a ledger stored by year while the query runs.  The key
    lists are not deduplicated first: a semi join ignores repeated keys, and a
    shuffle stage directly under the join lets AQE split a ledger partition
    that holds a hot centre (an aggregate there would block that).
    """
    def listed(rows: DataFrame, col: str, keys: DataFrame, key: str) -> DataFrame:
        listed_key = keys.select(F.col(key).alias("_listed"))
        return rows.join(listed_key, F.col(f"`{col}`").cast(keys.schema[key].dataType) == F.col("_listed"), "left_semi")

    if isinstance(fiscal_years, DataFrame):
        ledger = listed(ledger, year_col, fiscal_years, "fiscal_year")
    elif fiscal_years is not None:
        ledger = ledger.where(F.col(year_col).isin(list(fiscal_years)))
    if centres is not None:
        ledger = listed(ledger, centre_col, centres, "profit_center")
    if chart is not None:
        ledger = listed(ledger, account_col, chart, "account")
    return ledger


def line_item_amounts(ledger: DataFrame, chart: DataFrame) -> DataFrame:
    """Presentation-signed amount per (centre, month, line item)."""
    j = ledger.where(F.col("amount").isNotNull()).join(
        chart.select("account", "line_item", "sign"), "account")
    return (j.groupBy("profit_center", "month", "line_item")
             .agg(from_cents(F.sum(to_cents(F.col("amount")) * F.col("sign")), 2, 18).alias("amount")))


def lender_basis_ledger(lender: DataFrame, conversion: DataFrame, old_col: str = "old_account",
                        new_col: str = "ledger_account") -> DataFrame:
    """X11: lender-sheet rows on ledger accounts.

    ``lender``: SAP_Number, Account_Number, Line_Item, Date, Amount.
    ``conversion``: old account number -> ledger account number.  Unmapped
    accounts give a null account (as the reference's map does);
    ``quality.unmapped_accounts`` lists them.
    """
    conv = conversion.select(F.col(old_col).cast("string").alias("Account_Number"),
                             F.col(new_col).cast("string").alias("account"))
    return (lender.join(conv, "Account_Number", "left")
                  .select(F.col("SAP_Number").alias("profit_center"),
                          F.col("account"),
                          F.col("Line_Item").alias("line_item"),
                          F.col("Date").alias("month"),
                          F.col("Amount").alias("amount")))
