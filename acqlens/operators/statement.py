"""Income statements: X4 per centre and month, X5 portfolio, X7 group
statement, X8 dense line-item series, X9 start of operations, X15 cut-off."""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import fiscal
from ..functions.stats import from_cents, sum_money, to_cents
from .ledger import BASE_LINES
from .quality import unique_or_stop

# ---------------------------------------------------------------------------
# Presentation lines of the statement, in output order.
STATEMENT_LINES = [
    "STORAGE INCOME",
    "SALES",
    "COST OF SALES",
    "NET SALES",
    "MISCELLANEOUS INCOME",
    "U-BOX INCOME",
    "U-BOX DELIVERY INCOME",
    "U-MOVE NET COMMISSION",
    "INTERCOMPANY RENT",
    "THIRD PARTY LEASE",
    "TOTAL REVENUE",
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
    "TOTAL OPERATING EXPENSE",
    "NET OPERATING INCOME",
]
# Lines added into U-BOX INCOME.
UBOX_PARTS = ["U-BOX STORAGE INCOME", "U-BOX OTHER INCOME", "U-BOX DELIVERY INCOME"]
# Lines added into TOTAL REVENUE (intercompany rent is always 0).
REVENUE_PARTS = ["STORAGE INCOME", "NET SALES", "MISCELLANEOUS INCOME", "U-BOX INCOME",
                 "U-MOVE NET COMMISSION", "INTERCOMPANY RENT", "THIRD PARTY LEASE"]
# Lines added into TOTAL OPERATING EXPENSE.
EXPENSE_PARTS = ["PERSONNEL", "REPAIRS AND MAINTENANCE/GENERAL", "UTILITIES", "TELEPHONE",
                 "ADVERTISING", "SUPPLIES", "RENT-EQUIPMENT/LAND AND BLDGS",
                 "LIABILITY INSURANCE", "PROPERTY TAX", "BAD DEBT EXPENSE",
                 "OTHER OPERATING EXPENSE"]
# ---------------------------------------------------------------------------

VALUE_TYPE = "decimal(18,2)"   # statement values (per centre and month)


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def noi_weights() -> dict[str, int]:
    """Weight of each base line in NOI, expanded from the statement formulas
    (revenue parts with U-box and net sales expanded, minus expenses;
    intercompany rent contributes 0)."""
    expand = {"U-BOX INCOME": {p: 1 for p in UBOX_PARTS},
              "NET SALES": {"SALES": 1, "COST OF SALES": -1},
              "INTERCOMPANY RENT": {}}
    w: dict[str, int] = {}
    for part in REVENUE_PARTS:
        for base, k in expand.get(part, {part: 1}).items():
            w[base] = w.get(base, 0) + k
    for part in EXPENSE_PARTS:
        w[part] = w.get(part, 0) - 1
    return w


def statement_wide(ledger: DataFrame, chart: DataFrame,
                   keys: tuple[str, ...] = ("profit_center", "month"), few_accounts: bool = False) -> DataFrame:
    """One row per (centre, month) with all 24 presentation lines as columns.

    A single hash aggregate does the work of the reference's centre x line
    loops: each line is a conditional sum over the joined ledger, so there is
    one shuffle for all centres (``pivot`` would add a second job).

    ``few_accounts``: a ledger of a few accounts with many rows each.  The join
    leaves all centres of an account in one task, so the chart is hashed, no ledger
    row sorted, and the rows go to their centre's task before they are summed:
    sums made before that shuffle would hold every centre and month in each task.
    """
    if few_accounts:
        return _wide_lines(_signed_cents(ledger, chart.hint("shuffle_hash")).repartition("profit_center"), keys)
    return _wide_lines(_signed_cents(ledger, chart), keys)


def _signed_cents(ledger: DataFrame, chart: DataFrame) -> DataFrame:
    """The ledger's rows on reported accounts, with line and signed cents."""
    j = (ledger.where(F.col("amount").isNotNull())
               .join(chart.select("account", "line_no", "sign"), "account"))
    return j.withColumn("_cents", to_cents(F.col("amount")) * F.col("sign"))


def _wide_lines(j: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    sums = [F.coalesce(F.sum(F.when(F.col("line_no") == i, F.col("_cents"))), F.lit(0)).alias(name)
            for i, name in enumerate(BASE_LINES, start=1)]
    # NOI as one more aggregate (its line weights expanded from the formulas
    # below), so the NOI <> 0 filter reads one column instead of re-deriving
    # the whole statement inside the filter.
    w = noi_weights()
    noi_w = F.lit(0)
    for i, name in enumerate(BASE_LINES, start=1):
        if w.get(name):
            noi_w = F.when(F.col("line_no") == i, F.lit(w[name])).otherwise(noi_w)
    sums.append(F.coalesce(F.sum(F.col("_cents") * noi_w), F.lit(0)).alias("_noi"))
    wide = j.groupBy(*keys).agg(*sums)
    # Lines are exact cents (long) up to here; arithmetic on them stays exact.
    wide = wide.withColumn("INTERCOMPANY RENT", F.lit(0).cast("long"))
    wide = wide.withColumn("U-BOX INCOME", sum((_q(c) for c in UBOX_PARTS[1:]), _q(UBOX_PARTS[0])))
    wide = wide.withColumn("NET SALES", _q("SALES") - _q("COST OF SALES"))
    wide = wide.withColumn("TOTAL REVENUE", sum((_q(c) for c in REVENUE_PARTS[1:]), _q(REVENUE_PARTS[0])))
    wide = wide.withColumn("TOTAL OPERATING EXPENSE",
                           sum((_q(c) for c in EXPENSE_PARTS[1:]), _q(EXPENSE_PARTS[0])))
    wide = wide.withColumn("NET OPERATING INCOME", F.col("_noi"))
    return wide.select(*keys, *[from_cents(_q(c), 2, 18).alias(c) for c in STATEMENT_LINES])


def income_statement(ledger: DataFrame, chart: DataFrame, drop_zero_noi: bool = True,
                     keys: tuple[str, ...] = ("profit_center", "month"), few_accounts: bool = False) -> DataFrame:
    """Tidy statement (date, profit_center, line_item, value, further keys).

    ``ledger``: profit_center, account, month, amount (ledger sign).
    ``chart``: output of ``chart_of_accounts``.  Months whose NOI is exactly
    0 are dropped with all their lines.  ``few_accounts``: see ``statement_wide``.
    """
    return _tidy(statement_wide(ledger, chart, keys, few_accounts), drop_zero_noi, keys)


def _tidy(wide: DataFrame, drop_zero_noi: bool, keys: tuple[str, ...]) -> DataFrame:
    if drop_zero_noi:
        wide = wide.where(_q("NET OPERATING INCOME") != 0)
    tidy = wide.unpivot(list(keys), [_q(c) for c in STATEMENT_LINES], "line_item", "value")
    return tidy.select(F.col("month").alias("date"), "profit_center", "line_item", "value",
                       *[k for k in keys if k not in ("profit_center", "month")])


def line_state(ledger: DataFrame, chart: DataFrame) -> DataFrame:
    """X5 kept between runs: additive cents per (centre, month, line).  Stored by
    month (``tables.replace_partitions``), only months whose ledger changed are
    computed again; ``statement_from_state`` gives what the whole ledger would."""
    return (_signed_cents(ledger, chart).groupBy("profit_center", "month", "line_no")
            .agg(F.sum("_cents").alias("cents")))


def statement_from_state(state: DataFrame, drop_zero_noi: bool = True) -> DataFrame:
    """X4 from stored line cents: no ledger, no chart."""
    return _tidy(_wide_lines(state.withColumn("_cents", F.col("cents")), ("profit_center", "month")),
                 drop_zero_noi, ("profit_center", "month"))


def collapse_ubox(wide: DataFrame) -> DataFrame:
    """Q9: the older report's statement, which shows U-box as one line: delivery
    income is already in U-BOX INCOME, so its memo column goes."""
    return wide.drop("U-BOX DELIVERY INCOME")


def portfolio_statement(ledger: DataFrame, chart: DataFrame, centres: DataFrame,
                        as_of: _dt.date, base_fy: int = 2015, base_q: int = 4) -> DataFrame:
    """Statements of the included centres for the fiscal year of ``as_of``
    and the one before, months up to the first of the ``as_of`` month.

    ``centres``: profit_center, MEntity, Group (output of
    ``acquisitions.included_centres``); a centre listed twice stops the job, as
    its statement would be counted twice.

    The centres are joined once, before the aggregate: the join restricts the
    ledger and brings the attributes, which then travel as grouping keys.
    """

    out = income_statement(_portfolio_ledger(ledger, centres, as_of), chart,
                           keys=("profit_center", "month", "MEntity", "grp_num"))
    return _portfolio_columns(out, base_fy, base_q)


def _portfolio_ledger(ledger: DataFrame, centres: DataFrame, as_of: _dt.date) -> DataFrame:
    grp = unique_or_stop(centres.select("profit_center", "MEntity", F.col("Group").alias("grp_num")),
                         "profit_center", "profit centre listed twice")
    return _portfolio_months(ledger, as_of).join(grp, "profit_center")


def _portfolio_months(ledger: DataFrame, as_of: _dt.date) -> DataFrame:
    fy_last, _ = fiscal.fiscal_years_of(as_of)
    lo = _dt.date(fy_last - 1, 4, 1)             # first month of the earlier fiscal year
    cut = _dt.date(as_of.year, as_of.month, 1)    # first of the as-of month, inclusive
    return ledger.where(F.col("month").between(F.lit(lo), F.lit(cut)))


def _portfolio_columns(statement: DataFrame, base_fy: int, base_q: int) -> DataFrame:
    d = F.col("date")
    return statement.select(
        "date", "profit_center", "MEntity", "line_item", "value",
        fiscal.group_label_of_number(F.col("grp_num"), base_fy, base_q).alias("grp_name"),
        "grp_num",
        F.month(d).alias("month"), F.year(d).alias("year"),
        fiscal.fiscal_year(d).alias("fiscal_year"), fiscal.fiscal_month(d).alias("fiscal_month"),
    )


def checked_statement(ledger: DataFrame, chart: DataFrame, centres: DataFrame, as_of: _dt.date,
                      base_fy: int = 2015, base_q: int = 4) -> tuple[DataFrame, dict[str, Observation]]:
    """X5 with the checks of X24 counted on the way (A11, X6): the statement and
    the observations that hold the counts once it has been written.

    ``centres``: rows of the centre list, and keys listed more than once.
    ``ledger``: the included centres' rows of the statement's months, rows without
    an amount, rows on an account that the chart does not report.  A centre
    listed twice counts once here, as the count tells of it.
    """
    listed, read = Observation("centres"), Observation("ledger")
    others = [F.col("MEntity"), F.col("Group").alias("grp_num")]
    grp = (centres.groupBy("profit_center").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*others)).alias("_row"))
           .observe(listed, F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
                    F.count_if(F.col("_n") > 1).alias("duplicates"))
           .select(F.when(F.col("_n") > 0, F.col("profit_center")).alias("profit_center"), "_row.*"))
    lines = chart.select("account", F.col("line_no").alias("_line"))
    marked = (_portfolio_months(ledger, as_of).join(grp, "profit_center").join(lines, "account", "left")
              .observe(read, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("amount").isNull()).alias("unreadable"),
                       F.count_if(F.col("_line").isNull()).alias("unmapped")))
    amounts = marked.where(F.col("_line").isNotNull()).drop("_line")
    out = income_statement(amounts, chart, keys=("profit_center", "month", "MEntity", "grp_num"))
    return _portfolio_columns(out, base_fy, base_q), {"centres": listed, "ledger": read}


def group_statement(portfolio: DataFrame) -> DataFrame:
    """Portfolio statement summed per month x line x acquisition group."""
    keys = ["date", "line_item", "fiscal_year", "fiscal_month", "month", "grp_name", "grp_num"]
    return _group_columns(portfolio.groupBy(*keys).agg(sum_money("value").alias("value")))


def group_statement_from_ledger(ledger: DataFrame, chart: DataFrame, centres: DataFrame, as_of: _dt.date,
                                base_fy: int = 2015, base_q: int = 4) -> DataFrame:
    """X7 straight from the ledger: the 24 lines are summed as columns per month
    and group, and only these sums become rows."""
    wide = (statement_wide(_portfolio_ledger(ledger, centres, as_of), chart, ("profit_center", "month", "grp_num"))
            .where(_q("NET OPERATING INCOME") != 0))
    sums = wide.groupBy("month", "grp_num").agg(*[sum_money(_q(c)).alias(c) for c in STATEMENT_LINES])
    tidy = sums.unpivot(["month", "grp_num"], [_q(c) for c in STATEMENT_LINES], "line_item", "value")
    d = F.col("month")
    return _group_columns(tidy.select(
        d.alias("date"), "line_item", "value", fiscal.fiscal_year(d).alias("fiscal_year"),
        fiscal.fiscal_month(d).alias("fiscal_month"), F.month(d).alias("month"),
        fiscal.group_label_of_number(F.col("grp_num"), base_fy, base_q).alias("grp_name"), "grp_num"))


def _group_columns(agg: DataFrame) -> DataFrame:
    return agg.select(
        "date", "line_item", "value", "fiscal_year", "fiscal_month",
        fiscal.fiscal_quarter(F.col("date")).alias("quarter"),
        F.col("month").alias("cal_month"),
        fiscal.display_label(F.col("grp_name")).alias("grp_name"), "grp_num",
        (F.col("value") * F.lit(Decimal("0.001"))).cast("decimal(38,5)").alias("val_thousands"),
    )


def dense_line_items(line_amounts: DataFrame, max_month: _dt.date) -> DataFrame:
    """Every line x every month from the centre's first ledger month to
    ``max_month``, 0 where absent (leading and inner gaps alike).

    ``line_amounts``: output of ``ledger.line_item_amounts``.  The spine is
    generated per centre (bounded by months x lines) and joined back on the
    full key, so no row of the ledger is replicated.
    """
    first = line_amounts.groupBy("profit_center").agg(F.min("month").alias("first_month"))
    spine = (first.where(F.col("first_month") <= F.lit(max_month))
                  .select("profit_center",
                          F.explode(fiscal.month_sequence(F.col("first_month"), F.lit(max_month))).alias("month"))
                  .select("profit_center", "month",
                          F.explode(F.array(*[F.lit(n) for n in BASE_LINES])).alias("line_item")))
    facts = line_amounts.where(F.col("month") <= F.lit(max_month))
    out = spine.join(facts, ["profit_center", "month", "line_item"], "left")
    return out.select("profit_center", "month", "line_item",
                      F.coalesce(F.col("amount"), F.lit(0)).cast(VALUE_TYPE).alias("amount"))


def operations_start(statement: DataFrame) -> DataFrame:
    """Earliest month with non-zero NOI per centre, from a tidy statement."""
    noi = statement.where((F.col("line_item") == "NET OPERATING INCOME") & (F.col("value") != 0))
    return noi.groupBy("profit_center").agg(F.min("date").alias("start_month"))


def operations_start_from_ledger(ledger: DataFrame, chart: DataFrame) -> DataFrame:
    """X9 straight from the ledger: only the NOI column of the wide statement
    is needed, so the 24-line unpivot is skipped."""
    wide = statement_wide(ledger, chart).where(_q("NET OPERATING INCOME") != 0)
    return wide.groupBy("profit_center").agg(F.min("month").alias("start_month"))


def statement_cutoff(statement: DataFrame, as_of: _dt.date, date_col: str = "date") -> DataFrame:
    """Rows up to the last day of the month before ``as_of``."""
    return statement.where(F.col(date_col) <= fiscal.prev_month_end(as_of))
