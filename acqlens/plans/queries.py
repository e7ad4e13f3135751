"""Driver queries: each takes (spark, sf_dir) and returns a DataFrame built by
the library's operators over the test-table bindings."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..functions import fiscal
from ..functions.stats import sum_money
from ..operators import acquisitions as A
from ..operators import ledger as L
from ..operators import lender as LD
from ..operators import movein as MV
from ..operators import occupancy as O
from ..operators import quality as Q
from ..operators import samestore as SS
from ..operators import statement as S
from ..session import shared_folder
from ..sources import bindings as B
from ..sources import quarantine as QU
from ..sources import tables as T

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def reported(df: DataFrame) -> DataFrame:
    """Money as reported to the driver: the operators keep exact decimals
    (summed in integer cents); the registered queries hand them over as
    double, the reference's own money type.  An exact decimal converts to
    the same double in any engine, and a double compares the same way
    whatever container (pandas, Arrow, Python) carries it."""
    return df.select(*[F.col(f"`{f.name}`").cast("double").alias(f.name)
                       if isinstance(f.dataType, DecimalType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = lambda spark, d: reported(fn(spark, d))
    return fn


def _chart(spark, d):
    return L.chart_of_accounts(B.chart_raw(spark, d))


def _ledger_from_wide(spark, d, keep_null=False):
    return L.normalize_ledger(B.ledger_wide(spark, d), keep_null=keep_null)


# ---------------------------------------------------------------- statements
@query
def income_statement(spark, d):
    return S.income_statement(_ledger_from_wide(spark, d), _chart(spark, d))


@query
def ledger_unpivot(spark, d):
    centres = A.included_centres(B.acquisitions(spark, d))
    last, current = fiscal.fiscal_years_of(B.AS_OF)
    wide = B.ledger_wide(spark, d, _dt.date(last - 1, 4, 1), _dt.date(current, 3, 1))
    wide = L.restrict_ledger(wide, centres, _chart(spark, d), [last, current],
                             "PROFIT_CENTER", "GL_ACCOUNT", "FISCAL_YEAR")
    return L.normalize_ledger(wide, keep_null=True)


@query
def chart_of_accounts(spark, d):
    return _chart(spark, d)


@query
def line_item_amounts(spark, d):
    return L.line_item_amounts(B.ledger_long(spark, d), _chart(spark, d))


def _portfolio_ledger(spark, d, as_of):
    first = _dt.date(fiscal.fiscal_years_of(as_of)[0] - 1, 4, 1)
    return B.ledger_long(spark, d, first, _dt.date(as_of.year, as_of.month, 1))


def _portfolio(spark, d, as_of=B.AS_OF):
    centres = A.included_centres(B.acquisitions(spark, d))
    return S.portfolio_statement(_portfolio_ledger(spark, d, as_of), _chart(spark, d), centres, as_of,
                                 B.BASE_FY, B.BASE_Q)


@query
def portfolio_statement(spark, d):
    return _portfolio(spark, d)


@query
def group_statement(spark, d):
    centres = A.included_centres(B.acquisitions(spark, d))
    return S.group_statement_from_ledger(_portfolio_ledger(spark, d, B.AS_OF), _chart(spark, d), centres, B.AS_OF,
                                         B.BASE_FY, B.BASE_Q)


@query
def statement_cutoff(spark, d):
    return S.statement_cutoff(_portfolio(spark, d), B.AS_OF)


@query
def list_cutoff(spark, d):
    return A.list_cutoff(B.acquisitions(spark, d), B.AS_OF)


@query
def dense_line_items(spark, d):
    amounts = L.line_item_amounts(B.ledger_long(spark, d), _chart(spark, d))
    return S.dense_line_items(amounts, fiscal.py_prev_month_start(B.AS_OF))


@query
def operations_start(spark, d):
    return S.operations_start_from_ledger(B.ledger_long(spark, d), _chart(spark, d))


@query
def fiscal_calendar(spark, d):
    bounds = B.ledger_long(spark, d).agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
    return fiscal.fiscal_calendar_from_bounds(bounds, B.BASE_FY, B.BASE_Q)


# ---------------------------------------------------------------- occupancy
MIN_ACTUAL = _dt.date(1995, 1, 1)    # earliest actual month used by the splice


def _actual(spark, d):
    um = B.unit_mix(spark, d, hi=fiscal.py_prev_month_start(B.AS_OF))
    return O.actual_occupancy(um, B.acquisitions(spark, d), B.AS_OF)


def _last_mix(spark, d):
    month = fiscal.py_prev_month_start(B.AS_OF)
    return B.unit_mix(spark, d, month, month)


@query
def actual_occupancy(spark, d):
    return _actual(spark, d)


@query
def group_occupancy(spark, d):
    return O.group_occupancy(_actual(spark, d), B.acquisitions(spark, d))


@query
def occupancy_mix(spark, d):
    return O.occupancy_mix(_last_mix(spark, d), B.forecast(spark, d),
                           fiscal.py_prev_month_start(B.AS_OF), MIN_ACTUAL)


def _nullable_counts_as_double(df, cols):
    # integer columns that are null on part of the rows are reported as
    # double, as a concatenation of frames in the reference reports them
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


@query
def forecast_splice(spark, d):
    out = O.forecast_splice(_last_mix(spark, d), B.forecast(spark, d), B.AS_OF, MIN_ACTUAL)
    return _nullable_counts_as_double(out, ["ID", "total_units", "occ_units"])


@query
def forecast_latest_vintage(spark, d):
    return O.latest_vintage(B.forecast(spark, d))


@query
def forecast_capacity(spark, d):
    out = O.forecast_capacity(O.latest_vintage(B.forecast(spark, d)), _actual(spark, d),
                              B.acquisitions(spark, d))
    return _nullable_counts_as_double(out, ["Group", "Total_Rooms"])


@query
def forecast_listed(spark, d):
    return O.listed_forecasts(B.forecast(spark, d), B.acquisitions(spark, d))


@query
def forecast_group_entities(spark, d):
    return O.forecast_group_entities(O.latest_vintage(B.forecast(spark, d)), B.acquisitions(spark, d))


@query
def forecast_future(spark, d):
    return O.listed_forecasts(B.forecast(spark, d), B.acquisitions(spark, d), B.AS_OF)


# ---------------------------------------------------------------- same-store
SAMESTORE_EXCLUDE = ["7000000003", "7000000005", "7000000007"]


def _panel(spark, d, lo=None, hi=None):
    rooms = B.rooms(spark, d, lo, hi)
    occ = rooms.select("MEntity", "Date", F.col("occ").alias("Amount"))
    tot = rooms.select("MEntity", "Date", F.col("total").alias("Amount"))
    return SS.occupancy_panel(occ, tot, B.samestore_centres(spark, d), B.entity_info(spark, d),
                              SAMESTORE_EXCLUDE)


@query
def occupancy_panel(spark, d):
    return _panel(spark, d)


def _recent_panel(spark, d):
    anchor = fiscal.py_prev_month_start(B.AS_OF)
    return _panel(spark, d, fiscal.py_add_months(anchor, -23), anchor)


@query
def samestore_metrics(spark, d):
    out = SS.samestore_metrics(_recent_panel(spark, d), fiscal.py_prev_month_start(B.AS_OF))
    # rounded for the comparison with another engine, not in the operator
    return out.withColumns({c: F.round(c, 6) for c in ("weighted_occ", "median_occ", "share_at_threshold")})


@query
def samestore_histogram(spark, d):
    return SS.samestore_histogram(_recent_panel(spark, d), fiscal.py_prev_month_start(B.AS_OF))


# ---------------------------------------------------------------- lender
LENDER_WATERMARK = _dt.date(2000, 3, 1)       # months after it are loaded
LENDER_STORED_UNTIL = _dt.date(2000, 6, 1)    # state of the stored table before the reload
RANGE_REPLACE_OLD_AS_OF = _dt.date(1999, 10, 15)


def _as_file(df, name):
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _trends(spark, d, watermark=None):
    return LD.load_trends(B.lender_trends_wide(spark, d, watermark), watermark)


@query
def lender_trend_load(spark, d):
    return _trends(spark, d, LENDER_WATERMARK)


@query
def lender_ubox_load(spark, d):
    return LD.load_ubox(B.lender_ubox_wide(spark, d, LENDER_WATERMARK), LENDER_WATERMARK)


@query
def lender_adjustment_load(spark, d):
    sheet = B.lender_adjustments_sheet(spark, d, fiscal.py_add_months(LENDER_WATERMARK, 1))
    return LD.load_adjustments(sheet, LENDER_WATERMARK)


@query
def lender_reload(spark, d):
    # the extract is a file: written once, read column by column
    sheet = _as_file(B.lender_trends_wide(spark, d), "trends")
    every = LD.load_trends(sheet)
    stored = every.where(F.col("Date") <= F.lit(LENDER_STORED_UNTIL))
    # rows without a date, which a reload must keep
    undated = every.where(F.col("Date") == F.lit(LENDER_STORED_UNTIL)).withColumn("Date", F.lit(None).cast("date"))
    stored = stored.unionByName(undated)
    return LD.apply_reload(stored, LD.load_trends(sheet, LENDER_WATERMARK), LENDER_WATERMARK)


@query
def statement_range_replace(spark, d):
    old = _portfolio(spark, d, RANGE_REPLACE_OLD_AS_OF)
    # stored rows without a fiscal year, which belong to no range
    old = old.withColumn("fiscal_year", F.when(~((F.col("line_item") == "SALES") & (F.col("month") == 4)),
                                               F.col("fiscal_year")))
    new = _portfolio(spark, d)
    fy_last, fy_cur = fiscal.fiscal_years_of(B.AS_OF)
    return _nullable_counts_as_double(T.replace_range(old, new, "fiscal_year", fy_last, fy_cur), ["fiscal_year"])


@query
def statement_partition_replace(spark, d):
    """The same replacement in a stored statement, where only the partitions of the
    two fiscal years are written."""
    root = shared_folder(spark, "statement")
    old = _portfolio(spark, d, RANGE_REPLACE_OLD_AS_OF)
    old = old.withColumn("fiscal_year", F.when(~((F.col("line_item") == "SALES") & (F.col("month") == 4)),
                                               F.col("fiscal_year")))
    T.replace(old, root, ["fiscal_year"])
    path = T.replace_years(_portfolio(spark, d), root, "fiscal_year", *fiscal.fiscal_years_of(B.AS_OF))
    return _nullable_counts_as_double(spark.read.schema(old.schema).parquet(path), ["fiscal_year"])


@query
def statement_incremental(spark, d):
    """A stored statement brought up to date: the state lacks the last month and has
    another ledger for the month before; only these two months are read again."""
    root, chart = shared_folder(spark, "state"), _chart(spark, d)
    last = fiscal.py_prev_month_start(B.AS_OF)
    before = fiscal.py_add_months(last, -1)
    old = B.ledger_long(spark, d, None, before)
    stale = old.withColumn("amount", F.when(F.col("month") == F.lit(before), F.lit(1).cast("decimal(18,2)"))
                           .otherwise(F.col("amount")))
    path = T.replace(S.line_state(stale, chart), root, ["month"])
    T.replace_partitions(S.line_state(B.ledger_long(spark, d, before, last), chart), root, "month", [before, last])
    return S.statement_from_state(spark.read.parquet(path))


@query
def statement_checks(spark, d):
    """The statement is written once; its checks are counted on the way."""
    centres = A.included_centres(B.acquisitions(spark, d))
    statement, seen = S.checked_statement(_portfolio_ledger(spark, d, B.AS_OF), _chart(spark, d), centres, B.AS_OF,
                                          B.BASE_FY, B.BASE_Q)
    T.replace(statement, shared_folder(spark, "statement"))
    rows = [(f"{name} {check}", n) for name, counts in seen.items() for check, n in counts.get.items()]
    return spark.createDataFrame(rows, "check string, n long")


def _extract_checked(spark, d):
    """The adjustments sheet from its CSV extract: accepted rows and rejects, written
    in one pass."""
    path = shared_folder(spark, "extract")
    B.adjustments_extract(spark, d, path)
    sheet = T.read_sheet(spark, path, B.EXTRACT_HEADER_ROW, rejects=True, file_col="file")
    amounts = ["Final Adjustment", "Storage Adjustment", "U-Move Adjustment"]
    checked = QU.cast_or_reject(sheet, {"Final Month": "date", **{c: LD.AMOUNT for c in amounts}}, amounts, file_col="file")
    root = shared_folder(spark, "checked")
    QU.write_checked(checked, root)
    return root


@query
def sheet_adjustments(spark, d):
    return LD.load_adjustments(QU.read_accepted(spark, _extract_checked(spark, d)))


@query
def sheet_rejects(spark, d):
    bad = QU.read_rejects(spark, _extract_checked(spark, d))
    return bad.select(F.regexp_extract("file", "/(year=[0-9]+)/", 1).alias("file"), "reason", "record")


@query
def append_batches(spark, d):
    """Two batches of adjustments, each appended twice, as a rerun does."""
    rows = LD.load_adjustments(B.lender_adjustments_sheet(spark, d))
    root = shared_folder(spark, "adjustments")
    until = F.col("Date") <= F.lit(LENDER_WATERMARK)
    for batch, part in (("until", rows.where(until)), ("until", rows.where(until)),
                        ("after", rows.where(~until)), ("after", rows.where(~until))):
        path = T.append_batch(part, root, batch)
    stored = spark.read.parquet(path)
    return stored.groupBy("batch_id", "Date").agg(F.count(F.lit(1)).alias("n"), sum_money("Total_Adjustment").alias("total"))


def _lender_accounts(spark, d):
    part = B.table(spark, d, "part")
    return part.where(F.col("p_size") <= 25).select(
        (F.lit(B.ACCOUNT_BASE) + F.col("p_partkey")).cast("string").alias("account"))


@query
def lender_trend_rollup(spark, d):
    return LD.trend_rollup(LD.load_trends(B.lender_trends_wide(spark, d), None, _lender_accounts(spark, d),
                                          B.samestore_centres(spark, d)))


@query
def lender_adjustment_rollup(spark, d):
    adj = LD.load_adjustments(B.lender_adjustments_sheet(spark, d))
    return LD.adjustment_rollup(adj, B.samestore_centres(spark, d))


@query
def lender_ubox_rollup(spark, d):
    ub = LD.load_ubox(B.lender_ubox_wide(spark, d))
    return LD.ubox_rollup(ub, B.samestore_centres(spark, d))


@query
def lender_basis_ledger(spark, d):
    return LD.basis_from_sheet(B.lender_trends_wide(spark, d), B.account_conversion(spark, d))


# ---------------------------------------------------------------- move-in
MOVEIN_CY = (_dt.date(1998, 3, 8), _dt.date(1998, 3, 17))
MOVEIN_LY = (_dt.date(1997, 3, 8), _dt.date(1997, 3, 19))


def _windows(spark, d):
    return MV.compare_windows(B.movein(spark, d), MOVEIN_CY, MOVEIN_LY)


@query
def movein_windows(spark, d):
    return _windows(spark, d)


@query
def movein_by_day(spark, d):
    return MV.counts_by_day(_windows(spark, d))


@query
def movein_same_day(spark, d):
    return MV.same_day_share(B.movein(spark, d))


# ---------------------------------------------------------------- checks
@query
def data_presence(spark, d):
    return Q.data_presence(A.included_centres(B.acquisitions(spark, d)), _cash_trend(spark, d))


def _cash_trend(spark, d):
    noi = S.statement_wide(B.ledger_long(spark, d), _chart(spark, d)).select(
        "profit_center", "month", F.col("`NET OPERATING INCOME`").alias("amount"))
    return B.cash_trend(spark, d, noi)


@query
def centres_without_data(spark, d):
    """Included centres without a month of non-zero NOI in the cash trend."""
    hierarchy = B.cost_centre_hierarchy(spark, d).select(
        F.col("Profit_Center").alias("profit_center"), F.col("`Hierarchy Area`").alias("owner_area"))
    trend = Q.cash_trend_with_noi(_cash_trend(spark, d))
    return Q.centres_without_data(A.included_centres(B.acquisitions(spark, d)), trend,
                                  fact_key="PROFIT CENTER", info=hierarchy)


@query
def check_unreadable_amounts(spark, d):
    sheet = B.lender_trends_wide(spark, d)
    return LD.unreadable_amounts(sheet, ["SAP", "Account_Number", "Description", "Line Item"], "Account_Number")


@query
def check_unreadable_flags(spark, d):
    return Q.unreadable_flags(B.acquisitions(spark, d), "MEntity", "Include")


@query
def check_account_conflicts(spark, d):
    """The ledger's chart beside the lender's, which moves some accounts a line on."""
    raw = B.chart_raw(spark, d)
    return Q.account_conflicts(raw.unionByName(B.lender_chart(spark, d)))


@query
def check_duplicates(spark, d):
    return Q.duplicate_keys(B.movein(spark, d), "con_pk", "duplicate contract").unionByName(
        Q.duplicate_keys(A.included_centres(B.acquisitions(spark, d)), "profit_center", "duplicate profit centre"))


@query
def check_expected_value(spark, d):
    latest = A.latest_entity_record(B.entity_master(spark, d))
    return Q.unexpected_values(latest, "MEntity", {"DATE_EXPIRATION": _dt.date(9999, 12, 31), "STATUS": "O"},
                               "latest entity record")


@query
def check_unmapped_accounts(spark, d):
    accounts = LD.trend_accounts(B.lender_trends_wide(spark, d, keys_only=True))
    return Q.unmapped_accounts(accounts, B.account_conversion(spark, d))


# ---------------------------------------------------------------- acquisition list
LIST_AS_OF = _dt.date(1999, 6, 30)


def _new(spark, d):
    current = B.acquisitions(spark, d).where(F.col("Close_of_Escrow") <= F.lit(LIST_AS_OF))
    return A.new_acquisitions(B.closed_deals(spark, d), current, base_fy=B.BASE_FY, base_q=B.BASE_Q)


@query
def new_acquisitions(spark, d):
    return _new(spark, d)


@query
def acquisition_enrichment(spark, d):
    # check_expected_value lists the records that strict mode would stop on
    return A.enrich_acquisitions(_new(spark, d), B.entity_master(spark, d), B.index_match(spark, d),
                                 B.entity_info(spark, d), B.real_additions(spark, d), strict=False)


@query
def list_maintenance(spark, d):
    lst = B.acquisitions(spark, d).select(
        "MEntity", "Group", "Close_of_Escrow", "Profit_Center", "Include",
        F.col("Name").alias("ENTITY_NAME"), F.lit(None).cast("double").alias("LOC_LATITUDE"),
        F.lit(None).cast("double").alias("LOC_LONGITUDE"), F.lit(None).cast("string").alias("Simple_Owner"),
        F.lit(None).cast("string").alias("CBSA"), "Type")
    return A.maintain_list(lst, B.entity_master(spark, d), B.index_match(spark, d),
                           B.entity_info(spark, d), B.real_additions(spark, d))


@query
def cost_centre_lookup(spark, d):
    acq = B.acquisitions(spark, d)
    return A.centre_lookup(A.included_centres(acq), B.cost_centre_hierarchy(spark, d), acq)


@query
def quarter_cohorts(spark, d):
    return A.quarter_cohorts(B.acquisitions(spark, d), B.BASE_FY, B.BASE_Q)


@query
def cohort_gaps(spark, d):
    acq = B.acquisitions(spark, d)
    cohort = A.quarter_cohorts(acq, B.BASE_FY, B.BASE_Q)
    entity_of = A.included_centres(acq).select("profit_center", "MEntity")
    flags = A.cohort_presence(cohort, entity_of, _actual(spark, d), O.latest_vintage(B.forecast(spark, d)))
    return flags.where(~(F.col("has_entity") & F.col("has_occupancy") & F.col("has_forecast")))


@query
def check_missing_line_items(spark, d):
    return Q.missing_line_items(_chart(spark, d), [*L.BASE_LINES, "MANAGEMENT FEE"])


@query
def check_centre_lines(spark, d):
    return Q.centre_missing_lines(B.ledger_long(spark, d), _chart(spark, d))


@query
def samestore_histogram_literal(spark, d):
    return SS.samestore_histogram(_recent_panel(spark, d), fiscal.py_prev_month_start(B.AS_OF),
                                  capped=SS.CAPPED_PERIODS, literal_edges=True)


@query
def lender_basis_statement(spark, d):
    basis = LD.basis_from_sheet(B.lender_trends_wide(spark, d), B.account_conversion(spark, d))
    return S.income_statement(basis.where(F.col("account").isNotNull()), _chart(spark, d), few_accounts=True)
