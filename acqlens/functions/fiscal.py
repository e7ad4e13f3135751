"""Fiscal calendar expressions (April–March year named by its end).

All functions return Column expressions, so they stay inside whole-stage
code generation; none of them needs a lookup table.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _d(value) -> Column:
    """A date literal or a date column."""
    if isinstance(value, (_dt.date, str)):
        return F.lit(value).cast("date") if isinstance(value, str) else F.lit(value)
    return _c(value)


# fiscal year.  April 2020 .. March 2021 is fiscal year 2021.
def fiscal_year(d: ColumnOrName) -> Column:
    return F.year(F.add_months(_c(d), 9))


# fiscal month 1..12 (April = 1).
def fiscal_month(d: ColumnOrName) -> Column:
    return F.month(F.add_months(_c(d), -3))


# fiscal quarter 1..4 (April–June = 1), valid for every date.
def fiscal_quarter(d: ColumnOrName) -> Column:
    return F.quarter(F.add_months(_c(d), -3))


# calendar year of a fiscal-year / calendar-month pair.
def calendar_year(fy: ColumnOrName, cal_month: ColumnOrName) -> Column:
    return F.when(_c(cal_month) >= 4, _c(fy) - 1).otherwise(_c(fy))


# month anchors of an as-of date.
def month_start(d) -> Column:
    return F.trunc(_d(d), "MM")


def prev_month_start(d) -> Column:
    return F.trunc(F.add_months(_d(d), -1), "MM")


def prev_month_end(d) -> Column:
    return F.last_day(F.add_months(_d(d), -1))


def fiscal_years_of(as_of: _dt.date) -> tuple[int, int]:
    """(last, current) fiscal year of a Python date, for plan-time filters."""
    current = as_of.year + 1 if as_of.month >= 4 else as_of.year
    return current - 1, current


def py_prev_month_start(as_of: _dt.date) -> _dt.date:
    y, m = (as_of.year, as_of.month - 1) if as_of.month > 1 else (as_of.year - 1, 12)
    return _dt.date(y, m, 1)


def py_add_months(d: _dt.date, n: int) -> _dt.date:
    idx = d.year * 12 + d.month - 1 + n
    return _dt.date(idx // 12, idx % 12 + 1, 1)


# whole-month difference b - a.
def month_diff(a: ColumnOrName, b: ColumnOrName) -> Column:
    a, b = _c(a), _c(b)
    return (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)


# month abbreviation ("Jan").
def month_abbr(d: ColumnOrName) -> Column:
    return F.date_format(_c(d), "MMM")


# F8: first of month from year and month numbers.
def first_of_month(y: ColumnOrName, m: ColumnOrName) -> Column:
    return F.make_date(_c(y).cast("int"), _c(m).cast("int"), F.lit(1))


# text to date; dirty text gives null.
def parse_date(c: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(_c(c), fmt)


# month sequence between two first-of-month dates (inclusive).
def month_sequence(start: ColumnOrName, end: ColumnOrName) -> Column:
    return F.sequence(_c(start), _c(end), F.expr("INTERVAL 1 MONTH"))


# period bounds relative to an anchor month.
def shift_months(d: ColumnOrName, n: int) -> Column:
    return F.add_months(_c(d), n)


# Acquisition group number; group 1 is (base_fy, base_q) and every
# later fiscal quarter adds one.
def group_number(fy: ColumnOrName, fq: ColumnOrName, base_fy: int = 2015, base_q: int = 4) -> Column:
    return (_c(fy) - base_fy) * 4 + _c(fq) - base_q + 1


def group_of_date(d: ColumnOrName, base_fy: int = 2015, base_q: int = 4) -> Column:
    return group_number(fiscal_year(d), fiscal_quarter(d), base_fy, base_q)


# Stored group label F20_Q3 and its display form FY20 Q3.
def group_label(fy: ColumnOrName, fq: ColumnOrName) -> Column:
    yy = F.lpad((_c(fy) % 100).cast("string"), 2, "0")
    return F.concat(F.lit("F"), yy, F.lit("_Q"), _c(fq).cast("string"))


def group_label_of_number(grp: ColumnOrName, base_fy: int = 2015, base_q: int = 4) -> Column:
    idx = _c(grp) - 1 + base_q - 1          # quarters after Q1 of base_fy
    fy = F.lit(base_fy) + F.floor(idx / 4).cast("int")
    fq = (idx % 4) + 1
    return F.when(_c(grp) >= 1, group_label(fy, fq))


def display_label(label: ColumnOrName) -> Column:
    return F.replace(F.replace(_c(label), F.lit("_"), F.lit(" ")), F.lit("F"), F.lit("FY"))


def with_fiscal_columns(df: DataFrame, date_col: str, prefix: str = "") -> DataFrame:
    """FY, FM, Quarter and month abbreviation next to a date column."""
    d = F.col(date_col)
    return df.withColumns({
        f"{prefix}fiscal_year": fiscal_year(d),
        f"{prefix}fiscal_month": fiscal_month(d),
        f"{prefix}fiscal_quarter": fiscal_quarter(d),
        f"{prefix}month_abbr": month_abbr(d),
    })


# Fiscal calendar dimension, one row per month between two dates.
def fiscal_calendar(spark: SparkSession, start, end, base_fy: int = 2015, base_q: int = 4) -> DataFrame:
    return fiscal_calendar_from_bounds(
        spark.range(1).select(_d(start).alias("lo"), _d(end).alias("hi")), base_fy, base_q)


def fiscal_calendar_from_bounds(bounds: DataFrame, base_fy: int = 2015, base_q: int = 4) -> DataFrame:
    """``bounds`` holds one row (lo, hi); the spine is generated on executors."""
    months = bounds.select(
        F.explode(month_sequence(F.trunc("lo", "MM"), F.trunc("hi", "MM"))).alias("month"))
    m = F.col("month")
    fy, fq = fiscal_year(m), fiscal_quarter(m)
    return months.select(
        m.alias("month"),
        F.year(m).alias("year"),
        F.month(m).alias("cal_month"),
        month_abbr(m).alias("month_abbr"),
        fy.alias("fiscal_year"),
        fiscal_month(m).alias("fiscal_month"),
        fq.alias("fiscal_quarter"),
        group_number(fy, fq, base_fy, base_q).alias("grp_num"),
        group_label(fy, fq).alias("grp_name"),
        display_label(group_label(fy, fq)).alias("grp_display"),
        F.last_day(m).alias("month_end"),
    )
