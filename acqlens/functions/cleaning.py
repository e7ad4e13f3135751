"""Key and cell hygiene."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# numeric key, as a number or as text ("7000000001.0", "7.000000001E9")
# -> "7000000001".  Null stays null (pandas would produce the text "nan").
def clean_key(c) -> Column:
    text = F.trim(_c(c).cast("string"))
    whole = F.when(text.rlike(r"^[+-]?\d+(\.\d+)?[eE][+-]?\d+$"), text.try_cast("decimal(38,0)").cast("string"))
    return F.when(text != "", F.coalesce(whole, F.split_part(text, F.lit("."), F.lit(1))))


# sentinel cell ("x") -> 0; other text parsed as an amount, unparsable -> null.
def sentinel_amount(c, sentinel: str = "x", dtype: str = "decimal(18,2)") -> Column:
    text = F.trim(_c(c).cast("string"))
    return (F.when(F.lower(text) == sentinel.lower(), F.lit(0).cast(dtype))
            .otherwise(text.try_cast(dtype)))


def _sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def amount_or_zero(c, sentinel: str = "x", dtype: str = "decimal(18,2)") -> Column:
    """The sentinel and blank cells are 0; text that is no amount stays null
    (``unreadable_amount`` finds it)."""
    blank = F.trim(F.coalesce(_c(c).cast("string"), F.lit(""))) == ""
    return F.when(blank, F.lit(0).cast(dtype)).otherwise(sentinel_amount(c, sentinel, dtype))


def unreadable_amount(c, sentinel: str = "x", dtype: str = "decimal(18,2)") -> Column:
    """True for a cell that holds text which is neither an amount nor the sentinel."""
    return amount_or_zero(c, sentinel, dtype).isNull()


# Drop columns whose name contains a pattern (plan-time list work only).
def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    return df.select([F.col(_sql_name(c)) for c in df.columns if pattern not in c])


# Wide date-named columns strictly later than a watermark.
def date_columns_after(columns: list[str], watermark: _dt.date | None) -> list[str]:
    return [c for c in columns if (d := column_date(c)) is not None and (watermark is None or d > watermark)]


def column_date(name: str) -> _dt.date | None:
    """The date that a column name is, as a whole: an ISO date, or date and time."""
    try:
        return _dt.datetime.fromisoformat(name.strip()).date()
    except ValueError:
        return None


def undated_columns(columns: list[str], ids: list[str]) -> list[str]:
    """Columns that are neither ids nor months; the loaders stop on them."""
    return [c for c in columns if c not in ids and column_date(c) is None]


# P10: key text longer than n characters.
def long_key(c, n: int = 3) -> Column:
    return F.length(_c(c)) > n
