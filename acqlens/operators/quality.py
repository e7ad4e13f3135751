"""Data checks: X10 data presence, X24 duplicate keys, unexpected values,
unmapped accounts.  Every check returns a DataFrame of findings
``(check, key, detail)``; ``raise_on_findings`` turns a check into a stop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

FINDING_COLS = ["check", "key", "detail"]


def _finding(df: DataFrame, check: str, key: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(check).alias("check"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))


def duplicate_keys(df: DataFrame, key: str, check: str | None = None) -> DataFrame:
    """Keys held by more than one row (the count is the detail)."""
    dup = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return _finding(dup, check or f"duplicate {key}", F.col(key), F.concat(F.lit("rows="), F.col("n").cast("string")))


def unexpected_values(df: DataFrame, key: str, expected: dict[str, object], check: str = "unexpected value") -> DataFrame:
    """Rows whose column differs from the expected value; null differs too."""
    out = None
    for col, value in expected.items():
        bad = df.where(~F.coalesce(F.col(col) == F.lit(value), F.lit(False)))
        f = _finding(bad, check, F.col(key), F.concat(F.lit(f"{col}="), F.coalesce(F.col(col).cast("string"), F.lit("null"))))
        out = f if out is None else out.unionByName(f)
    return out


def unmapped_accounts(lender: DataFrame, conversion: DataFrame, old_col: str = "old_account") -> DataFrame:
    """Lender accounts without a ledger account in the conversion table."""
    accts = lender.select("Account_Number").distinct()
    conv = conversion.select(F.col(old_col).cast("string").alias("Account_Number"))
    missing = accts.join(conv, "Account_Number", "left_anti")
    return _finding(missing, "unmapped account", F.col("Account_Number"), F.lit("no conversion"))


def cash_trend_with_noi(cash_trend: DataFrame, currency: str = "Group", split: str = "ALL") -> DataFrame:
    """The cash trend's rows, over all its months, that count as data: the given
    currency and split, NOI not 0."""
    return cash_trend.where((F.col("CURRENCY") == currency) & (F.col("SPLIT") == split)
                            & (F.col("NET OPERATING INCOME") != 0))


def data_presence(centres: DataFrame, cash_trend: DataFrame, currency: str = "Group", split: str = "ALL") -> DataFrame:
    """Per listed centre, whether the cash trend holds a non-zero NOI
    row (currency and split filters); the key-or-null and key-or-error forms
    of the reference, in one pass (semi-join keys + left join)."""
    has = (cash_trend_with_noi(cash_trend, currency, split)
           .select(F.col("PROFIT CENTER").alias("profit_center")).distinct().withColumn("has_data", F.lit(True)))
    m = centres.select("profit_center").distinct().join(has, "profit_center", "left")
    flag = F.coalesce(F.col("has_data"), F.lit(False))
    return m.select("profit_center", flag.alias("has_data"),
                    F.when(flag, F.col("profit_center")).alias("na_key"),
                    F.when(flag, F.col("profit_center"))
                     .otherwise(F.concat(F.lit("Error: "), F.col("profit_center"))).alias("flag"))


def raise_on_findings(findings: DataFrame, message: str) -> None:
    """Strict mode: stop the job when a check found anything.  The message shows
    the first 20 findings and how many there are; the check runs once, as the
    findings are counted on their way to the sort."""
    seen = Observation("findings")
    shown = (findings.observe(seen, F.count(F.lit(1)).alias("n"))
             .orderBy(*[F.col(f"`{c}`") for c in findings.columns]).limit(20).collect())
    if shown:
        raise ValueError(f"{message}: {seen.get['n']} findings, the first {len(shown)}: {shown}")


def unique_or_stop(df: DataFrame, key: str, message: str) -> DataFrame:
    """``df`` with one row per key; the job stops where a key has several.  One
    aggregate in the plan itself: no extra job, and nothing can read past it."""
    others = [c for c in df.columns if c != key]
    one = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*others)).alias("_row"))
    several = F.raise_error(F.concat(F.lit(f"{message}: "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    return (one.select(F.when(F.col("_n") == 1, F.col(key)).otherwise(several.cast(df.schema[key].dataType)).alias(key),
                       "_row").select(key, "_row.*"))


def unreadable_flags(df: DataFrame, key: str, flag: str) -> DataFrame:
    """Rows whose flag holds something that is neither true nor false."""
    bad = df.where(F.col(flag).isNotNull() & F.col(flag).try_cast("boolean").isNull())
    return _finding(bad, "unreadable flag", F.col(key), F.concat(F.lit(f"{flag}="), F.col(flag).cast("string")))


def account_conflicts(chart_raw: DataFrame, account_col: str = "account", line_col: str = "line_item") -> DataFrame:
    """Accounts that the raw chart puts on two lines."""
    a, line = F.trim(F.col(account_col).cast("string")), F.rtrim(F.col(line_col))
    two = (chart_raw.groupBy(a.alias("account")).agg(F.min(line).alias("lo"), F.max(line).alias("hi"))
           .where(F.col("lo") != F.col("hi")))
    return _finding(two, "account on two lines", F.col("account"), F.concat_ws(" / ", "lo", "hi"))


def accounts_without_line(chart_raw: DataFrame, account_col: str = "account",
                          line_col: str = "line_item") -> DataFrame:
    """Accounts of the raw chart whose line is missing, blank or no statement line."""
    from .ledger import NOT_REPORTED, line_no_of
    line = F.rtrim(F.col(line_col))
    bad = chart_raw.where(line.isNull() | (line_no_of(F.col(line_col)).isNull() & (line != NOT_REPORTED)))
    return _finding(bad, "account without a line", F.trim(F.col(account_col).cast("string")),
                    F.coalesce(line, F.lit("null"))).distinct()


def centres_without_data(centres: DataFrame, facts: DataFrame, fact_key: str = "profit_center",
                         info: DataFrame | None = None) -> DataFrame:
    """Listed centres with no row in ``facts`` (anti join), optionally
    with their hierarchy record (left join on the centre key)."""
    keys = facts.select(F.col(f"`{fact_key}`").alias("profit_center")).distinct()
    missing = centres.select("profit_center").distinct().join(keys, "profit_center", "left_anti")
    return missing if info is None else missing.join(info, "profit_center", "left")


def missing_line_items(chart: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Required statement lines that no chart account maps to."""
    from .ledger import BASE_LINES
    need = required or BASE_LINES
    req = chart.sparkSession.range(1).select(F.explode(F.array(*[F.lit(n) for n in need])).alias("line_item"))
    present = chart.select("line_item").distinct()
    missing = req.join(present, "line_item", "left_anti")
    return _finding(missing, "missing line item", F.col("line_item"), F.lit("no account"))


def centre_missing_lines(ledger: DataFrame, chart: DataFrame) -> DataFrame:
    """U3 by centre: per statement line the number of the centre's ledger months
    without a row for it (its statement shows them as 0).  The lines of a month are
    one bit each of a long, so the ledger passes one small hash aggregate; a month
    without a reportable account lacks every line."""
    from .ledger import BASE_LINES
    bit = F.expr("shiftleft(1L, line_no)")
    lined = ledger.join(chart.select("account", "line_no"), "account", "left")
    have = lined.groupBy("profit_center", "month").agg(F.coalesce(F.bit_or(bit), F.lit(0).cast("long")).alias("_have"))
    lines = F.posexplode(F.array(*[F.lit(n) for n in BASE_LINES])).alias("_at", "line_item")
    missing = have.select("profit_center", "_have", lines).where("_have & shiftleft(1L, _at + 1) = 0")
    months = missing.groupBy("profit_center", "line_item").agg(F.count(F.lit(1)).alias("n"))
    return _finding(months, "centre without line", F.col("profit_center"),
                    F.concat("line_item", F.lit(": months="), F.col("n").cast("string")))
