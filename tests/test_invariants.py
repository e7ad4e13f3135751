"""Invariants on the sf0.01 driver tables."""

import datetime as dt

from pyspark.sql import functions as F

from acqlens.functions import fiscal
from acqlens.operators import ledger as L
from acqlens.operators import occupancy as O
from acqlens.operators import samestore as SS
from acqlens.operators import statement as S
from acqlens.plans import queries as Qs
from acqlens.sources import bindings as B

SF = "/root/testdata/sf0.01"


def test_unpivot_keeps_the_total(spark):
    long_total = B.ledger_long(spark, SF).agg(F.sum("amount")).first()[0]
    wide_total = L.normalize_ledger(B.ledger_wide(spark, SF)).agg(F.sum("amount")).first()[0]
    assert long_total == wide_total


def test_statement_identities(spark):
    st = Qs.income_statement(spark, SF)
    wide = st.groupBy("profit_center", "date").pivot("line_item", S.STATEMENT_LINES).agg(F.first("value"))
    bad = wide.where(
        (F.col("`TOTAL REVENUE`") - F.col("`TOTAL OPERATING EXPENSE`") != F.col("`NET OPERATING INCOME`"))
        | (F.col("`NET OPERATING INCOME`") == 0)
        | (F.col("`INTERCOMPANY RENT`") != 0)
        | (F.col("`SALES`") - F.col("`COST OF SALES`") != F.col("`NET SALES`")))
    assert bad.count() == 0
    per_month = st.groupBy("profit_center", "date").count()
    assert per_month.where(F.col("count") != 24).count() == 0


def test_histogram_covers_the_cohort(spark):
    panel = Qs._panel(spark, SF)
    anchor = fiscal.py_prev_month_start(B.AS_OF)
    hist = SS.samestore_histogram(panel, anchor)
    total = sum(F.col(f"bucket_{i}") for i in range(1, 11))
    met = SS.samestore_metrics(panel, anchor)
    j = hist.select("period", total.alias("t")).join(met.select("period", "n_entities"), "period")
    assert j.where(F.col("t") != F.col("n_entities")).count() == 0
    assert j.count() == 6


def test_splice_has_no_forecast_at_or_before_last_actual(spark):
    spl = O.forecast_splice(B.unit_mix(spark, SF), B.forecast(spark, SF), B.AS_OF, dt.date(1995, 1, 1))
    last = spl.agg(F.max("Date")).first()[0]
    assert last == fiscal.py_prev_month_start(B.AS_OF)
    assert spl.where(F.col("FC_Date") <= F.lit(last)).count() == 0


def test_dense_series_keeps_amounts(spark):
    amounts = L.line_item_amounts(B.ledger_long(spark, SF), L.chart_of_accounts(B.chart_raw(spark, SF)))
    cut = fiscal.py_prev_month_start(B.AS_OF)
    dense = S.dense_line_items(amounts, cut)
    a = amounts.where(F.col("month") <= F.lit(cut)).agg(F.sum("amount")).first()[0]
    b = dense.agg(F.sum("amount")).first()[0]
    assert a == b
    dup = dense.groupBy("profit_center", "month", "line_item").count().where("count > 1").count()
    assert dup == 0
