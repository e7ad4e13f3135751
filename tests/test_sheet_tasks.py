"""The lender sheets' memory: rows are dealt over tasks whose number grows with the
ledger, and wide or many rows are not sorted by their few accounts."""

import datetime as dt

from pyspark.sql import functions as F

from acqlens.operators import lender as LD
from acqlens.operators import statement as S
from acqlens.sources import bindings as B
from tests.conftest import rows


def _tables(spark, root):
    """1,200 ledger rows of 40 centres on the two accounts 40051 and 40052."""
    (spark.range(1200).select(
        (F.col("id") % 40).alias("l_suppkey"), (F.col("id") % 2 + 1 + 50 * (F.col("id") % 3)).alias("l_partkey"),
        F.add_months(F.lit(dt.date(2000, 1, 1)), (F.col("id") % 4).cast("int")).alias("l_shipdate"),
        F.col("id").cast("decimal(15,2)").alias("l_extendedprice")).write.parquet(f"{root}/lineitem.parquet"))
    (spark.range(1, 201).select(F.col("id").alias("p_partkey"), F.lit(1).alias("p_size"))
     .write.parquet(f"{root}/part.parquet"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_an_account_of_the_sheet_is_spread_over_tasks(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(B, "SHEET_TASK_ROWS", 100, raising=False)
    _tables(spark, tmpdir_path)
    sheet = B.lender_trends_wide(spark, tmpdir_path)
    assert sheet.rdd.getNumPartitions() == 12
    at = sheet.withColumn("_task", F.spark_partition_id()).groupBy("Account_Number")
    spread = {r["Account_Number"]: r["n"] for r in at.agg(F.count_distinct("_task").alias("n")).collect()}
    assert set(spread) == {"40051", "40052"} and min(spread.values()) > 1


def test_the_sheet_does_not_depend_on_the_number_of_tasks(spark, tmpdir_path, monkeypatch):
    _tables(spark, tmpdir_path)
    one = [tuple(r) for r in B.lender_trends_wide(spark, tmpdir_path).collect()]
    keys = B.lender_trends_wide(spark, tmpdir_path, keys_only=True).count()
    monkeypatch.setattr(B, "SHEET_TASK_ROWS", 7, raising=False)
    many = [tuple(r) for r in B.lender_trends_wide(spark, tmpdir_path).collect()]
    assert len(one) == 40 and sorted(map(str, one)) == sorted(map(str, many))
    assert keys == B.lender_trends_wide(spark, tmpdir_path, keys_only=True).count() == 40


def test_wide_rows_are_not_sorted_for_a_key_list(spark, tmpdir_path):
    _tables(spark, tmpdir_path)
    sheet = B.lender_trends_wide(spark, tmpdir_path)
    accounts = spark.createDataFrame([("40051",), ("40051",)], "account string")
    conversion = spark.createDataFrame([("40051", "7"), ("40051", "8")], "old_account string, ledger_account string")
    listed = LD.load_trends(sheet, None, accounts)
    basis = LD.basis_from_sheet(sheet, conversion)
    for df in (listed, basis):
        assert "ShuffledHashJoin" in _plan(df) and "Sort [" not in _plan(df)
    every = LD.load_trends(sheet)
    assert rows(listed) == rows(every.where(F.col("Account_Number") == "40051"))
    unmapped = every.where(F.col("Account_Number") != "40051").count()
    assert basis.count() == 2 * listed.count() + unmapped


def test_statement_of_few_accounts(spark):
    ledger = spark.range(600).select(
        F.concat(F.lit("P"), F.col("id") % 7).alias("profit_center"), F.concat(F.lit("A"), F.col("id") % 3).alias("account"),
        F.add_months(F.lit(dt.date(2020, 4, 1)), (F.col("id") % 5).cast("int")).alias("month"),
        F.when(F.col("id") % 11 != 0, (F.col("id") % 97 - 40).cast("decimal(18,2)")).alias("amount"))
    chart = spark.createDataFrame([("A0", "SALES", 2, -1), ("A1", "PERSONNEL", 11, 1)],
                                  "account string, line_item string, line_no int, sign int")
    few = S.income_statement(ledger, chart, few_accounts=True)
    plan = _plan(few)
    assert "ShuffledHashJoin" in plan and "Sort [" not in plan
    # the one shuffle by centre lies below both aggregates
    assert plan.index("Exchange hashpartitioning(profit_center") > plan.rindex("HashAggregate")
    assert rows(few) == rows(S.income_statement(ledger, chart)) != []
