"""A key holding a third of all rows: results stay whole and exact, and the
plans keep the hot key out of any single buffer."""

import datetime as dt

from pyspark.sql import functions as F

from acqlens.functions.stats import pick_per_key
from acqlens.operators import ledger as L
from acqlens.operators import statement as S

SKEW_CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096"}


def _hot_ledger(spark, n=120000):
    # centre P0 holds a third of all rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("P0"))
         .otherwise(F.concat(F.lit("P"), (F.col("id") % 2000 + 1).cast("string"))).alias("profit_center"),
        F.concat(F.lit("A"), (F.col("id") % 21 + 1).cast("string")).alias("account"),
        F.add_months(F.lit(dt.date(2020, 4, 1)), (F.col("id") % 12).cast("int")).alias("month"),
        (F.col("id") % 97 - 40).cast("decimal(18,2)").alias("amount"))


def test_hot_centre_semi_join_is_split(spark):
    led = _hot_ledger(spark)
    centres = spark.range(0, 2001).select(F.concat(F.lit("P"), F.col("id").cast("string")).alias("profit_center"))
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        out = L.restrict_ledger(led, centres=centres)
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert len(rows) == 120000
    assert "SortMergeJoin(skew=true)" in plan


def test_hot_centre_statement_matches_plain_sums(spark):
    led = _hot_ledger(spark)
    chart = L.chart_of_accounts(spark.createDataFrame(
        [(f"A{i}", n) for i, n in enumerate(L.BASE_LINES, start=1)], "account string, line_item string"))
    noi = (S.statement_wide(led, chart).where(F.col("profit_center") == "P0")
            .select("month", F.col("`NET OPERATING INCOME`").alias("noi")))
    # the same NOI from plain sums over the hot centre's rows
    w = S.noi_weights()
    weights = spark.createDataFrame([(f"A{i}", L.BASE_LINES[i - 1]) for i in range(1, 22)], "account string, line string")
    ref = (led.where(F.col("profit_center") == "P0").join(weights, "account")
              .join(chart.select("account", "sign"), "account")
              .withColumn("wt", F.element_at(F.create_map(*[x for k, v in w.items() for x in (F.lit(k), F.lit(v))]),
                                             F.col("line")))
              .groupBy("month").agg(F.sum(F.col("amount") * F.col("sign") * F.coalesce("wt", F.lit(0))).alias("noi")))
    a = {r.month: r.noi for r in noi.collect()}
    b = {r.month: r.noi for r in ref.collect()}
    assert a == b and len(a) == 4          # the hot rows fall in months 0, 3, 6, 9


def test_hot_key_pick_per_key(spark):
    df = spark.range(90000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).alias("k"),
                                   F.col("id").alias("v"))
    got = {r.k: r.v for r in pick_per_key(df, ["k"], [F.col("v")], ["v"]).collect()}
    want = {r.k: r.m for r in df.groupBy("k").agg(F.max("v").alias("m")).collect()}
    assert got == want


def test_salted_join_equals_plain_join(spark):
    from acqlens.functions.stats import salted_join
    big = spark.range(60000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 700).alias("k"),
                                    F.col("id").alias("v"))
    small = spark.range(0, 700, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    for how in ("inner", "left", "left_semi"):
        a = sorted(map(tuple, salted_join(big, small, ["k"], how).collect()))
        b = sorted(map(tuple, big.join(small, ["k"], how).collect()))
        assert a == b, how


def _split_joins(spark, df):
    """Rows of ``df`` and how many of its joins split a hot partition, with
    broadcasts off."""
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        out = df()
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return rows, plan.split("Initial Plan")[0].count("SortMergeJoin(skew=true)")


def _chart(spark, n=2000):
    return L.chart_of_accounts(spark.range(n + 1).select(
        F.concat(F.lit("A"), F.col("id").cast("string")).alias("account"),
        F.element_at(F.array(*[F.lit(x) for x in L.BASE_LINES]), (F.col("id") % 21 + 1).cast("int")).alias("line_item")))


def test_hot_account_is_split_in_the_chart_join(spark):
    led = _hot_ledger(spark).select(F.col("account").alias("profit_center"), "month", "amount",
                                    F.concat(F.lit("A"), F.substring("profit_center", 2, 9)).alias("account"))
    rows, split = _split_joins(spark, lambda: L.line_item_amounts(led, _chart(spark)))
    assert split == 1 and sum(r.amount for r in rows) != 0
    want = led.join(_chart(spark), "account").agg(F.sum(F.col("amount") * F.col("sign"))).first()[0]
    assert sum(r.amount for r in rows) == want


def test_hot_centre_is_split_in_the_portfolio_join(spark):
    led = _hot_ledger(spark)
    centres = spark.range(2001).select(F.concat(F.lit("P"), F.col("id").cast("string")).alias("profit_center"),
                                       F.col("id").cast("string").alias("MEntity"), F.lit(1).alias("Group"))
    rows, split = _split_joins(spark, lambda: S.portfolio_statement(led, _chart(spark, 25), centres, dt.date(2021, 3, 15)))
    assert split >= 1 and len(rows) > 0


def test_hot_key_is_split_in_a_keyed_update(spark):
    from acqlens.operators.acquisitions import keyed_update
    big = spark.range(60000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 700).alias("k"),
                                    F.col("id").alias("v"), F.repeat(F.lit("x"), 20).alias("t"))
    small = spark.range(0, 700, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    rows, split = _split_joins(spark, lambda: keyed_update(big, small, "k", {"v": "w"}))
    assert split == 1 and len(rows) == 60000
    assert all(r.v == r.k * 10 for r in rows if r.k % 2 == 0)
