"""Every registered query against its DuckDB oracle on the smallest scale,
plus plan checks (no Python UDF anywhere, flagship shape)."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from acqlens.plans.oracle import SQL
from acqlens.plans.queries import REGISTRY
from tools.compare import compare

SF = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(SQL)
    assert set(REGISTRY) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


def test_queries_match_duckdb(spark):
    res = compare(spark, SF, sorted(REGISTRY), verbose=False)
    bad = {k: v for k, v in res.items() if v[0] != "OK"}
    assert not bad, bad


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "profit_center", "line_item", "value"]
    assert df.count() > 0


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_python_in_plans(spark, name):
    plan = _plan(REGISTRY[name](spark, SF))
    for marker in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                   "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert marker not in plan, (name, marker)


def test_flagship_plan_shape(spark):
    from acqlens.operators import ledger as L
    from acqlens.operators import statement as S
    from acqlens.sources import bindings as B
    st = S.income_statement(B.ledger_long(spark, SF), L.chart_of_accounts(B.chart_raw(spark, SF)))
    plan = _plan(st)
    nodes = re.findall(r"^\(\d+\) (\w+)", plan, flags=re.M)
    # one shuffle for the whole statement (the aggregate) and one for the chart,
    # which is then broadcast; both are hash aggregates that start before the shuffle
    assert nodes.count("Exchange") == 2, nodes
    assert nodes.count("BroadcastExchange") == 1 and "BroadcastHashJoin" in nodes
    assert nodes.count("HashAggregate") == 4 and "SortAggregate" not in nodes and "Sort" not in nodes
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in plan


def test_oracle_types_match(spark):
    """Column types of every query equal its oracle's (DuckDB names)."""
    from tools.compare import duck
    from tools.types import spark_type
    con = duck(SF)
    qs, sqls = REGISTRY, SQL
    diffs = {}
    for name in sorted(qs):
        sch = {f.name: spark_type(f.dataType) for f in qs[name](spark, SF).schema.fields}
        rel = con.sql(sqls[name])
        dt = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        if sch != dt:
            diffs[name] = (sch, dt)
    assert not diffs, diffs


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_windows_only_on_bounded_tables(spark, name):
    """Windows appear only over bounded tables: inside the exact median (over
    bucket counts) and in group occupancy (one row per month and group);
    every other per-key choice is an aggregate."""
    nodes = re.findall(r"^\(\d+\) (\w+)", _plan(REGISTRY[name](spark, SF)), flags=re.M)
    if "Window" in nodes:
        assert name in ("samestore_metrics", "group_occupancy"), name


def test_pick_per_key_aggregates_before_the_shuffle(spark):
    from acqlens.functions.stats import pick_per_key
    from pyspark.sql import functions as F
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = _plan(pick_per_key(df, ["k"], [F.col("v")], ["v"]))
    nodes = re.findall(r"^\(\d+\) (\w+)", plan, flags=re.M)
    first_exchange = nodes.index("Exchange")       # details are numbered from the scan upwards
    assert any(n.endswith("Aggregate") for n in nodes[:first_exchange])      # partial, below the shuffle
    assert "partial_max" in plan


def test_queries_match_duckdb_through_pandas(spark):
    """The same comparison with both results carried through pandas (Spark
    ``toPandas`` against DuckDB ``.df()``), as a generic checker might."""
    from tools.compare import compare_pandas
    assert compare_pandas(spark, SF, sorted(REGISTRY)) == []
