"""Sheet extracts over several splits, quarantined records, appends that are run
again, replaced years, checks counted beside a write."""

import contextlib
import csv
import datetime as dt
import glob
import gzip
import io
import os
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from acqlens.operators import ledger as L
from acqlens.operators import quality as Q
from acqlens.operators import statement as S
from acqlens.sources import quarantine as QU
from acqlens.sources import tables as T


@contextlib.contextmanager
def settings(spark, **conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def splits(spark, size):
    return settings(spark, **{"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"})


def some_cells(seed, n, width=4):
    rng = random.Random(seed)
    parts = ["a", "b c", 'say "hi"', "line\nbreak", "x,y", "\n\n", '"', "é", "", "two\r\nlines", "long " * 9]
    return [[f"k{i}", *["".join(rng.choice(parts) for _ in range(rng.randint(0, 3))) for _ in range(width - 1)]]
            for i in range(n)]


def csv_text(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("size", [130, 300, 1000, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_records_across_splits(spark, tmp_path, size, end):
    header, banner = ["key", "one", "two \"x\"", "2020-01-01"], [["Title", 'with "quotes"\nand a break'], [""]]
    want = []
    for f in range(2):
        rows = some_cells(f, 60)
        (tmp_path / f"{f}.csv").write_bytes(csv_text([*banner, header, *rows], end).encode())
        want += rows
    with splits(spark, size):
        df = T.read_sheet(spark, str(tmp_path), header_row=2)
        assert df.columns == header
        got = [["" if v is None else v for v in r] for r in df.collect()]
    assert sorted(got) == sorted(want)


def test_plain_lines_are_not_shuffled(spark, tmp_path):
    (tmp_path / "a.csv").write_text("t\nk,v\n" + "".join(f"{i},{i}\n" for i in range(500)))
    with splits(spark, 700):
        df = T.read_sheet(spark, str(tmp_path), header_row=1)
        assert sorted(int(r.k) for r in df.collect()) == list(range(500))


def test_rejected_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,2\n3,4,5\n6,7,, \n\n8\n"9\n\nx","y"\n')
    (tmp_path / "b.csv").write_text('k,w\n1,2\n')
    (tmp_path / "c.csv").write_text('k,v\n4,4\n10,"open\n11,2\n12,3\n')
    df = T.read_sheet(spark, str(tmp_path), rejects=True)
    good = sorted((r.k, r.v) for r in df.where("_reject IS NULL").collect())
    assert good == [("1", "2"), ("1", "2"), ("4", "4"), ("6", "7"), ("8", None), ("9\n\nx", "y")]
    bad = sorted((os.path.basename(r.file), r.reason, r.record) for r in df.where("_reject IS NOT NULL").select("_reject.*").collect())
    assert bad == [("a.csv", "surplus cells", "3,4,5"), ("b.csv", "another header", "k,w"),
                   ("c.csv", "quotes that do not close", '10,"open\n11,2\n12,3')]
    for f, words in (("a.csv", "surplus cells"), ("b.csv", None), ("c.csv", "quotes that do not close")):
        one = T.read_sheet(spark, str(tmp_path / f))
        if words:
            with pytest.raises(Exception, match=words):
                one.collect()


@pytest.mark.parametrize("size", [64, 1 << 20])
def test_a_record_that_never_ends_is_cut(spark, tmp_path, size):
    (tmp_path / "a.csv").write_text('k,v\n1,2\n3,"open\n' + "more\n" * 500)
    with splits(spark, size):
        df = T.read_sheet(spark, str(tmp_path), rejects=True, max_lines=10)
        rows = df.collect()
    assert [(r.k, r.v) for r in rows if r._reject is None] == [("1", "2")]
    [bad] = [r._reject for r in rows if r._reject]
    assert bad.reason == "quotes that do not close" and bad.record.startswith('3,"open\nmore') and len(bad.record) < 600


def test_zipped_sheet_and_missing_header(spark, tmp_path):
    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write('t\n"k\n1",v\n1,"a\nb"\n')
    df = T.read_sheet(spark, str(tmp_path), header_row=1)
    assert df.columns == ["k\n1", "v"] and [tuple(r) for r in df.collect()] == [("1", "a\nb")]
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "x.csv").write_text("only one\n")
    with pytest.raises(ValueError, match="no header on row 3"):
        T.read_sheet(spark, str(tmp_path / "e"), header_row=3)


def test_quarantine_in_one_pass(spark, tmp_path):
    df = spark.createDataFrame([("f1", "1", "2020-01-05", "3.5", "a"), ("f1", "2", "soon", "x", "b"),
                                ("f2", "3", None, "#REF!", "c"), ("f2", " ", "2020-02-01", " ", "d")],
                               "file string, k string, day string, amount string, other string")
    checked = QU.cast_or_reject(df, {"day": "date", "amount": "decimal(18,2)"}, ["amount"], ["k"], "file")
    root = str(tmp_path / "t")
    QU.write_checked(checked, root)
    good = QU.read_accepted(spark, root)
    assert good.columns == ["k", "day", "amount", "other"]
    assert [tuple(r) for r in good.collect()] == [("1", dt.date(2020, 1, 5), D("3.50"), "a")]
    bad = sorted(tuple(r) for r in QU.read_rejects(spark, root).collect())
    assert [(f, r) for f, r, _ in bad] == [("f1", "unreadable day"), ("f2", "no k"), ("f2", "unreadable amount")]
    assert bad[0][2] == '"2","soon","x","b"'
    # each side reads its own directory
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rejected" in plan


def test_typed_csv_quarantine(spark, tmp_path):
    (tmp_path / "d.csv").write_text('id,day,n\n1,2020-01-01,5\n2,never,6\n3,2020-01-03\n4,2020-01-04,7,8\n')
    df = QU.read_csv(spark, str(tmp_path / "d.csv"), T.StructType().add("id", "integer").add("day", "date").add("n", "integer"),
                     {"n": "count"})
    rows = df.collect()
    assert [(r.id, r.day, r["count"]) for r in rows if r._reject is None] == [(1, dt.date(2020, 1, 1), 5)]
    assert [r._reject.record for r in rows if r._reject] == ["2,never,6", "3,2020-01-03", "4,2020-01-04,7,8"]
    assert all(r._reject.file.endswith("d.csv") for r in rows if r._reject)


def test_append_twice(spark, tmp_path):
    root = str(tmp_path / "t")
    three = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "v int, w string")
    for _ in range(2):
        path = T.append_batch(three, root, "2020-01")
    T.append_batch(three.limit(1), root, "2020-02")
    assert spark.read.parquet(path).groupBy("batch_id").count().orderBy("batch_id").collect() == [("2020-01", 3), ("2020-02", 1)]
    # a batch that a lost job left half done is written anew
    os.remove(f"{path}/_batches/2020-02")
    T.append_batch(three, root, "2020-02")
    assert spark.read.parquet(path).count() == 6
    assert T.current_version(spark, root) == path


def test_only_the_replaced_years_are_written(spark, tmp_path):
    root = str(tmp_path / "t")
    old = spark.createDataFrame([(y, i) for y in (None, 2018, 2019, 2020, 2021) for i in range(3)], "fy int, v int")
    path = T.replace(old, root, ["fy"])
    files = lambda y: sorted(glob.glob(f"{path}/fy={y}/*.parquet"))
    before = {y: files(y) for y in ("__HIVE_DEFAULT_PARTITION__", 2018, 2019, 2020, 2021)}
    T.replace_years(spark.createDataFrame([(2019, 9)], "fy int, v int"), root, "fy", 2019, 2020)
    for y in ("__HIVE_DEFAULT_PARTITION__", 2018, 2021):
        assert files(y) == before[y] and before[y]
    assert files(2019) != before[2019] and files(2020) == []
    rows = sorted((r.fy or 0, r.v) for r in spark.read.parquet(path).collect())
    assert rows == sorted([(y, i) for y in (0, 2018, 2021) for i in range(3)] + [(2019, 9)])
    with pytest.raises(Exception, match="row outside 2019 to 2020: 2021"):
        T.replace_years(spark.createDataFrame([(2019, 1), (2021, 1)], "fy int, v int"), root, "fy", 2019, 2020)
    with pytest.raises(Exception, match="row outside 2019 to 2020: null"):
        T.replace_years(spark.createDataFrame([(None, 1)], "fy int, v int"), root, "fy", 2019, 2020)
    assert sorted((r.fy or 0, r.v) for r in spark.read.parquet(path).collect()) == rows


def test_checks_counted_beside_the_write(spark, tmp_path):
    chart = L.chart_of_accounts(spark.createDataFrame([("1", "SALES"), ("2", L.NOT_REPORTED)], "account string, line_item string"))
    led = spark.createDataFrame([("c", a, dt.date(2020, 5, 1), v) for a, v in
                                 [("1", D("-100.00")), ("1", None), ("2", D("5.00")), ("3", D("6.00"))]]
                                + [("other", "1", dt.date(2020, 5, 1), D("1.00")), ("c", "1", dt.date(2010, 1, 1), D("1.00"))],
                                "profit_center string, account string, month date, amount decimal(18,2)")
    centres = spark.createDataFrame([("c", "M", 1), ("c", "M", 1), ("d", "N", 2)], "profit_center string, MEntity string, Group int")
    out, seen = S.checked_statement(led, chart, centres, dt.date(2020, 6, 15))
    T.replace(out, str(tmp_path / "s"))
    assert seen["centres"].get == {"rows": 3, "duplicates": 1}
    assert seen["ledger"].get == {"rows": 4, "unreadable": 1, "unmapped": 2}
    plain = S.portfolio_statement(led, chart, centres.distinct(), dt.date(2020, 6, 15))
    assert sorted(map(str, T.read_current(spark, str(tmp_path / "s")).collect())) == sorted(map(str, plain.collect()))


def test_accounts_without_a_line_are_listed_not_raised(spark):
    raw = spark.createDataFrame([("1", "SALES"), ("2", None), ("3", "no such line"), ("1", None), ("4", L.NOT_REPORTED)],
                                "account string, line_item string")
    assert [r.account for r in L.chart_of_accounts(raw).collect()] == ["1"]
    assert sorted((r.key, r.detail) for r in Q.accounts_without_line(raw).collect()) == [
        ("1", "null"), ("2", "null"), ("3", "no such line")]
    with pytest.raises(Exception, match="account on two lines: 4"):
        L.chart_of_accounts(raw.union(spark.createDataFrame([("4", "SALES")], raw.schema))).collect()


def test_lines_that_a_centre_lacks(spark):
    chart = L.chart_of_accounts(spark.createDataFrame([(str(i), n) for i, n in enumerate(L.BASE_LINES)],
                                                      "account string, line_item string"))
    march, april = dt.date(2020, 3, 1), dt.date(2020, 4, 1)
    led = spark.createDataFrame([("c", march, str(i)) for i in range(20)] + [("c", april, str(i)) for i in range(1, 21)]
                                + [("d", march, "99"), ("d", april, "99")],
                                "profit_center string, month date, account string")
    got = sorted((r.key, r.detail) for r in Q.centre_missing_lines(led, chart).collect())
    assert got == sorted([("c", f"{L.BASE_LINES[0]}: months=1"), ("c", f"{L.BASE_LINES[20]}: months=1")]
                         + [("d", f"{n}: months=2") for n in L.BASE_LINES])


def test_state_of_changed_months_equals_the_whole(spark, tmp_path):
    chart = L.chart_of_accounts(spark.createDataFrame([("1", "SALES"), ("2", "SUPPLIES")], "account string, line_item string"))
    months = [dt.date(2020, m, 1) for m in range(1, 6)]
    schema = "profit_center string, account string, month date, amount decimal(18,2)"
    rows = [(c, a, m, D(f"{-7 * (i + 1)}.25")) for i, m in enumerate(months) for c in "cd" for a in "12"]
    led = spark.createDataFrame(rows, schema)
    root = str(tmp_path / "state")
    path = T.replace(S.line_state(led, chart), root, ["month"])
    files = {m: sorted(glob.glob(f"{path}/month={m}/*.parquet")) for m in months}
    # March changes, April loses all its rows
    changed = [r if r[2] != months[2] else (*r[:3], r[3] + 1) for r in rows if r[2] != months[3]]
    now = spark.createDataFrame(changed, schema)
    T.replace_partitions(S.line_state(now.where(F.col("month").isin(months[2:4])), chart), root, "month", months[2:4])
    got = S.statement_from_state(spark.read.parquet(path))
    assert sorted(map(str, got.collect())) == sorted(map(str, S.income_statement(now, chart).collect()))
    after = {m: sorted(glob.glob(f"{path}/month={m}/*.parquet")) for m in months}
    assert [after[m] == files[m] for m in months] == [True, True, False, False, True] and after[months[3]] == []


def test_years_prune_the_ledger_while_it_is_read(spark, tmp_path):
    wide = spark.createDataFrame([(y, f"c{i}", str(i), D("1.00")) for y in range(2015, 2022) for i in range(5)],
                                 "FISCAL_YEAR int, PROFIT_CENTER string, GL_ACCOUNT string, GC_PER_1 decimal(18,2)")
    wide.write.partitionBy("FISCAL_YEAR").parquet(str(tmp_path / "w"))
    spark.range(2000, 2030).select(F.col("id").cast("int").alias("fiscal_year")).write.parquet(str(tmp_path / "y"))
    years = spark.read.parquet(str(tmp_path / "y")).where("fiscal_year >= 2019 AND fiscal_year <= 2020")
    centres = spark.createDataFrame([("c1",), ("c1",), ("c3",)], "profit_center string")
    chart = spark.createDataFrame([("1",), ("2",)], "account string")
    cut = L.restrict_ledger(spark.read.parquet(str(tmp_path / "w")), centres, chart, years,
                            "PROFIT_CENTER", "GL_ACCOUNT", "FISCAL_YEAR")
    out = L.normalize_ledger(cut)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    # the lists cut the wide rows, before they are unpivoted
    assert plan.index("Generate inline") < plan.index("LeftSemi")
    long = L.restrict_ledger(L.normalize_ledger(wide), centres, chart, [2019, 2020])
    got = sorted(map(tuple, out.collect()))
    assert got == sorted(map(tuple, long.collect())) and len(got) == 2


def test_sheet_is_cut_and_converted_before_it_is_unpivoted(spark):
    from acqlens.operators import lender as LD
    sheet = spark.createDataFrame([("7000000001.0", "5.0", "a", "SALES", "1.5", "x"), ("7000000002", "6", "b", "SUPPLIES", "2", None),
                                   (None, "5", "c", "SALES", "9", "9"), ("7000000003", "7", "d", "SALES", "#REF!", "4")],
                                  "SAP string, Account_Number string, Description string, `Line Item` string, "
                                  "`2020-01-01` string, `2020-02-01` string")
    accounts = spark.createDataFrame([("5",), ("7",)], "account string")
    centres = spark.createDataFrame([("7000000001",), ("7000000002",), ("7000000001",)], "profit_center string")
    both = LD.trend_rollup(LD.load_trends(sheet, None, accounts, centres))
    after = LD.trend_rollup(LD.load_trends(sheet), accounts, centres)
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, after.collect())) != []
    conv = spark.createDataFrame([(5, 50), (6, 60)], "old_account int, ledger_account int")
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, LD.basis_from_sheet(sheet, conv).collect()), key=key) == \
        sorted(map(tuple, L.lender_basis_ledger(LD.load_trends(sheet), conv).collect()), key=key)
    assert sorted(r[0] for r in LD.trend_accounts(sheet).collect()) == ["5", "6", "7"]
