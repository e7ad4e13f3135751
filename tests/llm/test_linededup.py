import hashlib
import random

from conftest import same_rows

from acqlens.llm import linededup

SCHEMA = "doc_id long, text string, line string, llm_doc string"


def brute(rows, min_chars=20, min_docs=3):
    strip = " \t\n\x0b\x0c\r"
    key = lambda x: "".join(c.lower() if c.isascii() else c for c in x.strip(strip))
    low = lambda i: linededup.NO_ID if i is None else i
    holders = {}
    for i, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= min_chars:
                holders.setdefault(k, []).append(low(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(h := holders.get(key(x), [])) < min_docs or max(h) == low(i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def test_against_brute_force(spark):
    rng = random.Random(5)
    lines = [f"Line number {k} é of the shared ones" for k in range(40)] + ["short", "", "exactly twenty chars", "ÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉ"]
    rows = []
    for i in range(150):
        text = [rng.choice([str.upper, str, lambda x: f" \t{x}\x0b"])(rng.choice(lines)) for _ in range(rng.randint(0, 8))]
        rows.append((i * 3 % 151, "\n".join(text)))
    rows += [(900 + i, "One very common line of text\nand another") for i in range(80)]
    rows += [(None, "One very common line of text"), (None, None), (2000, None), (2001, ""), (2001, ""),
             (5, lines[0]), (5, lines[0]), (3000, "\n".join(f"line of a very long document {k}" for k in range(20_000)))]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    for options in ({}, {"batches": 1}, {"batches": 7, "fanout": 2}, {"min_docs": 2, "min_chars": 1}):
        want = brute(rows, options.get("min_chars", 20), options.get("min_docs", 3))
        same_rows(linededup.line_report(df, **options), want)


def test_empty_table_and_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert linededup.line_report(empty).count() == 0
    df = spark.createDataFrame([(1, None, "a", "b")], SCHEMA)
    assert [tuple(r) for r in linededup.dedup_lines(df).collect()] == [(1, None, "a", "b")]


def test_runs_are_merged_by_level(spark):
    runs = linededup.LineRuns(spark, fanout=2)
    for b in range(4):
        runs.add(spark.createDataFrame([(b"old", 10 - b), (b"new%d" % b, 10 - b)], "line binary, doc long"))
    assert [len(level) for level in runs.levels] == [0, 0, 1]  # two merges of two, then one of those
    got = {bytes(r.line): (r.keeper, r.n) for r in runs.levels[2][0].collect()}
    assert got[b"old"] == (10, 1) and len(got) == 5
    assert [(bytes(r.line), r.keeper) for r in runs.repeated(4).collect()] == [(b"old", 10)]
