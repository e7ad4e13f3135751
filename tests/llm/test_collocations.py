import re
from collections import Counter

import random

import pytest
from conftest import same_rows
from pyspark.sql import functions as F

from acqlens.llm import collocations

SCHEMA = "doc_id long, text string, lang string, chunk long, n string"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, max_words=3, min_count=10, share=50, top=2000):
    f, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, max_words + 1):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    out = {}
    candidates = {p: n for p, n in f.items() if len(p[1]) > 1 and n >= min_count}
    longest = Counter()
    for (lang, p), n in candidates.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                longest[lang, p[i:i + k]] = max(longest[lang, p[i:i + k]], n)
    for (lang, p), a in candidates.items():
        if (lang, p) in longest and 100 * longest[lang, p] >= share * a:
            continue
        cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return [(lang, rank, p.decode(), -a, left, right, totals[lang], -score)
            for lang, found in out.items() for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)]


def some_rows(n=250, seed=4):
    rng, rows = random.Random(seed), []
    words = ["the", "The", "of", "new", "york", "New", "é", "É", "a-b", "x", "\x1c", "city"] + [f"w{k}" for k in range(20)]
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", " ", " ", ". ", ",", "\r\n", "\x0b"])
                       for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice([i, 3, None]), text, rng.choice(["en", "de", None, "und", ""])))
    return rows + [(1, None, "en"), (1, "", None), (2, "new york city " * 3000, "en"), (2, "one.", "xx"),
                   (4, ("ab " * 50_000 + ".") * 9, "zz")]


@pytest.mark.parametrize("options", [{}, {"chunk_words": 50}, {"max_words": 4, "min_count": 3, "chunk_words": 700},
                                     {"top": 5, "share": 90, "min_count": 2}, {"max_words": 2}])
def test_against_brute_force(spark, options):
    rows = some_rows()
    df = spark.createDataFrame([(*r, 9, "x") for r in rows], SCHEMA).repartition(3)
    shown = {k: v for k, v in options.items() if k != "chunk_words"}
    want = brute(rows, **shown)
    assert len(want) > 4
    same_rows(collocations.collocations(df, **options), want, COLUMNS)


def test_empty_and_nothing_frequent(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert collocations.collocations(empty).collect() == []
    df = spark.createDataFrame([(1, "some words only once", "en", 1, "x"), (2, None, None, 1, "x")], SCHEMA)
    assert collocations.collocations(df).collect() == []


def test_score_needs_more_than_64_bits(spark):
    a, low = 3_000_000_019, 3_000_000_021
    row = spark.range(1).select(
        (F.lit(a).cast("decimal(19,0)") * F.lit(a).cast("decimal(19,0)") * F.lit(1_000_000)).cast("decimal(38,0)").alias("above"),
        (F.lit(low).cast("decimal(19,0)") * F.lit(low).cast("decimal(19,0)")).cast("decimal(38,0)").alias("below"))
    assert row.select(F.expr("above div below")).first()[0] == 1_000_000 * a * a // (low * low)


def test_too_many_tasks_are_named(spark, monkeypatch):
    monkeypatch.setattr(collocations, "_NUMBER", 1)
    import pyarrow as pa

    class Ctx:
        @staticmethod
        def get():
            return Ctx()

        def partitionId(self):
            return 0

    monkeypatch.setattr(collocations, "TaskContext", Ctx)
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array(["a b c d e"])], ["lang", "text"])
    with pytest.raises(OverflowError):
        list(collocations._occurrences(100)([batch]))
