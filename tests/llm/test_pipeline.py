"""The pipeline's stages against brute force, each on its own input."""
import hashlib
import random

import pytest
import test_decontam
import test_linededup
import test_superminhash

import corpus_pipeline as cp
from acqlens.llm import toxicity
from acqlens.llm.tokens import WordEncoder, default_tokenizer


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=lambda r: tuple((v is not None, v) for v in r))


@pytest.fixture(scope="module")
def stages(spark, sf):
    """Input and output of every stage, on the given tables."""
    out, docs = {}, spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in cp.STAGES:
        after = cp.stored(stage(spark, docs, sf), "test")
        out[name] = docs, after
        docs = after
    return out


def test_order_and_columns(stages):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line dedup", "MinHash near-dedup", "benchmark decontamination",
                                         "best-fit packing"]
    for name, (before, after) in stages.items():
        if name != "best-fit packing":
            assert after.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert after.dtypes == before.dtypes


def test_toxicity_stage(spark, sf, stages):
    before, after = stages["toxicity"]
    report = toxicity.toxicity_report(before, spark.read.parquet(f"{sf}/labels.parquet"))
    assert rows(after, "doc_id") == rows(report.where("NOT rejected"), "doc_id")
    assert 0 < before.count() - after.count() < 0.3 * before.count()


def test_line_dedup_stage(stages):
    before, after = stages["line dedup"]
    want = test_linededup.brute(rows(before, "doc_id", "text"))
    got = [(i, hashlib.sha256(t.encode()).hexdigest(), n) for i, t, n in rows(after, "doc_id", "text", "n_chars")]
    assert [(i, h) for i, h, _ in got] == sorted((i, h) for i, _, _, h in want)
    assert all(n == len(t) for t, n in rows(after, "text", "n_chars"))
    assert any(w[2] for w in want)


def test_near_dedup_stage(stages):
    before, after = stages["MinHash near-dedup"]
    kept = [(i,) for i, _, _, keep in test_superminhash.brute(rows(before, "doc_id", "text")) if keep]
    assert rows(after, "doc_id") == sorted(kept)


def test_decontamination_stage(spark, sf, stages):
    before, after = stages["benchmark decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    keys = [(k, [" ".join(w[p:p + 6]) for p in range(len(w) - 5)]) for k, t in items
            for w in [t.encode().translate(test_decontam.decontam._AS_WORDS).decode().split()]]
    gone = set()
    for i, text in rows(before, "doc_id", "text"):  # a plain search first, as the full one is slow
        plain = " ".join(text.encode().translate(test_decontam.decontam._AS_WORDS).decode().split())
        near = [it for it, (_, grams) in zip(items, keys) if any(g in plain for g in grams)]
        if near and test_decontam.brute([(i, text)], near):
            gone.add(i)
    assert {i for i, in rows(before, "doc_id")} - {i for i, in rows(after, "doc_id")} == gone


def test_packing_stage_and_run(spark, sf, stages):
    before, after = stages["best-fit packing"]
    enc = WordEncoder(default_tokenizer())
    want = sorted((i, len(enc.encode_whole(t)) // 4 + 1) for i, t in rows(before, "doc_id", "text"))
    got = after.groupBy("doc_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n")
    assert rows(got, "doc_id", "n") == want
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows(cp.run(spark, sf), *columns) == rows(after, *columns)


def test_odd_rows_pass_the_filters(spark, sf):
    rng = random.Random(4)
    text = lambda: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(40))
    odd = [(None, text(), None, None, None, "x"), (-1, None, "en", "s", 0, "x"), (-2, "", "en", "s", 0, "x"),
           (-3, text(), "en", "s", 5, "x"), (-3, text(), "en", "s", 5, "x")]
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long, llm_gone string")
    for k, (name, stage) in enumerate(cp.STAGES):
        done = stage(spark, docs, sf)
        if k < 4:
            assert done.columns == docs.columns and done.count() == 5, name
        else:
            assert done.select("doc_id").distinct().count() == 4
        assert stage(spark, docs.limit(0), sf).count() == 0, name
