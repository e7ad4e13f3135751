import hashlib
import random

from conftest import same_rows
from hypothesis import given, settings, strategies as st

from acqlens.llm import suffixes
from acqlens.llm.stringmerge import common, front_code, front_decode, merge

SCHEMA = "doc_id long, text string, doc string, spans string"


def brute(rows, length=100):
    seen, out = set(), []
    for i, text in rows:  # in order
        b = (text or "").encode()
        mark = bytearray(len(b))
        for s in range(len(b) - length + 1):
            x = b[s:s + length]
            if x in seen:
                mark[s:s + length] = b"\1" * length
            seen.add(x)
        kept = bytes(c for c, m in zip(b, mark) if not m)
        spans = sum(bool(mark[k]) and (k == 0 or not mark[k - 1]) for k in range(len(b)))
        out.append((i, len(b), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=6).map(lambda b: bytes(97 + c % 2 for c in b)), max_size=12),
                min_size=1, max_size=9))
def test_merge_of_front_coded_runs(runs):
    runs = [sorted(r) for r in runs]
    coded = [front_code(r) for r in runs]
    assert [front_decode(*c) for c in coded] == runs
    of, at, shared = merge([(c[0], r) for c, r in zip(coded, runs)])
    got = [runs[i][j] for i, j in zip(of, at)]
    assert got == sorted(x for r in runs for x in r)
    assert all(shared[i] == common(got[i - 1], got[i], 0) for i in range(1, len(got)))


def corpus():
    rng = random.Random(11)
    text = lambda n: "".join(rng.choices("abcdé \n", k=n))
    shared = [text(rng.randint(80, 400)) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [text(rng.randint(0, 150))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, 40)
            parts += [s[a:len(s) - rng.randint(0, 40)], text(rng.randint(0, 60))]
        rows.append((i, "".join(parts)))
    copy = text(700)
    for i in range(120, 160):  # near copies: one place differs
        k = rng.randint(0, 690)
        rows.append((i, copy[:k] + "#" * rng.randint(0, 2) + copy[k + 1:]))
    rows += [(200, None), (201, ""), (202, "z" * 2500), (203, "xy" * 900), (204, "q" * 99), (205, "q" * 100),
             (206, "q" * 100), (207, "é" * 300)]
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(4)
    for options in ({}, {"hot": 3, "bucket_rows": 40}, {"hot": 1 << 40, "bucket_rows": 10}):
        same_rows(suffixes.suffix_report(df, **options), brute(rows))
    same_rows(suffixes.suffix_report(df, length=40), brute(rows, 40))


def test_long_documents_are_cut_without_loss(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 300)
    rows = corpus()
    pieces = [(d, b, t) for data, ends, docs, begins in suffixes.side_by_side(
        ((i, (t or "").encode()) for i, t in rows), 100)
        for d, b, t in zip(docs, begins, (data[a:e].tobytes() for a, e in zip([0, *ends], ends)))]
    strings = lambda d, b, t: {(d, b + s, t[s:s + 100]) for s in range(len(t) - 99)}
    got = [x for p in pieces for x in strings(*p)]
    want = {x for i, t in rows for x in strings(i, 0, (t or "").encode())}
    assert len(got) == len(set(got)) and set(got) == want


def test_repeated_and_missing_ids(spark):
    a, b = "first text " * 30, "second text " * 30
    rows = [(None, a), (7, a), (7, a), (7, b), (8, b)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = sorted((r.doc_id or 0, r.n_removed == r.n_bytes) for r in suffixes.suffix_report(df).collect())
    # the null id comes first and keeps a; of the rows of 7 one keeps b
    assert got == [(0, False), (7, False), (7, True), (7, True), (8, True)]
    assert suffixes.suffix_report(df.limit(0)).count() == 0


def test_anchor_with_few_texts_in_every_block_is_hot(spark):
    import random
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    phrase = noise(150)
    # 90 tasks, each with three different texts around the phrase
    rows = [(i, noise(120) + phrase + noise(120)) for i in range(270)]
    texts = spark.createDataFrame(spark.sparkContext.parallelize(rows, 90), "doc long, text string")
    assert len(suffixes.hot_anchors(texts, 100, 256)) > 0
    assert len(suffixes.hot_anchors(texts, 100, 270)) == 0
