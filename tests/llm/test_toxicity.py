import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from acqlens.llm import toxicity as t


def made(n, seed, rate=0.15):
    """Documents whose toxic ones hold words with one of a few stems."""
    rng = random.Random(seed)
    plain = ["".join(rng.choices("aeioulnrst", k=rng.randint(2, 9))) for _ in range(600)]
    stems, ends = ["grobz", "vexqu", "zhklo"], ["", "ant", "en", "ique", "ö", "ß", "s"]
    rows = []
    for i in range(n):
        words = rng.choices(plain, k=rng.randint(15, 120))
        toxic, junk = rng.random() < rate, rng.random() < 0.2
        for _ in range(rng.randint(2, 6) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(stems) + rng.choice(ends) + rng.choice(["", ",", "."]))
        if junk:
            words = [w + "%%%" for w in words]
        rows.append((i, " ".join(words), int(not junk), int(toxic)))
    return rows


def frames(spark, rows, labelled):
    docs = spark.createDataFrame([(i, x, "s", 0) for i, x, _, _ in rows], "doc_id long, text string, p string, llm_id int")
    labels = spark.createDataFrame([(i, q, y) for i, _, q, y in rows[:labelled]], "doc_id long, quality int, toxic int")
    return docs, labels


def test_held_out_documents(spark):
    rows = made(1500, 1)
    docs, labels = frames(spark, rows, 900)
    got = {r.doc_id: r for r in t.toxicity_report(docs, labels).collect()}
    assert len(got) == 1500
    held = rows[900:]
    missed = [i for i, _, _, y in held if y and not got[i].rejected]
    wrong = [i for i, _, _, y in held if not y and got[i].rejected]
    assert len(missed) <= 0.03 * sum(y for *_, y in held) + 1 and len(wrong) <= 1
    junk = np.mean([(got[i].p_low_quality >= 0.5) == (q == 0) for i, _, q, _ in held])
    assert junk > 0.97
    kept = t.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.rejected}


def test_later_models_see_earlier_probabilities():
    """The second category equals the first, which has features; the second has
    noise of its own, so the chain must lean on the first's probability."""
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 600)
    texts = [("signal " if a else "other ").encode() * 3 + b"%d" % rng.integers(0, 9) for a in y]
    chain = t.train_chain(texts, np.column_stack([y, y]).astype(float), np.arange(600) % 4, 4, 1000)
    assert chain.earlier[1, 0] > 0.5 and chain.earlier[0].tolist() == [0, 0]
    assert chain.probabilities(b"signal signal")[1] > 0.9 > 0.1 > chain.probabilities(b"other")[1]


def test_out_of_fold_rows_do_not_see_their_own_label():
    """Labels that no feature explains: in-sample probabilities would follow them."""
    rng = np.random.default_rng(6)
    y = rng.integers(0, 2, 400)
    texts = [b"w%d x%d" % (i, i) for i in range(400)]
    chain = t.train_chain(texts, np.column_stack([y, y]).astype(float), np.arange(400) % 4, 4, 1000, z_least=0)
    assert chain.earlier[1, 0] < 2


def test_no_labels_one_outcome_nulls_and_empty(spark):
    rows = made(60, 3)
    docs, labels = frames(spark, rows, 40)
    none = t.toxicity_report(docs, labels.limit(0))
    assert none.count() == 60 and none.where("rejected").count() == 0
    same = t.toxicity_report(docs, labels.withColumn("toxic", F.lit(0)))
    assert same.where("rejected").count() == 0
    more = spark.createDataFrame([(None, "x", "s", 0), (700, None, "s", 0), (701, "", "s", 0), (701, "", "s", 0),
                                  (702, "word " * 200_000, "s", 0)], docs.schema)
    odd = labels.unionByName(spark.createDataFrame([(None, 1, 1), (700, None, None), (701, 1, 0), (701, 1, 1)], labels.schema))
    assert t.toxicity_report(docs.unionByName(more), odd).count() == 65
    assert t.toxicity_report(docs.limit(0), labels).count() == 0
    assert t.without_toxic(docs.limit(0), labels.limit(0)).columns == docs.columns


def test_sample_is_bounded_and_repeatable(spark):
    rows = made(300, 8)
    docs, labels = frames(spark, rows, 300)
    cat = t.labelled_categories(labels)
    one = t.fit_chain(docs, cat, max_labelled=100)
    two = t.fit_chain(docs.repartition(7), cat, max_labelled=100)
    assert one.vocabulary == two.vocabulary and np.allclose(one.weights, two.weights)


def _plain_features(text):
    """The features by name, without hashes or caches."""
    words = [w for w in "".join(c if c.isascii() and c.isalnum() or not c.isascii() else " " for c in text).split()]
    words = ["".join(c.lower() if c.isascii() else c for c in w) for w in words]
    some = set(words)
    out = {w.encode() for w in some} | {w[:k].encode() + b"*" for w in some for k in range(3, 7) if len(w) >= k}
    raw = text.encode()
    odd = sum(not (b >= 128 or chr(b).isalnum() or chr(b) in " \t\n\x0b\x0c\r") for b in raw) / max(1, len(raw))
    mean = sum(len(w.encode()) for w in some) / max(1, len(some))
    return out | {b"# odd %d" % min(10, int(40 * odd)), b"# distinct %d" % int(10 * len(some) / max(1, len(words))),
                  b"# length %d" % min(10, int(mean))}


def _newton(x, extra, y, use, ridge):
    """The optimum of the same loss by dense Newton steps: ridge on the features, the
    smallest of penalties on the other columns."""
    z = np.column_stack([x, extra, np.ones(len(x))])
    penalty = np.r_[np.full(x.shape[1], ridge), np.full(extra.shape[1] + 1, 1e-9)]
    w = np.zeros(z.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-(z @ w)))
        slope = z.T @ ((p - y) * use) + penalty * w
        step = np.linalg.solve((z * (p * (1 - p) * use)[:, None]).T @ z + np.diag(penalty), slope)
        w = w - step
        if np.abs(step).max() < 1e-12:
            break
    return w


def test_chain_equals_a_dense_one():
    """Features, selection, folds, out-of-fold chaining and weights against a dense
    recomputation that shares nothing with the code but the hash of a name."""
    rng = random.Random(9)
    bad, low, other = ["idiot", "stupids"], ["spam", "click"], [f"wort{k}" for k in range(25)] + ["café", "x1!"]
    texts, labels = [], []
    for i in range(240):
        q, x = rng.random() < 0.4, rng.random() < 0.3
        texts.append(" ".join(rng.choice(other + bad * (4 * x) + low * (4 * q)) for _ in range(rng.randint(3, 25)))
                     + rng.choice(["", ".", "!!! $$"]))
        labels.append([q, x])
    y, folds = np.array(labels, float), 4
    fold = np.arange(len(texts)) % folds
    chain = t.train_chain([d.encode() for d in texts], y, fold, folds, 1000, z_least=2.0, steps=30_000)
    found = [_plain_features(d) for d in texts]
    names = sorted({n for f in found for n in f})
    x = np.array([[n in f for n in names] for f in found], float)
    df = x.sum(axis=0)
    strength = np.max([np.abs(x.T @ y[:, c] - df * y[:, c].mean()) / np.sqrt(df * y[:, c].mean() * (1 - y[:, c].mean()))
                       for c in range(2)], axis=0)
    keep = (df >= 5) & (strength >= 2.0)
    x, names = x[:, keep], [n for n, k in zip(names, keep) if k]
    assert sorted(chain.vocabulary) == sorted(xxhash.xxh3_64_intdigest(n) for n in names) and len(names) > 5
    everything, nothing = np.ones(len(texts)), np.zeros((len(texts), 0))
    first = _newton(x, nothing, y[:, 0], everything, 1.0)
    held_out = np.zeros(len(texts))
    for f in range(folds):
        w = _newton(x, nothing, y[:, 0], (fold != f).astype(float), 1.0)
        z = np.column_stack([x, np.ones(len(texts))]) @ w
        held_out[fold == f] = (1 / (1 + np.exp(-z)))[fold == f]
    second = _newton(x, held_out[:, None], y[:, 1], everything, 1.0)
    at = [chain.vocabulary.index(xxhash.xxh3_64_intdigest(n)) for n in names]
    assert np.allclose(chain.weights[at, 0], first[:-1], atol=1e-5)
    assert np.allclose(chain.weights[at, 1], second[:-2], atol=1e-5)
    assert np.allclose([chain.bias[0], chain.bias[1], chain.earlier[1, 0]], [first[-1], second[-1], second[-2]], atol=1e-4)
    # scoring feeds the first probability to the second model
    for i in (0, 7, 100):
        p = 1 / (1 + np.exp(-(x[i] @ first[:-1] + first[-1])))
        q = 1 / (1 + np.exp(-(x[i] @ second[:-2] + second[-2] * p + second[-1])))
        assert np.allclose(chain.probabilities(texts[i].encode()), [p, q], atol=1e-4)
