import random

import numpy as np
from conftest import same_rows

from acqlens.llm import superminhash as s
from acqlens.llm.components import components

SCHEMA = "doc_id long, text string, doc string, comp string"


def words(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()


def brute(rows):
    sets = {}
    for i, text in rows:
        w = words(text)
        sets.setdefault(i, []).append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    flat = [(i, x) for i, xs in sets.items() for x in xs if x and i is not None]
    for n, (i, x) in enumerate(flat):
        for j, y in flat[:n]:
            both = len(x & y)
            if 100 * both >= 75 * (len(x) + len(y) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [(i, len(x), find(i) if i is not None else None, i is None or find(i) == i)
            for i, xs in sets.items() for x in xs]


def corpus():
    rng = random.Random(17)
    pool = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(900)]
    base = [rng.choices(pool, k=rng.randint(40, 200)) for _ in range(12)]
    rows = []
    for i in range(220):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5, 9])):
            w[rng.randrange(len(w))] = rng.choice(pool)
        if i % 3 == 0:
            w = w[rng.randint(0, 9):] + rng.choices(pool, k=rng.randint(0, 30))
        rows.append((i * 7 % 223, " ".join(w)))
    rows += [(300 + i, " ".join(base[0])) for i in range(30)]
    star = rng.choices(pool, k=300)  # variants that are near the centre, not each other
    rows.append((400, " ".join(star)))
    for i in range(40):
        w = list(star)
        for k in range(6):
            w[rng.randrange(5, 295)] = f"new{i}x{k}"
        rows.append((401 + i, " ".join(w)))
    rows += [(500, None), (501, ""), (502, " \n\t"), (503, "One two"), (504, "one TWO"), (505, "two one"),
             (506, "a b c d e"), (507, "a b c d e"), (508, "É b c d e"), (509, "é b c d e")]
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(4)
    same_rows(s.near_report(df), brute(rows))


def test_repeated_and_missing_ids_and_empty_table(spark):
    one, two = " ".join(f"w{k}" for k in range(30)), " ".join(f"v{k}" for k in range(30))
    rows = [(3, one), (3, two), (1, two), (5, one), (None, one), (9, "alone in here with words")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in s.near_report(df).collect())
    assert got == [(0, 0, True), (1, 1, True), (3, 1, False), (3, 1, False), (5, 1, False), (9, 9, True)]
    assert s.near_report(df.limit(0)).count() == 0


def test_near_copies_of_every_text_of_a_repeated_id(spark):
    one, two = [f"w{k}" for k in range(120)], [f"v{k}" for k in range(120)]
    # whichever set of id 3 comes first, the other one has a near copy too
    rows = [(3, " ".join(one)), (3, " ".join(two)), (3, ""), (5, " ".join(two[:-2])), (6, " ".join(one[:-2]))]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    same_rows(s.near_report(df), brute(rows))
    assert {r.component_id for r in s.near_report(df).collect()} == {3}


def test_signature_estimates_similarity_and_stops_early():
    rng = np.random.default_rng(5)
    errors = []
    for _ in range(60):
        n, both = 400, 300
        x = rng.integers(0, 1 << 63, 2 * n - both, dtype=np.uint64)
        a, b = np.sort(x[:n]), np.sort(x[n - both:])
        sig = s.super_minhash([a, b], 176)
        errors.append((sig[0] == sig[1]).mean() - both / len(x))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.04
    # few elements fill every place by going through the ranks
    small = s.super_minhash([np.array([5], np.uint64), np.zeros(0, np.uint64)], 176)
    assert sorted((small[0] >> 24).tolist()) == list(range(176)) and (small[1] == 0xFFFFFFFF).all()
    big = np.sort(rng.integers(0, 1 << 63, 5000, dtype=np.uint64))
    assert (s.super_minhash([big], 176, block=700) == s.super_minhash([big], 176)).all()
    assert (s.super_minhash([big], 176) >> 24).max() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(35)]
    edges += [(200, 201 + k) for k in range(50)] + [(5, 5), (201, 202)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "a long, b long").repartition(4)
    same_rows(components(df), [(x, find(x)) for x in parent if find(x) != x])
    assert components(df.limit(0)).count() == 0
