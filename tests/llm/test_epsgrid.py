import math
import random

import numpy as np
import pytest
from conftest import same_rows

from acqlens.llm import epsgrid

SCHEMA = "vec_id long, embedding array<double>, place long, v string, interval int"
COLUMNS = ["vec_id", "n_links", "component_id", "kept"]


def brute(rows, least=0.9):
    usable = lambda i, v: i is not None and v and None not in v and np.isfinite(v).all() and any(v)
    scaled = [np.array(v, float) / max(map(abs, v)) if usable(i, v) else None for i, v in rows]
    unit = [None if x is None else x / np.linalg.norm(x) for x in scaled]
    links = [[k for k, b in enumerate(unit) if k != j and a is not None and b is not None and len(a) == len(b)
              and a @ b >= least] for j, a in enumerate(unit)]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for j, found in enumerate(links):
        for k in found:
            a, b = find(rows[j][0]), find(rows[k][0])
            root[max(a, b)] = min(a, b)
    return [(i, len(links[j]), None if i is None else find(i), True if i is None else find(i) == i)
            for j, (i, _) in enumerate(rows)]


def some_rows(n=250, dims=12, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    rows = []
    for i in range(n):
        c = centres[rng.integers(len(centres))]
        rows.append((i * 7 % n, (c * rng.choice([1.0, 3.5]) + rng.normal(size=dims) * rng.choice([0.05, 0.4, 1.0])).tolist()))
    chain = [(1000 + k, [math.cos(0.4 * k), math.sin(0.4 * k)]) for k in range(20)]  # linked one to the next
    copies = [(2000 + k, rows[3][1]) for k in range(40)]
    odd = [(3000, None), (3001, []), (3002, [0.0] * dims), (3003, [float("nan")] * dims), (3004, [None] * dims),
           (3005, [float("inf")] + [0.0] * (dims - 1)), (None, rows[3][1]), (None, None), (3006, [1e300] * dims),
           (3007, [2e-300] * dims), (5, rows[9][1]), (5, rows[20][1]), (3008, [-0.0] + rows[3][1][1:]), (3010, [7.0])]
    return rows + chain + copies + odd


@pytest.mark.parametrize("options", [{}, {"leaf": 4}, {"interval_bytes": 12 * 8 * 9, "partition_bytes": 12 * 8 * 40, "leaf": 3},
                                     {"dims": 2, "interval_bytes": 12 * 8 * 60}, {"least": 0.99}])
def test_against_brute_force(spark, options):
    rows = some_rows()
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(4)
    want = brute(rows, options.get("least", 0.9))
    same_rows(epsgrid.vector_report(df, **options), want, COLUMNS)


def test_distant_blocks_are_skipped(monkeypatch):
    rng = np.random.default_rng(2)
    u = np.vstack([rng.normal(size=(500, 16)) * 0.05 + c for c in np.eye(16)[:4]])
    raw = [x.tobytes() for x in u]
    tree = epsgrid._Tree(np.arange(len(u)), np.ones(len(u), np.int64), raw, (16, np.eye(16)[:, :4]), 4)
    met = []
    compare = epsgrid._Join.compare
    monkeypatch.setattr(epsgrid._Join, "compare", lambda self, *a: (met.append(a), compare(self, *a)))
    join = epsgrid._Join(tree, tree, 0.9, 0.2 ** 0.5, 64)
    join.join(0, len(u), 0, len(u))
    assert sum((a1 - a0) * (b1 - b0) for a0, a1, b0, b1 in met) < 0.4 * len(u) ** 2
    cosine = tree.u @ tree.u.T >= 0.9
    assert (tree.links == cosine.sum(axis=1) - 1).all()


def test_limit_is_met_exactly(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.9, (1 - 0.81) ** 0.5]), (3, [-0.9, 0.5]), (4, [0.899999, (1 - 0.899999 ** 2) ** 0.5])]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    got = {r["vec_id"]: r["n_links"] for r in epsgrid.vector_report(df).collect()}
    x = np.array([0.9, (1 - 0.81) ** 0.5])
    assert got[1] == int(x[0] / np.sqrt(x @ x) >= 0.9) and got[3] == 0


def test_empty(spark):
    assert epsgrid.vector_report(spark.createDataFrame([], SCHEMA)).collect() == []
    only = spark.createDataFrame([(4, None, 1, "x", 2)], SCHEMA)
    same_rows(epsgrid.vector_report(only), [(4, 0, 4, True)], COLUMNS)
