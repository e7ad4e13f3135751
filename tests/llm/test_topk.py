import math
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from acqlens.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string, rank int"


def brute(rows, k, scale=1024):
    part = [(i, [math.floor(float(np.float32(x)) * scale) for x in v]) for i, v, *_ in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i in {i for i, _ in part if i % 100 == 0}:
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for n, q in part if n == i
                        for j, v in part if j != i and len(v) == len(q))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def result(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 100 == 0, **options).collect()))


def test_against_brute_force_with_ties_and_odd_rows(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.choice([-0.5, 0.0, 0.25, 1.0], 6)], "x", 1) for i in range(420)]
    rows += [(500 + i, [0.5] * 6, "x", 1) for i in range(60)]          # one frequent vector
    rows += [(7, [9.0] * 6, "x", 1), (7, [9.0] * 6, "x", 1)]           # a repeated id
    rows += [(None, [1.0] * 6, "x", 1), (901, None, "x", 1), (902, [1.0, None, 1.0, 1.0, 1.0, 1.0], "x", 1),
             (903, [float("nan")] * 6, "x", 1), (904, [float("inf")] + [0.0] * 5, "x", 1),
             (1000, [0.0] * 6, "x", 1), (1100, [1.0, 2.0], "x", 1), (1101, [1.0, 1.0], "x", 1),
             (1200, [], "x", 1)]
    for options in ({}, {"block_rows": 64, "query_rows": 2}, {"k": 3}):
        assert result(spark, rows, **options) == brute(rows, options.get("k", 10))


def test_rows_that_share_an_id(spark):
    rows = [(1, [1.0, 0.0], "", 0), (1, [5.0, 0.0], "", 0), (1, [5.0, 0.0], "", 0), (100, [1.0, 0.0], "", 0)]
    assert result(spark, rows) == [(100, 1, 1, 5242880), (100, 2, 1, 5242880), (100, 3, 1, 1048576)]
    rows += [(100, [-2.0, 1.0], "", 0), (200, [3.0, 1.0], "", 0)] + [(7, [0.5, 0.5], "", 0)] * 40
    for options in ({}, {"block_rows": 5, "query_rows": 1}):
        assert result(spark, rows, **options) == brute(rows, 10)


def test_scores_beyond_64_bits(spark):
    rows = [(100, [1e6, 1.0], "", 0), (1, [2e6, 0.0], "", 0), (2, [-2e6, 3.0], "", 0)]
    assert result(spark, rows) == brute(rows, 10)
    with pytest.raises(Exception, match="does not fit 64 bits"):
        result(spark, [(100, [1e7, 1e7], "", 0), (1, [1e7, 1e7], "", 0)])


def test_fewer_candidates_than_k_and_no_rows(spark):
    assert result(spark, [(0, [1.0], "", 0), (1, [2.0], "", 0)]) == [(0, 1, 1, 1024 * 2048)]
    assert result(spark, [(0, [1.0], "", 0)]) == []
    assert result(spark, []) == []


def test_threshold_stops_before_reading_all():
    n = 20_000
    vectors = np.zeros((n, 2), np.int64)
    vectors[:, 0] = np.arange(n)
    lists = topk.SortedLists(np.arange(n), vectors)
    scored = []
    inner = lists._scores
    lists._scores = lambda rows, q: scored.append(len(rows)) or inner(rows, q)
    rows, scores = lists.best(-1, np.array([1, 0]), 10)
    assert rows.tolist() == list(range(n - 1, n - 11, -1)) and scores[0] == n - 1
    assert sum(scored) < 100


def test_threshold_ends_the_search_after_most_are_met():
    # three lists that meet over a quarter of the block before the bound holds
    rng = np.random.default_rng(11)
    vectors, query = rng.integers(0, 1000, (3000, 3)), np.array([5, 7, 6])
    lists = topk.SortedLists(np.arange(3000), vectors)
    scored = []
    inner = lists._scores
    lists._scores = lambda rows, q: scored.extend(rows.tolist()) or inner(rows, q)
    rows, scores = lists.best(-1, query, 200)
    want = sorted(range(3000), key=lambda i: (-int(vectors[i] @ query), i))[:200]
    assert rows.tolist() == want and scores.tolist() == (vectors[want] @ query).tolist()
    assert 3000 / 4 < len(scored) < 3000 and len(set(scored)) == len(scored)


def test_large_components_stay_exact():
    vectors = np.array([[1 << 29, 1], [1 << 29, 2], [(1 << 29) - 1, 5]], np.int64)
    rows, scores = topk.SortedLists(np.arange(3), vectors).best(-1, np.array([1 << 29, 1]), 3)
    assert rows.tolist() == [1, 0, 2] and scores.tolist() == [(1 << 58) + 2, (1 << 58) + 1, (1 << 58) - (1 << 29) + 5]


def test_a_search_that_stops_early_copies_no_list():
    rng = np.random.default_rng(5)
    vectors = rng.integers(0, 3, (60_000, 16))
    vectors[:, 0] = 1000 * np.arange(60_000)
    lists, query = topk.SortedLists(np.arange(60_000), vectors), np.array([1] * 16)
    tracemalloc.start()
    rows, _ = lists.best(-1, query, 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows.tolist() == list(range(59_999, 59_989, -1))
    assert peak < 8 * len(vectors)  # less than one of the sixteen lists


@pytest.mark.parametrize("most", [2895, 2897, 67_108_863, 67_108_865, 2_147_483_647])
def test_scores_stay_exact_in_every_range(most):
    rng = np.random.default_rng(most)
    vectors = most - rng.integers(0, 4, (300, 2)) * rng.choice([1, most // 2], (300, 2))
    lists = topk.SortedLists(np.arange(300), vectors)
    for query in (np.array([most, most - 1]), np.array([-most, most - 2]), np.array([0, 1 - most])):
        exact = [sum(int(a) * int(b) for a, b in zip(v, query)) for v in vectors]
        want = sorted(range(300), key=lambda i: (-exact[i], i))[:40]
        rows, scores = lists.best(-1, query, 40)
        assert rows.tolist() == want and scores.tolist() == [exact[i] for i in want]
