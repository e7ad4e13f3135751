"""Property tests: exact half-up ratios against fractions, the distributed
median against numpy on random data with heavy duplicates."""

from fractions import Fraction

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from acqlens.functions.stats import exact_median, ratio_half_up


def _half_up(a: int, b: int, places: int) -> float:
    q = Fraction(a, b) * 10 ** places
    return float((q + Fraction(1, 2)).__floor__()) / 10 ** places


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10 ** 9), st.integers(1, 10 ** 6)), min_size=1, max_size=200),
       st.integers(0, 6))
def test_ratio_half_up_is_exact(spark, pairs, places):
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [r.x for r in df.select(ratio_half_up("a", "b", places).alias("x")).collect()]
    assert got == [_half_up(a, b, places) for a, b in pairs]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.sampled_from([0.0, 0.5, 0.77495, 0.85, 1.0, 1.02]) | st.floats(0, 2), min_size=1, max_size=300),
       st.integers(1, 3))
def test_exact_median_property(spark, values, groups):
    pdf = pd.DataFrame({"g": [i % groups for i in range(len(values))], "v": values})
    got = {r.g: r.m for r in exact_median(spark.createDataFrame(pdf), ["g"], "v", "m").collect()}
    for g, part in pdf.groupby("g"):
        assert abs(got[g] - float(np.median(part.v))) < 1e-12
