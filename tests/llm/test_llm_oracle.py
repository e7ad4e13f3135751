"""Every query that SQL can state, against DuckDB on the given tables."""
import pandas as pd
import pytest

from acqlens.llm.oracle import SQL
from acqlens.llm.queries import REGISTRY


def rows(frame, columns):
    clean = lambda v: None if pd.isna(v) else int(v) if isinstance(v, float) else v
    return sorted(map(repr, (tuple(map(clean, r)) for r in frame[columns].itertuples(index=False, name=None))))


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf, duck, name):
    got, want = REGISTRY[name](spark, sf).toPandas(), duck.execute(SQL[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want) > 0
    columns = sorted(got.columns)
    assert rows(got, columns) == rows(want, columns)


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in REGISTRY} == set(range(1, 14))
