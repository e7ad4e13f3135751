import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for t in "documents embeddings pages benchmark labels conversations".split():
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def same_rows(df, want, columns=None):
    """The rows of a DataFrame, as sorted tuples, against a list of tuples."""
    columns = columns or df.columns
    key = lambda r: tuple((v is not None, str(type(v)), v) if not isinstance(v, bool) else (True, "b", v) for v in r)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key)
    assert got == sorted(want, key=key)
