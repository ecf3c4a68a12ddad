import duckdb
import pytest
from kinspark.plans.linkage_sql import TABLES
from kinspark.plans.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def oracle(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def rounded(rows, columns):
    """Rows with their columns by name, as sorted tuples."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_duckdb(spark, sf, oracle, name):
    df = QUERIES[name](spark, sf)
    want = oracle.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rounded(df.collect(), df.columns) == rounded(want.fetchall(), want.columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs_over_its_table(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
