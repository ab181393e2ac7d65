"""Every scene query against its SQL on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from atrium.plans import registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


def canonical(df):
    def plain(v):
        if pd.isna(v):
            return "null"
        return repr(round(float(v), 5) + 0.0) if isinstance(v, float) else str(v)

    df = df[sorted(df.columns)]
    return list(df.columns), sorted(tuple(map(plain, row)) for row in df.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, oracle, name):
    got = registry.queries()[name](spark, SF_DIR).toPandas()
    assert canonical(got) == canonical(oracle.execute(registry.oracle_sql()[name]).df())


def test_queries_without_sql_are_those_tested_by_brute_force():
    assert set(registry.queries()) - set(registry.oracle_sql()) == {"image_occlusion"}


def test_entry_points():
    import __spark_entry__ as entry

    assert registry.FLAGSHIP in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())
