"""Every registered telemetry query against its SQL twin in DuckDB, on the smallest tables."""

import math
import os

import duckdb
import pytest

from ledgerspark.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def cell(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "NULL"
    if isinstance(x, bool):
        return str(x)
    if hasattr(x, "quantize") or isinstance(x, (int, float)):
        return repr(round(float(x), 6) + 0.0)
    return str(x).replace(" 00:00:00", "")


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in data)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    sql = registry.oracle_sql()[name]
    cur = duck.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows(names, cur.fetchall())


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())
