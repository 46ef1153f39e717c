"""Every registered query of the library against its SQL, on the smallest tables."""

import collections
import os

import pytest

from barloom.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def norm(v):
    return "None" if v is None or v != v else repr(v + 0.0) if isinstance(v, float) else str(v)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    got = collections.Counter(tuple(norm(r[c]) for c in sorted(df.columns)) for r in df.collect())
    cur = duck.execute(registry.ORACLE_SQL[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    want = collections.Counter(tuple(norm(r[cols.index(c)]) for c in sorted(cols)) for r in cur.fetchall())
    assert got == want
