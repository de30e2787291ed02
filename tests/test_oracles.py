"""Every registered query of the library's own operators against its SQL counterpart, over the smallest tables."""

import math
import os

import duckdb
import pytest

from corpusproof.plans import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(frame):
    def plain(x):
        if hasattr(x, "item"):
            x = x.item()
        if x is None or (isinstance(x, float) and math.isnan(x)):
            return None
        return round(x, 6) if isinstance(x, float) else x

    frame = frame[sorted(frame.columns)]
    return list(frame.columns), sorted((tuple(map(plain, r)) for r in frame.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(spark, duck, name):
    assert rows(queries.QUERIES[name](spark, SF).toPandas()) == rows(duck.execute(queries.ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_gives_rows(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0
