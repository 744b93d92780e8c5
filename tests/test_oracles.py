"""Every registered query against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

from plotkeep.plans import all_queries  # noqa: F401
from plotkeep.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
NAMES = sorted(ORACLES)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def shown(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return f"{type(value).__name__}:{value}"


@pytest.mark.parametrize("name", NAMES)
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted(tuple(shown(r[i]) for i in order) for r in cursor.fetchall())
    assert sorted(tuple(shown(r[c]) for c in columns) for r in df.collect()) == expected
