"""Registered queries against their SQL twins on the small test tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tidymart.plans.catalog import QUERIES
from tidymart.plans.oracle import ORACLE

FOLDER = os.environ.get("TIDYMART_TEST_FOLDER", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

# One per family; TIDYMART_ALL_QUERIES=1 runs all of them.
SOME = ("text_fold", "tidy_weighted", "merge_outer", "merge_qc", "column_profile", "impute_mode", "stream_rejects")
NAMES = sorted(ORACLE) if os.environ.get("TIDYMART_ALL_QUERIES") else SOME

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


def canonical(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        return repr(round(v, 9)) if isinstance(v, float) and math.isfinite(v) else repr(v)

    return sorted(columns), sorted(tuple(cell(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, database, name):
    df = entry.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "CartesianProduct" not in plan
    cursor = database.execute(entry.oracle_sql()[name])
    expected = canonical([d[0] for d in cursor.description], cursor.fetchall())
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == expected


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
