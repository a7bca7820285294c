"""Every query of the register against its SQL, and the entry points."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tempora.plans.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{FOLDER}/{f}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_the_rows_of_its_sql(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    found = db.execute(ORACLE_SQL[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    expected = sorted(tuple(str(dict(zip(names, row, strict=True))[c]) for c in order) for row in found.fetchall())
    assert sorted(tuple(str(r[c]) for c in order) for r in df.collect()) == expected


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and sum(r["posts"] for r in rows) == 150


def test_names(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_iso_date_has_every_order(spark, tmp_path):
    keys = [1, 99_999_999, 100_000_000, 10**12]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    found = {r["o_orderkey"]: r["day"] for r in QUERIES["iso_date"](spark, str(tmp_path)).collect()}
    assert sorted(found) == keys and found[1] == "1970-01-02" and all(found.values())


def test_iso_date_of_far_years_is_that_of_its_sql(spark, tmp_path):
    keys = [0, 149_999, 2_052_558, 2_052_559, 8_999_999, 69_999_999, 70_000_000, 10**12, 2**63 - 1, -1, -320_000, -500_000, -503_554, -503_555, -600_000, -69_999_999, -(2**63), None]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM read_parquet('{tmp_path}/orders.parquet/*.parquet')")
    expected = dict(con.execute(ORACLE_SQL["iso_date"]).fetchall())
    assert expected[2_052_559] == "10000-01-01" and expected[-503_555] == "-1-12-31"
    assert {r["o_orderkey"]: r["day"] for r in QUERIES["iso_date"](spark, str(tmp_path)).collect()} == expected


def test_asof_reaches_the_scan(spark):
    plan = QUERIES["asof_active"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(l_shipdate" in plan.split("PushedFilters: ")[1].split("ReadSchema")[0]


def test_recursive_tree_reaches_every_part(spark):
    assert QUERIES["recursive_tree"](spark, FOLDER).count() == spark.read.parquet(f"{FOLDER}/part.parquet").count()
