"""Every catalogue query against its SQL in DuckDB, on the smallest tables."""

import duckdb
import pytest

from landweave.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events embeddings".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_sql(spark, duck, name):
    got = catalog.queries()[name](spark, SF).toArrow()
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert got.num_rows > 0
        return
    duck.register("got", got)
    duck.execute(f"CREATE OR REPLACE TEMP TABLE want AS {sql}")
    columns = sorted(got.column_names)
    assert columns == sorted(r[0] for r in duck.execute("DESCRIBE want").fetchall())
    names = ", ".join(f'"{c}"' for c in columns)
    for a, b in (("got", "want"), ("want", "got")):
        assert duck.execute(f"SELECT {names} FROM {a} EXCEPT ALL SELECT {names} FROM {b} LIMIT 3").fetchall() == []


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


def test_filters_and_columns_reach_the_scan(spark):
    plan = catalog.scene_filter(spark, SF)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(value)" in plan and "LessThan(value,30.0)" in plan
    assert "props" not in plan.split("== Physical Plan ==")[1]
