"""Every registered query against its SQL on the smallest data."""

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as entry
from cabrank import registry
from cabrank.registry.base import stepped, stepped_sql
from cabrank.sources import bindings
from conftest import SMALL

QUERIES, ORACLE = registry.QUERIES, registry.ORACLE
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in bindings.TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return float(value) if isinstance(value, float) else value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(str(plain(row[i])) for i in order) for row in rows)


def test_only_queries_without_sql_are_the_listed_ones():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SMALL)
    assert len(set(result.columns)) == len(result.columns)
    rows = result.collect()
    if name not in ORACLE:
        assert rows
        return
    expected = duck.sql(ORACLE[name])
    types = {"tinyint": "integer", "string": "varchar", "int": "integer", "timestamp_ntz": "timestamp"}
    assert {n: types.get(t, t) for n, t in result.dtypes} == {
        n: str(t).lower() for n, t in zip(expected.columns, expected.types)
    }
    assert table(result.columns, rows) == table(expected.columns, expected.fetchall())


def test_all_are_in_the_entry():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_steps_keep_large_and_special_values(spark, duck):
    values = [0.0, 1.25, -3.0000004, 12345.678, 1e10, 1e14, -1e200, float("inf"), float("-inf"), float("nan")]
    rows = stepped(spark.createDataFrame([(v, v) for v in values], "x double, y double"), "x").collect()
    assert [str(r.y) for r in rows] == [str(v) for v in values]
    assert [str(r.x) for r in rows[4:]] == [str(v) for v in values[4:]]
    assert [r.x for r in rows[:4]] == pytest.approx(values[:4], abs=1e-2)
    casts = ", ".join(f"('{v}'::DOUBLE)" for v in values)
    expected = duck.sql(f"SELECT {stepped_sql('x')} FROM (VALUES {casts}) t(x)").fetchall()
    assert [str(r.x) for r in rows] == [str(x) for (x,) in expected]


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(bindings.TABLES))
def test_source_schemas_hold_at_every_scale(spark, name):
    for scale in ("0.001", "0.01", "0.1"):
        found = spark.read.parquet(f"/root/testdata/sf{scale}/{name}.parquet")
        declared = spark.createDataFrame([], bindings.TABLES[name])
        assert found.dtypes == declared.dtypes
