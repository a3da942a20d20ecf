"""Every registered query against its SQL on the smallest test data."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from lakemart.bindings import oracles
from lakemart.bindings import queries as bound
from lakemart.bindings.tables import SCHEMAS
from lakemart.operators import lookups

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}
QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{SF_DIR}/{file}'")
    return con


def text(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return repr(value) if isinstance(value, float) else str(value)


def compare(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    kinds = {column[0]: str(column[1]) for column in cursor.description}
    order = sorted(df.columns)
    assert order == sorted(kinds)
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        assert TYPES.get(kind, kind.upper()) == kinds[field.name].replace(" ", ""), field.name
    names = list(kinds)
    got = sorted((tuple(text(row[c]) for c in order) for row in df.collect()), key=str)
    expected = [tuple(text(row[names.index(c)]) for c in order) for row in cursor.fetchall()]
    assert got == sorted(expected, key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    compare(spark, duck, name)


# Queries with lookups, again as if no table were small enough to broadcast.
LARGE = (
    "fact_order_items",
    "fact_order_lifecycle",
    "fact_payments",
    "mart_category_performance",
    "dim_customer",
    "translate_category",
    "join_residual_interval",
    "fk_lookup_late_dimensions",
)


@pytest.mark.parametrize("name", LARGE)
@pytest.mark.parametrize("missing", [0, 10**6])
def test_query_without_broadcast(spark, duck, monkeypatch, name, missing):
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(lookups, "MISSING_KEYS", missing)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        compare(spark, duck, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_entry_points(spark):
    assert entry_points.entry(spark).count() == 1
    assert set(oracles.oracle_sql()) == set(bound.queries())
    assert set(ORACLES) <= set(QUERIES)


def test_stated_schemas_match_the_files(spark):
    for name, ddl in SCHEMAS.items():
        found = spark.read.parquet(f"{SF_DIR}/{name}.parquet").schema
        stated = spark.createDataFrame([], ddl).schema
        assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in stated]
