"""Every registered query against its SQL, over the smallest given tables."""

import os

import pytest

import __spark_entry__ as registered
from catalog import documents  # noqa: F401  (registers its queries)
from catalog.check import connection, difference
from catalog.queries import ORACLE, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    sql = ORACLE.get(name)
    assert sql is not None, "every query has its SQL"
    assert difference(df, duck, sql) is None


def test_all_fixed_places(spark):
    """The smallest table has fewer customers than there are places."""
    sf = "/root/testdata/sf0.01"
    assert difference(QUERIES["resolve_places"](spark, sf), connection(sf), ORACLE["resolve_places"]) is None


def test_entry(spark):
    assert registered.entry(spark).count() > 0


def test_all_are_registered():
    assert QUERIES.keys() <= registered.queries().keys()
    assert ORACLE.items() <= registered.oracle_sql().items()


def test_cubes_without_a_dimension_grow_with_the_customers(spark, monkeypatch):
    from catalog import documents

    sf, seen, flatten = "/root/testdata/sf0.001", [], documents.cubes.jsonstat_to_long
    monkeypatch.setattr(documents.cubes, "jsonstat_to_long", lambda docs, dims, **more: seen.append(docs.count()) or flatten(docs, dims, **more))
    customers = spark.read.parquet(f"{sf}/customer.parquet").count()
    assert documents.cube_without_a_dimension(spark, sf).count() == 25 + customers
    assert seen == [25 + customers]
