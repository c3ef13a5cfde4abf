"""Every registered query against its SQL twin on the smallest tables."""

from decimal import Decimal
from pathlib import Path

import pytest

import __spark_entry__ as entry
from inkledger.checks.oracle import oracles
from inkledger.checks.queries import registry

SF = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not there")


@pytest.fixture(scope="module")
def twin():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def shown(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    return format(value, "f") if isinstance(value, Decimal) else str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(shown(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry()))
def test_query_equals_its_twin(spark, twin, name):
    df = registry()[name](spark, SF)
    result = twin.execute(oracles()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(columns, result.fetchall())


def test_every_query_has_a_twin():
    assert set(registry()) == set(oracles())
    assert set(registry()) <= set(entry.queries()) and set(oracles()) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
