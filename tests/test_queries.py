import os
from pathlib import Path

import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
DUCK_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN", "double": "DOUBLE"}


def normal(table):
    return sorted([tuple(row) for row in table], key=repr)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


@needs_tables
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    sql = duck.execute(entry.oracle_sql()[name])
    types = {c[0]: str(c[1]) for c in sql.description}
    assert types == {f.name: DUCK_TYPES[f.dataType.simpleString()] for f in df.schema.fields}
    names = [c[0] for c in sql.description]
    want = [[row[names.index(c)] for c in columns] for row in sql.fetchall()]
    got = [[row[c] for c in columns] for row in df.collect()]
    assert got and normal(got) == normal(want)


@needs_tables
def test_entry(spark):
    assert entry.entry(spark).columns == ["path", "size", "type", "architecture", "imports", "exports"]
