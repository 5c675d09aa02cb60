"""Every catalog key against its DuckDB oracle on the smallest driver tables (row count,
column names, order-insensitive values)."""

import duckdb
import pytest

import __spark_entry__ as entry
from crease import catalog, oracle
from conftest import SMALL_SF
from tools.compare import TABLES, digest

SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP"}
KEYS = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL_SF}/{t}.parquet')")
    return c


def test_every_key_has_oracle_sql():
    assert set(catalog.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SMALL_SF)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    rel = con.sql(entry.oracle_sql()[key])
    duck_types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    assert spark_types == duck_types
    assert len(srows) == len(orows)
    assert digest(df.columns, srows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["batter", "innings", "not_outs", "runs", "average", "strike_rate"]
    assert df.count() > 0
