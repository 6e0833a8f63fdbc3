"""Every query of the catalogue against its SQL in DuckDB, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from lodestone.plans import catalogue

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        src = f"{path}/*.parquet" if os.path.isdir(path) else path
        c.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{src}'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name, tmp_path):
    df = catalogue.QUERIES[name](spark, SF)
    df.write.parquet(str(tmp_path / "out"))
    if name not in catalogue.ORACLE:
        assert df.columns
        return
    duck.execute(f"CREATE OR REPLACE TEMP TABLE a AS {catalogue.ORACLE[name]}")
    duck.execute(f"CREATE OR REPLACE TEMP TABLE b AS SELECT * FROM '{tmp_path}/out/*.parquet'")
    names = sorted(r[0] for r in duck.execute("DESCRIBE a").fetchall())
    assert names == sorted(r[0] for r in duck.execute("DESCRIBE b").fetchall())
    cols = ", ".join(f'"{n}"' for n in names)
    for x, y in (("a", "b"), ("b", "a")):
        assert duck.execute(f"SELECT {cols} FROM {x} EXCEPT ALL SELECT {cols} FROM {y} LIMIT 3").fetchall() == []


def test_entry_imports_and_lists_queries():
    import __spark_entry__ as e

    assert set(catalogue.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
