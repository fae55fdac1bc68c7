"""Every registered query of the library beside its SQL in DuckDB."""

import duckdb
import pytest

from panelspark.plans import catalogue
from tools.compare import TABLES, compare

NAMES = sorted(catalogue.queries())


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, sf_dir, name):
    said = compare(spark, con, name, catalogue.queries()[name], catalogue.oracle_sql().get(name), sf_dir)
    assert ": ok" in said or "no SQL" in said, said


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_are_listed_without_a_session():
    """Importing the entry and naming its queries starts no Spark."""
    import subprocess
    import sys
    from pathlib import Path

    code = "import __spark_entry__ as e, pyspark; print(len(e.queries()) >= len(e.oracle_sql()) > 0, pyspark.SparkContext._active_spark_context is None)"
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parent.parent, capture_output=True, text=True, check=True)
    assert out.stdout.split()[-2:] == ["True", "True"]
