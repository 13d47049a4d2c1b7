"""Every registered query against its SQL on the smallest data set; the rest must give rows."""

import pathlib
import subprocess
import sys

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, normal


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_matches_sql(key, spark, sf_dir, duck):
    got = queries()[key](spark, sf_dir).toPandas()
    want = duck.execute(oracle_sql()[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)


@pytest.mark.parametrize("key", sorted(set(queries()) - set(oracle_sql())))
def test_gives_rows(key, spark, sf_dir):
    assert queries()[key](spark, sf_dir).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["bucket", "negative", "positive", "neutral"]
    assert entry(spark).count() > 0


def test_import_needs_no_spark_jars_and_no_session(tmp_path):
    """The registry loads where Spark's jars are not beside its Python package."""
    code = (
        "import pyspark, sys; pyspark.__file__ = sys.argv[1] + '/pyspark/__init__.py'\n"
        "import __spark_entry__ as e; from pyspark.sql import SparkSession\n"
        "assert len(e.oracle_sql()) > 90 and SparkSession.getActiveSession() is None"
    )
    root = pathlib.Path(__file__).resolve().parent.parent
    subprocess.run([sys.executable, "-c", code, str(tmp_path)], cwd=root, check=True, timeout=120)
