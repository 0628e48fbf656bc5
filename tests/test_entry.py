"""The driver contract: entry runs, every query has an oracle, and each query
agrees with its oracle on the smallest test tables."""

import datetime as dt
import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as entry_mod
from tierlake.sources.fixtures import TABLES, table_path

from conftest import SF_SMALL


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["id", "year", "month", "day", "total_revenue"]
    assert df.count() > 0


def test_every_query_of_the_library_has_an_oracle():
    from tierlake.catalog import ORACLE_SQL, QUERIES

    assert set(QUERIES) == set(ORACLE_SQL)
    # Other queries may have none; their own tests hold them against brute force.
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{round(v, 6):.6f}"
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return str(v)


def _digest(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted(
        "|".join(_norm(r[i]) for i in order) for r in data)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return con


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "TIMESTAMP": "timestamp_ntz", "DATE": "date", "BOOLEAN": "boolean"}


@pytest.mark.parametrize("name", sorted(entry_mod.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    """Rows, column names and column types."""
    df = entry_mod.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(entry_mod.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert _digest(df.columns, got) == _digest(cols, want)
    described = duck.execute(f"DESCRIBE {entry_mod.oracle_sql()[name]}").fetchall()
    assert dict(df.dtypes) == {row[0]: DUCK_TO_SPARK.get(row[1], row[1]) for row in described}


def test_only_the_absence_of_the_corpus_operators_is_put_up_with(tmp_path):
    """Without both folders the other queries load; a broken import inside them is not hidden."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry_mod.__file__))
    copy = f"{tmp_path}/copy"
    shutil.copytree(root, copy, ignore=lambda d, names: [n for n in names if n in (".git", "llm", "corpus_pipeline.py", "__pycache__")])
    ask = [sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries())"]
    got = subprocess.run(ask, cwd=copy, capture_output=True, text=True)
    from tierlake.catalog import QUERIES
    assert got.stdout.split() == [str(len(QUERIES)), "False"], got.stderr
    with open(f"{copy}/corpus_pipeline.py", "w") as f:
        f.write("import tierlake.no_such_module\n")
    got = subprocess.run(ask, cwd=copy, capture_output=True, text=True)
    assert "no_such_module" in got.stderr and got.returncode != 0
