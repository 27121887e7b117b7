"""Every query with SQL against DuckDB, on the smallest tables; the entry point without the optional subpackage."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from millrace import oracles, queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    text = lambda v: "" if v is None else repr(v) if isinstance(v, float) else str(v)
    return sorted(columns), sorted(tuple(text(row[i]) for i in order) for row in rows)


def same(df, cursor):
    assert canonical(df.collect(), df.columns) == canonical(cursor.fetchall(), [c[0] for c in cursor.description])


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    same(queries.queries()[name](spark, SF), duck.execute(oracles.oracle_sql()[name]))


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(oracles.oracle_sql())))
def test_other_queries_run(spark, name):
    assert queries.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry_point_without_the_optional_subpackage(tmp_path):
    root = Path(__file__).resolve().parent.parent
    for name in ("millrace", "__spark_entry__.py"):
        source = root / name
        shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__")) if source.is_dir() else shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; assert e.queries() and not [q for q in e.queries() if q.startswith('op')]; e.oracle_sql()"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
