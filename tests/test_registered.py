"""Every registered query against its SQL, on whole tables."""

import datetime
import math
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from foldwright.checks.oracles import statements  # noqa: E402
from foldwright.checks.queries import registered  # noqa: E402

QUERIES, SQL = registered(), statements()
TABLES = ["customer", "orders", "lineitem", "embeddings"]
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.001/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.date()
    return value


def ordered(rows, columns, order):
    places = [columns.index(c) for c in order]
    return sorted((tuple(plain(row[i]) for i in places) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    expected = duck.execute(SQL[name])
    columns = [c[0] for c in expected.description]
    assert sorted(columns) == sorted(result.columns)
    types = dict(result.dtypes)
    assert {c[0]: str(c[1]) for c in expected.description} == {c: TYPES[t] for c, t in types.items()}
    order = sorted(columns)
    assert ordered(result.collect(), result.columns, order) == ordered(expected.fetchall(), columns, order)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_fitted_query_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["AGE_GROUP", "n", "avg_age", "approval_rate"]
    assert result.count() == 6


def test_every_statement_has_a_query():
    assert not set(SQL) - set(QUERIES)
    assert not set(contract.oracle_sql()) - set(contract.queries())
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("left", [[], ["__init__.py"], ["__pycache__"]])
def test_the_entry_needs_no_subpackage(tmp_path, left):
    """Without the operations of training data, or with an empty folder of theirs, the other queries are registered."""
    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "foldwright", tmp_path / "foldwright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    if left:
        (tmp_path / "foldwright" / "llm").mkdir()
    for name in left:
        if name.endswith(".py"):
            (tmp_path / "foldwright" / "llm" / name).write_text("")
        else:
            (tmp_path / "foldwright" / "llm" / name).mkdir()
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": ""}, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == [str(len(QUERIES)), str(len(SQL))], done.stderr
