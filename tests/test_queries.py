"""All registered queries against DuckDB on the same files."""

from __future__ import annotations

import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from checks import ORACLES, QUERIES

FOLDER = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def counted(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(round(v, 6) if isinstance(v := row[i], float) else v for i in order) for row in rows)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLES) <= set(__spark_entry__.oracle_sql())


def test_the_library_works_without_the_training_data_operators(tmp_path):
    root = Path(__spark_entry__.__file__).parent
    for name in ("quayside", "checks", "__spark_entry__.py"):
        (tmp_path / name).symlink_to(root / name) if name != "quayside" else shutil.copytree(
            root / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__")
        )
    shutil.copy(root / "__spark_entry__.py", tmp_path / "entry_copy.py")
    program = "import entry_copy as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-B", "-c", program], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))]


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    rows = QUERIES[name](spark, str(FOLDER))
    result = duck.execute(ORACLES[name])
    columns = [column[0] for column in result.description]
    assert sorted(rows.columns) == sorted(columns)
    expected = result.fetchall()
    assert expected, "an empty result shows nothing"
    assert counted(rows.collect(), rows.columns) == counted(expected, columns)


def test_entry(spark):
    assert len(__spark_entry__.entry(spark).columns) == 49
