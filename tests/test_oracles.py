"""Every registered query against its reference SQL, over the smallest test tables."""

import re
import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")
# The training-data queries have their own tests, some of them without SQL.
QUERIES = {name: fn for name, fn in driver.queries().items() if not re.match(r"op\d+_|pipeline$", name)}
SQL = driver.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return connection


def _plain(value):
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else value


def test_every_query_has_reference_sql():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    found = duck.execute(SQL[name])
    order = [d[0] for d in found.description]
    assert sorted(order) == columns
    pick = [order.index(c) for c in columns]
    expected = Counter(tuple(_plain(row[i]) for i in pick) for row in found.fetchall())
    got = Counter(tuple(_plain(v) for v in row) for row in df.select(*columns).collect())
    assert got == expected


@pytest.mark.parametrize("gone", [("vitrine/llm",), ("vitrine/llm", "corpus_pipeline.py")])
def test_the_entry_point_works_without_the_training_data_folders(tmp_path, gone):
    root = Path(driver.__file__).resolve().parent
    skipped = [root / g for g in (*gone, "tests", ".git")]
    shutil.copytree(root, tmp_path / "copy", ignore=lambda folder, names: [n for n in names if Path(folder) / n in skipped or n == "__pycache__"])
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(QUERIES))] * 2
