"""Every query with SQL gives the rows that DuckDB gives for it."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from geosieve.plans import registry

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    return v


def key(row):
    return tuple((v is not None, str(v)) for v in row)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_against_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    want = duck.sql(registry.ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = lambda xs: sorted((tuple(plain(v) for v in x) for x in xs), key=key)
    a = rows(tuple(r[c] for c in columns) for r in got.collect())
    b = rows(want.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())
    assert len(a) == len(b) and len(a) > 0
    assert a == b


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("gone", [("geosieve/llm", "corpus_pipeline.py"), ("geosieve/llm",)])
def test_without_the_corpus_folders(tmp_path, gone):
    """In a copy without them the rest still imports and registers its own queries."""
    root = Path(__file__).resolve().parents[1]
    for name in ("geosieve", "__spark_entry__.py", "corpus_pipeline.py"):
        if (root / name).is_dir():
            shutil.copytree(root / name, tmp_path / name, ignore=lambda d, names: [n for n in names if str((Path(d) / n).relative_to(root)) in gone or n == "__pycache__"])
        elif name not in gone and (root / name).exists():
            shutil.copy(root / name, tmp_path / name)
    code = "import __spark_entry__ as e; print(len(e.queries()), any(q.startswith('op') for q in e.queries()), 'pipeline' in e.oracle_sql())"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": ""}, capture_output=True, text=True, check=True)
    assert out.stdout.split() == [str(len(registry.QUERIES)), str(any(q.startswith("op") for q in registry.QUERIES)), "False"]
