"""Registered queries against their SQL twins on the smallest tables."""

import pathlib
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as contract
from checks.queries import QUERIES
from tools.compare_oracles import rows

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in pathlib.Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_the_entry_works_without_the_optional_package(tmp_path):
    """A copy of the repository without ``textmill/llm``, with and without what is built on it."""
    here = pathlib.Path(contract.__file__).resolve().parent
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__")
    for name in ("textmill", "checks"):
        shutil.copytree(here / name, tmp_path / name, ignore=skip)
    shutil.copy(here / "__spark_entry__.py", tmp_path)
    names = []
    for extra in (None, "corpus_pipeline.py", "textmill/llm"):
        if extra == "textmill/llm":
            (tmp_path / extra).mkdir()
        elif extra and (here / extra).exists():
            shutil.copy(here / extra, tmp_path)
        code = "import __spark_entry__ as e; print(*sorted(e.queries()))"
        names.append(subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True).stdout.split())
    assert names == [sorted(QUERIES)] * 3


def test_entry(spark):
    assert not contract.entry(spark).isEmpty()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_twin(spark, db, name):
    got = contract.queries()[name](spark, SF_DIR).toPandas()
    want = db.execute(contract.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
