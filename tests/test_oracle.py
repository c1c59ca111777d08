"""Every registered query against its SQL, or by row count where SQL cannot state it."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from scoremill_checks import oracles, queries
from scoremill_checks.compare import difference
from tests.conftest import SF_DIR

QUERIES, ORACLES = queries.queries(), oracles.oracle_sql()


@pytest.mark.parametrize("name", QUERIES)
def test_query(name, spark, duckdb_tables):
    result = QUERIES[name](spark, SF_DIR)
    if name in ORACLES:
        assert difference(result, duckdb_tables.sql(ORACLES[name]).to_arrow_table()) is None
    else:
        assert result.count() > 0


def test_only_boosted_trees_lack_sql():
    assert set(QUERIES) - set(ORACLES) == {"gbt_primary", "attribution_primary"}
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["feature", "iv", "predictive_power"]


def test_entry_covers_every_variable(spark):
    every = entry.queries()["iv_all_variables"](spark, "/root/testdata/sf0.001").count()
    assert entry.entry(spark).count() == every > 8


@pytest.mark.parametrize("pipeline", [True, False])
def test_the_rest_stands_without_the_separable_folders(tmp_path, pipeline):
    """In a copy without them, with or without the pipeline's file, every other query is there."""
    here, copy = Path(entry.__file__).parent, tmp_path / "copy"
    left_out = shutil.ignore_patterns("llm", ".git", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(here, copy, ignore=left_out)
    code = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    names, stated = run.stdout.splitlines()
    assert set(names.split()) == set(QUERIES) and set(stated.split()) == set(ORACLES)
