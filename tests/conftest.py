import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from scoremill import tuned  # noqa: E402
from scoremill_checks.compare import duck, session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    spark = tuned(session("4"))
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def duckdb_tables():
    return duck(SF_DIR)
