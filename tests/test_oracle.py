"""Every registered query on the driver's smallest tables, against DuckDB where SQL can say it."""

from pathlib import Path

import pytest

from verification import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    from verification.compare import database

    return database(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    from verification.compare import difference

    assert name in ORACLES
    assert difference(spark, con, name, SF_DIR) is None
