"""Every registered query gives the rows its SQL gives."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from compare import connect, duck_result, spark_result  # noqa: E402

from ledgerloom.queries import ORACLES, QUERIES  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    schema, rows = spark_result(QUERIES[name](spark, FOLDER))
    assert rows, "a query without rows compares nothing"
    if name in ORACLES:
        expected_schema, expected = duck_result(duck, ORACLES[name])
        assert schema == expected_schema
        assert rows == expected
