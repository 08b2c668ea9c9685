import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerloom.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    spark = session(
        "ledgerloom tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(warehouse),
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()
