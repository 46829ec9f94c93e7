import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from stockloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session("4", "tests", {
        "spark.checkpoint.dir": str(folder),
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.warehouse.dir": str(folder / "warehouse"),
    })
    yield session
    session.stop()
