import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pressloom.session import build_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g", "spark.checkpoint.dir": "file:" + shared,
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def folder(tmp_path):
    return "file:" + str(tmp_path)


def rows(df, *cols):
    """Rows as a sorted list of tuples, with text for anything that does not sort."""
    found = df.select(*cols).collect() if cols else df.collect()
    return sorted((tuple(r) for r in found), key=lambda r: tuple(str(v) for v in r))
