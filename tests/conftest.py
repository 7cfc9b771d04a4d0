import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from grainfold.session import local_session  # noqa: E402

ROOT = Path(__file__).resolve().parent.parent
TABLES = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    session = local_session(4, **{"spark.checkpoint.dir": folder, "spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def text_file(tmp_path):
    """Write lines to a new file and give its path."""

    def write(name, *lines):
        path = tmp_path / name
        path.write_text("".join(line + "\n" for line in lines))
        return str(path)

    return write


@pytest.fixture
def settings(spark):
    """Set session options for one test."""
    before = {}

    def set_all(**values):
        for key, value in values.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_all
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def lines_in(folder):
    """All lines of the part files, in file order."""
    parts = sorted(Path(folder).glob("part-*"))
    return [line for part in parts for line in part.read_text().splitlines()]
