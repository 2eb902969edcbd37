import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from ledgerloom.session import build_session, release  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    work = tempfile.mkdtemp(prefix="ledgerloom-test-")
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": os.path.join(work, "warehouse"),
            "spark.checkpoint.dir": os.path.join(work, "shared"),
            "spark.ui.showConsoleProgress": "false",
            "spark.log.level": "ERROR",
        },
    )
    yield session
    release(session)
    session.stop()


@pytest.fixture()
def csv_dir(tmp_path):
    """Writes named CSV texts into one folder, bytes as given."""

    def write(**tables: str) -> str:
        for name, text in tables.items():
            (tmp_path / f"{name}.csv").write_bytes(text.encode())
        return str(tmp_path)

    return write
