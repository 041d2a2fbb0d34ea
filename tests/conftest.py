import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from reviewloom.session import build_session

    session = build_session("tests", 8, spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
                            spark__ui__showConsoleProgress="false", spark__checkpoint__dir=tempfile.mkdtemp(prefix="reviewloom-tests-"))
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture()
def folder(spark):
    """A fresh folder below the session's shared folder."""
    from reviewloom.session import shared_dir

    return shared_dir(spark, "test")
