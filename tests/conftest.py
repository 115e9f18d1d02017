from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent
sys.path[:0] = [str(HERE), str(HERE.parent)]

from samples import CATALOG_LINES  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from basketmine import build_session
    s = build_session("local[4]", 4)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bm-test-ckpt-"))
    yield s


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="bm-test-")


@pytest.fixture(scope="session")
def catalog_lines_df(spark):
    return spark.createDataFrame([(line,) for line in CATALOG_LINES], "value string")
