import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from threadline.session import local_session  # noqa: E402

SF_DIR = os.environ.get("THREADLINE_TEST_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, 8, app="threadline-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def turns_frame(spark, convs):
    """Build a flat turn table from {conv_id: [(role, text), ...]}."""
    rows = [(cid, i, r, t) for cid, turns in convs.items() for i, (r, t) in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
