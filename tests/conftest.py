from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidewatch.session import get_spark

    s = get_spark(8, shuffle_partitions=8, app="tidewatch-tests")
    yield s


@pytest.fixture(scope="session")
def students(spark):
    from tests.fixtures import student_frame

    return student_frame(spark)
