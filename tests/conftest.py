from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from strata.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_session("local[*]", app_name="strata-tests", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture()
def cfg(spark):
    from strata.config import LayerConfig

    return LayerConfig.scratch(spark, "test")
