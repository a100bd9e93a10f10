from __future__ import annotations

import os
import sys
from datetime import timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from series_vectors import START  # noqa: E402

from slotcast.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("4", partitions=4, memory="4g")


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def series(spark):
    """Frame of one value column on a regular grid: ``series([1, None], minutes=60)``."""

    def build(values, minutes=15, name="block_load", key="a", start=START):
        rows = [
            (key, start + timedelta(minutes=minutes * i), None if x is None else float(x))
            for i, x in enumerate(values)
        ]
        return spark.createDataFrame(
            rows, f"series_id string, datetime timestamp_ntz, {name} double"
        )

    return build
