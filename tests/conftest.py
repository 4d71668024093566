from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.session import spark_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return spark_session()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
