from __future__ import annotations

import json

import pytest

from bazaarspark.session import session
from bazaarspark.sources.landing import from_text


@pytest.fixture(scope="session")
def spark():
    return session("tests")


@pytest.fixture
def land(spark):
    """Landing frame from Python objects (or raw text lines)."""

    def make(*records):
        lines = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
        return from_text(spark.createDataFrame(lines, "value string"))

    return make
