from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quaverlake.session import build

    session = build("local[4]", 4, **{"spark.driver.memory": "3g", "spark.sql.adaptive.coalescePartitions.enabled": "true"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data() -> str:
    return DATA
