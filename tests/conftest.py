"""Shared Spark session and small synthetic panels (seeded, as in the model's own tests)."""

from __future__ import annotations

import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelcast.session import build_session  # noqa: E402

PANEL_SCHEMA = "entity STRING, period INT, price DOUBLE, cash_rate DOUBLE, cpi DOUBLE, unemployment_rate DOUBLE"
ENTITIES = ["Alpha", "Bravo", "Charlie", "Delta", "Echo", "Foxtrot", "Golf", "Hotel"]
START = 2010 * 4  # 2010Q1


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[2]", shuffle_partitions=4, app_name="panelcast-tests")
    yield s
    s.stop()


def synthetic_rows(n_entities: int = 8, n_periods: int = 40, start: int = START):
    """Seeded panel: price trend + noise (floor 50), falling rate, rising cpi."""
    rows = []
    for e in range(n_entities):
        rng = np.random.default_rng(e)
        base = 100 + 10 * e
        for i in range(n_periods):
            price = max(50.0, base + 0.5 * i + rng.normal(0, 0.3))
            rate = max(0.1, 3 - 0.03 * i + rng.normal(0, 0.1))
            rows.append((ENTITIES[e], start + i, float(price), float(rate), 100 + 0.4 * i,
                         max(3.0, 5.5 - 0.02 * i)))
    return rows


@pytest.fixture(scope="session")
def sample_panel(spark):
    return spark.createDataFrame(synthetic_rows(), PANEL_SCHEMA)


@pytest.fixture(scope="session")
def two_entity_panel(spark):
    rows = []
    for i in range(10):
        rows.append(("Alpha", 2015 * 4 + i, 100.0 + i, 1.0, 100.0, 5.0))
        rows.append(("Bravo", 2015 * 4 + i, 200.0 + i, 1.0, 100.0, 5.0))
    return spark.createDataFrame(rows, PANEL_SCHEMA)
