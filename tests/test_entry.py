"""The driver contract, with or without the training-data subpackage."""

from __future__ import annotations

import __spark_entry__ as entry
from checks.registry import ORACLES, QUERIES


def test_registered_names():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())
