"""Shared fixtures: one local Spark session for the whole test run."""

from __future__ import annotations

import math
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from verity.session import local_session

    s = local_session("*", shuffle_partitions=8, app="verity-tests")
    yield s
    s.stop()


def norm(v):
    """Value normal form for multiset comparison (doubles to 9 dp, NaN = NULL)."""
    if v is None:
        return "NULL"
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else f"{round(v, 9):.9f}"
    return str(v)


def as_rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(norm(x) for x in rec) for rec in pdf[cols].itertuples(index=False))
