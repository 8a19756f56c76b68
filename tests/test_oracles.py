"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from conftest import SMOKE_DIR, as_rows
from verity.plans.catalog import ORACLES, QUERIES
from verity.sources.tables import DRIVER_TABLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in DRIVER_TABLES:
        p = Path(SMOKE_DIR) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, key):
    got = QUERIES[key](spark, SMOKE_DIR).toPandas()
    want = duck.execute(ORACLES[key]).df()
    gcols, grows = as_rows(got)
    wcols, wrows = as_rows(want)
    assert gcols == wcols
    assert len(grows) == len(wrows)
    assert grows == wrows


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    import __spark_entry__ as se

    df = se.entry(spark)
    assert {"question_id", "score", "accepted"} <= set(df.columns)
    assert df.count() == spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").count()
