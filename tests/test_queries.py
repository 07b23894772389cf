"""Every registered query against its SQL equivalent in another engine."""

from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from check import compare  # noqa: E402
from tallybook.plans import catalog  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in sorted(Path(SF).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, con, name):
    verdict = compare(spark, con, name, SF)
    assert verdict.startswith(("ok", "rows only")) and "TYPES" not in verdict, verdict


def test_every_query_has_an_equivalent():
    assert set(catalog.queries()) <= set(oracle_sql()) <= set(queries())
    assert set(catalog.queries()) <= set(queries())


def test_flagship(spark):
    counts = {r["match_status"]: r["count"] for r in entry(spark).collect()}
    assert counts == {"MATCHED": 1425, "PARTIAL": 30, "UNMATCHED": 105}
