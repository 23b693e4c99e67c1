"""A representative set of registered queries against their DuckDB SQL
(the full set: ``python tools/check_oracle.py``)."""

import collections
import sys

import duckdb
import pytest

from fleetscope.fixtures import TABLES
from fleetscope.plans.queries import ORACLES, QUERIES
from tests.conftest import SF001

sys.path.insert(0, ".")
from tools.check_oracle import rows_of  # noqa: E402

SUBSET = ["exception_reports", "breadcrumbs", "sessions", "identity_links", "flush_status",
          "cap_queue", "form_batches", "batch_disposition", "retry_schedule", "sanitize_properties",
          "event_payload", "idle_sessions", "environment_dim", "report_frames", "manifest"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    got = collections.Counter(rows_of(df.columns, [tuple(r) for r in df.collect()]))
    want = collections.Counter(rows_of(ocols, res.fetchall()))
    assert got == want
