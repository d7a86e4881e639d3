"""The registered queries against their SQL."""

from pathlib import Path

import duckdb
import pytest
from conftest import FOLDER, rows

from __spark_entry__ import entry, oracle_sql, queries
from verification.queries import QUERIES

# These publish tables or run streams and are exercised by the other modules as well.
SLOW = {
    "archive_repeated_batch",
    "archive_repeated_errors",
    "expired_archive",
    "freshness_visible",
    "reconciled_now",
    "stream_catalog_change",
    "stream_out_of_order",
    "stream_set_aside",
    "stream_two_consumers",
    "stream_untimely_events",
    "stream_untimely_outcomes",
    "archive_errors",
    "archive_roundtrip",
    "archive_stream",
    "archive_table_scan",
    "drift_corrected",
    "reconcile_lookback",
    "reconcile_published",
    "stream_capture_events",
    "stream_minute_counts",
    "stream_late_rows",
    "stream_replay_idempotent",
    "stream_restart",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql())


def test_entry_runs(spark):
    assert entry(spark).columns == ["campaign_id", "minute_bucket", "click_count"]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query_matches_sql(spark, duck, name):
    frame = queries()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    result = duck.execute(oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == columns
    order = [names.index(column) for column in columns]
    expected = sorted((tuple(row[i] for i in order) for row in result.fetchall()), key=repr)
    assert rows(frame, *columns) == expected
