"""The same comparison on tables where single keys hold a third of the rows and events repeat."""

from __future__ import annotations

import os
import shutil

import duckdb
import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry

NAMES = (
    "clean_scan", "clean_two_prefixes", "constraint_report", "daily_listening_metrics", "dedup_events", "dim_artist", "dim_track",
    "duplicate_keys", "fact_count", "fact_stream", "gate_invalid", "gate_two_streams", "incremental_ingest", "lake_tables",
    "metric_alarms", "order_plays_daily_metrics", "order_plays_dedup", "order_plays_duplicate_keys",
    "order_plays_top_artists", "lake_pipeline", "raw_scan_concatenated", "stream_dedup", "stream_gate", "stream_upsert",
    "top10_artists", "top_artists", "upsert_fact", "upsert_idempotent",
)

EVENTS = """
SELECT CASE WHEN event_id % 3 = 1 AND event_id % 2 = 0 THEN 4 WHEN event_id % 9 = 2 THEN event_id - 1 ELSE event_id END AS event_id,
       ts + to_days(CAST(event_id % 2 AS INTEGER)) AS ts,
       CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id,
       CASE WHEN event_id % 3 = 2 THEN 'click' ELSE event_type END AS event_type,
       value,
       CASE WHEN event_id % 3 = 0 THEN '{"k": 5}' ELSE props END AS props
FROM source
UNION ALL SELECT * FROM source WHERE event_id % 50 = 0
"""

LINES = """
SELECT CASE WHEN l_orderkey % 3 = 0 THEN 3 ELSE l_orderkey END AS l_orderkey,
       CASE WHEN l_orderkey % 3 = 1 THEN 5 ELSE l_partkey END AS l_partkey,
       * EXCLUDE (l_orderkey, l_partkey)
FROM source
"""


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    from conftest import SF_DIR

    out = str(tmp_path_factory.mktemp("skewed"))
    for name in os.listdir(SF_DIR):
        shutil.copy(f"{SF_DIR}/{name}", out)
    with duckdb.connect() as con:
        for name, sql in (("events", EVENTS), ("lineitem", LINES)):
            con.execute(f"CREATE OR REPLACE VIEW source AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
            os.chmod(f"{out}/{name}.parquet", 0o644)
            con.execute(f"COPY ({sql}) TO '{out}/{name}.parquet' (FORMAT parquet)")
    return out


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, skewed, name):
    with connect(skewed) as con:
        assert compare(entry.queries()[name](spark, skewed), con, entry.oracle_sql()[name]) == ""
