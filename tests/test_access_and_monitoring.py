from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from streamlake.operators import access, monitoring


@pytest.fixture
def mapping(spark):
    rows = [("admins", "*", "*"), ("web", "platform", "web"), ("both", "platform", "web"), ("both", "platform", "ios"), ("north", "market", "n"), ("trap", "platform", "*")]
    return spark.createDataFrame(rows, "principal string, dimension string, value string")


@pytest.mark.parametrize(
    ("principal", "expected"),
    [("admins", [1, 2, 3, 4]), ("web", [1]), ("both", [1, 2]), ("north", []), ("nobody", []), ("trap", [])],
)
def test_rows_by_principal(spark, mapping, principal, expected):
    events = spark.createDataFrame([(1, "web"), (2, "ios"), (3, "tv"), (4, None)], "id int, platform string")
    assert sorted(r["id"] for r in access.visible_rows(events, mapping, principal).collect()) == expected


def test_market_grants_count_once_the_column_exists(spark, mapping):
    events = spark.createDataFrame([(1, "n"), (2, "s")], "id int, market string")
    assert [r["id"] for r in access.visible_rows(events, mapping, "north").collect()] == [1]


def test_access_needs_no_join(spark, mapping):
    plan = access.visible_rows(spark.range(5).withColumn("platform", F.lit("web")), mapping, "web")
    assert "Join" not in plan._jdf.queryExecution().executedPlan().toString()


def logs(spark, rows):
    df = spark.createDataFrame(rows, "log_id int, ts string, log_group string, message string")
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def test_triage_takes_the_newest_failures(spark):
    rows = [(i, f"2026-01-01 00:{i % 60:02d}:00", "g", m) for i, m in enumerate(["ok", "x ERROR", "FAILED", "TIMEOUT!", "error"])]
    assert [r["log_id"] for r in monitoring.log_triage(logs(spark, rows), limit=2).collect()] == [3, 2]


def test_log_metrics_by_group_and_window(spark):
    rows = [
        (1, "2026-01-01 00:00:00", "raw_to_clean", "run FAILED"),
        (2, "2026-01-01 00:04:59", "raw_to_clean", "FAILED with TIMEOUT"),
        (3, "2026-01-01 00:05:00", "raw_to_clean", "FAILED"),
        (4, "2026-01-01 00:00:00", "warehouse", "FAILED"),
        (5, "2026-01-01 00:00:00", "warehouse", "ERROR capacity"),
    ]
    got = {(str(r[0])[11:16], r[1]): r[2] for r in monitoring.log_metrics(logs(spark, rows)).collect()}
    assert got == {
        ("00:00", "job_failed"): 2, ("00:05", "job_failed"): 1, ("00:00", "job_timeout"): 1,
        ("00:00", "warehouse_errors"): 1, ("00:00", "warehouse_capacity"): 1,
    }


@pytest.mark.parametrize(
    ("metric", "values", "breach"),
    [
        ("function_errors", [1], True), ("function_errors", [0, 0], False),
        ("stream_iterator_age_ms", [60000], False), ("stream_iterator_age_ms", [10, 60001], True),
        ("stream_iterator_age_ms", [40000, 40000], False),
        ("delivery_success", [0], True), ("delivery_success", [0, 1], False), ("delivery_success", [], False),
        ("query_bytes_scanned", [1073741824], False), ("query_bytes_scanned", [1073741824, 1], True),
        ("dead_letter_depth", [1, 0], True), ("not_monitored", [99], False),
    ],
)
def test_alarm_thresholds(spark, metric, values, breach):
    points = spark.createDataFrame([("2026-01-01 00:01:00", metric, v) for v in values] or [], "ts string, metric string, value long")
    alarms = monitoring.metric_alarms(points.withColumn("ts", F.col("ts").cast("timestamp")), monitoring.alarm_rules(spark))
    assert alarms.count() == int(breach)


def test_ten_rules():
    assert len(monitoring.ALARM_RULES) == 10


def test_lag(spark):
    rows = [("2026-01-01 00:00:00", "2026-01-01 00:01:00"), ("2026-01-01 00:00:00", "2026-01-01 00:05:30")]
    df = spark.createDataFrame(rows, "event_ts string, arrival_ts string")
    out = monitoring.stream_lag(df.withColumns({c: F.col(c).cast("timestamp") for c in df.columns})).orderBy("window_start")
    assert [(r["max_lag_ms"], r["breach"]) for r in out.collect()] == [(60000, False), (330000, True)]


def test_recent_queries(spark):
    df = spark.createDataFrame([(i, i % 3, i * 10, "S") for i in range(9)], "query_id int, submitted_at int, bytes_scanned int, status string")
    assert [r["query_id"] for r in monitoring.recent_queries(df, 2).collect()] == [8, 5]
