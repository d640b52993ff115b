from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streamlake.operators.dedup import duplicate_keys, first_per_key, require_unique


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=40))
def test_first_per_key_is_the_minimum_in_any_input_order(spark, rows):
    schema = "event_id int, played_at int, d int"
    expected = {}
    for k, t, d in rows:
        expected[k] = min(expected.get(k, (t, d)), (t, d))
    for order in (rows, rows[::-1]):
        out = first_per_key(spark.createDataFrame(order, schema).repartition(3))
        assert {r["event_id"]: (r["played_at"], r["d"]) for r in out.collect()} == expected
        assert first_per_key(out).count() == len(expected)


def test_a_key_with_a_third_of_the_rows_leaves_each_map_task_as_one_row(spark):
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    df = spark.range(0, 30000, 1, 6).select(hot.alias("event_id"), F.col("id").alias("played_at"))
    out = first_per_key(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.count("WindowGroupLimit") == 2
    assert out.count() == 20001
    assert out.filter("event_id = 0").first()["played_at"] == 0


def test_rows_with_unorderable_columns(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 2, map('x', 1)), ('a', 1, map('y', 2)) AS t(event_id, played_at, m)")
    assert first_per_key(df).first()["m"] == {"y": 2}


def test_missing_key_column(spark):
    with pytest.raises(ValueError, match="event_id"):
        first_per_key(spark.range(3))


def test_duplicate_report_and_check(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "event_id string")
    assert [tuple(r) for r in duplicate_keys(df).collect()] == [("a", 2)]
    with pytest.raises(ValueError, match="'a' 2 times"):
        require_unique(df, "event_id")
    with pytest.raises(ValueError, match="None"):
        require_unique(spark.createDataFrame([(None,)], "event_id string"), "event_id")
    require_unique(df.distinct(), "event_id")
