"""The physical plans have the shape that holds at scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from streamlake.operators import marts, modeling, quality
from streamlake.operators.upsert import upsert
from streamlake.plans import fixtures as fx
from streamlake.plans.pipelines import classify_objects
from streamlake.plans.queries import QUERIES

WRITES_FILES = {
    "raw_scan", "raw_scan_concatenated", "clean_scan", "csv_scan", "lake_tables", "lake_pipeline", "quarantine_sink",
    "upsert_idempotent", "stream_landing", "stream_gate", "stream_dedup", "stream_upsert", "incremental_ingest",
    "raw_scan_nested", "clean_two_prefixes", "gate_two_streams", "manifest_dead_letters", "lake_views",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES_FILES))
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups"):
        assert bad not in text


@pytest.fixture
def fact(spark, sf_dir, tmp_path):
    path = str(tmp_path / "fact")
    modeling.artist_key(fx.music_events(spark, sf_dir)).select(*modeling.FACT_NAMES).write.parquet(path)
    return spark.read.parquet(path)


def test_marts_read_only_their_columns_and_shuffle_once(fact):
    text = plan(marts.platform_distribution(fact))
    assert "ReadSchema: struct<duration_seconds:int,platform:string>" in text
    assert text.count("Exchange") == 1
    text = plan(marts.skip_rate(fact))
    assert "ReadSchema: struct<played_at:timestamp,duration_seconds:int>" in text
    assert text.count("Exchange") == 1


def test_filters_reach_the_files(fact):
    for condition, pushed in (
        (F.col("ingest_date") >= "2024-01-10", "GreaterThanOrEqual(ingest_date,2024-01-10)"),
        (F.col("platform") == "web", "EqualTo(platform,web)"),
    ):
        assert pushed in plan(marts.platform_distribution(fact.filter(condition)))


def test_top_artists_totals_before_the_join(spark, sf_dir, fact):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(marts.top_artists(fact, modeling.dim_artist(fx.music_events(spark, sf_dir))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = text.index("SortMergeJoin")
    assert "partial_sum(duration_seconds" in text[join:]


def test_unique_keys_need_no_expand(fact):
    assert "Expand" in plan(modeling.daily_listening_metrics(fact))
    assert "Expand" not in plan(modeling.daily_listening_metrics(fact, unique_keys=True))


def test_dim_track_reduces_with_a_hash_aggregate_first(fact, spark, sf_dir):
    text = plan(modeling.dim_track(fx.track_conflicts(spark, sf_dir)))
    assert "partial_max(played_at" in text
    assert "ObjectHashAggregate" not in text


def test_the_gate_does_not_shuffle(spark, sf_dir):
    raw = quality.parse_event_time(fx.raw_events(spark, sf_dir))
    for part in quality.split(raw, quality.gate_rules(raw, "contract")):
        assert "Exchange" not in plan(part)


@pytest.mark.parametrize("level", quality.LEVELS)
def test_each_json_text_is_parsed_once(spark, level):
    objects = spark.createDataFrame([("{}", "s", None)], "raw_line string, source string, run_date date")
    kept = classify_objects(objects, level).filter(F.size("reasons") == 0).select("event_id", "reasons")
    text = kept._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(") == 1
    assert text.count("schemaOfVariant(static_invoke") == (1 if level == "contract" else 0)


def test_upsert_joins_on_the_source_keys_only(fact):
    text = plan(upsert(fact, fact.filter("platform = 'web'")))
    assert "LeftAnti" in text
    assert "ReadSchema: struct<event_id:string,platform:string>" in text


def test_top_k_is_not_a_full_sort(spark, sf_dir):
    for name in ("log_triage", "recent_queries", "top10_artists", "latest_skip_rate"):
        assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, sf_dir))
