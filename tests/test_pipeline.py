"""The jobs end to end on a lake in a temporary folder."""

from __future__ import annotations

import json
import os

import pytest
from conftest import event, uuid_of
from pyspark.sql import functions as F
from test_sources import put

from streamlake import storage
from streamlake.contracts import TABLES
from streamlake.operators import quality
from streamlake.plans import pipelines
from streamlake.sources import catalog
from streamlake.sources.readers import read_clean


def land(lake, source, day, *records, name="events.json", manifest=True):
    text = "".join(r if isinstance(r, str) else json.dumps(r) + "\n" for r in records)
    put(lake, f"raw/source={source}/ingest_date={day}/{name}", text)
    if manifest:
        put(lake, f"raw/source={source}/ingest_date={day}/manifest.json", json.dumps({"source": source, "ingest_date": day}))


def fact(spark, lake):
    return {r["event_id"]: r for r in storage.read(spark, lake.warehouse("fact_stream")).collect()}


def rejects(spark, lake):
    return spark.read.parquet(lake.quarantine).collect()


def test_batch_and_stream_files_reach_the_warehouse(spark, lake):
    land(lake, "acceptance", "2026-07-11", event(event_id=uuid_of(1), duration_seconds=180))
    land(lake, "landing", "2026-07-11", event(event_id=uuid_of(2)), event(event_id=uuid_of(2)))
    land(lake, "bad", "2026-07-11", event(event_id=...), "{cut\n")
    run = pipelines.run_all(spark, lake)
    assert (run.accepted, run.rejected) == (3, 2)

    rows = fact(spark, lake)
    assert set(rows) == {uuid_of(1), uuid_of(2)}
    assert str(rows[uuid_of(1)]["ingest_date"]) == "2026-07-11"  # the run's date, not the record's
    bad = rejects(spark, lake)
    assert sorted(r["reasons"][0] for r in bad) == ["missing:event_id", "not_json"]
    assert {r["run_id"] for r in bad} == {run.run_id}
    assert all(r["quarantined_at"].endswith("+00:00") for r in bad)
    minutes = storage.read(spark, lake.warehouse("daily_listening_minutes")).collect()
    assert [(str(r[0]), r[1]) for r in minutes] == [("2025-03-04", (180 + 246) / 60)]
    assert storage.read(spark, lake.warehouse("top_artists")).first()["event_count"] == 2


def test_running_again_changes_nothing(spark, lake):
    land(lake, "s", "2026-07-11", *[event(event_id=uuid_of(i)) for i in range(5)])
    pipelines.run_all(spark, lake)
    before = fact(spark, lake)
    version = storage.current(spark, lake.warehouse("fact_stream"))
    metrics = storage.read(spark, lake.analytics("daily_listening_metrics")).collect()
    pipelines.run_all(spark, lake)
    assert fact(spark, lake) == before
    assert storage.current(spark, lake.warehouse("fact_stream")) == version
    assert read_clean(spark, lake.clean).count() == 5
    assert storage.read(spark, lake.analytics("daily_listening_metrics")).collect() == metrics


def test_events_delivered_on_two_days_count_once(spark, lake):
    same = event(event_id=uuid_of(1))
    land(lake, "s", "2026-07-11", same)
    land(lake, "s", "2026-07-12", same)
    pipelines.run_all(spark, lake)
    assert read_clean(spark, lake.clean).count() == 2
    assert len(fact(spark, lake)) == 1
    row = storage.read(spark, lake.analytics("daily_listening_metrics")).first()
    assert (row["event_count"], row["listening_seconds"]) == (1, 246)


def test_prefixes_without_a_manifest_wait(spark, lake):
    land(lake, "a", "2026-07-11", event(event_id=uuid_of(1)))
    land(lake, "b", "2026-07-11", event(event_id=uuid_of(2)), manifest=False)
    pipelines.run_all(spark, lake)
    assert set(fact(spark, lake)) == {uuid_of(1)}
    land(lake, "b", "2026-07-11")
    assert [r["raw_prefix"] for r in pipelines.pending_prefixes(spark, lake).collect()] == ["raw/source=b/ingest_date=2026-07-11/"]
    land(lake, "b", "2026-07-11", event(event_id=uuid_of(2)))
    pipelines.run_all(spark, lake)
    assert set(fact(spark, lake)) == {uuid_of(1), uuid_of(2)}


def test_a_manifest_is_taken_once_until_it_changes(spark, lake):
    land(lake, "a", "2026-07-11", event(event_id=uuid_of(1)))
    assert pipelines.ingest_pending(spark, lake) is not None
    assert pipelines.ingest_pending(spark, lake) is None
    land(lake, "a", "2026-07-11", event(event_id=uuid_of(1)), event(event_id=uuid_of(2)))
    manifest = f"{lake.root}/raw/source=a/ingest_date=2026-07-11/manifest.json"
    os.utime(manifest, (2_000_000_000, 2_000_000_000))
    assert pipelines.ingest_pending(spark, lake) is not None
    assert read_clean(spark, lake.clean).count() == 2


def test_a_failed_run_is_taken_up_again(spark, lake, monkeypatch):
    land(lake, "a", "2026-07-11", event(event_id=uuid_of(1)), event(user_id=None))

    def lost(*_args):
        raise RuntimeError("lost")

    monkeypatch.setattr(pipelines, "write_clean", lost)
    with pytest.raises(RuntimeError):
        pipelines.ingest_pending(spark, lake)
    monkeypatch.undo()
    assert pipelines.ingest_pending(spark, lake) is not None
    assert read_clean(spark, lake.clean).count() == 1


def test_concatenated_objects_all_arrive(spark, lake):
    text = "".join(json.dumps(event(event_id=uuid_of(i))) for i in range(4))
    land(lake, "s", "2026-07-11", text)
    pipelines.run_all(spark, lake)
    assert len(fact(spark, lake)) == 4


@pytest.mark.parametrize(("level", "accepted"), [("required", 3), ("contract", 1)])
def test_gate_levels(spark, lake, level, accepted):
    land(
        lake, "s", "2026-07-11",
        event(event_id=uuid_of(1)), event(event_id=uuid_of(2), platform="tv"), event(event_id=uuid_of(3), extra=1),
    )
    pipelines.ingest_pending(spark, lake, level)
    assert read_clean(spark, lake.clean).count() == accepted


def test_a_prefix_with_only_rejects_or_nothing(spark, lake):
    land(lake, "s", "2026-07-11", event(user_id=None))
    land(lake, "e", "2026-07-11", "")
    pipelines.run_all(spark, lake)
    assert fact(spark, lake) == {}
    assert len(rejects(spark, lake)) == 1


def test_a_prefix_that_loses_its_last_accepted_row(spark, lake):
    prefixes = ["raw/source=s/ingest_date=2026-07-11/", "raw/source=t/ingest_date=2026-07-11/"]
    land(lake, "s", "2026-07-11", event(event_id=uuid_of(1)))
    land(lake, "t", "2026-07-11", event(event_id=uuid_of(2)))
    pipelines.raw_to_clean(spark, lake, prefixes)
    land(lake, "s", "2026-07-11", event(event_id=uuid_of(1), user_id=None))
    pipelines.raw_to_clean(spark, lake, prefixes)
    assert [r["event_id"] for r in read_clean(spark, lake.clean).collect()] == [uuid_of(2)]


def test_a_run_id_that_looks_like_a_number(spark, lake):
    land(lake, "s", "2026-07-11", event(user_id=None))
    prefixes = ["raw/source=s/ingest_date=2026-07-11/"]
    pipelines.raw_to_clean(spark, lake, prefixes, run_id="0001")
    assert [r["run_id"] for r in quality.read_quarantine(spark, lake.quarantine).collect()] == ["0001"]
    pipelines.replay_quarantine(spark, lake, "0001", {"user_id": F.lit("u")})
    assert read_clean(spark, lake.clean).count() == 1


def test_a_given_run_date_serves_prefixes_without_one(spark, lake):
    put(lake, "drop/a.json", json.dumps(event()))
    pipelines.raw_to_clean(spark, lake, ["drop/"], run_date="2026-08-01")
    row = read_clean(spark, lake.clean).first()
    assert (str(row["ingest_date"]), row["source"]) == ("2026-08-01", "unknown")


def test_replay_moves_repaired_rows_to_clean(spark, lake):
    land(lake, "s", "2026-07-11", event(event_id=uuid_of(1), user_id=None), event(event_id=uuid_of(2), user_id=None, played_at="x"))
    run_id = pipelines.ingest_pending(spark, lake).run_id
    fixes = {"user_id": F.coalesce("user_id", F.lit("user-unknown"))}
    for _ in range(2):
        replay_id = pipelines.replay_quarantine(spark, lake, run_id, fixes)
    rows = read_clean(spark, lake.clean).collect()
    assert [(r["event_id"], r["user_id"], str(r["ingest_date"]), r["load_id"]) for r in rows] == [
        (uuid_of(1), "user-unknown", "2026-07-11", replay_id)
    ]
    left = [r for r in rejects(spark, lake) if r["run_id"] == replay_id]
    assert [(r["event_id"], r["reasons"]) for r in left] == [(uuid_of(2), ["timestamp:played_at"])]


def test_a_broken_staging_table_is_not_merged(spark, lake):
    bad = spark.createDataFrame([("x" * 37,)], "event_id string")
    for name, kind in TABLES["stg_fact_stream"].columns[1:]:
        bad = bad.withColumn(name, F.lit("2026-07-11" if kind in ("date", "timestamp") else "1").cast(kind))
    storage.publish(bad, lake.analytics("fact_stream"), "ingest_date")
    with pytest.raises(ValueError, match="max_length:event_id"):
        pipelines.load_warehouse(spark, lake)
    assert storage.current(spark, lake.warehouse("fact_stream")) is None


def test_what_cannot_be_published_is_rejected_and_the_rest_arrives(spark, lake):
    land(lake, "s", "2026-07-11", event(event_id="x" * 37), event(event_id=uuid_of(1)))
    put(lake, "drop/a.json", json.dumps(event(ingest_date="soon")) + "\n" + json.dumps(event(event_id=uuid_of(2))))
    pipelines.raw_to_clean(spark, lake, ["drop"])
    pipelines.run_all(spark, lake)
    assert set(fact(spark, lake)) == {uuid_of(1), uuid_of(2)}
    assert sorted(tuple(r["reasons"]) for r in rejects(spark, lake)) == [("length:event_id",), ("missing:run_date",)]


def test_loads_of_other_folders_and_files_stay(spark, lake):
    for n, name in enumerate(("one/a.json", "two/a.json", "part/a.json", "part/b.json")):
        put(lake, name, json.dumps(event(event_id=uuid_of(n))))
    for prefix in ("one", "two", "part/a.json", "part/b.json", "one"):
        pipelines.raw_to_clean(spark, lake, [prefix])
    assert {r["event_id"] for r in read_clean(spark, lake.clean).collect()} == {uuid_of(n) for n in range(4)}
    put(lake, "two/a.json", json.dumps(event(user_id=None)))
    pipelines.raw_to_clean(spark, lake, ["two"])
    assert {r["event_id"] for r in read_clean(spark, lake.clean).collect()} == {uuid_of(n) for n in (0, 2, 3)}


def test_odd_names_are_loaded_and_dead_letters_wait_for_a_replay(spark, lake):
    for n, source in enumerate(("a+b", "a%20b", "100%", "good")):
        land(lake, source, "2026-07-11", event(event_id=uuid_of(n)))
    land(lake, "good", "2026-99-99", event(event_id=uuid_of(8)))
    broken = "raw/source=broken/ingest_date=2026-07-11"
    put(lake, f"{broken}/x.gz", "no gzip")
    put(lake, f"{broken}/manifest.json", "{}")
    for _ in range(2):
        pipelines.run_all(spark, lake)
        assert set(fact(spark, lake)) == {uuid_of(n) for n in range(4)}
        dead = {r["key"]: r["reason"] for r in pipelines.dead_letters(spark, lake).collect()}
        assert dead.pop("raw/source=good/ingest_date=2026-99-99/manifest.json") == "no_such_date"
        assert dead.popitem()[0] == f"{broken}/manifest.json" and not dead
    os.remove(f"{lake.root}/{broken}/x.gz")
    put(lake, f"{broken}/x.gz", json.dumps(event(event_id=uuid_of(9))), compress=True)
    pipelines.run_all(spark, lake)
    assert uuid_of(9) in fact(spark, lake)
    assert [r["reason"] for r in pipelines.dead_letters(spark, lake).collect()] == ["no_such_date"]


def test_what_clean_loses_to_retention_stays_in_fact_and_dimensions(spark, lake):
    land(lake, "s", "2026-07-11", event(event_id=uuid_of(1), artist_name="Early"))
    pipelines.run_all(spark, lake)
    storage.delete_dir(spark, f"{lake.clean}/ingest_date=2026-07-11")
    land(lake, "s", "2026-07-12", event(event_id=uuid_of(2), artist_name="Late"))
    pipelines.run_all(spark, lake)
    assert storage.read(spark, lake.analytics("fact_stream")).count() == 2
    names = {r["artist_name"] for r in storage.read(spark, lake.warehouse("top_artists")).collect()}
    assert names == {"Early", "Late"}


def test_registered_tables_follow_the_newest_version(spark, lake):
    land(lake, "s", "2026-07-11", event(event_id=uuid_of(1)))
    pipelines.run_all(spark, lake)
    catalog.register_analytics(spark, lake.root, "rt")
    count = "SELECT count(*) AS n FROM rt_analytics.fact_stream"
    assert spark.sql(count).first()["n"] == 1
    land(lake, "s", "2026-07-12", event(event_id=uuid_of(2)))
    pipelines.run_all(spark, lake)
    catalog.register_analytics(spark, lake.root, "rt")
    assert spark.sql(count).first()["n"] == 2
    pruned = spark.sql("SELECT event_id FROM rt_analytics.fact_stream WHERE ingest_date = date'2026-07-12'")
    assert pruned.count() == 1 and len(pruned.inputFiles()) == 1
    types = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE rt_analytics.daily_listening_metrics").collect()}
    assert types == {
        "ingest_date": "date", "platform": "string", "event_count": "bigint", "unique_listener_count": "bigint",
        "listening_seconds": "bigint",
    }
