"""Days that changed are carried through the lake: the same tables as a full run, and only their files read."""

from __future__ import annotations

import hashlib
import random

import pytest
from conftest import event, uuid_of
from pyspark.sql import functions as F
from test_pipeline import land

from streamlake import storage
from streamlake.operators import maintenance, modeling
from streamlake.plans import changes, pipelines
from streamlake.plans.pipelines import ANALYTICS, Lake

MARTS = ("daily_listening_minutes", "top_artists", "platform_distribution", "skip_rate")


def tables(spark, lake):
    found = {f"analytics/{n}": lake.analytics(n) for n in ANALYTICS} | {f"warehouse/{n}": lake.warehouse(n) for n in (*ANALYTICS, *MARTS)}
    return {n: sorted(map(str, storage.read(spark, p).collect())) for n, p in found.items()}


def test_random_loads_give_the_tables_of_a_full_run(spark, tmp_path):
    """Loads that add, change and drop events, also ones that lie in several days."""
    draw = random.Random(11)
    lake, other = Lake(str(tmp_path / "a")), Lake(str(tmp_path / "b"))
    for step in range(3):
        for _ in range(2):
            source, day = draw.choice("st"), f"2026-07-1{draw.randint(1, 3)}"
            records = [
                event(event_id=uuid_of(n), user_id=f"u{draw.randint(1, 3)}", artist_name=f"A{draw.randint(1, 4)}",
                      track_id=f"t{n % 4}", played_at=f"2026-07-1{draw.randint(1, 3)}T10:00:0{draw.randint(0, 9)}Z",
                      duration_seconds=draw.choice([10, 100, 200]), platform=draw.choice(["ios", "web"]))
                for n in draw.sample(range(8), draw.randint(0, 6))
            ]
            prefix = f"raw/source={source}/ingest_date={day}/"
            for x in (lake, other):
                storage.delete_dir(spark, f"{x.root}/{prefix}")
                land(x, source, day, *records, "{broken\n", manifest=False)
                pipelines.raw_to_clean(spark, x, [prefix])
        pipelines.clean_to_analytics(spark, lake)
        pipelines.clean_to_analytics(spark, other, full=True)
        for x in (lake, other):
            pipelines.load_warehouse(spark, x, full=x is other)
            pipelines.publish_marts(spark, x, full=x is other)
        assert tables(spark, lake) == tables(spark, other), step
    assert storage.current(spark, lake.analytics("fact_stream")).keys


def test_a_load_of_one_day_reads_one_day_of_clean(spark, lake, monkeypatch):
    for day in range(1, 8):
        land(lake, "s", f"2026-07-0{day}", *[event(event_id=uuid_of(100 * day + n)) for n in range(3)])
    pipelines.run_all(spark, lake)
    before = {n: storage.current(spark, lake.analytics(n)) for n in ("fact_stream", "last_plays")}
    before |= {n: storage.current(spark, lake.warehouse(n)) for n in ("play_totals",)}
    warehouse = storage.current(spark, lake.warehouse("fact_stream"))
    land(lake, "t", "2026-07-03", event(event_id=uuid_of(901)))
    pipelines.ingest_pending(spark, lake)
    assert changes.pending(spark, lake.changes("clean")).days == ("2026-07-03",)

    original = pipelines.read_clean

    def only_that_day(*args):
        """A row of any other day raises as soon as it is read."""
        found = original(*args)
        return found.filter(F.when(F.col("ingest_date") == F.lit("2026-07-03").cast("date"), True).otherwise(F.raise_error(F.concat(F.lit("read "), "event_id"))))

    monkeypatch.setattr(pipelines, "read_clean", only_that_day)
    pipelines.clean_to_analytics(spark, lake)
    monkeypatch.undo()
    pipelines.load_warehouse(spark, lake)
    pipelines.publish_marts(spark, lake)
    after = {n: storage.current(spark, lake.analytics(n)) for n in ("fact_stream", "last_plays")}
    after |= {n: storage.current(spark, lake.warehouse(n)) for n in ("play_totals",)}
    for name in before:
        assert storage.changed_partitions(before[name], after[name]) == ["2026-07-03"], name
    assert storage.changed_partitions(warehouse, storage.current(spark, lake.warehouse("fact_stream"))) == ["2026-07-03"]
    assert storage.read(spark, lake.warehouse("fact_stream")).count() == 22
    plan = original(spark, lake.clean).filter(pipelines._in_days(["2026-07-03"]))
    scan = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in scan  # the job's filter prunes to the day's two loads


def test_notes_stay_until_the_next_stage_is_done(spark, lake, monkeypatch):
    land(lake, "s", "2026-07-11", event(event_id=uuid_of(1)))
    pipelines.run_all(spark, lake)
    land(lake, "s", "2026-07-12", event(event_id=uuid_of(2)))
    pipelines.ingest_pending(spark, lake)

    def lost(*_args, **_more):
        raise RuntimeError("lost")

    monkeypatch.setattr(pipelines, "_publish_metrics", lost)
    with pytest.raises(RuntimeError):
        pipelines.clean_to_analytics(spark, lake)
    monkeypatch.undo()
    pipelines.run_all(spark, lake)
    assert storage.read(spark, lake.warehouse("fact_stream")).count() == 2
    assert storage.read(spark, lake.analytics("daily_listening_metrics")).count() == 2
    assert all(changes.pending(spark, lake.changes(z)) == ((), ()) for z in ("clean", "analytics", "warehouse"))


def test_a_failed_run_leaves_its_rejects_once(spark, lake, monkeypatch):
    land(lake, "a", "2026-07-11", event(event_id=uuid_of(1)), event(user_id=None))

    def lost(*_args):
        raise RuntimeError("lost")

    monkeypatch.setattr(pipelines, "write_clean", lost)
    with pytest.raises(RuntimeError):
        pipelines.ingest_pending(spark, lake)
    monkeypatch.undo()
    run = pipelines.ingest_pending(spark, lake)
    assert spark.read.parquet(lake.quarantine).count() == 1
    assert (run.accepted, run.rejected) == (1, 1)


def test_a_repeated_key_in_another_day_is_found_by_the_index(spark, lake):
    for day in (1, 2):
        land(lake, "s", f"2026-07-0{day}", *[event(event_id=uuid_of(10 * day + n)) for n in range(3)])
    pipelines.run_all(spark, lake)
    land(lake, "s", "2026-07-03", event(event_id=uuid_of(31)))
    pipelines.ingest_pending(spark, lake)
    pipelines.clean_to_analytics(spark, lake)
    root = lake.analytics("fact_stream")
    base, rows = storage.current(spark, root), storage.read(spark, root)
    twice = rows.filter(F.col("event_id").isin(uuid_of(11), uuid_of(31))).withColumn("ingest_date", F.lit("2026-07-03").cast("date"))
    keep = storage.carried_over(base, "ingest_date", ["2026-07-03"])
    storage.publish(twice, root, "ingest_date", keep=keep, base=base, keys=base.keys)
    with pytest.raises(ValueError, match="primary_key:event_id \\(1\\)"):
        pipelines.load_warehouse(spark, lake)
    full = maintenance.constraint_report(storage.read(spark, root), pipelines.TABLES["fact_stream"])
    changed = storage.read(spark, root).filter("ingest_date = date'2026-07-03'")
    assert sorted(maintenance.changed_report(spark, root, changed, pipelines.TABLES["fact_stream"]).collect()) == sorted(full.collect())


def test_rejects_are_replayed_in_batches_and_not_offered_again(spark, lake):
    bad = [event(event_id=uuid_of(n), user_id=None) for n in range(20)]
    bad += [event(event_id=uuid_of(50 + n), user_id=None, played_at="x") for n in range(5)]
    land(lake, "s", "2026-07-11", *bad)
    run_id = pipelines.ingest_pending(spark, lake).run_id
    fixes = {"user_id": F.coalesce("user_id", F.lit("user-unknown"))}
    first = pipelines.replay_open(spark, lake, run_id, fixes, batch_rows=7, batches=2)
    assert 0 < first < 20 and pipelines.open_rejects(spark, lake, run_id).count() == 25 - first
    ledger = spark.read.schema(pipelines.REPLAYED).parquet(lake.replayed)
    assert ledger.count() == first
    assert pipelines.replay_open(spark, lake, run_id, fixes, batch_rows=7) == 20 - first
    assert pipelines.replay_open(spark, lake, run_id, fixes, batch_rows=7) == 0
    clean = pipelines.read_clean(spark, lake.clean)
    assert sorted(r["event_id"] for r in clean.collect()) == [uuid_of(n) for n in range(20)]
    # The rest stays open, with its evidence, for other fixes.
    assert {r["reasons"][0] for r in pipelines.open_rejects(spark, lake, run_id).collect()} == {"missing:user_id"}
    times = fixes | {"played_at": F.lit("2026-07-11T00:00:00Z")}
    assert pipelines.replay_open(spark, lake, run_id, times, batch_rows=7) == 5
    assert pipelines.open_rejects(spark, lake, run_id).count() == 0
    assert clean.count() == 20 and pipelines.read_clean(spark, lake.clean).count() == 25


def test_an_interrupted_replay_batch_is_replaced(spark, lake, monkeypatch):
    land(lake, "s", "2026-07-11", *[event(event_id=uuid_of(n), user_id=None) for n in range(4)])
    run_id = pipelines.ingest_pending(spark, lake).run_id
    fixes = {"user_id": F.lit("u")}
    original = pipelines.write_clean

    def then_lost(*args):
        original(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(pipelines, "write_clean", then_lost)
    with pytest.raises(RuntimeError):
        pipelines.replay_open(spark, lake, run_id, fixes)
    monkeypatch.undo()
    assert pipelines.replay_open(spark, lake, run_id, fixes) == 4
    assert pipelines.read_clean(spark, lake.clean).count() == 4


def test_sketches_of_days_make_longer_spans(spark):
    rows = spark.range(60_000).select(
        F.col("id").cast("string").alias("event_id"),
        (F.col("id") % 20_000).cast("string").alias("user_id"),
        F.lit(1).alias("duration_seconds"),
        F.when(F.col("id") % 2 == 0, "ios").otherwise("web").alias("platform"),
        F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("ingest_date"),
    )
    sketches = modeling.daily_sketches(rows)
    assert sketches.count() == 6
    (whole,) = modeling.metrics_of_sketches(sketches, ()).collect()
    assert whole["listening_seconds"] == 60_000
    assert abs(whole["event_count"] - 60_000) <= modeling.SKETCH_ERROR * 60_000
    assert abs(whole["unique_listener_count"] - 20_000) <= modeling.SKETCH_ERROR * 20_000
    again = modeling.metrics_of_sketches(sketches.unionByName(sketches), ("platform",)).collect()  # a repeat adds nothing
    once = modeling.metrics_of_sketches(sketches, ("platform",)).collect()
    assert {r["platform"]: r["event_count"] for r in again} == {r["platform"]: r["event_count"] for r in once}


def test_new_manifests_are_found_without_listing_the_old(spark, lake, monkeypatch):
    import json
    import os

    from test_sources import put

    from streamlake.streaming import jobs

    def announce(*names):
        rows = [{"bucket": "lake", "key": f"raw/source%3D{s}/ingest_date={d}/manifest.json", "modified": 5} for s, d in names]
        put(lake, f"manifest_events/{len(os.listdir(lake.manifest_events)) if os.path.exists(lake.manifest_events) else 0}-{names[0]}.json",
            "".join(json.dumps(r) + "\n" for r in rows))
        jobs.discover(jobs.read_storage_events(spark, lake), lake, f"{lake.root}/cp", trigger=jobs.ONCE).awaitTermination()

    old = [("s", f"2026-06-{d:02d}") for d in range(1, 21)]
    for n, (source, day) in enumerate(old):
        land(lake, source, day, event(event_id=uuid_of(n)))
    announce(*old, ("s", "2026-99-99"), ("late", "2026-06-30"))
    assert pipelines.ingest_discovered(spark, lake).accepted == 20

    def never(*_args):
        raise AssertionError("raw is listed")

    monkeypatch.setattr(pipelines, "list_manifests", never)
    land(lake, "s", "2026-07-11", event(event_id=uuid_of(50)))
    announce(("s", "2026-07-11"))
    assert [n for n in os.listdir(lake.manifest_events) if n.startswith("0-")] == []  # moved away
    assert pipelines.ingest_discovered(spark, lake).accepted == 1
    assert storage.child_names(spark, lake.worklist) == []
    assert sorted(r["reason"] for r in pipelines.dead_letters(spark, lake).collect()) == ["missing_prefix", "no_such_date"]
    land(lake, "late", "2026-06-30", event(event_id=uuid_of(60)))  # a dead letter is tried again without an event
    assert pipelines.ingest_discovered(spark, lake).accepted == 1
    assert pipelines.read_clean(spark, lake.clean).count() == 22


def test_a_large_part_of_the_work_list_is_written_by_several_tasks(spark, lake, monkeypatch):
    import json
    import os

    from test_sources import put

    from streamlake.streaming import jobs

    monkeypatch.setattr(jobs, "LISTED_ROWS", 100, raising=False)
    files = {}
    for label, n_files, rows in (("large", 4, 100), ("small", 4, 20)):
        one = Lake(f"{lake.root}-{label}")
        for n in range(n_files):
            keys = [f"raw/source={label}{n}-{i}/ingest_date=2026-06-01/manifest.json" for i in range(rows)]
            text = "".join(json.dumps({"bucket": "lake", "key": k, "modified": 5}) + "\n" for k in keys)
            put(one, f"manifest_events/{n}.json", text)
        events = jobs.read_storage_events(spark, one)
        jobs.discover(events, one, f"{one.root}/cp", trigger=jobs.ONCE).awaitTermination()
        (name,) = storage.child_names(spark, one.worklist)
        listed = spark.read.parquet(f"{one.worklist}/{name}")
        assert listed.filter("status = 'accepted'").select("key").distinct().count() == listed.count() == n_files * rows
        files[label] = len([f for f in os.listdir(f"{one.worklist}/{name}") if f.endswith(".parquet")])
    assert files == {"large": 4, "small": 1}


def test_a_point_lookup_skips_row_groups(spark, lake):
    rows = spark.range(20_000).select(
        F.md5(F.col("id").cast("string")).alias("event_id"), F.current_timestamp().alias("played_at"),
        F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("ingest_date"),
    )
    from streamlake.operators.upsert import merge_into

    root = lake.warehouse("fact_stream")
    merge_into(spark, root, rows)
    wanted = hashlib.md5(b"4711").hexdigest()

    def rows_scanned(df):
        df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))

    found = storage.read(spark, root).filter(F.col("event_id") == wanted)
    assert found.count() == 1
    assert rows_scanned(found) <= 4_000  # of ten files of 2,000 rows
    plain = f"{lake.root}/plain"
    storage.publish(rows, plain, "ingest_date", ("played_at",))
    assert rows_scanned(storage.read(spark, plain).filter(F.col("event_id") == wanted)) == 20_000
