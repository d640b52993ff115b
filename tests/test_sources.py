from __future__ import annotations

import gzip
import json

import pytest
from conftest import event, uuid_of

from streamlake.plans.pipelines import Lake
from streamlake.sources import catalog, manifests, readers


def put(lake, path, text, compress=False):
    import pathlib

    f = pathlib.Path(lake.root) / path
    f.parent.mkdir(parents=True, exist_ok=True)
    f.write_bytes(gzip.compress(text.encode()) if compress else text.encode())


def test_resolve_prefix():
    assert readers.resolve_prefix("s3a://b/", "raw/x/") == "s3a://b/raw/x/"
    assert readers.resolve_prefix("s3a://b", "hdfs://n/raw") == "hdfs://n/raw"
    assert readers.resolve_prefix("/lake", "/other/raw") == "/other/raw"


def test_raw_scan_ignores_manifests_and_keeps_broken_lines(spark, lake):
    put(lake, "raw/source=s/ingest_date=2026-07-10/a.json", json.dumps(event()) + "\n{broken\n")
    put(lake, "raw/source=s/ingest_date=2026-07-10/manifest.json", '{"source": "s"}')
    rows = readers.read_raw(spark, lake.raw).collect()
    assert len(rows) == 2
    good = next(r for r in rows if r["event_id"])
    assert (good["duration_seconds"], good["ingest_date"]) == ("246", "2025-03-05")
    assert [r[readers.CORRUPT] for r in rows if not r["event_id"]] == ["{broken"]


def test_concatenated_gzip_objects(spark, lake):
    records = [event(event_id=uuid_of(i), artist_name="a}{b" * i) for i in range(5)]
    put(lake, "raw/source=my feed/ingest_date=2026-07-10/x.gz", "".join(map(json.dumps, records)), compress=True)
    rows = readers.parse_objects(readers.read_raw_lines(spark, lake.raw)).collect()
    assert {r["event_id"]: r["artist_name"] for r in rows} == {r["event_id"]: r["artist_name"] for r in records}
    assert {(r["source"], str(r["run_date"])) for r in rows} == {("my feed", "2026-07-10")}


def test_csv_sample(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text(
        "event_id,user_id,track_id,artist_name,played_at,duration_seconds,platform,ingest_date\n"
        f"{uuid_of(7)},kim,waltz,Sea Organ,2025-11-30T23:59:59Z,61,desktop,2025-12-01\n"
        f"{uuid_of(8)},lou,polka,\"Harbour, Hill & Sons\",2025-12-01T00:00:01Z,4,android,2025-12-01\n"
    )
    rows = readers.read_csv_sample(spark, str(path)).collect()
    assert [r["artist_name"] for r in rows] == ["Sea Organ", "Harbour, Hill & Sons"]
    assert len({r["event_id"] for r in rows}) == 2


@pytest.mark.parametrize(
    ("key", "status", "reason"),
    [
        ("raw/source=feed/ingest_date=2026-07-11/manifest.json", "accepted", None),
        ("raw/source%3Da%20b/ingest_date%3D2026-07-11/manifest.json", "accepted", None),
        ("raw/source=100%/ingest_date=2026-07-11/manifest.json", "accepted", None),
        ("raw/readme.txt", "rejected", "not_a_manifest"),
        ("x/raw/source=a/ingest_date=2026-07-11/manifest.json", "rejected", "not_a_manifest"),
        ("raw/source=a/b/ingest_date=2026-07-11/manifest.json", "rejected", "not_a_manifest"),
        ("raw/source=a/ingest_date=2026-07-11/manifest.json\n", "rejected", "not_a_manifest"),
        ("raw/source=a/ingest_date=2026-07-11/manifestxjson", "rejected", "not_a_manifest"),
        ("raw/source=a/ingest_date=2026-99-99/manifest.json", "rejected", "no_such_date"),
    ],
)
def test_manifest_keys(spark, key, status, reason):
    df = spark.createDataFrame([("b", key)], "bucket string, key string")
    row = manifests.manifest_worklist(df).first()
    assert (row["status"], row["reason"], row["bucket"]) == (status, reason, "b")
    if status == "accepted":
        assert row["raw_prefix"].endswith("/ingest_date=2026-07-11/") and str(row["ingest_date"]) == "2026-07-11"
    work, dead = manifests.split_worklist(manifests.manifest_worklist(df))
    assert (work.count(), dead.count()) == ((1, 0) if status == "accepted" else (0, 1))


def test_manifests_are_found_below_raw(spark, tmp_path):
    lake = Lake(str(tmp_path / "raw" / "lake"))  # a parent folder called raw must not confuse the key
    put(lake, "raw/source=s/ingest_date=2026-07-10/manifest.json", "{}")
    put(lake, "raw/source=s/ingest_date=2026-07-10/data.json", "{}")
    rows = manifests.list_manifests(spark, lake.root).collect()
    assert [tuple(r)[:2] for r in rows] == [(lake.root, "raw/source=s/ingest_date=2026-07-10/manifest.json")]


def test_clean_zone_that_does_not_exist_yet_is_empty(spark, lake):
    assert readers.read_clean(spark, lake.clean).count() == 0


def test_zone_databases(spark, lake):
    names = catalog.register_zones(spark, lake.root, "zt")
    assert names == ["zt_raw", "zt_clean", "zt_analytics"]
    listed = {r[0] for r in spark.sql("SHOW DATABASES").collect()}
    assert set(names) <= listed
