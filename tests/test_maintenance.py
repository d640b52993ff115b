from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from streamlake import storage
from streamlake.contracts import TABLES
from streamlake.operators import maintenance


def artists(spark, *rows):
    return spark.createDataFrame(list(rows), "artist_id string, artist_name string")


def test_constraint_report(spark):
    df = artists(spark, ("a", "x"), ("a", None), ("b" * 65, "y" * 513), (None, "z"), ("a", "w"))
    got = {r["rule"]: r["failures"] for r in maintenance.constraint_report(df, TABLES["dim_artist"]).collect()}
    assert got == {
        "not_null:artist_id": 1, "not_null:artist_name": 1, "max_length:artist_id": 1, "max_length:artist_name": 1,
        "primary_key:artist_id": 2,
    }


def test_check_constraints(spark):
    maintenance.check_constraints(artists(spark, ("a", "x")), "dim_artist")
    with pytest.raises(ValueError, match=r"primary_key:artist_id \(1\)"):
        maintenance.check_constraints(artists(spark, ("a", "x"), ("a", "y")), "dim_artist")
    with pytest.raises(ValueError, match="lacks columns: artist_name"):
        maintenance.check_constraints(artists(spark, ("a", "x")).drop("artist_name"), "dim_artist")


def test_empty_table_has_no_failures(spark):
    maintenance.check_constraints(artists(spark, ("a", "x")).filter("false"), "dim_artist")


def test_expired_partitions_at_the_boundary(spark):
    df = spark.createDataFrame([(z, d) for z in ("raw", "clean", "analytics") for d in ("2026-01-01", "2026-01-02", "2025-07-05")], "zone string, d string")
    parts = df.select("zone", F.to_date("d").alias("ingest_date"))
    got = {(r[0], str(r[1])) for r in maintenance.expired_partitions(parts, "2026-04-02").collect()}
    assert got == {("raw", "2026-01-01"), ("raw", "2025-07-05"), ("clean", "2025-07-05")}


def test_drop_expired_is_a_dry_run_by_default(spark, tmp_path):
    root = str(tmp_path / "lake")
    for zone, day in (("raw/source=a", "2026-01-01"), ("raw/source=a", "2026-06-01"), ("clean", "2026-01-01")):
        (tmp_path / "lake" / zone / f"ingest_date={day}").mkdir(parents=True)
        (tmp_path / "lake" / zone / f"ingest_date={day}" / "f.txt").write_text("x")
    fact = spark.range(3).withColumn("ingest_date", F.date_add(F.lit("2025-03-31").cast("date"), F.col("id").cast("int")))
    storage.publish(fact, f"{root}/analytics/fact_stream", "ingest_date")

    listed = maintenance.drop_expired(spark, root, "2026-04-02")
    assert [p.split("/lake/")[1] for p in listed] == ["raw/source=a/ingest_date=2026-01-01"]
    assert (tmp_path / "lake/raw/source=a/ingest_date=2026-01-01").exists()

    maintenance.drop_expired(spark, root, "2026-04-02", dry_run=False)
    assert not (tmp_path / "lake/raw/source=a/ingest_date=2026-01-01").exists()
    assert (tmp_path / "lake/raw/source=a/ingest_date=2026-06-01").exists()
    assert (tmp_path / "lake/clean/ingest_date=2026-01-01").exists()
    days = {r[0] for r in storage.read(spark, f"{root}/analytics/fact_stream").select("ingest_date").collect()}
    assert days == {dt.date(2025, 4, 2)}


def test_compact_keeps_rows_and_leaves_fewer_files(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.range(0, 1000, 1, 8).withColumn("ingest_date", F.lit("2026-01-01").cast("date"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.repartition(8).write.partitionBy("ingest_date").parquet(f"{root}/v=00000001-x")
        storage.commit(spark, root, None, ("v=00000001-x/ingest_date=2026-01-01",), df.schema)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    snapshot = maintenance.compact(spark, root, "ingest_date", ("id",))
    files = [n for n in storage.child_names(spark, f"{root}/{snapshot.dirs[0]}") if n.endswith(".parquet")]
    assert len(files) == 1
    assert storage.read(spark, root).count() == 1000
