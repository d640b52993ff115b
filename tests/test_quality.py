"""The gate: splitting, reasons, contract rules, quarantine and replay."""

from __future__ import annotations

import json

import pytest
from conftest import event
from pyspark.sql import functions as F

from streamlake.contracts import EVENT_CONTRACT
from streamlake.operators import quality
from streamlake.operators.dedup import first_per_key
from streamlake.plans import fixtures as fx
from streamlake.plans.pipelines import classify_objects
from streamlake.sources.readers import parse_objects


@pytest.fixture
def small(spark):
    return spark.createDataFrame(
        [
            ("e-70", "kim", None, "Lowland Choir"),
            ("e-71", "ada", "waltz", "Sea Organ"),
            ("e-71", "ada", "waltz", "Sea Organ"),
            ("e-71", "ada", "waltz", "Sea Organ"),
            ("e-72", "lou", "polka", "Sea Organ"),
        ],
        "event_id string, user_id string, track_id string, artist_name string",
    )


def objects(spark, *records):
    lines = [(r if isinstance(r, str) else json.dumps(r), "test", None) for r in records]
    df = spark.createDataFrame(lines, "raw_line string, source string, run_date string")
    return df.withColumn("run_date", F.col("run_date").cast("date"))


def reasons_of(spark, record, level="contract"):
    row = classify_objects(objects(spark, record), level).select("reasons").first()
    return row["reasons"]


def test_small_frame_dedups_to_three_and_splits_four_to_one(spark, small, tmp_path):
    assert first_per_key(small).count() == 3
    valid, invalid = quality.split_required(small, ["event_id", "user_id", "track_id"])
    assert (valid.count(), invalid.count()) == (4, 1)
    path = str(tmp_path / "quarantine")
    quality.write_quarantine(quality.quarantine_records(invalid, "r1", "t"), path)
    row = spark.read.parquet(path).first()
    assert (row["event_id"], row["track_id"], row["run_id"]) == ("e-70", None, "r1")


def test_missing_columns_are_named_in_order(small):
    with pytest.raises(ValueError, match="platform, played_at"):
        quality.split_required(small, ["played_at", "platform", "event_id"])


def test_ensure_columns_adds_typed_nulls(small):
    full = quality.ensure_columns(small)
    assert set(full.columns) == set(EVENT_CONTRACT.names)
    types = dict(full.dtypes)
    assert (types["duration_seconds"], types["played_at"], types["ingest_date"]) == ("int", "timestamp", "date")
    assert quality.ensure_columns(full).columns == full.columns


def test_blank_and_tab(spark):
    df = spark.createDataFrame([("a",), ("",), ("   ",), ("\t",), (None,)], "c string")
    valid, invalid = quality.split_required(df, ["c"])
    assert sorted(r["c"] for r in valid.collect()) == ["\t", "a"]
    assert invalid.count() == 3


def test_valid_and_invalid_make_up_the_input(spark, sf_dir):
    raw = quality.parse_event_time(fx.raw_events(spark, sf_dir))
    valid, invalid = quality.split(raw, quality.gate_rules(raw))
    assert valid.count() + invalid.count() == raw.count()
    both = valid.unionByName(invalid.drop("reasons"))
    assert both.exceptAll(raw).count() == 0
    assert invalid.filter(F.size("reasons") == 0).count() == 0


def test_every_rule_condition_is_never_null(spark):
    nothing = objects(spark, "{}", "[", event(), event(duration_seconds=None, played_at=7))
    parsed = quality.parse_event_time(parse_objects(nothing))
    rules = quality.gate_rules(parsed, "contract", raw_line="raw_line")
    row = parsed.agg(*[F.count_if(c.isNull()).alias(n) for n, c in rules]).first()
    assert set(row) == {0}


@pytest.mark.parametrize(
    ("record", "expected"),
    [
        (event(), []),
        (event(event_id=...), ["missing:event_id"]),
        (event(user_id=None), ["missing:user_id"]),
        (event(user_id=""), ["missing:user_id", "length:user_id"]),
        (event(event_id="nope"), ["format:event_id"]),
        (event(played_at="2026-07-10 08:15:00Z"), ["format:played_at"]),
        (event(played_at="08:15:00"), ["timestamp:played_at", "format:played_at"]),
        (event(user_id="u" * 129), ["length:user_id"]),
        (event(duration_seconds="12d"), ["type:duration_seconds", "kind:duration_seconds"]),
        (event(played_at="soon"), ["timestamp:played_at", "format:played_at"]),
        (event(duration_seconds=0), ["minimum:duration_seconds"]),
        (event(duration_seconds=1.5), ["type:duration_seconds"]),
        (event(duration_seconds=180.0), []),
        (event(duration_seconds="187"), ["kind:duration_seconds"]),
        (event(duration_seconds="x"), ["type:duration_seconds", "kind:duration_seconds"]),
        (event(platform="smart_tv"), ["enum:platform"]),
        (event(ingest_date="2026-02-30"), ["format:ingest_date", "missing:run_date"]),
        (event(track_id=7), ["kind:track_id"]),
        (event(country="NL"), ["unknown_fields"]),
        (event(meta={"a": {"b": 1}}), ["unknown_fields"]),
    ],
)
def test_contract_rules(spark, record, expected):
    assert reasons_of(spark, record) == expected


def test_required_level_accepts_what_only_the_contract_forbids(spark):
    for record in (event(platform="smart_tv"), event(duration_seconds="187"), event(duration_seconds=0), event(x=1)):
        assert reasons_of(spark, record, "required") == []
    assert reasons_of(spark, event(duration_seconds="x"), "required") == ["type:duration_seconds"]
    assert reasons_of(spark, event(played_at="soon"), "required") == ["timestamp:played_at"]


@pytest.mark.parametrize("level", quality.LEVELS)
@pytest.mark.parametrize("cut", [1, 5, 40])
def test_cut_off_records_are_rejected_whole(spark, level, cut):
    text = json.dumps(event())[:-cut]
    row = classify_objects(objects(spark, text), level).first()
    assert row["reasons"][0] == "not_json"
    assert row["event_id"] is None and row["raw_line"] == text


def test_unknown_level(spark):
    with pytest.raises(ValueError, match="level"):
        quality.gate_rules(quality.parse_event_time(parse_objects(objects(spark, event()))), "strict")


def test_timestamps_become_utc_and_keep_their_text(spark):
    df = spark.createDataFrame([("2026-07-10T08:15:00+08:00",), ("2026-07-10T08:15:00Z",), ("2026-07-10",), ("x",)], "played_at string")
    rows = quality.parse_event_time(df).select(F.col("played_at").cast("string").alias("t"), "played_at_raw").collect()
    assert [r["t"] for r in rows] == ["2026-07-10 00:15:00", "2026-07-10 08:15:00", "2026-07-10 00:00:00", None]
    assert rows[3]["played_at_raw"] == "x"


def test_quarantine_has_one_schema_whatever_the_input(spark, tmp_path):
    path = str(tmp_path / "q")
    full = quality.parse_event_time(spark.createDataFrame([(1, 2.5, "x")], "event_id int, duration_seconds double, played_at string"))
    other = full.withColumn("event_id", F.lit(None).cast("string")).withColumn("duration_seconds", F.lit("a"))
    for run, df in (("a", full), ("b", other)):
        quality.write_quarantine(quality.quarantine_records(df, run, "t"), path)
    types = set(dict(spark.read.option("mergeSchema", "true").parquet(path).dtypes).values())
    assert types == {"string"}


def test_repeating_a_run_replaces_its_rejects_and_another_adds(spark, small, tmp_path):
    path = str(tmp_path / "q")
    _, invalid = quality.split_required(small, ["track_id"])
    for run in ("a", "a", "b"):
        quality.write_quarantine(quality.quarantine_records(invalid, run, "t"), path)
    assert {r["run_id"]: r["count"] for r in spark.read.parquet(path).groupBy("run_id").count().collect()} == {"a": 1, "b": 1}


def test_replay_recovers_only_what_the_fix_repairs(spark):
    bad = classify_objects(objects(spark, event(user_id=None), event(user_id=None, played_at="x")))
    records = quality.quarantine_records(bad, "r", "t")
    recovered, rest = quality.replay(records, {"user_id": F.coalesce("user_id", F.lit("u"))})
    assert [r["user_id"] for r in recovered.collect()] == ["u"]
    assert [r["reasons"] for r in rest.collect()] == [["timestamp:played_at"]]


def test_stamp_replaces_the_records_own_date(spark):
    df = spark.createDataFrame([("1999-01-01",)], "ingest_date string")
    assert str(quality.stamp_ingest_date(df, "2026-07-10").first()[0]) == "2026-07-10"
