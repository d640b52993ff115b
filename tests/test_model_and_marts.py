"""Hand-computed values for the model and the dashboard marts."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from conftest import uuid_of
from pyspark.sql import functions as F

from streamlake.contracts import FACT_NAMES
from streamlake.operators import marts, modeling


@pytest.fixture
def clean(spark):
    rows = [
        (uuid_of(1), "u1", "t1", "A", "2026-07-10 23:59:59", 120, "web", "2026-07-11"),
        (uuid_of(1), "u1", "t1", "A", "2026-07-10 23:59:59", 180, "web", "2026-07-12"),
        (uuid_of(2), "u2", "t1", "B", "2026-07-11 08:00:00", 29, "web", "2026-07-11"),
        (uuid_of(3), "u1", "t2", "B", "2026-07-11 09:00:00", 30, "ios", "2026-07-11"),
    ]
    cols = "event_id string, user_id string, track_id string, artist_name string, played_at string, duration_seconds int, platform string, ingest_date string"
    df = spark.createDataFrame(rows, cols)
    return df.withColumns({"played_at": F.col("played_at").cast("timestamp"), "ingest_date": F.to_date("ingest_date")})


@pytest.fixture
def fact(clean):
    return modeling.fact_stream(clean)


def test_fact(fact):
    rows = {r["event_id"]: r for r in fact.collect()}
    assert fact.columns == FACT_NAMES
    assert len(rows) == 3
    assert rows[uuid_of(1)]["duration_seconds"] == 120
    assert rows[uuid_of(2)]["artist_id"] == hashlib.sha256(b"B").hexdigest()


def test_dimensions(clean):
    assert {r["artist_name"] for r in modeling.dim_artist(clean).collect()} == {"A", "B"}
    tracks = {r["track_id"]: r["artist_id"] for r in modeling.dim_track(clean).collect()}
    assert tracks == {"t1": hashlib.sha256(b"B").hexdigest(), "t2": hashlib.sha256(b"B").hexdigest()}


def test_daily_metrics_count_distinct_but_sum_all_rows(clean, fact):
    rows = {(str(r["ingest_date"]), r["platform"]): tuple(r)[2:] for r in modeling.daily_listening_metrics(clean).collect()}
    assert rows == {("2026-07-11", "web"): (2, 2, 149), ("2026-07-12", "web"): (1, 1, 180), ("2026-07-11", "ios"): (1, 1, 30)}
    by_fact = {tuple(r) for r in modeling.daily_listening_metrics(fact).collect()}
    assert by_fact == {tuple(r) for r in modeling.daily_listening_metrics(fact, unique_keys=True).collect()}


def test_marts(clean, fact):
    d10, d11 = dt.date(2026, 7, 10), dt.date(2026, 7, 11)
    assert {r["event_id"]: r["is_skip"] for r in marts.dashboard_events(fact).collect()} == {uuid_of(1): 0, uuid_of(2): 1, uuid_of(3): 0}
    assert [tuple(r) for r in marts.daily_listening_minutes(fact).collect()] == [(d10, 2.0), (d11, 59 / 60)]
    totals = marts.top_artists(fact, modeling.dim_artist(clean))
    assert [tuple(r) for r in marts.top_n_artists(totals).collect()] == [("A", 1, 2.0), ("B", 2, 59 / 60)]
    assert {tuple(r) for r in marts.platform_distribution(fact).collect()} == {("web", 2, 149 / 60), ("ios", 1, 0.5)}
    rates = marts.skip_rate(fact)
    assert {tuple(r) for r in rates.collect()} == {(d10, 0.0), (d11, 0.5)}
    assert tuple(marts.latest_skip_rate(rates).first()) == (d11, 0.5)
    assert marts.fact_count(fact).first()[0] == 3


def test_plays_of_artists_without_a_dimension_row_are_left_out(fact, clean):
    only_a = modeling.dim_artist(clean).filter("artist_name = 'A'")
    assert [r["artist_name"] for r in marts.top_artists(fact, only_a).collect()] == ["A"]


def test_top_n_breaks_ties_by_name(spark):
    totals = spark.createDataFrame([(n, 1, 5.0) for n in "dcba"], "artist_name string, event_count long, listening_minutes double")
    assert [r[0] for r in marts.top_n_artists(totals, 3).collect()] == ["a", "b", "c"]
