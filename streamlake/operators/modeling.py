"""Clean events -> fact, dimensions and daily metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlake.contracts import EVENT_CONTRACT, FACT_NAMES
from streamlake.functions.expressions import surrogate_key
from streamlake.operators.dedup import first_per_key


def artist_key(df: DataFrame, name: str = "artist_name", key: str = "artist_id") -> DataFrame:
    return df.withColumn(key, surrogate_key(F.col(name)))


def fact_stream(
    clean: DataFrame, key: str = "event_id", order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """The eight fact columns, one row per event across all runs.

    The default order is that of the clean zone (time, then the contract fields), so
    the row that wins does not depend on how the events were spread over runs. The hash
    is computed after the deduplication, on the surviving rows only.
    """
    extra = [c for c in order_by or [] if isinstance(c, str) and c not in EVENT_CONTRACT.names]
    events = clean.select(*EVENT_CONTRACT.names, *extra)
    return artist_key(first_per_key(events, key, order_by)).select(*FACT_NAMES)


def dim_artist(clean: DataFrame) -> DataFrame:
    """Distinct artists; the names are made distinct first, then hashed once each."""
    return artist_key(clean.select("artist_name").distinct()).select("artist_id", "artist_name")


def dim_track(clean: DataFrame, event_time: str = "played_at") -> DataFrame:
    """One artist per track: that of the latest play, the greatest key among equal times.

    The first aggregate keeps one number per (track, artist) and so runs as a hash
    aggregate with map-side combine; only the few conflicting pairs are compared after it.
    """
    return tracks_of_plays(last_plays(clean, (), event_time))


def last_plays(clean: DataFrame, by: Sequence[str] = ("ingest_date",), event_time: str = "played_at") -> DataFrame:
    """The last play of each (track, artist), per load day unless ``by`` says otherwise."""
    plays = clean.groupBy(*by, "track_id", "artist_name").agg(F.max(event_time).alias("last_played"))
    return artist_key(plays).drop("artist_name")


def tracks_of_plays(plays: DataFrame) -> DataFrame:
    """The track dimension from ``last_plays``, of any number of days."""
    latest = plays.groupBy("track_id").agg(F.max(F.struct("last_played", "artist_id")).alias("latest"))
    return latest.select("track_id", "latest.artist_id")


def daily_listening_metrics(
    events: DataFrame,
    by: Sequence[str] = ("ingest_date", "platform"),
    key: str = "event_id",
    user: str = "user_id",
    duration: str = "duration_seconds",
    unique_keys: bool = False,
) -> DataFrame:
    """Distinct events, distinct listeners and seconds per day and platform, all exact.

    The seconds are summed over all rows. With ``unique_keys`` (a published fact) events
    are counted instead of made distinct: the plan then has one distinct, so it neither
    expands each row three times nor shuffles event ids.
    """
    event_count = F.count(key) if unique_keys else F.countDistinct(key)
    return events.groupBy(*by).agg(
        event_count.alias("event_count"),
        F.countDistinct(user).alias("unique_listener_count"),
        F.sum(duration).cast("bigint").alias("listening_seconds"),
    )


# Sketches have 2**SKETCH_LOG slots; a count is off by more than SKETCH_ERROR (three standard errors) about once in 400.
SKETCH_LOG = 14
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_LOG / 2)


def daily_sketches(
    events: DataFrame,
    by: Sequence[str] = ("ingest_date", "platform"),
    key: str = "event_id",
    user: str = "user_id",
    duration: str = "duration_seconds",
) -> DataFrame:
    """Mergeable state of the daily metrics: a distinct-count sketch of events and one of listeners
    per group, and the seconds.

    Sketches are combined before the shuffle, so what moves is a few kilobytes per group and
    task instead of every key. Stored per day, they give any longer span without the events.
    """
    return events.groupBy(*by).agg(
        F.hll_sketch_agg(key, SKETCH_LOG).alias("event_sketch"),
        F.hll_sketch_agg(user, SKETCH_LOG).alias("listener_sketch"),
        F.sum(duration).cast("bigint").alias("listening_seconds"),
    )


def metrics_of_sketches(sketches: DataFrame, by: Sequence[str] = ("ingest_date", "platform")) -> DataFrame:
    """``daily_listening_metrics`` by any of the sketches' columns, with estimated counts."""
    return sketches.groupBy(*by).agg(
        F.hll_sketch_estimate(F.hll_union_agg("event_sketch")).alias("event_count"),
        F.hll_sketch_estimate(F.hll_union_agg("listener_sketch")).alias("unique_listener_count"),
        F.sum("listening_seconds").cast("bigint").alias("listening_seconds"),
    )
