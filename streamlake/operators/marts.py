"""The dashboard marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlake.contracts import FACT_NAMES

# Fixed value: a play shorter than this many seconds counts as skipped.
SKIP_BELOW_SECONDS = 30
# Fixed value: artists shown by the top-artists chart.
TOP_ARTISTS = 10


def _minutes(seconds: Column) -> Column:
    return (F.sum(seconds).cast("double") / 60).alias("listening_minutes")


def dashboard_events(fact: DataFrame, duration: str = "duration_seconds") -> DataFrame:
    """The fact columns and the skip flag."""
    is_skip = F.when(F.col(duration) < SKIP_BELOW_SECONDS, 1).otherwise(0)
    return fact.select(*FACT_NAMES, is_skip.alias("is_skip"))


def daily_listening_minutes(
    fact: DataFrame, event_time: str = "played_at", duration: str = "duration_seconds"
) -> DataFrame:
    """Minutes per day of play, ordered by day."""
    day = F.to_date(event_time).alias("listening_date")
    return fact.groupBy(day).agg(_minutes(F.col(duration))).orderBy("listening_date")


def top_artists(
    fact: DataFrame, artists: DataFrame, key: str = "artist_id", duration: str = "duration_seconds"
) -> DataFrame:
    """Plays and minutes per artist name, for artists known to the dimension.

    Plays are totalled per key before the join. The join then meets one row per artist
    instead of one per play, so it needs no hint and a very popular artist is no skew.
    """
    per_key = fact.groupBy(key).agg(
        F.count(F.lit(1)).alias("plays"), F.sum(duration).cast("bigint").alias("seconds")
    )
    return (
        per_key.join(artists.select(key, "artist_name"), key, "inner")
        .groupBy("artist_name")
        .agg(F.sum("plays").alias("event_count"), _minutes(F.col("seconds")))
    )


def top_n_artists(totals: DataFrame, n: int = TOP_ARTISTS) -> DataFrame:
    """Artists with the most minutes; the name breaks ties."""
    return totals.orderBy(F.desc("listening_minutes"), F.asc("artist_name")).limit(n)


def platform_distribution(fact: DataFrame, platform: str = "platform", duration: str = "duration_seconds") -> DataFrame:
    return fact.groupBy(platform).agg(F.count(F.lit(1)).alias("event_count"), _minutes(F.col(duration)))


def skip_rate(fact: DataFrame, event_time: str = "played_at", duration: str = "duration_seconds") -> DataFrame:
    """Share of skipped plays per day of play."""
    is_skip = F.when(F.col(duration) < SKIP_BELOW_SECONDS, 1.0).otherwise(0.0)
    return fact.groupBy(F.to_date(event_time).alias("listening_date")).agg(F.avg(is_skip).alias("skip_rate"))


def latest_skip_rate(rates: DataFrame) -> DataFrame:
    return rates.orderBy(F.desc("listening_date")).limit(1)


def fact_count(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count(F.lit(1)).alias("event_count"))


def play_totals(fact: DataFrame, event_time: str = "played_at", duration: str = "duration_seconds") -> DataFrame:
    """Plays, seconds and skips per load day, day of play, platform and artist.

    The dashboard marts are sums of these, so a changed load day replaces its own totals and
    the events of the other days are not read again.
    """
    skipped = F.count_if(F.col(duration) < SKIP_BELOW_SECONDS)
    return fact.groupBy("ingest_date", F.to_date(event_time).alias("listening_date"), "platform", "artist_id").agg(
        F.count(F.lit(1)).alias("plays"), F.sum(duration).cast("bigint").alias("seconds"), skipped.alias("skips")
    )


def marts_of_totals(totals: DataFrame, artists: DataFrame) -> dict[str, DataFrame]:
    """The dashboard marts by name; the same rows as from the events themselves."""
    minutes = _minutes(F.col("seconds"))
    plays = F.sum("plays")
    per_artist = totals.groupBy("artist_id").agg(plays.alias("plays"), F.sum("seconds").alias("seconds"))
    named = per_artist.join(artists.select("artist_id", "artist_name"), "artist_id")
    per_day = totals.groupBy("listening_date")
    return {
        "daily_listening_minutes": per_day.agg(minutes).orderBy("listening_date"),
        "top_artists": named.groupBy("artist_name").agg(plays.alias("event_count"), minutes),
        "platform_distribution": totals.groupBy("platform").agg(plays.alias("event_count"), minutes),
        "skip_rate": per_day.agg((F.sum("skips").cast("double") / plays).alias("skip_rate")),
    }
