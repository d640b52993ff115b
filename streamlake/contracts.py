"""The event contract and the warehouse table rules, held as data.

Everything else (read schemas, gate rules, constraint checks) is generated from here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """One contract field: its published type and the rules a value has to meet."""

    name: str
    dtype: T.DataType
    json_kind: str = "string"
    fmt: str | None = None
    min_length: int | None = None
    max_length: int | None = None  # of the published column
    minimum: int | None = None
    choices: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Contract:
    version: str
    fields: tuple[Field, ...]
    key: str
    event_time: str
    partition: str

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def __getitem__(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)

    def raw_schema(self) -> T.StructType:
        """Every field as string: a bad value stays readable and can be quarantined as it came."""
        return T.StructType([T.StructField(f.name, T.StringType()) for f in self.fields])

    def clean_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.dtype) for f in self.fields])


# Event contract version 1.0.0 (names, types, formats, limits, platforms).
EVENT_CONTRACT = Contract(
    version="1.0.0",
    fields=(
        Field("event_id", T.StringType(), fmt="uuid", min_length=1, max_length=36),
        Field("user_id", T.StringType(), min_length=1, max_length=128),
        Field("track_id", T.StringType(), min_length=1, max_length=128),
        Field("artist_name", T.StringType(), min_length=1, max_length=512),
        Field("played_at", T.TimestampType(), fmt="date-time", min_length=1),
        Field("duration_seconds", T.IntegerType(), json_kind="integer", minimum=1),
        Field("platform", T.StringType(), max_length=32, choices=("android", "ios", "web", "desktop")),
        Field("ingest_date", T.DateType(), fmt="date", min_length=1),
    ),
    key="event_id",
    event_time="played_at",
    partition="ingest_date",
)


@dataclass(frozen=True)
class TableRules:
    """Warehouse rules of one table: column order, types, varchar lengths, key, sort order."""

    name: str
    columns: tuple[tuple[str, str], ...]
    primary_key: tuple[str, ...] = ()
    sort_key: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def ddl(self) -> str:
        return ", ".join(f"{name} {dtype}" for name, dtype in self.columns)


# Columns, varchar lengths, primary keys and sort keys of the published tables.
FACT_COLUMNS = (
    ("event_id", "string"),
    ("user_id", "string"),
    ("track_id", "string"),
    ("artist_id", "string"),
    ("played_at", "timestamp"),
    ("duration_seconds", "int"),
    ("platform", "string"),
    ("ingest_date", "date"),
)
FACT_LENGTHS = {"event_id": 36, "user_id": 128, "track_id": 128, "artist_id": 64, "platform": 32}

TABLES = {
    "dim_artist": TableRules(
        "dim_artist",
        (("artist_id", "string"), ("artist_name", "string")),
        primary_key=("artist_id",),
        max_length={"artist_id": 64, "artist_name": 512},
    ),
    "dim_track": TableRules(
        "dim_track",
        (("track_id", "string"), ("artist_id", "string")),
        primary_key=("track_id",),
        max_length={"track_id": 128, "artist_id": 64},
    ),
    "fact_stream": TableRules(
        "fact_stream",
        FACT_COLUMNS,
        primary_key=("event_id",),
        sort_key=("ingest_date", "played_at"),
        max_length=FACT_LENGTHS,
    ),
    "daily_listening_metrics": TableRules(
        "daily_listening_metrics",
        (
            ("ingest_date", "date"),
            ("platform", "string"),
            ("event_count", "bigint"),
            ("unique_listener_count", "bigint"),
            ("listening_seconds", "bigint"),
        ),
        primary_key=("ingest_date", "platform"),
        sort_key=("ingest_date",),
        max_length={"platform": 32},
    ),
    "stg_fact_stream": TableRules("stg_fact_stream", FACT_COLUMNS, max_length=FACT_LENGTHS),
}

FACT_NAMES = TABLES["fact_stream"].names
