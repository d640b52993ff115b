"""Databases per zone, tables over the published datasets, and the dashboard views."""

from __future__ import annotations

from pyspark.sql import SparkSession

from streamlake import storage
from streamlake.contracts import FACT_NAMES, TABLES
from streamlake.operators.marts import SKIP_BELOW_SECONDS

ZONES = ("raw", "clean", "analytics")
ANALYTICS_TABLES = ("fact_stream", "dim_artist", "dim_track", "daily_listening_metrics")
WAREHOUSE_TABLES = ANALYTICS_TABLES
FACT_PARTITIONS = {"fact_stream": "ingest_date"}

# The dashboard's views over the warehouse; ``operators.marts`` has the same as functions.
VIEWS = {
    "vw_dashboard_events": f"""
        SELECT {', '.join(FACT_NAMES)}, IF(duration_seconds < {SKIP_BELOW_SECONDS}, 1, 0) AS is_skip
        FROM {{db}}.fact_stream""",
    "vw_daily_listening_minutes": """
        SELECT to_date(played_at) AS listening_date, CAST(sum(duration_seconds) AS DOUBLE) / 60 AS listening_minutes
        FROM {db}.fact_stream GROUP BY to_date(played_at)""",
    "vw_top_artists": """
        SELECT a.artist_name, t.event_count, t.listening_minutes
        FROM (SELECT artist_id, count(*) AS event_count, CAST(sum(duration_seconds) AS DOUBLE) / 60 AS listening_minutes
              FROM {db}.fact_stream GROUP BY artist_id) t
        JOIN {db}.dim_artist a ON t.artist_id = a.artist_id""",
    "vw_platform_distribution": """
        SELECT platform, count(*) AS event_count, CAST(sum(duration_seconds) AS DOUBLE) / 60 AS listening_minutes
        FROM {db}.fact_stream GROUP BY platform""",
    "vw_skip_rate": """
        SELECT to_date(played_at) AS listening_date, avg(CAST(is_skip AS DOUBLE)) AS skip_rate
        FROM {db}.vw_dashboard_events GROUP BY to_date(played_at)""",
}


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _database(spark: SparkSession, name: str, location: str) -> str:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION {_text(location)}")
    return name


def register_zones(spark: SparkSession, root: str, prefix: str = "lake") -> list[str]:
    """One database per zone, located at the zone's folder."""
    return [_database(spark, f"{prefix}_{zone}", f"{root}/{zone}") for zone in ZONES]


def _register(spark: SparkSession, db: str, name: str, base: str) -> str | None:
    """Make ``db.name`` a view of a table over the newest version of a dataset.

    The table has the version in its name, and the view is replaced in one step, so the
    name can be queried at any time; tables of older versions are dropped after it.
    Partitioned tables get one catalog partition per published directory, so a query
    with a partition filter never lists the rest.
    """
    snapshot = storage.current(spark, base)
    if snapshot is None:
        return None
    table, column = f"{name}_v{snapshot.version:08d}", FACT_PARTITIONS.get(name)
    if not spark.catalog.tableExists(f"{db}.{table}"):
        place = f"{base}/{storage.SNAPSHOTS}/none" if column or not snapshot.dirs else f"{base}/{snapshot.dirs[0]}"
        by = f"PARTITIONED BY ({column}) " if column else ""
        spark.sql(f"CREATE TABLE {db}.{table} ({TABLES[name].ddl}) USING PARQUET {by}LOCATION {_text(place)}")
        if column and snapshot.dirs:
            parts = " ".join(
                f"PARTITION ({column}={_text(d.split('=')[-1])}) LOCATION {_text(f'{base}/{d}')}" for d in snapshot.dirs
            )
            spark.sql(f"ALTER TABLE {db}.{table} ADD {parts}")
    spark.sql(f"CREATE OR REPLACE VIEW {db}.{name} AS SELECT * FROM {db}.{table}")
    for other in spark.catalog.listTables(db):
        if other.name.startswith(f"{name}_v") and other.name != table:
            spark.sql(f"DROP TABLE IF EXISTS {db}.{other.name}")  # external: the files stay
    return f"{db}.{name}"


def register_analytics(spark: SparkSession, root: str, prefix: str = "lake") -> list[str]:
    """Names for the newest version of each analytics dataset. Call again after a publish."""
    register_zones(spark, root, prefix)
    db = f"{prefix}_analytics"
    found = [_register(spark, db, name, f"{root}/analytics/{name}") for name in ANALYTICS_TABLES]
    return [name for name in found if name]


def register_warehouse(spark: SparkSession, root: str, prefix: str = "lake") -> list[str]:
    """Names for the warehouse tables and the five dashboard views over them."""
    db = _database(spark, f"{prefix}_warehouse", f"{root}/warehouse")
    found = [_register(spark, db, name, f"{root}/warehouse/{name}") for name in WAREHOUSE_TABLES]
    names = [name for name in found if name]
    if {f"{db}.fact_stream", f"{db}.dim_artist"} <= set(names):
        for view, body in VIEWS.items():
            spark.sql(f"CREATE OR REPLACE VIEW {db}.{view} AS {body.format(db=db)}")
            names.append(f"{db}.{view}")
    return names
