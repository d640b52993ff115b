"""Constraint report, retention and compaction."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlake import storage
from streamlake.contracts import TABLES, TableRules
from streamlake.operators import keys

# Days a zone keeps its partitions.
RETENTION_DAYS = {"raw": 90, "clean": 180, "analytics": 365}


def constraint_report(df: DataFrame, rules: TableRules) -> DataFrame:
    """One row per rule of the table: (table_name, rule, failures).

    All column rules are counted in one pass over the table. The key rule counts the rows
    too many per key; its aggregate reads only the key columns and combines before the shuffle.
    """
    missing = sorted(set(rules.names) - set(df.columns))
    if missing:
        raise ValueError(f"{rules.name} lacks columns: {', '.join(missing)}")
    checks = [(f"not_null:{c}", F.col(c).isNull()) for c in rules.names]
    checks += [(f"max_length:{c}", F.length(c) > n) for c, n in rules.max_length.items()]
    counted = df.agg(*[F.count_if(condition).alias(f"c{i}") for i, (_, condition) in enumerate(checks)])
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("rule"), F.col(f"c{i}").alias("failures"))
            for i, (name, _) in enumerate(checks)
        ]
    )
    report = counted.select(F.inline(pairs))
    if rules.primary_key:
        repeated = (
            df.groupBy(*rules.primary_key)
            .agg((F.count(F.lit(1)) - 1).alias("extra"))
            .agg(F.coalesce(F.sum("extra"), F.lit(0)).cast("bigint").alias("failures"))
            .select(F.lit(f"primary_key:{','.join(rules.primary_key)}").alias("rule"), "failures")
        )
        report = report.unionByName(repeated)
    return report.select(F.lit(rules.name).alias("table_name"), "rule", "failures")


def changed_report(spark: SparkSession, dataset: str, changed: DataFrame, rules: TableRules, partition: str = "ingest_date") -> DataFrame:
    """``constraint_report`` of a dataset of which only the partitions in ``changed`` are new.

    The rest was checked when it was published. Column rules are counted over the changed
    rows; for the key, those are counted among themselves and looked up in the dataset's key
    index, which opens the buckets of their keys. Without an index all keys are counted.
    """
    snapshot = storage.current(spark, dataset)
    report = constraint_report(changed, replace(rules, primary_key=()))
    (key,) = rules.primary_key
    if snapshot is None or snapshot.keys is None:
        whole = storage.read(spark, dataset)
        extra = whole.groupBy(key).agg((F.count(F.lit(1)) - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    else:
        extra = keys.repeated_keys(spark, dataset, snapshot, changed, key, partition)
    row = [(rules.name, f"primary_key:{key}", extra)]
    return report.unionByName(spark.createDataFrame(row, "table_name string, rule string, failures long"))


def check_constraints(df: DataFrame, table: str) -> None:
    """Raise when a table breaks one of its rules; the report has a fixed, small size."""
    _require_sound(constraint_report(df, TABLES[table]), table)


def check_changed(spark: SparkSession, dataset: str, changed: DataFrame, table: str) -> None:
    """``check_constraints`` for the changed partitions of a dataset; stands for its primary key."""
    rules = replace(TABLES[table], primary_key=TABLES["fact_stream"].primary_key)
    _require_sound(changed_report(spark, dataset, changed, rules), table)


def _require_sound(report: DataFrame, table: str) -> None:
    broken = report.filter("failures > 0").collect()
    if broken:
        listed = ", ".join(f"{r['rule']} ({r['failures']})" for r in broken)
        raise ValueError(f"{table} breaks {listed}")


def expired_partitions(partitions: DataFrame, as_of: str, days: dict[str, int] = RETENTION_DAYS) -> DataFrame:
    """Partitions older than their zone keeps them.

    ``partitions`` has columns zone and ingest_date, one row per partition or several.
    """
    keep = F.create_map(*[F.lit(x) for pair in days.items() for x in pair])
    return (
        partitions.filter(F.col("ingest_date") < F.date_sub(F.lit(as_of).cast("date"), keep[F.col("zone")]))
        .select("zone", "ingest_date")
        .distinct()
    )


# Where the zones keep their partition directories.
PARTITION_DIRS = {"raw": "raw/*/ingest_date=*", "clean": "clean/ingest_date=*"}


def lake_partitions(spark: SparkSession, root: str) -> DataFrame:
    """(zone, ingest_date, path) of the raw and clean partition directories; lists no files."""
    rows = [
        (zone, path.rsplit("=", 1)[-1], path)
        for zone, pattern in PARTITION_DIRS.items()
        for path, _ in storage.glob(spark, f"{root}/{pattern}")
    ]
    found = spark.createDataFrame(rows, "zone string, ingest_date string, path string")
    return found.withColumn("ingest_date", F.try_to_date("ingest_date"))


def drop_expired(spark: SparkSession, root: str, as_of: str, dry_run: bool = True) -> list[str]:
    """Expired raw and clean directories, deleted unless ``dry_run``.

    Expired partitions of the fact are dropped too, by publishing a version without
    them, because their directories belong to a snapshot.
    """
    partitions = lake_partitions(spark, root)
    expired = partitions.join(expired_partitions(partitions, as_of), ["zone", "ingest_date"], "left_semi")
    paths = sorted(r["path"] for r in expired.collect())
    if not dry_run:
        for path in paths:  # one call per partition directory
            storage.delete_dir(spark, path)
        cutoff = dt.date.fromisoformat(as_of) - dt.timedelta(days=RETENTION_DAYS["analytics"])
        retire_partitions(spark, f"{root}/analytics/fact_stream", "ingest_date", cutoff)
    return paths


def retire_partitions(spark: SparkSession, dataset: str, column: str, cutoff: dt.date) -> storage.Snapshot | None:
    """Publish a version without the partitions before ``cutoff``; no data is read or written."""
    base = storage.current(spark, dataset)
    if base is None:
        return None
    kept = tuple(d for d in base.dirs if not d.split(f"{column}=")[-1] < cutoff.isoformat())
    return base if kept == base.dirs else storage.commit(spark, dataset, base, kept, base.schema, base.keys)


def compact(spark: SparkSession, dataset: str, partition: str | None, sort_by: tuple[str, ...]) -> storage.Snapshot:
    """Rewrite the published state into few sorted files per partition."""
    base = storage.current(spark, dataset)
    return storage.publish(storage.read(spark, dataset), dataset, partition, sort_by, base=base)
