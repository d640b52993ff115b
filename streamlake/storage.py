"""Versioned Parquet datasets: write a new version beside the old one, then publish it.

A dataset is ``root/v=<version>/[<column>=<value>/]`` plus one small snapshot file per
version that lists the directories belonging to it. Readers follow the newest snapshot,
so they see the old state or the new one and never a half-written mix; a version may
keep directories of an earlier one, so a merge rewrites only the partitions it touches.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SNAPSHOTS = "_snapshots"


@dataclass(frozen=True)
class KeyIndex:
    """Folders of the dataset's key index, see ``operators.keys``."""

    buckets: int
    dirs: tuple[str, ...]


@dataclass(frozen=True)
class Snapshot:
    version: int
    dirs: tuple[str, ...]
    schema: T.StructType
    keys: KeyIndex | None = None


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def qualified(spark: SparkSession, path: str) -> str:
    """The full URI of a path, as the file system writes it."""
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toString()


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a directory; used on snapshot and partition directories only."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(p))


def glob(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(path, modification time in ms) of what matches; used to list partition directories
    and manifests without listing the data files beside them."""
    fs, p = _fs(spark, pattern)
    return sorted((s.getPath().toString(), s.getModificationTime()) for s in fs.globStatus(p) or [])


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file; fails when it exists, which makes it usable as a commit."""
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def delete_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.delete(p, True)


def partition_dir(column: str, value: object) -> str:
    """Directory name Spark gives a date partition."""
    return f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def current(spark: SparkSession, root: str) -> Snapshot | None:
    names = [n for n in child_names(spark, f"{root}/{SNAPSHOTS}") if n.endswith(".json")]
    if not names:
        return None
    body = json.loads(read_text(spark, f"{root}/{SNAPSHOTS}/{names[-1]}"))
    keys = body.get("keys")
    index = KeyIndex(keys["buckets"], tuple(keys["dirs"])) if keys else None
    return Snapshot(body["version"], tuple(body["dirs"]), T.StructType.fromJson(body["schema"]), index)


def read(spark: SparkSession, root: str) -> DataFrame:
    """The published state. A filter on the partition column prunes directories."""
    snapshot = current(spark, root)
    if snapshot is None:
        raise ValueError(f"nothing is published at {root}")
    if not snapshot.dirs:
        return spark.createDataFrame([], snapshot.schema)
    with_version = T.StructType([*snapshot.schema.fields, T.StructField("v", T.StringType())])
    return (
        spark.read.schema(with_version)
        .option("basePath", root)
        .parquet(*[f"{root}/{d}" for d in snapshot.dirs])
        .select(*snapshot.schema.names)
    )


def publish(
    df: DataFrame,
    root: str,
    partition_by: str | None = None,
    sort_by: tuple[str, ...] = (),
    keep: tuple[str, ...] = (),
    base: Snapshot | None = None,
    keys: KeyIndex | None = None,
    lookup: str | None = None,
) -> Snapshot:
    """Write ``df`` as a new version and make it the published one.

    ``lookup`` names a column that single values are looked up by: its row groups get Bloom
    filters, of a size that adapts to their values, so a lookup skips most of them.

    ``keep`` lists directories of the ``base`` snapshot carried over unchanged, ``keys`` is an
    index that covers all rows of the new version. When
    another writer has published since ``base`` was read, the commit fails and leaves
    the published state alone; the attempt has a directory of its own, so a repeat
    after a failure cannot mix with leftovers.
    """
    spark = df.sparkSession
    base = base or current(spark, root)
    version = base.version + 1 if base else 1
    attempt = f"v={version:08d}-{uuid.uuid4().hex[:8]}"
    laid_out = layout(df, partition_by, sort_by)
    writer = laid_out.write.mode("errorifexists").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if lookup:
        writer = writer.options(
            **{f"parquet.bloom.filter.enabled#{lookup}": "true", f"parquet.bloom.filter.adaptive.enabled#{lookup}": "true"}
        )
    writer.parquet(f"{root}/{attempt}")

    if partition_by:
        written = tuple(
            f"{attempt}/{name}"
            for name in child_names(spark, f"{root}/{attempt}")
            if name.startswith(f"{partition_by}=")
        )
    else:
        written = (attempt,)
    return commit(spark, root, base, tuple(keep) + written, df.schema, keys)


def commit(
    spark: SparkSession,
    root: str,
    base: Snapshot | None,
    dirs: tuple[str, ...],
    schema: T.StructType,
    keys: KeyIndex | None = None,
) -> Snapshot:
    """Make ``dirs`` the published state; fails when ``base`` is no longer the newest version."""
    version = base.version + 1 if base else 1
    body = {"version": version, "dirs": dirs, "schema": schema.jsonValue()}
    if keys:
        body["keys"] = {"buckets": keys.buckets, "dirs": keys.dirs}
    write_text(spark, f"{root}/{SNAPSHOTS}/{version:08d}.json", json.dumps(body))
    return Snapshot(version, dirs, schema, keys)


def changed_partitions(before: Snapshot | None, after: Snapshot) -> list[str]:
    """Partition values, as in the directory names, that two versions do not share."""
    differing = set(before.dirs if before else ()) ^ set(after.dirs)
    return sorted({d.rsplit("=", 1)[-1] for d in differing})


def carried_over(base: Snapshot | None, partition: str, values: list[str]) -> tuple[str, ...]:
    """Directories of ``base`` outside the given partition values."""
    names = {partition_dir(partition, v) for v in values}
    return tuple(d for d in base.dirs if d.split("/")[-1] not in names) if base else ()


def prune(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete directories that none of the newest ``keep`` versions uses; returns them.

    Attempts of a version that is not published yet stay, as a writer may be at work.
    """
    names = [n for n in child_names(spark, f"{root}/{SNAPSHOTS}") if n.endswith(".json")]
    if not names:
        return []
    newest = int(names[-1].removesuffix(".json"))
    bodies = [json.loads(read_text(spark, f"{root}/{SNAPSHOTS}/{n}")) for n in names[-keep:]]
    used = {d for body in bodies for d in body["dirs"]}
    used_attempts = {d.split("/")[0] for d in used}
    indexes = {d for body in bodies if body.get("keys") for d in body["keys"]["dirs"]}
    removed = [d for d in _index_dirs(spark, root, names[:-keep]) if d not in indexes]
    for attempt in child_names(spark, root):
        if not attempt.startswith("v=") or int(attempt[2:10]) > newest:
            continue
        if attempt not in used_attempts:
            removed.append(attempt)
        elif attempt not in used:
            parts = [f"{attempt}/{n}" for n in child_names(spark, f"{root}/{attempt}") if "=" in n]
            removed += [d for d in parts if d not in used]
    for d in removed:
        delete_dir(spark, f"{root}/{d}")
    for n in names[:-keep]:
        delete_dir(spark, f"{root}/{SNAPSHOTS}/{n}")
    return removed


def _index_dirs(spark: SparkSession, root: str, names: list[str]) -> list[str]:
    """Index folders of the given snapshots; a writer at work has its own in none of them."""
    bodies = [json.loads(read_text(spark, f"{root}/{SNAPSHOTS}/{n}")) for n in names]
    return sorted({d for body in bodies if body.get("keys") for d in body["keys"]["dirs"]})


def layout(df: DataFrame, partition_by: str | tuple[str, ...] | None, sort_by: tuple[str, ...] = ()) -> DataFrame:
    """Few, evenly sized, sorted files per partition.

    The rebalance shuffle lets adaptive execution split a partition value that holds
    most rows over many tasks and merge the small ones; a plain repartition by the
    column would send each value to a single task.
    """
    columns = (partition_by,) if isinstance(partition_by, str) else tuple(partition_by or ())
    order = (*columns, *[c for c in sort_by if c not in columns])
    if not order:
        return df
    return df.hint("rebalance", *columns).sortWithinPartitions(*order)
