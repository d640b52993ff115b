"""Keyed upsert, as an operator and as a merge into a published dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlake import storage
from streamlake.functions.expressions import all_of
from streamlake.operators import keys
from streamlake.operators.dedup import default_order, first_per_key, require_unique


def latest_first(df: DataFrame, key: str) -> list[Column]:
    """An order in which the latest version of a key comes first: event time, then the rest."""
    return [F.col(c).desc() for c in default_order(df) if c != key]


def upsert(target: DataFrame, source: DataFrame, key: str = "event_id", newest: bool = False) -> DataFrame:
    """Rows of ``source`` replace or join those of ``target``; the other target rows stay.

    With ``newest`` the later version of a key on both sides stays, whichever side has it.

    Repeating it with the same source changes nothing. The joins broadcast the source keys
    when Spark measures them as small, and then the target is not shuffled.
    """
    source = source.select(*target.columns)
    kept = target.join(source.select(key), key, "left_anti").select(*target.columns)
    if newest:
        met = target.join(source.select(key), key, "left_semi").select(*target.columns)
        source = first_per_key(met.unionByName(source), key, latest_first(target, key))
    return kept.unionByName(source)


def compare_partitions(target: DataFrame, source: DataFrame, partition: str) -> tuple[list, list]:
    """Partition values of the source: (those where the target holds the same rows, the others).

    Compared by row count and two 64-bit hashes over all columns, so each side is
    scanned once, combined on the map side, and nothing but one row per partition moves. The
    target's partitions that the source does not name are not read.
    The hash passes over nulls, so each column goes in with its null flag.
    """
    named = [r[0] for r in source.select(partition).distinct().collect()]

    def digest(df: DataFrame, prefix: str) -> DataFrame:
        columns = [x for c in target.columns for x in (F.col(c), F.col(c).isNull())]
        return df.groupBy(partition).agg(
            F.count(F.lit(1)).alias(f"{prefix}_rows"),
            F.bit_xor(F.xxhash64(*columns)).alias(f"{prefix}_hash"),
            F.bit_xor(F.xxhash64(F.lit("second"), *columns)).alias(f"{prefix}_hash2"),
        )

    same = all_of([F.col(f"t_{x}") == F.col(f"s_{x}") for x in ("rows", "hash", "hash2")])
    both = digest(source, "s").join(digest(target.filter(keys.in_partitions(partition, named)), "t"), partition, "left")
    rows = both.select(partition, F.coalesce(same, F.lit(False)).alias("same")).collect()
    return [r[0] for r in rows if r["same"]], [r[0] for r in rows if not r["same"]]


def merge_into(
    spark: SparkSession,
    root: str,
    source: DataFrame,
    key: str = "event_id",
    partition: str = "ingest_date",
    sort_by: tuple[str, ...] = ("played_at",),
    skip_equal: bool = False,
    newest: bool = False,
) -> storage.Snapshot:
    """Upsert ``source`` into the dataset at ``root`` and publish the result as a new version.

    The source is checked first: a null or repeated key raises and publishes nothing.
    Only partitions with a changed or new row are rewritten, the rest are carried over
    by reference. The dataset's key index tells where source keys are stored now, also those
    that the source has in another partition; it is made by the first merge and kept with
    every version. ``source`` is read several times, so pass a written table.

    ``skip_equal`` first leaves out the partitions that already hold the same rows; it
    suits a reload of whole partitions that differs in a few of them. The rows left are
    checked among themselves and against the keys left out, which amounts to checking the
    whole source. With ``newest`` the later version of an event stays instead of the source's.
    """
    base = storage.current(spark, root)
    if base is None:
        require_unique(source, key)
        return storage.publish(source, root, partition, sort_by, lookup=key)
    target = storage.read(spark, root)
    source = source.select(*target.columns)
    if skip_equal:
        same, changed = compare_partitions(target, source, partition)
        if not changed:
            return base
        equal = keys.in_partitions(partition, same)
        left_out, source = source.filter(equal), source.filter(~equal)
        require_unique(source, key)
        _require_disjoint(left_out, source, key)
    else:
        require_unique(source, key)
    index = base.keys or keys.build(target, root, key, partition)
    named, elsewhere, fresh = keys.lookup(spark, root, index, source, key, partition)
    touched = named + [v for v in elsewhere if v not in named]
    if not touched:
        return base
    index = keys.extended(spark, root, base, index, fresh, partition)
    names = {storage.partition_dir(partition, v) for v in touched}
    keep = tuple(d for d in base.dirs if d.split("/")[-1] not in names)
    merged = upsert(target.filter(keys.in_partitions(partition, touched)), source, key, newest)
    return storage.publish(merged, root, partition, sort_by, keep=keep, base=base, keys=index, lookup=key)


def _require_disjoint(left: DataFrame, right: DataFrame, key: str) -> None:
    """Raise when a key occurs on both sides; the smaller side is broadcast if it is small."""
    shared = left.select(key).join(right.select(key), key, "left_semi")
    found = shared.agg(F.count(F.lit(1)).alias("rows"), F.any_value(key).alias("example")).first()
    if found["rows"]:
        raise ValueError(f"{key} must be unique; {found['example']!r} is in two partitions of the source")
