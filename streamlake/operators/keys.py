"""Where each key of a published dataset is stored: an index beside it, in buckets by key hash.

A row is (key_hash, partition, bucket). A merge opens the buckets of its own keys only and
learns which partitions hold them, without reading the key column of the dataset. Entries
are only added; one that no longer holds costs a partition that is looked at in vain. After
``MERGE_FOLDERS`` additions the index is written anew, with buckets for its size by then.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlake.storage import KeyIndex, Snapshot, layout, read

FOLDER = "_keys"
ROWS_PER_BUCKET = 4_000_000  # some 60 MB as Parquet
LEAST_BUCKETS, MOST_BUCKETS = 8, 4096
MERGE_FOLDERS = 16


def in_partitions(partition: str, values: list) -> Column:
    """Whether a row lies in one of the partitions; null is a partition too."""
    known = [v for v in values if v is not None]
    column = F.col(partition)
    return (column.isin(known) | column.isNull()) if None in values else F.coalesce(column.isin(known), F.lit(False))


def bucket_count(rows: int) -> int:
    """A power of two that gives buckets of about ``ROWS_PER_BUCKET``."""
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, 1 << (rows // ROWS_PER_BUCKET).bit_length()))


def key_rows(df: DataFrame, key: str, partition: str, buckets: int) -> DataFrame:
    """The index entries of a frame's rows."""
    hashed = df.select(F.xxhash64(key).alias("key_hash"), F.col(partition))
    return hashed.withColumn("bucket", F.pmod("key_hash", F.lit(buckets)).cast("int"))


def write_entries(entries: DataFrame, root: str) -> str:
    """Write entries as one more folder of the index; returns the folder."""
    folder = f"{FOLDER}/k={uuid.uuid4().hex[:12]}"
    laid_out = layout(entries, "bucket", ("key_hash",))
    laid_out.write.partitionBy("bucket").option("compression", "snappy").parquet(f"{root}/{folder}")
    return folder


def read_entries(spark: SparkSession, root: str, index: KeyIndex, kind: T.StructField, buckets: list[int] | None = None) -> DataFrame:
    """(key_hash, partition, bucket), of the given buckets only."""
    fields = [T.StructField("key_hash", T.LongType()), kind, T.StructField("bucket", T.IntegerType())]
    schema = T.StructType([*fields, T.StructField("k", T.StringType())])
    found = spark.read.schema(schema).option("basePath", f"{root}/{FOLDER}").parquet(*[f"{root}/{d}" for d in index.dirs])
    if buckets is not None and len(buckets) < index.buckets:
        found = found.filter(F.col("bucket").isin(buckets))
    return found.drop("k")


def build(target: DataFrame, root: str, key: str, partition: str) -> KeyIndex:
    """The index of a dataset that has none yet; one pass over its key column."""
    buckets = bucket_count(target.select(partition).count())  # from the file footers
    return KeyIndex(buckets, (write_entries(key_rows(target, key, partition, buckets), root),))


def _same(left: DataFrame, right: DataFrame, partition: str) -> Column:
    return (left["key_hash"] == right["key_hash"]) & left[partition].eqNullSafe(right[partition])


def lookup(
    spark: SparkSession, root: str, index: KeyIndex, source: DataFrame, key: str, partition: str
) -> tuple[list, list, DataFrame | None]:
    """(partitions that the source names, partitions where its keys are stored, new entries).

    The new entries are None where the index has them all. Partition values and bucket
    numbers are all that the driver gets.
    """
    entries = key_rows(source, key, partition, index.buckets)
    used = entries.groupBy(partition, "bucket").agg(F.count(F.lit(1)).alias("n")).collect()
    if not used:
        return [], [], None
    stored = read_entries(spark, root, index, source.schema[partition], sorted({r["bucket"] for r in used}))
    held = stored.select(F.col("key_hash"), F.col(partition).alias("_stored"), F.lit(True).alias("_held"))
    both = entries.join(held, "key_hash", "left")
    in_place = F.when(F.col("_held") & F.col("_stored").eqNullSafe(F.col(partition)), F.col("key_hash"))
    found = both.agg(
        F.collect_set("_stored").alias("stored"),
        F.bool_or(F.col("_held") & F.col("_stored").isNull()).alias("null_stored"),
        F.count_distinct(in_place).alias("in_place"),
    ).first()
    named = list({r[partition] for r in used})
    elsewhere = [*found["stored"], *([None] if found["null_stored"] else [])]
    fresh = entries.join(stored, _same(entries, stored, partition), "left_anti")
    return named, elsewhere, fresh if found["in_place"] < sum(r["n"] for r in used) else None


def extended(spark: SparkSession, root: str, base: Snapshot, index: KeyIndex, fresh: DataFrame | None, partition: str) -> KeyIndex:
    """The index with the new entries; written anew once it has many folders."""
    if fresh is None:
        return index
    if len(index.dirs) < MERGE_FOLDERS:
        return KeyIndex(index.buckets, (*index.dirs, write_entries(fresh, root)))
    whole = read_entries(spark, root, index, base.schema[partition]).unionByName(fresh).select("key_hash", partition).distinct()
    buckets = bucket_count(whole.count())
    whole = whole.withColumn("bucket", F.pmod("key_hash", F.lit(buckets)).cast("int"))
    return KeyIndex(buckets, (write_entries(whole, root),))


def repeated_keys(spark: SparkSession, root: str, snapshot: Snapshot, rows: DataFrame, key: str, partition: str) -> int:
    """How many rows too many there are for the keys of ``rows``, a dataset's changed partitions.

    ``rows`` are counted among themselves, and those whose hash the index has in another
    partition are compared with the keys of that partition. Keys of other buckets and
    partitions are not read.
    """
    extra = rows.groupBy(key).agg((F.count(F.lit(1)) - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    named, elsewhere, _ = lookup(spark, root, snapshot.keys, rows, key, partition)
    others = [v for v in elsewhere if v not in named]
    if not others:
        return extra
    stored = read(spark, root).filter(in_partitions(partition, others)).select(key)
    return extra + stored.join(rows.select(key).distinct(), key, "left_semi").count()
