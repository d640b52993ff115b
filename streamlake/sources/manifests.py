"""Manifest keys -> work list of raw prefixes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlake import storage
from streamlake.functions.expressions import decode_form_url
from streamlake.sources.readers import MANIFEST_NAME

# Fixed value: the only object key that may start a run.
MANIFEST_KEY = r"^raw/source=[^/]+/ingest_date=(\d{4}-\d{2}-\d{2})/manifest\.json\z"


def manifest_worklist(keys: DataFrame, encoded: bool = True) -> DataFrame:
    """Decide each ``(bucket, key)``: adds raw_prefix, ingest_date, status and reason.

    Keys of storage events are form-encoded; listed paths are literal (``encoded`` false).

    ``status`` is ``accepted`` or ``rejected``; a rejected key belongs to the dead letters.
    The key has to match as a whole, and its date has to exist.
    """
    key = decode_form_url(F.col("key")) if encoded else F.col("key")
    decoded = keys.withColumn("_key", key)
    day = F.regexp_extract("_key", MANIFEST_KEY, 1)
    reason = F.when(~F.col("_key").rlike(MANIFEST_KEY), "not_a_manifest").when(
        F.try_to_date(day).isNull(), "no_such_date"
    )
    accepted = reason.isNull()
    return decoded.select(
        *keys.columns,
        F.when(accepted, F.regexp_replace("_key", r"manifest\.json\z", "")).alias("raw_prefix"),
        F.when(accepted, F.try_to_date(day)).alias("ingest_date"),
        F.when(accepted, "accepted").otherwise("rejected").alias("status"),
        reason.alias("reason"),
    )


def split_worklist(worklist: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(work list, dead letters)."""
    accepted = F.col("status") == "accepted"
    return worklist.filter(accepted), worklist.filter(~accepted)


def list_manifests(spark: SparkSession, root: str) -> DataFrame:
    """``(bucket, key, modified)`` of every manifest below ``root/raw``; data files are not listed."""
    root = root.rstrip("/")
    found = storage.glob(spark, f"{root}/raw/*/*/{MANIFEST_NAME}")
    rows = [(root, "raw/" + "/".join(path.split("/")[-3:]), modified) for path, modified in found]
    return spark.createDataFrame(rows, "bucket string, key string, modified long")
