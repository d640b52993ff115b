"""Scans of the raw, clean and sample data."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlake import storage
from streamlake.contracts import EVENT_CONTRACT, Contract
from streamlake.functions.expressions import split_json_objects
from streamlake.operators.quality import CORRUPT, SHAPE

MANIFEST_NAME = "manifest.json"
CLEAN_PARTITIONS = ("ingest_date", "source", "load_id")


def resolve_prefix(root: str, prefix: str) -> str:
    """An absolute URI or path stays as it is; a relative prefix is joined to the lake root."""
    if "://" in prefix or prefix.startswith("/"):
        return prefix
    return f"{root.rstrip('/')}/{prefix}"


def path_part(path: Column, name: str) -> Column:
    """Value of the ``name=value`` directory in a file path, percent escapes decoded; null without one."""
    marker = f"/{name}="
    value = F.substring_index(F.substring_index(path, marker, -1), "/", 1)
    decoded = F.when(F.contains(value, F.lit("%")), F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))))
    return F.when(F.contains(path, F.lit(marker)), F.coalesce(decoded, value))


def _not_manifest() -> Column:
    return F.col("_metadata.file_name") != MANIFEST_NAME


def read_raw(
    spark: SparkSession, *prefixes: str, contract: Contract = EVENT_CONTRACT
) -> DataFrame:
    """JSON objects below the prefixes, all fields as text; unreadable text lands in ``_corrupt_record``.

    Partition directories are not turned into columns, so the record's own
    ``ingest_date`` stays visible to the quality gate.
    """
    return parse_objects(read_raw_lines(spark, *prefixes), contract).select(*contract.names, CORRUPT)


LOAD_ID_CHARS = 16


def load_id_of(location: str) -> str:
    """Name of the load that a folder or file of raw data makes; the same for every run."""
    plain = re.sub(r"^(\w+):/+", r"\1:/", location.rstrip("/"))
    return hashlib.sha256(plain.encode()).hexdigest()[:LOAD_ID_CHARS]


def _load_id(path: Column, whole_folders: bool) -> Column:
    """``load_id_of`` the file's folder, or of the file itself."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    unit = F.regexp_replace(decoded, "/[^/]*$", "") if whole_folders else decoded
    return F.substring(F.sha2(F.regexp_replace(unit, r"^(\w+):/+", "$1:/"), 256), 1, LOAD_ID_CHARS)


def read_raw_lines(spark: SparkSession, *prefixes: str) -> DataFrame:
    """One row per JSON object text, also where objects follow each other without a newline.

    Columns: ``raw_line``, ``source`` and ``run_date`` taken from the directory names, and
    ``load_id``: rows of one folder are one load. A prefix that names a file or a pattern
    covers a part of a folder, so each of its files is a load of its own.
    """
    out = None
    folders = [p for p in prefixes if storage.is_dir(spark, p)]
    for paths, whole in ((folders, True), ([p for p in prefixes if p not in folders], False)):
        if paths:
            lines = spark.read.option("recursiveFileLookup", "true").text(paths).filter(_not_manifest())
            part = raw_objects(lines, whole)
            out = part if out is None else out.unionByName(part)
    return out


def raw_objects(lines: DataFrame, whole_folders: bool = True) -> DataFrame:
    """The splitting step of ``read_raw_lines``, for a batch or streaming frame of text files."""
    path = F.col("_metadata.file_path")
    return (
        lines.filter(F.trim("value") != "")
        .select(
            F.explode(split_json_objects(F.trim("value"))).alias("raw_line"),
            path_part(path, "source").alias("source"),
            F.try_to_date(path_part(path, "ingest_date")).alias("run_date"),
            _load_id(path, whole_folders).alias("load_id"),
        )
    )


def parse_objects(df: DataFrame, contract: Contract = EVENT_CONTRACT, shape: bool = False) -> DataFrame:
    """Contract columns, as text, from ``raw_line``; the other columns stay.

    Text that is no JSON object has all fields null and ``_corrupt_record`` set, also
    when some fields could be read before the error. With ``shape`` the names and JSON
    types of the object are added, for the contract level of the gate.
    """
    schema = T.StructType([*contract.raw_schema().fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("raw_line", schema, {"columnNameOfCorruptRecord": CORRUPT})
    own = [c for c in df.columns if c not in schema.names]
    # Generators and not projections: a filter on the fields stays above them, where a
    # projection would have the filter repeat the parse for every field it mentions.
    if shape:
        df = df.select(*own, F.explode(F.array(F.schema_of_variant(F.try_parse_json("raw_line")))).alias(SHAPE))
        own = [*own, SHAPE]
    fields = df.select(*own, F.inline(F.array(parsed)))
    whole = F.col(CORRUPT).isNull()
    return fields.select(*own, *[F.when(whole, F.col(n)).alias(n) for n in contract.names], CORRUPT)


def read_clean(spark: SparkSession, path: str, contract: Contract = EVENT_CONTRACT) -> DataFrame:
    """The clean zone; a filter on ``ingest_date`` prunes directories."""
    schema = T.StructType(
        [
            *[f for f in contract.clean_schema() if f.name not in CLEAN_PARTITIONS],
            T.StructField("ingest_date", T.DateType()),
            T.StructField("source", T.StringType()),
            T.StructField("load_id", T.StringType()),
        ]
    )
    if not storage.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_csv_sample(spark: SparkSession, path: str, contract: Contract = EVENT_CONTRACT) -> DataFrame:
    """CSV with a header line and the contract columns, as text."""
    return (
        spark.read.schema(contract.raw_schema())
        .option("header", "true")
        .option("enforceSchema", "false")
        .csv(path)
    )
