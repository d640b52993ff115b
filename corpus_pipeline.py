"""A training-corpus pipeline: quality rules, line dedup, near-duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read as the next one's ``docs``. All but the last return the columns of documents.
A stage works on every row it is given and passes on what it keeps, whole.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlake.llm import decontaminate, line_dedup, minhash, packing, quality_rules
from streamlake.llm.files import ship_package, staged
from streamlake.llm.queries import table, tokenizer_file
from streamlake.session import scratch_dir

# Packing and the certified cutoffs are not expressible in SQL; tests/llm compares the
# stages with brute-force versions.
ORACLE_SQL: str | None = None

READ = ("doc_id", "text", "lang", "n_chars")  # columns that the stages know; others only pass through


def _passing(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Keeps the other columns of ``docs`` under internal names during the stage, so that none
    is taken for a column that an operator adds or replaces."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        inner = docs.toDF(*[c if c in READ else f"_passed_{n}" for n, c in enumerate(docs.columns)])
        return stage(spark, inner, sf_dir).toDF(*docs.columns)

    return run_stage


@_passing
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the cutoffs certified for their language.

    Null and short texts fail the base rules. A null ``lang`` is a stratum of its own. The
    counted documents are written once, and both the calibration and the verdict read them,
    so that no text is shuffled or counted again.
    """
    ship_package(spark)
    counted = staged(quality_rules.count_rules(docs), "quality-counts")
    cutoffs = staged(quality_rules.calibrate(counted, table(spark, sf_dir, "labels")), "quality-cutoffs")
    return quality_rules.decide(counted, cutoffs).filter("kept").select(*docs.columns)


@_passing
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; those that lose every line go, ``n_chars`` follows the text."""
    found = line_dedup.dedup_lines(docs)
    left = found.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    return _recounted(left, docs)


@_passing
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, the one with the smallest id.

    Rows that repeat an id and text are reduced to one. Rows without an id belong to no
    component and stay.
    """
    ship_package(spark)
    gone = minhash.near_duplicates(docs).filter(~F.col("kept")).select("doc_id", F.col("text_hash").alias("_hash"))
    hashed = docs.withColumn("_hash", F.xxhash64("text"))
    left = hashed.join(gone.distinct(), ["doc_id", "_hash"], "left_anti")
    left = left.withColumn("_row", F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()))
    return left.dropDuplicates(["doc_id", "_hash", "_row"]).select(*docs.columns)


@_passing
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that the benchmark holds; ``n_chars`` follows the text."""
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return _recounted(decontaminate.remove_spans(found), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed sequences of the documents, one row per piece with its ids."""
    ship_package(spark)
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"), end_id=1)


def _recounted(found: DataFrame, docs: DataFrame) -> DataFrame:
    count = F.char_length("text").cast("long")
    return found.withColumn("n_chars", count).select(*docs.columns) if "n_chars" in docs.columns else found.select(*docs.columns)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
