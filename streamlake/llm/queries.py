"""The registered queries of the training-data operators: (spark, sf_dir) -> DataFrame.

Each runs its operator over the whole table with production parameters and derives the
digest columns from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlake.llm import (
    decontaminate,
    html,
    language,
    line_dedup,
    merkle,
    minhash,
    packing,
    quality_rules,
    records,
    sharding,
    sum_of_squares,
    warc,
    whitening,
)
from streamlake.llm.files import ship_package, staged
from streamlake.session import scratch_dir


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level ids of every document, written as checked records and read back."""
    documents = table(spark, sf_dir, "documents")
    root = scratch_dir(spark, "token-records")
    manifest = records.write_records(documents, root, tokenizer_file("byte_bpe_50k.json"), end_id=2)
    return records.read_records(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 24 shards of equal count, equal texts together where they fit."""
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), 24)
    none = F.lit(None).cast("int")
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": none})


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document, with cutoffs certified per language."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    counted = staged(quality_rules.count_rules(documents).drop("text"), "quality-counts")
    cutoffs = staged(quality_rules.calibrate(counted, table(spark, sf_dir, "labels")), "quality-cutoffs")
    decided = quality_rules.decide(counted, cutoffs)
    broken = F.array_join("broken", ",").alias("broken")
    return decided.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", broken, "certified")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into windows of 256 to 2048 tokens."""
    documents = table(spark, sf_dir, "documents")
    pieces = packing.pack(documents, tokenizer_file("word_bpe_49k.json"), end_id=1)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without lines that come earlier, up to one edit."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html.extract(pages, html.learn(pages))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from two of three thirds of the labelled ones."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    held_out = F.coalesce(remainder == 1, F.lit(False))
    dictionaries = language.train(documents.filter(~held_out), F.xxhash64("doc_id"))
    found = language.predict(documents.select("doc_id", "text", held_out.alias("held_out")), dictionaries)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives with revisit records, and read back."""
    manifest = warc.write_warc(table(spark, sf_dir, "pages"), scratch_dir(spark, "warc"))
    found = warc.read_warc(manifest, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 4096 tokens by the sum-of-squares rule."""
    documents = table(spark, sf_dir, "documents")
    pieces = sum_of_squares.pack_best_fit(documents, tokenizer_file("word_bpe_49k.json"), end_id=1)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle tree over every document, with proofs; every second document is tampered with."""
    documents = table(spark, sf_dir, "documents")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(chosen, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    manifest = merkle.build(merkle.document_leaves(documents, tampered))
    proved = merkle.prove(manifest, "tampered_digest").withColumnRenamed("digest", "leaf")
    result = proved.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root")
    return result.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the 16 components of most variance, whitened."""
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


QUERIES = {
    "op1_token_records": op1_token_records,
    "op2_line_dedup": op2_line_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_sharding": op4_sharding,
    "op5_quality_rules": op5_quality_rules,
    "op6_packing": op6_packing,
    "op7_html": op7_html,
    "op8_minhash": op8_minhash,
    "op9_language": op9_language,
    "op10_warc": op10_warc,
    "op11_best_fit": op11_best_fit,
    "op12_merkle": op12_merkle,
    "op13_whitening": op13_whitening,
}
