"""Landing, gate, deduplication and upsert on streams.

Every sink is safe against a repeated micro-batch: outputs are keyed by the query's id, which
its checkpoint keeps, and the batch id, and replaced as a whole, or merged by event id. So
queries with other checkpoints never touch them.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streamlake import storage
from streamlake.contracts import EVENT_CONTRACT
from streamlake.operators import monitoring, quality
from streamlake.operators.dedup import first_per_key
from streamlake.operators.upsert import latest_first, merge_into
from streamlake.plans.pipelines import (
    Lake,
    classify_objects,
    clean_records,
    gated,
    keep_dead_letters,
    reject_records,
    unreadable,
    write_clean,
)
from streamlake.session import configure
from streamlake.sources.manifests import manifest_worklist
from streamlake.sources.readers import MANIFEST_NAME, raw_objects

# Fixed value: how often the landing stream delivers.
LANDING_TRIGGER = {"processingTime": "60 seconds"}
ONCE = {"availableNow": True}
BATCH_BYTES = 1 << 30  # of files taken by one micro-batch


def batch_name(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """Name of a micro-batch: the query's id as its checkpoint keeps it, and the number."""
    query = json.loads(storage.read_text(spark, f"{checkpoint}/metadata"))["id"]
    return f"stream-{query}-{batch_id:010d}"


def read_lines(spark: SparkSession, path: str, max_bytes: int = BATCH_BYTES, **options: str) -> DataFrame:
    """Stream the text files below a folder, each file once per checkpoint, at most about
    ``max_bytes`` per micro-batch; a caller's ``maxFilesPerTrigger`` takes the place of that
    bound, as Spark accepts only one of them.

    Another source, such as a message bus, only has to provide a string column ``value``.
    """
    given = {name.lower() for name in options}
    bound = {} if given & {"maxfilespertrigger", "maxbytespertrigger"} else {"maxBytesPerTrigger": str(max_bytes)}
    return (
        spark.readStream.option("recursiveFileLookup", "true")
        .options(**bound, **options)
        .text(path)
        .filter(F.col("_metadata.file_name") != MANIFEST_NAME)
    )


# Fixed value: a delivered file is closed by the record with which it reaches this size.
FILE_BYTES = 5_000_000
CUT_BYTES = 64 << 20  # of a micro-batch that one task cuts into files


def _cut_files(batch: DataFrame, file_bytes: int) -> DataFrame:
    """Adds to ``batch_id`` the number of a row's file: running bytes over ``file_bytes``.

    Small micro-batches are cut as one sequence, so that no task leaves a small file of its
    own; large ones are dealt out first, ``CUT_BYTES`` a task.
    """
    size = F.octet_length("raw_line") + 1
    total = batch.agg(F.sum(size)).first()[0] or 0
    dealt = batch.repartition(max(1, -(-total // CUT_BYTES)))
    placed = dealt.withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()})
    before = Window.partitionBy("_part", "source", "ingest_date", "readable").orderBy("_row")
    running = F.coalesce(F.sum(size).over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    number = F.format_string("%s-%05d-%05d", "batch_id", "_part", F.floor(running / file_bytes))
    return placed.withColumn("batch_id", number).drop("_part", "_row")


# Fixed value: a storage event as it is delivered, one JSON object a line; the key is form-encoded.
STORAGE_EVENT = "bucket string, key string, modified long"


def read_storage_events(spark: SparkSession, lake: Lake, **options: str) -> DataFrame:
    """Stream the storage events below ``lake.manifest_events``; their files are moved away when
    the next micro-batch is done, so that old ones are never listed again.

    Another source, such as a message bus, only has to provide the same columns.
    """
    done = f"{lake.root}/manifest_events_done"
    return (
        spark.readStream.schema(STORAGE_EVENT)
        .options(cleanSource="archive", sourceArchiveDir=done, **options)
        .json(lake.manifest_events)
    )


LISTED_ROWS = 200_000  # of a micro-batch's work list that one task writes as a file


def discover(events: DataFrame, lake: Lake, checkpoint: str, trigger: dict = LANDING_TRIGGER) -> StreamingQuery:
    """Put each manifest that a storage event names on the work list, decided as by
    ``manifest_worklist``; ``pipelines.ingest_discovered`` takes it from there.

    A repeated micro-batch replaces its own part of the list, and a part that is taken twice
    loads the same prefixes again, which adds nothing.
    """

    def listed(batch: DataFrame, batch_id: int) -> None:
        name = batch_name(batch.sparkSession, checkpoint, batch_id)
        files = max(1, -(-batch.count() // LISTED_ROWS))  # few for small events, never all rows in one task
        manifest_worklist(batch).coalesce(files).write.mode("overwrite").parquet(f"{lake.worklist}/batch={name}")

    return events.writeStream.foreachBatch(listed).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def land(
    messages: DataFrame,
    lake: Lake,
    checkpoint: str,
    source: str = "stream",
    trigger: dict = LANDING_TRIGGER,
    file_bytes: int = FILE_BYTES,
) -> StreamingQuery:
    """Append messages unchanged to ``raw/source=<source>/ingest_date=<arrival date>`` as gzip text.

    A file is delivered with the micro-batch, each ``LANDING_TRIGGER``, and holds
    ``file_bytes`` of text and less than one record more. Messages that are no JSON object
    go to ``quarantine_landing`` instead. The arrival date is that of the micro-batch and
    stays the same when the batch is repeated.
    """
    arrived = messages.select(
        F.col("value").alias("raw_line"),
        F.lit(source).alias("source"),
        F.to_date(F.current_timestamp()).alias("ingest_date"),
        F.json_object_keys("value").isNotNull().alias("readable"),
    )

    def deliver(batch: DataFrame, batch_id: int) -> None:
        configure(batch.sparkSession)
        name = batch_name(batch.sparkSession, checkpoint, batch_id)
        batch = _cut_files(batch.withColumn("batch_id", F.lit(name)), file_bytes).persist()
        try:
            for readable, path in ((True, lake.raw), (False, f"{lake.root}/quarantine_landing")):
                (
                    batch.filter(F.col("readable") == readable)
                    .drop("readable")
                    .write.mode("overwrite")
                    .option("partitionOverwriteMode", "dynamic")
                    .option("compression", "gzip")
                    .partitionBy("source", "ingest_date", "batch_id")
                    .text(path)
                )
        finally:
            batch.unpersist()

    return (
        arrived.writeStream.foreachBatch(deliver)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def gate(
    lines: DataFrame,
    lake: Lake,
    checkpoint: str,
    level: str = "required",
    run_date: str | None = None,
    trigger: dict = LANDING_TRIGGER,
) -> StreamingQuery:
    """The batch gate on a stream of raw files; each micro-batch is one load and one run.

    With ``availableNow`` this is the incremental job: it takes the files that are new
    since the checkpoint and stops.
    """
    classified = classify_objects(raw_objects(lines), level, run_date).withColumn(
        "at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        configure(batch.sparkSession)
        name = batch_name(batch.sparkSession, checkpoint, batch_id)
        batch = batch.persist()
        try:
            rejects = reject_records(batch, name, F.col("at")).drop("at")
            quality.write_quarantine(rejects, lake.quarantine)
            days = batch.filter(F.size("reasons") == 0).select("run_date").distinct().collect()
            write_clean(clean_records(batch, name), lake.clean, [r[0] for r in days])
        finally:
            batch.unpersist()

    return (
        classified.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


# Fixed value: the columns of Spark's binary file source.
FILE_COLUMNS = "path string, modificationTime timestamp, length long, content binary"
BATCH_FILES = 10_000  # names of one micro-batch, a few megabytes


def read_files(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Stream the names of the files below a folder, each once per checkpoint: path and modified
    (milliseconds). Their contents are not read."""
    given = {name.lower() for name in options}
    bound = {} if given & {"maxfilespertrigger", "maxbytespertrigger"} else {"maxFilesPerTrigger": str(BATCH_FILES)}
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_COLUMNS)
        .option("recursiveFileLookup", "true")
        .options(**bound, **options)
        .load(path)
    )
    return files.filter(F.element_at(F.split("path", "/"), -1) != MANIFEST_NAME).select(
        "path", F.unix_millis("modificationTime").alias("modified")
    )


def _text_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.text(paths)


def split_readable(spark: SparkSession, files: list[tuple[str, int]]) -> tuple[list[tuple], list[tuple]]:
    """(files that can be read to their end, the others with the reason); bad ones are found by halving."""
    try:
        _text_of(spark, [path for path, _ in files]).agg(F.sum(F.length("value"))).collect()
        return files, []
    except (PySparkException, Py4JJavaError) as error:
        reason = unreadable(error)
        if not reason:
            raise
        if len(files) == 1:
            return [], [(*files[0], reason)]
    half = len(files) // 2
    parts = [split_readable(spark, part) for part in (files[:half], files[half:])]
    return parts[0][0] + parts[1][0], parts[0][1] + parts[1][1]


def gate_files(
    files: DataFrame,
    lake: Lake,
    checkpoint: str,
    level: str = "required",
    run_date: str | None = None,
    trigger: dict = LANDING_TRIGGER,
) -> StreamingQuery:
    """The batch gate on a stream of file names (``read_files``); each micro-batch is one load and
    one run, staged in the shared folder as in the batch job.

    A file that cannot be read, such as a cut-off gzip file, goes to the dead letters with its
    path; the others of its micro-batch are loaded and the stream goes on. With
    ``availableNow`` this is the incremental job: it takes the files that are new since
    the checkpoint and stops.
    """

    def run(spark: SparkSession, found: list[tuple], name: str) -> None:
        objects = raw_objects(_text_of(spark, [path for path, _ in found]))
        with gated(spark, lake, objects, name, level, run_date, load_id=name):
            pass

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = configure(batch.sparkSession)
        name = batch_name(spark, checkpoint, batch_id)
        found = sorted(tuple(r) for r in batch.collect())  # one row per file of the micro-batch
        if not found:
            return
        try:
            run(spark, found, name)
        except (PySparkException, Py4JJavaError) as error:
            if not unreadable(error):
                raise
            good, bad = split_readable(spark, found)
            if not bad:
                raise
            keep_dead_letters(spark, lake, bad, [path for path, _ in good])
            if good:
                run(spark, good, name)

    return files.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(**trigger).start()


DEDUP_SALTS = 64


def dedup(
    events: DataFrame,
    delay: str = "1 hour",
    key: str = EVENT_CONTRACT.key,
    event_time: str = EVENT_CONTRACT.event_time,
    salts: int = DEDUP_SALTS,
    salt: Column | None = None,
) -> DataFrame:
    """Drop replays of an event that arrive within ``delay`` of it.

    State is bounded by the delay, so an older replay passes; the upsert by key is the
    exact guard. A first pass splits each key over ``salts`` tasks, as one key may be most
    of a micro-batch; many salts cost no more state than the copies that arrive. 0 leaves
    it out.
    """
    watermarked = events.withWatermark(event_time, delay)
    if salts:
        spread = salt if salt is not None else F.spark_partition_id()
        watermarked = (
            watermarked.withColumn("_salt", F.pmod(spread, F.lit(salts)))
            .dropDuplicatesWithinWatermark([key, "_salt"])
            .drop("_salt")
        )
    return watermarked.dropDuplicatesWithinWatermark([key])


def append_to(
    df: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = (), trigger: dict = LANDING_TRIGGER
) -> StreamingQuery:
    """Append a stream to a Parquet folder; the sink's log makes each row appear once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def upsert(
    facts: DataFrame,
    dataset: str,
    checkpoint: str,
    key: str = EVENT_CONTRACT.key,
    trigger: dict = LANDING_TRIGGER,
) -> StreamingQuery:
    """Merge each micro-batch into a published dataset; the latest version of an event wins,
    by event time and then the other columns, so it does not matter how the versions are
    spread over micro-batches. Repeats change nothing. A micro-batch reads the key index's
    buckets of its own keys and the days that hold them, whatever else is published.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = configure(batch.sparkSession)
        source = first_per_key(batch, key, latest_first(batch, key)).persist()
        try:
            merge_into(spark, dataset, source, key, newest=True)
        finally:
            source.unpersist()

    return (
        facts.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def lag(arrivals: DataFrame, delay: str = "10 minutes", limit_ms: int = 60000) -> DataFrame:
    """Longest delay per arrival period on a stream; a period is final once the watermark passes it."""
    return monitoring.stream_lag(arrivals.withWatermark("arrival_ts", delay), limit_ms)
