"""Event-shaped inputs derived from the given tables, one scan each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlake import storage
from streamlake.contracts import EVENT_CONTRACT
from streamlake.plans.pipelines import Lake
from streamlake.session import configure, scratch_dir

PLATFORMS = {"click": "web", "view": "ios", "purchase": "android", "signup": "desktop"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def naive(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock time without a zone, as the SQL side has them."""
    cols = {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if f.dataType.typeName() == "timestamp"}
    return df.withColumns(cols) if cols else df


def music_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract-shaped events; durations may be 0 and one platform is outside the contract."""
    # Used several times each, so they are columns of their own and computed once.
    events = table(spark, sf_dir, "events").withColumns(
        {
            "h": F.md5(F.col("event_id").cast("string")),
            "k": F.get_json_object("props", "$.k").cast("int"),
        }
    )
    k = F.col("k")
    dashed = F.concat_ws("-", *[F.substring("h", a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    platform = F.coalesce(*[F.when(F.col("event_type") == t, p) for t, p in PLATFORMS.items()], F.lit("smart_tv"))
    return events.select(
        dashed.alias("event_id"),
        F.concat(F.lit("user-"), F.lpad(F.col("user_id").cast("string"), 5, "0")).alias("user_id"),
        F.concat(F.lit("track-"), F.lpad(k.cast("string"), 6, "0")).alias("track_id"),
        F.concat(F.lit("Artist "), (k % 20).cast("string")).alias("artist_name"),
        F.col("ts").cast("timestamp").alias("played_at"),
        F.floor("value").cast("int").alias("duration_seconds"),
        platform.alias("platform"),
        F.to_date("ts").alias("ingest_date"),
        F.col("event_id").alias("src_id"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty events: missing or overlong users, blank tracks, bad times and times without a
    date, and a second version of every tenth.

    The second version (``seq`` 1) has clean fields and one second more.
    """
    src = F.col("src_id")
    seq = F.when(src % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    events = music_events(spark, sf_dir).withColumn("seq", F.explode(seq))

    def dirty(every: int):
        return (F.col("seq") == 0) & (src % every == 0)

    iso = F.concat(F.date_format("played_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    return events.withColumns(
        {
            "user_id": F.when(dirty(31), F.repeat("user_id", F.lit(13))).when(~dirty(17), F.col("user_id")),
            "track_id": F.when(dirty(19), "  ").otherwise(F.col("track_id")),
            "played_at": F.when(dirty(23), "not-a-date").when(dirty(29), "10:00:00").otherwise(iso),
            "duration_seconds": F.col("duration_seconds") + F.col("seq"),
            "ingest_date": F.col("ingest_date").cast("string"),
        }
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_events`` as JSON text: (raw_line, src_id, seq, source, run_date)."""
    return raw_events(spark, sf_dir).select(
        F.to_json(F.struct(*EVENT_CONTRACT.names)).alias("raw_line"),
        "src_id",
        "seq",
        F.when(F.col("src_id") % 3 == 0, "batch").otherwise("stream").alias("source"),
        F.col("ingest_date").cast("date").alias("run_date"),
    )


def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event texts that break contract rules on the JSON level: (raw_line, src_id)."""
    src = F.col("src_id")

    def field(name: str, value):
        return F.concat(F.lit(f'"{name}":'), value)

    def quoted(value):
        return F.concat(F.lit('"'), value, F.lit('"'))

    duration = F.col("duration_seconds").cast("string")
    parts = [
        field("event_id", quoted(F.when(src % 41 == 0, "not-a-uuid").otherwise(F.col("event_id")))),
        field("user_id", F.when(src % 47 == 0, "7").when(src % 59 == 0, "null").otherwise(quoted(F.col("user_id")))),
        field("track_id", quoted(F.when(src % 61 == 0, "").otherwise(F.col("track_id")))),
        field("artist_name", quoted(F.col("artist_name"))),
        field(
            "played_at",
            quoted(
                F.when(src % 23 == 0, "2024-01-01 10:00:00").otherwise(
                    F.concat(F.date_format("played_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
                )
            ),
        ),
        field(
            "duration_seconds",
            F.when(src % 31 == 0, quoted(duration))
            .when(src % 37 == 0, F.concat(duration, F.lit(".5")))
            .when(src % 67 == 0, quoted(F.concat(duration, F.lit("d"))))
            .when(src % 71 == 0, quoted(F.lit("0x1p3")))
            .otherwise(duration),
        ),
        field("platform", quoted(F.col("platform"))),
        field("ingest_date", quoted(F.when(src % 43 == 0, "2024-13-45").otherwise(F.col("ingest_date").cast("string")))),
        F.when(src % 29 == 0, '"extra":{"a":1}'),
    ]
    text = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.when(src % 53 == 0, "").otherwise("}"))
    return music_events(spark, sf_dir).select(text.alias("raw_line"), "src_id")


def upsert_sides(fact: DataFrame, src_id: str = "src_id") -> tuple[DataFrame, DataFrame]:
    """(target, source): every event on one side or on both, there with another duration."""
    target = fact.filter(F.col(src_id) % 3 != 0).drop(src_id)
    source = fact.filter((F.col(src_id) % 2 == 0) | (F.col(src_id) % 3 == 0)).withColumn("duration_seconds", F.col("duration_seconds") + 100)
    return target, source.drop(src_id)


def track_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose artist does not depend on the track, so a track has several artists."""
    artist = F.concat(F.lit("Artist "), (F.substring("user_id", 6, 5).cast("int") % 7).cast("string"))
    return music_events(spark, sf_dir).withColumn("artist_name", artist)


def manifest_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object keys: good, percent-encoded, with a plus, and three kinds of bad ones."""
    day = F.date_format("ts", "yyyy-MM-dd")
    case = F.col("event_id") % 7
    key = (
        F.when(case == 2, F.concat(F.lit("raw/source%3Dbatch/ingest_date%3D"), day, F.lit("/manifest.json")))
        .when(case == 3, F.concat(F.lit("raw/source=my+feed/ingest_date="), day, F.lit("/manifest.json")))
        .when(case == 4, F.concat(F.lit("clean/source=batch/ingest_date="), day, F.lit("/manifest.json")))
        .when(case == 5, F.concat(F.lit("raw/source=batch/ingest_date="), day, F.lit("/events.json")))
        .when(case == 6, F.lit("raw/source=batch/ingest_date=2026-99-99/manifest.json"))
        .otherwise(F.concat(F.lit("raw/source=batch/ingest_date="), day, F.lit("/manifest.json")))
    )
    return table(spark, sf_dir, "events").select(F.lit("lake").alias("bucket"), key.alias("key"))


ACCESS_MAP = (
    ("analytics-admins", "*", "*"),
    ("business-web", "platform", "web"),
    ("business-ios", "platform", "ios"),
    ("regional-north", "market", "north"),
)


def access_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ACCESS_MAP, "principal string, dimension string, value string")


def job_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = {
        "error": "ERROR merge step",
        "click": "run FAILED",
        "purchase": "TIMEOUT after 30 min",
        "signup": "capacity scaled up",
    }
    text = F.coalesce(*[F.when(F.col("event_type") == t, m) for t, m in messages.items()], F.lit("run finished"))
    group = F.col("user_id") % 3
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("log_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(group == 0, "raw_to_clean").when(group == 1, "warehouse").otherwise("function").alias("log_group"),
        text.alias("message"),
    )


def metric_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-numbered metric values, so that sums do not depend on their order."""
    value = F.floor("value").cast("bigint")
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(kind == "click", "function_errors")
        .when(kind == "view", "stream_iterator_age_ms")
        .when(kind == "purchase", "query_bytes_scanned")
        .when(kind == "signup", "delivery_success")
        .otherwise("dead_letter_depth")
        .alias("metric"),
        F.when(kind == "view", value * 200)
        .when(kind == "purchase", value * 5000000)
        .otherwise(value % 2)
        .alias("value"),
    )


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    late = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("event_id") % 120)
    return table(spark, sf_dir, "events").select(ts.alias("event_ts"), (ts + late).alias("arrival_ts"))


def query_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("query_id"),
        F.col("o_orderdate").alias("submitted_at"),
        F.floor("o_totalprice").cast("bigint").alias("bytes_scanned"),
        F.when(F.col("o_orderstatus") == "F", "SUCCEEDED").otherwise("FAILED").alias("status"),
    )


def order_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines shaped as events: larger than ``events`` and with repeated event ids."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("event_id"),
            F.concat(F.lit("user-"), F.col("o_custkey").cast("string")).alias("user_id"),
            F.concat(F.lit("track-"), F.col("l_partkey").cast("string")).alias("track_id"),
            F.col("p_brand").alias("artist_name"),
            F.col("l_shipdate").cast("timestamp").alias("played_at"),
            F.floor("l_quantity").cast("int").alias("duration_seconds"),
            F.col("l_returnflag").alias("platform"),
            F.to_date("l_shipdate").alias("ingest_date"),
            "l_suppkey",
            "l_extendedprice",
        )
    )


def new_lake(spark: SparkSession, label: str) -> Lake:
    return Lake(scratch_dir(configure(spark), label))


def write_raw_zone(lines: DataFrame, lake: Lake, gzip: bool = False) -> None:
    """Write (raw_line, source, run_date) as files below ``raw/source=/ingest_date=``."""
    (
        storage.layout(
            lines.select("raw_line", "source", F.col("run_date").alias("ingest_date")), ("source", "ingest_date")
        )
        .write.mode("append")
        .option("compression", "gzip" if gzip else "none")
        .partitionBy("source", "ingest_date")
        .text(lake.raw)
    )


def write_manifests(spark: SparkSession, lake: Lake) -> None:
    """One manifest per raw partition directory, as a producer does when it is complete."""
    for source in storage.child_names(spark, lake.raw):
        if not source.startswith("source="):
            continue
        for day in storage.child_names(spark, f"{lake.raw}/{source}"):
            body = f'{{"source": "{source[7:]}", "ingest_date": "{day[12:]}"}}'
            storage.write_text(spark, f"{lake.raw}/{source}/{day}/manifest.json", body)


def concatenated(lines: DataFrame, per_line: int = 8) -> DataFrame:
    """Up to ``per_line`` objects on one line without a separator, as a buffered delivery writes them.

    Numbered by position and not by key: a group stays small however often an event repeats.
    """
    group = F.floor(F.monotonically_increasing_id() / per_line)
    numbered = lines.select("raw_line", "source", "run_date", group.alias("g"))
    joined = F.concat_ws("", F.collect_list("raw_line")).alias("raw_line")
    return numbered.groupBy("source", "run_date", "g").agg(joined)
