"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlake import storage
from streamlake.contracts import EVENT_CONTRACT, FACT_NAMES, TABLES
from streamlake.operators import access, dedup, maintenance, marts, modeling, monitoring, quality
from streamlake.operators.upsert import merge_into, upsert
from streamlake.plans import fixtures as fx
from streamlake.plans import pipelines
from streamlake.sources import catalog, manifests, readers
from streamlake.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed literals, so that the audit columns can be compared.
RUN_ID = "run-0001"
QUARANTINED_AT = "2026-01-01T00:00:00+00:00"


def query(fn: Query) -> Query:
    """Register under the function's name; instants come out as UTC wall-clock time."""
    QUERIES[fn.__name__] = lambda spark, sf_dir: fx.naive(fn(spark, sf_dir))
    return fn


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modeling.fact_stream(fx.music_events(spark, sf_dir))


def _published_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as the marts see it once published: event ids are already unique."""
    return modeling.artist_key(fx.music_events(spark, sf_dir)).select(*FACT_NAMES)


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fact row per event, with the source id that splits it into upsert sides."""
    events = dedup.first_per_key(fx.music_events(spark, sf_dir))
    return modeling.artist_key(events).select(*FACT_NAMES, "src_id")


def _gated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    normal = quality.parse_event_time(fx.raw_events(spark, sf_dir))
    return quality.split(normal, quality.gate_rules(normal))


def _reason_text(df: DataFrame) -> DataFrame:
    return df.withColumn("reasons", F.concat_ws(",", "reasons"))


def _drop(spark: SparkSession, *paths: str) -> None:
    """Remove intermediate copies that the result does not read."""
    for path in paths:
        storage.delete_dir(spark, path)


# ---------------------------------------------------------------- sources


@query
def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = fx.new_lake(spark, "raw_scan")
    fx.write_raw_zone(fx.raw_lines(spark, sf_dir), lake)
    fx.write_manifests(spark, lake)
    return readers.read_raw(spark, lake.raw)


@query
def raw_scan_concatenated(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = fx.new_lake(spark, "raw_scan_concatenated")
    fx.write_raw_zone(fx.concatenated(fx.raw_lines(spark, sf_dir)), lake, gzip=True)
    objects = readers.parse_objects(readers.read_raw_lines(spark, lake.raw))
    return objects.select("source", "run_date", *EVENT_CONTRACT.names)


@query
def raw_scan_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with an unknown field nested 1 to 60 levels deep, several on a line."""
    lake = fx.new_lake(spark, "raw_scan_nested")
    levels = (F.col("src_id") % 60 + 1).cast("int")
    extra = F.concat(F.lit(',"extra":'), F.repeat(F.lit('{"a":'), levels), F.lit("1"), F.repeat(F.lit("}"), levels), F.lit("}"))
    lines = fx.raw_lines(spark, sf_dir).withColumn("raw_line", F.concat(F.expr("left(raw_line, length(raw_line) - 1)"), extra))
    fx.write_raw_zone(fx.concatenated(lines), lake)
    return readers.read_raw(spark, lake.raw)


@query
def clean_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = fx.new_lake(spark, "clean_scan")
    objects = fx.raw_lines(spark, sf_dir).select("raw_line", "source", "run_date")
    pipelines.write_clean(pipelines.clean_records(pipelines.classify_objects(objects), "batch"), lake.clean)
    return readers.read_clean(spark, lake.clean)


@query
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = fx.new_lake(spark, "csv_scan")
    events = fx.raw_events(spark, sf_dir).select(*EVENT_CONTRACT.names)
    events.write.option("header", "true").option("ignoreTrailingWhiteSpace", "false").option(
        "ignoreLeadingWhiteSpace", "false"
    ).csv(lake.raw)
    return readers.read_csv_sample(spark, lake.raw)


@query
def lake_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = fx.new_lake(spark, "lake_tables")
    objects = fx.raw_lines(spark, sf_dir).select("raw_line", "source", "run_date")
    pipelines.write_clean(pipelines.clean_records(pipelines.classify_objects(objects), "batch"), lake.clean)
    pipelines.clean_to_analytics(spark, lake)
    _drop(spark, lake.clean)
    prefix = f"lake_{lake.root.rsplit('-', 1)[-1]}"
    catalog.register_analytics(spark, lake.root, prefix)
    db = f"{prefix}_analytics"
    return spark.sql(
        f"""
        SELECT f.ingest_date, f.platform, a.artist_name, m.event_count AS day_event_count,
               count(*) AS event_count, count(DISTINCT t.artist_id) AS track_artists
        FROM {db}.fact_stream f
        JOIN {db}.dim_artist a ON f.artist_id = a.artist_id
        JOIN {db}.dim_track t ON f.track_id = t.track_id
        JOIN {db}.daily_listening_metrics m ON f.ingest_date = m.ingest_date AND f.platform = m.platform
        GROUP BY f.ingest_date, f.platform, a.artist_name, m.event_count
        """
    )


@query
def manifest_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifests.manifest_worklist(fx.manifest_keys(spark, sf_dir))


@query
def manifest_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The work list from a stream of storage events that arrive in two parts."""
    lake = fx.new_lake(spark, "manifest_discovery")
    keys = fx.manifest_keys(spark, sf_dir).withColumn("modified", F.lit(1).cast("long"))
    early = F.pmod(F.xxhash64("key"), F.lit(2)) == 0
    for part in (early, ~early):
        keys.filter(part).write.mode("append").json(lake.manifest_events)
        events = jobs.read_storage_events(spark, lake)
        jobs.discover(events, lake, f"{lake.root}/checkpoint", trigger=jobs.ONCE).awaitTermination()
    names = storage.child_names(spark, lake.worklist)
    schema = manifests.manifest_worklist(keys).schema
    return spark.read.schema(schema).parquet(*[f"{lake.worklist}/{n}" for n in names]).drop("modified")


# ---------------------------------------------------------------- pipeline and sinks


@query
def lake_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = fx.new_lake(spark, "pipeline")
    fx.write_raw_zone(fx.raw_lines(spark, sf_dir), lake)
    fx.write_manifests(spark, lake)
    pipelines.run_all(spark, lake)
    _drop(spark, lake.raw, lake.clean, f"{lake.root}/analytics")
    return storage.read(spark, lake.warehouse("fact_stream"))


@query
def quarantine_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = fx.new_lake(spark, "quarantine_sink")
    _, rejected = _gated(spark, sf_dir)
    quality.write_quarantine(quality.quarantine_records(rejected, RUN_ID, QUARANTINED_AT), lake.quarantine)
    return _reason_text(quality.read_quarantine(spark, lake.quarantine)).drop("played_at")


@query
def clean_two_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders without a partition name are loaded one after the other, then one again."""
    lake = fx.new_lake(spark, "clean_two_prefixes")
    events = fx.music_events(spark, sf_dir)
    iso = F.concat(F.date_format("played_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    lines = events.withColumn("played_at", iso).select(F.to_json(F.struct(*EVENT_CONTRACT.names)).alias("value"), "src_id")
    for n in (0, 1):
        lines.filter(F.col("src_id") % 2 == n).select("value").write.text(f"{lake.root}/drop{n}")
    for n in (0, 1, 0):
        pipelines.raw_to_clean(spark, lake, [f"drop{n}"])
    return readers.read_clean(spark, lake.clean).select(*EVENT_CONTRACT.names)


@query
def manifest_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd source names are loaded; a manifest of a day that does not exist is kept as a dead letter."""
    lake = fx.new_lake(spark, "manifest_dead_letters")
    src = F.col("src_id") % 4
    source = F.when(src == 0, "a+b").when(src == 1, "a%20b").when(src == 2, "100%").otherwise("good")
    day = F.when(F.col("src_id") % 20 == 3, "2026-99-99").otherwise(F.col("ingest_date").cast("string"))
    names = fx.music_events(spark, sf_dir).select(source.alias("source"), day.alias("day")).distinct()
    line = '{"event_id": "x"}'  # the gate rejects it; only the work list matters here
    for name, date in names.collect():  # one per partition directory
        folder = f"{lake.raw}/source={name}/ingest_date={date}"
        storage.write_text(spark, f"{folder}/events.json", line)
        storage.write_text(spark, f"{folder}/manifest.json", "{}")
    for _ in range(2):
        pipelines.ingest_pending(spark, lake)
    loaded = spark.read.parquet(lake.ledger).select(F.concat("raw_prefix", F.lit("manifest.json")).alias("key"), F.lit("loaded").alias("state"))
    dead = pipelines.dead_letters(spark, lake).select("key", F.col("reason").alias("state"))
    return loaded.unionByName(dead)


@query
def lake_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five dashboard views, queried by name."""
    lake = fx.new_lake(spark, "lake_views")
    objects = fx.raw_lines(spark, sf_dir).select("raw_line", "source", "run_date")
    pipelines.write_clean(pipelines.clean_records(pipelines.classify_objects(objects), "batch"), lake.clean)
    pipelines.clean_to_analytics(spark, lake)
    pipelines.load_warehouse(spark, lake)
    _drop(spark, lake.clean)
    prefix = f"views_{lake.root.rsplit('-', 1)[-1]}"
    for _ in range(2):
        catalog.register_warehouse(spark, lake.root, prefix)
    db = f"{prefix}_warehouse"
    return spark.sql(
        f"""
        SELECT 'events' AS name, CAST(count(*) AS DOUBLE) AS value FROM {db}.vw_dashboard_events
        UNION ALL SELECT 'skips', CAST(sum(is_skip) AS DOUBLE) FROM {db}.vw_dashboard_events
        UNION ALL SELECT 'minutes', CAST(sum(CAST(round(listening_minutes * 60) AS BIGINT)) AS DOUBLE) / 60
                  FROM {db}.vw_daily_listening_minutes
        UNION ALL SELECT 'days', CAST(count(*) AS DOUBLE) FROM {db}.vw_daily_listening_minutes
        UNION ALL SELECT 'artist minutes ' || artist_name, listening_minutes FROM {db}.vw_top_artists
        UNION ALL SELECT 'platform events ' || platform, CAST(event_count AS DOUBLE) FROM {db}.vw_platform_distribution
        UNION ALL SELECT 'skip rate ' || CAST(listening_date AS STRING), skip_rate FROM {db}.vw_skip_rate
        """
    )


# ---------------------------------------------------------------- quality gate


@query
def ensure_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.ensure_columns(fx.music_events(spark, sf_dir).drop("platform", "duration_seconds"))


@query
def normalize_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.parse_event_time(fx.raw_events(spark, sf_dir)).select(
        "src_id", "seq", "played_at_raw", "played_at"
    )


@query
def gate_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gated(spark, sf_dir)[0].drop("played_at_raw")


@query
def gate_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reason_text(_gated(spark, sf_dir)[1])


@query
def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = readers.parse_objects(fx.broken_lines(spark, sf_dir), shape=True)
    rules = [("not_json", F.col(quality.CORRUPT).isNotNull())]
    rules += quality.contract_rules(lines, raw_line="raw_line")
    return lines.select("src_id", "raw_line", quality.reason_text(rules).alias("violations"))


@query
def quarantine_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = _gated(spark, sf_dir)[1]
    return _reason_text(quality.quarantine_records(rejected, RUN_ID, QUARANTINED_AT)).drop("played_at")


@query
def stamp_ingest_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = dedup.first_per_key(_gated(spark, sf_dir)[0])
    return quality.stamp_ingest_date(valid, "2026-07-10").select("event_id", "ingest_date")


@query
def canonical_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = readers.parse_objects(fx.broken_lines(spark, sf_dir))
    return quality.canonical_types(text).select("src_id", "duration_seconds", "ingest_date")


@query
def replay_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = _gated(spark, sf_dir)
    records = quality.quarantine_records(rejected, RUN_ID, QUARANTINED_AT)
    fixes = {"user_id": F.coalesce("user_id", F.lit("user-unknown"))}
    recovered, rest = quality.replay(records, fixes)
    columns = ["src_id", "event_id", "user_id", "run_id"]
    return recovered.select(*columns, F.lit("recovered").alias("status"), F.lit("").alias("reasons")).unionByName(
        _reason_text(rest).select(*columns, F.lit("rejected").alias("status"), "reasons")
    )


# ---------------------------------------------------------------- dedup, keys, constraints


@query
def dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.first_per_key(_gated(spark, sf_dir)[0].drop("played_at_raw"))


@query
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicate_keys(fx.raw_events(spark, sf_dir))


@query
def constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = quality.parse_event_time(fx.raw_events(spark, sf_dir))
    staged = modeling.artist_key(quality.canonical_types(events)).withColumn(
        "track_id", F.when(F.col("src_id") % 13 == 0, F.repeat("track_id", F.lit(12))).otherwise(F.col("track_id"))
    )
    return maintenance.constraint_report(staged, TABLES["fact_stream"])


# ---------------------------------------------------------------- model


@query
def artist_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modeling.artist_key(fx.music_events(spark, sf_dir)).select("event_id", "artist_name", "artist_id")


@query
def fact_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modeling.fact_stream(quality.canonical_types(_gated(spark, sf_dir)[0]))


@query
def dim_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modeling.dim_artist(fx.music_events(spark, sf_dir))


@query
def dim_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modeling.dim_track(fx.track_conflicts(spark, sf_dir))


@query
def daily_listening_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modeling.daily_listening_metrics(fx.raw_events(spark, sf_dir))


@query
def daily_listening_metrics_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics from sketches stored per day, and whether each count is within the error bound."""
    lake = fx.new_lake(spark, "metrics_approx")
    events = fx.raw_events(spark, sf_dir)
    storage.publish(modeling.daily_sketches(events), lake.analytics("daily_sketches"), "ingest_date")
    approx = modeling.metrics_of_sketches(storage.read(spark, lake.analytics("daily_sketches")))
    exact = modeling.daily_listening_metrics(events).withColumnRenamed("event_count", "events").withColumnRenamed(
        "unique_listener_count", "listeners"
    )

    def within(estimate: str, count: str) -> Column:
        return F.abs(F.col(estimate) - F.col(count)) <= F.ceil(F.col(count) * modeling.SKETCH_ERROR)

    both = approx.join(exact.drop("listening_seconds"), ["ingest_date", "platform"])
    return both.select(
        "ingest_date",
        "platform",
        "listening_seconds",
        within("event_count", "events").alias("events_within_error"),
        within("unique_listener_count", "listeners").alias("listeners_within_error"),
    )


@query
def constraint_report_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a table of which one day is new, from that day and the key index: as of the whole table."""
    lake = fx.new_lake(spark, "report_changed")
    root, rows = lake.warehouse("fact_stream"), _keyed(spark, sf_dir).select(*FACT_NAMES)
    day = F.col("ingest_date") == F.lit("2024-01-10").cast("date")
    storage.publish(rows.filter(~day), root, "ingest_date", ("played_at",))
    base = merge_into(spark, root, rows.filter(F.col("ingest_date") == F.lit("2024-01-09").cast("date")))
    # Published without a merge: some events of that day also lie in another one.
    again = storage.read(spark, root).filter(F.col("event_id") < "08").withColumn("ingest_date", F.lit("2024-01-10").cast("date"))
    changed = rows.filter(day).unionByName(again)
    storage.publish(changed, root, "ingest_date", ("played_at",), keep=base.dirs, base=base, keys=base.keys)
    return maintenance.changed_report(spark, root, storage.read(spark, root).filter(day), TABLES["fact_stream"])


@query
def replay_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects replayed in two batches, interrupted after the first and then taken up again."""
    lake = fx.new_lake(spark, "replay_state")
    _, rejected = _gated(spark, sf_dir)
    placed = rejected.withColumns({"source": F.lit("replay"), "run_date": F.col("ingest_date")})
    quality.write_quarantine(quality.quarantine_records(placed, RUN_ID, QUARANTINED_AT), lake.quarantine)
    rejects = quality.read_quarantine(spark, lake.quarantine)
    half = -(-rejects.count() // 2)
    fixes = {"user_id": F.coalesce("user_id", F.lit("user-unknown"))}
    for batches in (1, None, None):
        pipelines.replay_open(spark, lake, RUN_ID, fixes, batch_rows=half, batches=batches)
    left = pipelines.open_rejects(spark, lake, RUN_ID)
    open_ = left.groupBy("event_id").agg(F.count(F.lit(1)).alias("open"))
    clean = readers.read_clean(spark, lake.clean).groupBy("event_id").agg(F.count(F.lit(1)).alias("recovered"))
    return open_.join(clean, "event_id", "full").select("event_id", F.coalesce("open", F.lit(0)).alias("open"), F.coalesce("recovered", F.lit(0)).alias("recovered"))


@query
def upsert_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(*fx.upsert_sides(_keyed(spark, sf_dir)))


@query
def upsert_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merges the same source twice into a published dataset."""
    lake = fx.new_lake(spark, "upsert_idempotent")
    target, source = fx.upsert_sides(_keyed(spark, sf_dir))
    storage.publish(target, lake.warehouse("fact_stream"), "ingest_date", ("played_at",))
    storage.publish(source, lake.analytics("fact_stream"), "ingest_date", ("played_at",))
    staging = storage.read(spark, lake.analytics("fact_stream"))
    for _ in range(2):
        merge_into(spark, lake.warehouse("fact_stream"), staging)
    storage.prune(spark, lake.warehouse("fact_stream"), keep=1)
    _drop(spark, lake.analytics("fact_stream"))
    return storage.read(spark, lake.warehouse("fact_stream"))


# ---------------------------------------------------------------- marts


@query
def dashboard_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dashboard_events(_published_shape(spark, sf_dir))


@query
def daily_listening_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_listening_minutes(_published_shape(spark, sf_dir))


@query
def top_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    artists = modeling.dim_artist(fx.music_events(spark, sf_dir))
    return marts.top_artists(_published_shape(spark, sf_dir), artists)


@query
def top10_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    artists = modeling.dim_artist(fx.music_events(spark, sf_dir))
    return marts.top_n_artists(marts.top_artists(_fact(spark, sf_dir), artists))


@query
def platform_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.platform_distribution(_published_shape(spark, sf_dir))


@query
def skip_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.skip_rate(_published_shape(spark, sf_dir))


@query
def latest_skip_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.latest_skip_rate(marts.skip_rate(_published_shape(spark, sf_dir)))


@query
def fact_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fact_count(_fact(spark, sf_dir))


# ---------------------------------------------------------------- access, monitoring, retention


@query
def row_level_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.music_events(spark, sf_dir).select("event_id", "platform")
    mapping = fx.access_map(spark)
    seen = [
        access.visible_rows(events, mapping, who).withColumn("principal", F.lit(who))
        for who in ("analytics-admins", "business-web", "regional-north")
    ]
    out = seen[0]
    for part in seen[1:]:
        out = out.unionByName(part)
    return out


@query
def log_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.log_triage(fx.job_logs(spark, sf_dir))


@query
def log_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.log_metrics(fx.job_logs(spark, sf_dir))


@query
def metric_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.metric_alarms(fx.metric_points(spark, sf_dir), monitoring.alarm_rules(spark))


@query
def recent_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.recent_queries(fx.query_history(spark, sf_dir))


@query
def expired_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = F.explode(F.array(*[F.lit(z) for z in maintenance.RETENTION_DAYS]))
    partitions = fx.music_events(spark, sf_dir).select("ingest_date").distinct().select(zones.alias("zone"), "ingest_date")
    return maintenance.expired_partitions(partitions, "2024-07-15")


@query
def stream_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.stream_lag(fx.arrivals(spark, sf_dir))


# ---------------------------------------------------------------- streaming


@query
def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = fx.new_lake(spark, "stream_landing")
    messages = f"{lake.root}/messages"
    fx.broken_lines(spark, sf_dir).select("raw_line").write.text(messages)
    jobs.land(jobs.read_lines(spark, messages), lake, f"{lake.root}/checkpoint", trigger=jobs.ONCE).awaitTermination()
    out = None
    for zone, path in (("raw", lake.raw), ("error", f"{lake.root}/quarantine_landing")):
        if storage.child_names(spark, path):
            lines = spark.read.option("recursiveFileLookup", "true").text(path)
            part = lines.select(F.col("value").alias("raw_line"), F.lit(zone).alias("zone"))
            out = part if out is None else out.unionByName(part)
    return out


@query
def stream_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = fx.new_lake(spark, "stream_gate")
    fx.write_raw_zone(fx.raw_lines(spark, sf_dir), lake, gzip=True)
    jobs.gate_files(jobs.read_files(spark, lake.raw), lake, f"{lake.root}/checkpoint", trigger=jobs.ONCE).awaitTermination()
    _drop(spark, lake.raw)
    own = ["event_id", "user_id", "track_id", "artist_name"]
    day = F.col("ingest_date").cast("date").alias("ingest_date")
    rest = [F.col("duration_seconds").cast("int").alias("duration_seconds"), "platform", day, "source"]
    iso = F.date_format("played_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("played_at")
    clean = readers.read_clean(spark, lake.clean).select(*own, iso, *rest, F.lit("").alias("reasons"))
    rejects = _reason_text(quality.read_quarantine(spark, lake.quarantine))
    return clean.unionByName(rejects.select(*own, F.col("played_at_raw").alias("played_at"), *rest, "reasons"))


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event arrives again, changed, in a second run; the first arrival stays.

    The delay covers the span of the data.
    """
    lake = fx.new_lake(spark, "stream_dedup")
    events = fx.music_events(spark, sf_dir)
    first = dedup.first_per_key(events)
    again = events.withColumn("duration_seconds", F.col("duration_seconds") + 7)
    for sent in (first, again):
        sent.write.mode("append").parquet(f"{lake.root}/sent")
        arriving = spark.readStream.schema(sent.schema).parquet(f"{lake.root}/sent")
        unique = jobs.dedup(arriving, "400 days")
        jobs.append_to(unique, f"{lake.root}/unique", f"{lake.root}/checkpoint", trigger=jobs.ONCE).awaitTermination()
    _drop(spark, f"{lake.root}/sent")
    return spark.read.schema(first.schema).parquet(f"{lake.root}/unique")


@query
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = fx.new_lake(spark, "stream_upsert")
    target, source = fx.upsert_sides(_keyed(spark, sf_dir))
    storage.publish(target, lake.warehouse("fact_stream"), "ingest_date", ("played_at",))
    source.write.parquet(f"{lake.root}/changes")
    changes = spark.readStream.schema(source.schema).parquet(f"{lake.root}/changes")
    jobs.upsert(
        changes, lake.warehouse("fact_stream"), f"{lake.root}/checkpoint", trigger=jobs.ONCE
    ).awaitTermination()
    _drop(spark, f"{lake.root}/changes")
    return storage.read(spark, lake.warehouse("fact_stream"))


@query
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs, each after new files have landed; every file is taken once."""
    lake = fx.new_lake(spark, "incremental_ingest")
    lines = fx.raw_lines(spark, sf_dir)
    for source in ("batch", "stream"):
        fx.write_raw_zone(lines.filter(F.col("source") == source), lake)
        files = jobs.read_files(spark, lake.raw)
        jobs.gate_files(files, lake, f"{lake.root}/checkpoint", trigger=jobs.ONCE).awaitTermination()
    _drop(spark, lake.raw)
    # The load names hold the stream's own id.
    batch = F.regexp_replace("load_id", "^stream-.*-", "batch ")
    return readers.read_clean(spark, lake.clean).withColumn("load_id", batch)


@query
def gate_two_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two gate streams with a checkpoint each on one lake; each is run again without news."""
    lake = fx.new_lake(spark, "gate_two_streams")
    lines = fx.raw_lines(spark, sf_dir)
    for n in (0, 1):
        part = lines.filter(F.col("seq") == n).withColumn("source", F.lit(f"s{n}"))
        fx.write_raw_zone(part, pipelines.Lake(f"{lake.root}/in{n}"))
    for n in (0, 1, 0, 1):
        raw = jobs.read_lines(spark, f"{lake.root}/in{n}/raw")
        jobs.gate(raw, lake, f"{lake.root}/checkpoint{n}", trigger=jobs.ONCE).awaitTermination()
    stream = F.substring("source", 2, 1).cast("int").alias("stream")
    clean = readers.read_clean(spark, lake.clean).select("event_id", stream, F.lit("").alias("reasons"))
    rejects = _reason_text(quality.read_quarantine(spark, lake.quarantine))
    return clean.unionByName(rejects.select("event_id", stream, "reasons"))


# ---------------------------------------------------------------- the same operators on order lines


@query
def order_plays_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["l_suppkey", "played_at", "l_extendedprice", "duration_seconds", "platform"]
    return dedup.first_per_key(fx.order_plays(spark, sf_dir), order_by=order).select("event_id", "l_suppkey", "played_at")


@query
def order_plays_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicate_keys(fx.order_plays(spark, sf_dir))


@query
def order_plays_daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modeling.daily_listening_metrics(fx.order_plays(spark, sf_dir))


@query
def order_plays_top_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    plays = modeling.artist_key(fx.order_plays(spark, sf_dir))
    return marts.top_artists(plays, modeling.dim_artist(fx.table(spark, sf_dir, "part").withColumnRenamed("p_brand", "artist_name")))


@query
def order_plays_skip_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.skip_rate(fx.order_plays(spark, sf_dir))
