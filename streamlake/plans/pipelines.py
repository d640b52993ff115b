"""The lake jobs: raw -> clean and quarantine -> analytics -> warehouse -> marts.

Operators only describe; the writes happen here and in ``streaming``.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from streamlake import storage
from streamlake.contracts import EVENT_CONTRACT, TABLES
from streamlake.operators import keys, maintenance, marts, modeling, quality
from streamlake.operators.dedup import first_per_key
from streamlake.operators.upsert import merge_into
from streamlake.plans import changes
from streamlake.session import configure, scratch_dir
from streamlake.sources.manifests import MANIFEST_KEY, list_manifests, manifest_worklist, split_worklist
from streamlake.sources.readers import (
    MANIFEST_NAME,
    load_id_of,
    parse_objects,
    read_clean,
    read_raw_lines,
    resolve_prefix,
)

UNKNOWN_SOURCE = "unknown"
KEEP_VERSIONS = 2  # published versions that the jobs leave: readers of the last one may still be at work


@dataclass(frozen=True)
class Lake:
    """Folders of the zones below one root; any Hadoop file system URI."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def clean(self) -> str:
        return f"{self.root}/clean"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ingested_manifests"

    @property
    def dead_letters(self) -> str:
        return f"{self.root}/dead_letters"

    @property
    def manifest_events(self) -> str:
        return f"{self.root}/manifest_events"

    @property
    def worklist(self) -> str:
        return f"{self.root}/worklist"

    @property
    def replayed(self) -> str:
        return f"{self.root}/replayed_rejects"

    def changes(self, zone: str) -> str:
        return f"{self.root}/changes/{zone}"

    def analytics(self, table: str) -> str:
        return f"{self.root}/analytics/{table}"

    def warehouse(self, table: str) -> str:
        return f"{self.root}/warehouse/{table}"


@dataclass(frozen=True)
class Run:
    """One pass of the gate and what it found."""

    run_id: str
    accepted: int = 0
    rejected: int = 0


def classify_objects(objects: DataFrame, level: str = "required", run_date: str | None = None) -> DataFrame:
    """Object texts -> contract columns, parsed time, run date and reasons. No shuffle.

    The run date is that of the partition directory, else the given one, else the
    record's own. The original text is kept for rejected records only.
    """
    parsed = quality.parse_event_time(parse_objects(objects, shape=level == "contract"))
    own = F.try_to_date(F.col(EVENT_CONTRACT.partition))
    day = F.coalesce("run_date", F.lit(run_date).cast("date"), own)
    rules = quality.gate_rules(parsed, level, raw_line="raw_line")
    rules.append(("missing:run_date", day.isNull()))
    rejected = F.size("reasons") > 0
    return quality.classify(parsed, rules).drop(quality.CORRUPT, quality.SHAPE).withColumns(
        {
            "run_date": day,
            "source": F.coalesce("source", F.lit(UNKNOWN_SOURCE)),
            "raw_line": F.when(rejected, F.col("raw_line")),
            quality.RAW_TIME: F.when(rejected, F.col(quality.RAW_TIME)),
        }
    )


def clean_records(classified: DataFrame, load_id: str | None = None) -> DataFrame:
    """Accepted rows, one per event within a source and run date, with publish types.

    Each row keeps the load it came from, unless all are given one name.

    Duplicates across runs are left to the fact, as the runs are independent. The event
    id leads the key, since rows are sorted by it and it tells most rows apart at once.
    """
    load = F.col("load_id") if load_id is None else F.lit(load_id)
    ok = classified.filter(F.size("reasons") == 0)
    ok = ok.select(*EVENT_CONTRACT.names, "source", "run_date", load.alias("load_id"))
    typed = quality.canonical_types(quality.stamp_ingest_date(ok, F.col("run_date"))).drop("run_date")
    return first_per_key(typed, [EVENT_CONTRACT.key, "source", "ingest_date"])


def write_clean(records: DataFrame, path: str, days: Iterable[object] | None = None) -> None:
    """Replace the partitions present in the records, so that a repeated run adds nothing twice.

    Leaves a note for the next stage, of ``days`` or that any day may have changed.
    """
    (
        storage.layout(records, ("ingest_date", "source", "load_id"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("ingest_date", "source", "load_id")
        .parquet(path)
    )
    changes.note(records.sparkSession, f"{path.rsplit('/', 1)[0]}/changes/clean", days)


def _days_of(accepted: DataFrame) -> set[str]:
    """The run dates of accepted rows; one entry per partition directory."""
    return {r[0] for r in accepted.select(F.col("run_date").cast("string")).distinct().collect()}


def reject_records(classified: DataFrame, run_id: str, quarantined_at: str | Column) -> DataFrame:
    return quality.quarantine_records(classified.filter(F.size("reasons") > 0), run_id, quarantined_at)


def raw_to_clean(
    spark: SparkSession,
    lake: Lake,
    prefixes: list[str],
    run_id: str | None = None,
    level: str = "required",
    run_date: str | None = None,
) -> Run:
    """Gate the raw prefixes into clean and quarantine.

    Each raw folder is a load of its own in clean, named by its location: a repeated run
    replaces what it wrote before, and no other load.

    The JSON is parsed once: the classified rows are staged as Parquet in the shared
    scratch folder and both outputs read that table, so a lost executor costs a few
    columnar tasks and not a second pass over the raw text.
    """
    configure(spark)
    run_id = run_id or str(uuid.uuid4())
    paths = [resolve_prefix(lake.root, p) for p in prefixes]
    if not paths:
        return Run(run_id)
    with gated(spark, lake, read_raw_lines(spark, *paths), run_id, level, run_date) as (run, staged, kept):
        _clear_emptied(spark, lake, staged, paths, kept)
    return run


@contextmanager
def gated(
    spark: SparkSession, lake: Lake, objects: DataFrame, run_id: str, level: str, run_date: str | None, load_id: str | None = None
) -> Iterator[tuple[Run, DataFrame, set[tuple]]]:
    """Gate object texts into clean and quarantine: the run, the staged rows while the context
    lasts, and the (load, day) pairs that have accepted ones."""
    quarantined_at = dt.datetime.now(dt.timezone.utc).isoformat()
    staged_path = scratch_dir(spark, f"classified-{run_id}")
    verdict = F.when(F.size("reasons") == 0, "accepted").otherwise("rejected")
    classified = classify_objects(objects, level, run_date).withColumn("verdict", verdict)
    counts = Observation()
    ok = F.col("verdict") == "accepted"
    counted = classified.observe(counts, F.count_if(ok).alias("accepted"), F.count_if(~ok).alias("rejected"))
    counted.write.partitionBy("verdict").parquet(staged_path)
    staged = spark.read.schema(classified.schema).parquet(staged_path)
    rejected = staged.filter(~ok).drop("verdict")
    quality.write_quarantine(reject_records(rejected, run_id, quarantined_at), lake.quarantine)
    valid = staged.filter(ok).drop("verdict")
    kept = valid.select("load_id", F.col("run_date").cast("string")).distinct().collect()  # a row per load and day
    write_clean(clean_records(valid, load_id), lake.clean, {r[1] for r in kept})
    yield Run(run_id, **counts.get), staged, {tuple(r) for r in kept}
    storage.delete_dir(spark, staged_path)


def _clear_emptied(spark: SparkSession, lake: Lake, staged: DataFrame, paths: list[str], kept: set[tuple]) -> None:
    """Remove what an earlier run of the same loads left in clean where none is accepted now.

    The write replaces only partitions it has rows for. The lists hold one entry per load
    and partition directory.
    """
    loads = {r[0] for r in staged.select("load_id").distinct().collect()}
    named = {load_id_of(storage.qualified(spark, p)): p for p in paths}
    emptied = []
    for load in loads | named.keys():
        # A partition folder has its day in its name; for another one all days are looked at.
        day = re.search(r"/ingest_date=([^/]+)/?$", named.get(load, ""))
        for path, _ in storage.glob(spark, f"{lake.clean}/ingest_date={day[1] if day else '*'}/*/load_id={load}"):
            left = path.split("/ingest_date=")[1].split("/")[0]
            if (load, left) not in kept:
                emptied.append((path, left))
    # The note comes first here: after a failure the next run would not see what is gone.
    changes.note(spark, lake.changes("clean"), [day for _, day in emptied])
    for path, _ in emptied:
        storage.delete_dir(spark, path)


LEDGER = "raw_prefix string, modified long, run_id string"  # one row per manifest taken
DEAD_LETTERS = "key string, modified long, reason string, first_seen timestamp"


def pending_manifests(spark: SparkSession, lake: Lake) -> DataFrame:
    """Manifests that no run has taken in this version, decided as by ``manifest_worklist``."""
    found = manifest_worklist(list_manifests(spark, lake.root), encoded=False)
    if storage.exists(spark, lake.ledger):
        done = spark.read.schema(LEDGER).parquet(lake.ledger)
        found = found.join(done, ["raw_prefix", "modified"], "left_anti")
    return found


def pending_prefixes(spark: SparkSession, lake: Lake) -> DataFrame:
    """(raw_prefix, modified) of accepted manifests that no run has taken in this version."""
    accepted, _ = split_worklist(pending_manifests(spark, lake))
    return accepted.select("raw_prefix", "modified").distinct()


def dead_letters(spark: SparkSession, lake: Lake) -> DataFrame:
    """(key, modified, reason, first_seen) of the manifests that could not be loaded."""
    if storage.current(spark, lake.dead_letters) is None:
        return spark.createDataFrame([], DEAD_LETTERS)
    return storage.read(spark, lake.dead_letters)


def keep_dead_letters(spark: SparkSession, lake: Lake, now: list[tuple], loaded: list[str]) -> None:
    """Publish the dead letters: the known ones but those loaded now, and the new ones.

    A letter that is still dead keeps the time it was first seen. One row per manifest.
    """
    fresh = spark.createDataFrame(now, "key string, modified long, reason string")
    fresh = fresh.withColumn("first_seen", F.current_timestamp())
    old = dead_letters(spark, lake)
    if not now and old.isEmpty():
        return
    both = old.unionByName(fresh).filter(~F.col("key").isin(loaded))
    first = both.groupBy("key").agg(
        F.max_by(F.struct("modified", "reason"), "first_seen").alias("last"), F.min("first_seen").alias("first_seen")
    )
    storage.publish(first.select("key", "last.modified", "last.reason", "first_seen"), lake.dead_letters)
    storage.prune(spark, lake.dead_letters)


def unreadable(error: Exception) -> str | None:
    """The kind of an error that the input causes: it is not there or cannot be read."""
    found = re.search(r"\[(PATH_NOT_FOUND|FAILED_READ_FILE)[.\w]*\]", str(error))
    return f"unreadable: {found[1]}" if found else None


def _load_prefixes(spark: SparkSession, lake: Lake, pending: list[tuple], run_id: str, level: str) -> tuple[list[Run], list[tuple]]:
    """Gate prefixes in one pass; where that fails, halve them until the bad ones stand alone.

    Returns the runs that worked and the prefixes that did not, with the reason.
    """
    try:
        return [raw_to_clean(spark, lake, [p for p, _ in pending], run_id, level)], []
    except (PySparkException, Py4JJavaError) as error:
        # Only input that cannot be read is set aside; any other failure ends the run.
        reason = unreadable(error)
        if not reason:
            raise
        if len(pending) == 1:
            prefix, modified = pending[0]
            return [], [(f"{prefix}{MANIFEST_NAME}", modified, reason)]
    half = len(pending) // 2
    runs, failed = [], []
    for n, part in enumerate((pending[:half], pending[half:])):
        worked, bad = _load_prefixes(spark, lake, part, f"{run_id}-{n}", level)
        runs += worked
        failed += bad
    return runs, failed


def _run_id(pending: list[tuple]) -> str:
    """The name of a run over these prefixes in these versions: a repeat after a failure has the
    same, and replaces what the failed run has left."""
    return hashlib.sha256(json.dumps(sorted(pending)).encode()).hexdigest()[:32]


def discovered_manifests(spark: SparkSession, lake: Lake, batches: list[str]) -> DataFrame:
    """Manifests of the work list's batches, and those that are dead letters, to try them again."""
    columns = ["bucket", "key", "modified"]
    waiting = dead_letters(spark, lake).filter(F.col("key").rlike(MANIFEST_KEY))
    found = manifest_worklist(waiting.select(F.lit(lake.root).alias("bucket"), *columns[1:]), encoded=False)
    if batches:
        listed = spark.read.schema(found.schema).parquet(*[f"{lake.worklist}/{b}" for b in batches])
        newest = F.max_by(F.struct(*found.columns), "modified")  # a key may have several events
        found = found.unionByName(listed.groupBy("key").agg(newest.alias("last")).select("last.*"))
    return found


def ingest_discovered(spark: SparkSession, lake: Lake, level: str = "required") -> Run | None:
    """``ingest_pending`` for the manifests whose storage events ``streaming.jobs.discover`` has
    put on the work list. Neither raw nor the ledger is listed, however many are done.

    The batches of the work list go when their manifests are noted as taken or dead.
    """
    configure(spark)
    batches = [n for n in storage.child_names(spark, lake.worklist) if n.startswith("batch=")]
    run = ingest_pending(spark, lake, level, discovered_manifests(spark, lake, batches))
    for name in batches:
        storage.delete_dir(spark, f"{lake.worklist}/{name}")
    return run


def ingest_pending(
    spark: SparkSession, lake: Lake, level: str = "required", manifests: DataFrame | None = None
) -> Run | None:
    """Gate every pending prefix in one pass and note it as taken; None when there is none.

    The manifests are those given, else all below raw that the ledger does not have. The
    work list has one short row per partition directory. It is noted after the
    outputs are written, so a run that fails is taken up again and replaces its output.
    Rejected manifests and prefixes that cannot be read are kept as dead letters and do not
    stop the others; each run tries them again, and a letter goes once its prefix is loaded.
    """
    configure(spark)
    manifests = pending_manifests(spark, lake) if manifests is None else manifests
    accepted, rejected = split_worklist(manifests)
    pending = [tuple(r) for r in accepted.select("raw_prefix", "modified").distinct().collect()]
    dead = [tuple(r) for r in rejected.select("key", "modified", "reason").distinct().collect()]
    missing = [p for p in pending if not storage.exists(spark, resolve_prefix(lake.root, p[0]))]
    dead += [(f"{prefix}{MANIFEST_NAME}", modified, "missing_prefix") for prefix, modified in missing]
    pending = [p for p in pending if p not in missing]
    runs, failed = _load_prefixes(spark, lake, pending, _run_id(pending), level) if pending else ([], [])
    bad = {key for key, _, _ in failed}
    taken = [p for p in pending if f"{p[0]}{MANIFEST_NAME}" not in bad]
    keep_dead_letters(spark, lake, dead + failed, [f"{prefix}{MANIFEST_NAME}" for prefix, _ in taken])
    if not taken:
        return None
    run_id = runs[0].run_id
    rows = [(prefix, modified, run_id) for prefix, modified in taken]
    spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("append").parquet(lake.ledger)
    return Run(run_id, sum(r.accepted for r in runs), sum(r.rejected for r in runs))


def _with_older(spark: SparkSession, root: str, new: DataFrame, key: str | tuple[str, ...]) -> DataFrame:
    """``new`` and those published rows whose key it does not have."""
    if storage.current(spark, root) is None:
        return new
    keys = [key] if isinstance(key, str) else list(key)
    old = storage.read(spark, root)
    return new.unionByName(old.join(new.select(*keys), keys, "left_anti").select(*new.columns))


def _publish_fact(spark: SparkSession, lake: Lake, fact: DataFrame) -> None:
    """Publish the days that clean has, beside those that have left it by retention.

    Those stay by reference; one is rewritten only if an event of it was delivered again.
    """
    root, partition = lake.analytics("fact_stream"), "ingest_date"
    base = storage.current(spark, root)
    in_clean = {p.split(f"/{partition}=")[-1] for p, _ in storage.glob(spark, f"{lake.clean}/{partition}=*")}
    older = [d for d in base.dirs if d.split(f"{partition}=")[-1] not in in_clean] if base else []
    if older:
        days = {d.split(f"{partition}=")[-1]: d for d in older}
        kept = storage.read(spark, root).filter(F.col(partition).cast("string").isin(list(days)))
        moved = kept.join(fact.select("event_id"), "event_id", "left_semi")
        touched = [str(r[0]) for r in moved.select(partition).distinct().collect()]
        if touched:
            rest = kept.filter(F.col(partition).cast("string").isin(touched))
            fact = fact.unionByName(rest.join(fact.select("event_id"), "event_id", "left_anti").select(*fact.columns))
        older = [d for day, d in days.items() if day not in touched]
    storage.publish(fact, root, partition, TABLES["fact_stream"].sort_key, keep=tuple(older), base=base, lookup="event_id")


def at_once(*steps: Callable[[], object]) -> None:
    """Run independent steps at the same time; their jobs share the executors. The first error is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for running in [pool.submit(inheritable_thread_target(step)) for step in steps]:
            running.result()


DAY = EVENT_CONTRACT.partition
ANALYTICS = ("fact_stream", "dim_artist", "dim_track", "daily_listening_metrics")


def _in_days(days: Iterable[str]) -> Column:
    return F.col(DAY).isin([dt.date.fromisoformat(d) for d in days])


def clean_to_analytics(spark: SparkSession, lake: Lake, full: bool = False) -> None:
    """Bring the fact, both dimensions and the daily metrics up to date with the clean zone.

    Only the days that changed since the last run are read (``changes``); all of clean is,
    where nothing is published yet, a change has no day, or ``full`` asks for it. Both ways
    give the same tables. Metrics are taken from the published fact, where event ids are
    unique, so replays are not counted twice. What clean has lost to retention stays in
    the fact and the dimensions.
    """
    configure(spark)
    notes = changes.pending(spark, lake.changes("clean"))
    root = lake.analytics("fact_stream")
    before = storage.current(spark, root)
    clean = read_clean(spark, lake.clean)
    if before is None or full or notes.days is None:
        days = None
        steps = (
            lambda: (_publish_fact(spark, lake, modeling.fact_stream(clean)), _publish_metrics(spark, lake, None)),
            lambda: _publish_artists(spark, lake, clean),
            lambda: _publish_tracks(spark, lake, clean, None),
        )
        at_once(*steps)
    elif notes.days:
        days = _publish_changed_fact(spark, lake, clean, list(notes.days))
        changed = clean.filter(_in_days(notes.days))
        at_once(
            lambda: _publish_metrics(spark, lake, days),
            lambda: _publish_artists(spark, lake, changed),
            lambda: _publish_tracks(spark, lake, changed, list(notes.days)),
        )
    else:
        return
    changes.note(spark, lake.changes("analytics"), days)
    changes.done(spark, lake.changes("clean"), notes)
    for name in (*ANALYTICS, "last_plays"):
        storage.prune(spark, lake.analytics(name), KEEP_VERSIONS)


def _publish_changed_fact(spark: SparkSession, lake: Lake, clean: DataFrame, days: list[str]) -> list[str]:
    """Publish the fact with the given days of clean as they are now; returns the days that changed.

    An event may lie in several days of clean, and the first in the fact's order is published.
    So the events of the days compete with what the fact has of them elsewhere, which the key
    index finds, and an event that the days have lost or changed is looked for in the rest of
    clean. Only then are other days of clean read, by their event ids.
    """
    root, key, names = lake.analytics("fact_stream"), EVENT_CONTRACT.key, EVENT_CONTRACT.names
    base, fact = storage.current(spark, root), storage.read(spark, root)
    place = scratch_dir(spark, "changed-fact")

    def staged(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{place}/{name}")
        return spark.read.schema(df.schema).parquet(f"{place}/{name}")

    rows = staged(first_per_key(clean.filter(_in_days(days)).select(*names), key), "rows")
    lost = fact.filter(_in_days(days)).subtract(modeling.artist_key(rows).select(*fact.columns)).select(key)
    lost = staged(lost, "lost")
    if not lost.isEmpty():
        other = clean.filter(~_in_days(days)).select(*names).join(lost, key, "left_semi")
        rows = staged(first_per_key(rows.unionByName(other), key), "with-others")
    index = base.keys or keys.build(fact, root, key, DAY)
    named, stored, fresh = keys.lookup(spark, root, index, rows, key, DAY)
    touched = sorted({*days, *map(str, named), *map(str, stored)})
    met = [d for d in touched if d not in days]
    # A day that has left clean by retention gives up the events that are delivered again.
    competing = [d for d in met if storage.exists(spark, f"{lake.clean}/{storage.partition_dir(DAY, d)}")]
    if competing:
        artists = storage.read(spark, lake.analytics("dim_artist"))
        published = fact.filter(_in_days(competing)).join(rows.select(key), key, "left_semi").join(artists, "artist_id")
        rows = staged(first_per_key(rows.unionByName(published.select(*names)), key), "winners")
    kept = fact.filter(_in_days(met)).join(rows.select(key), key, "left_anti") if met else fact.filter(F.lit(False))
    result = kept.unionByName(modeling.artist_key(rows).select(*fact.columns))
    index = keys.extended(spark, root, base, index, fresh, DAY)
    keep = storage.carried_over(base, DAY, touched)
    storage.publish(result, root, DAY, TABLES["fact_stream"].sort_key, keep=keep, base=base, keys=index, lookup=key)
    storage.delete_dir(spark, place)
    return touched


def _publish_metrics(spark: SparkSession, lake: Lake, days: list[str] | None) -> None:
    """Daily metrics of the published fact; of the given days anew, the others as they are."""
    root, fact = lake.analytics("daily_listening_metrics"), storage.read(spark, lake.analytics("fact_stream"))
    metrics = modeling.daily_listening_metrics(fact if days is None else fact.filter(_in_days(days)), unique_keys=True)
    if days is not None and storage.current(spark, root):
        metrics = storage.read(spark, root).filter(~_in_days(days)).unionByName(metrics)
    storage.publish(metrics, root, sort_by=TABLES["daily_listening_metrics"].sort_key)


def _publish_artists(spark: SparkSession, lake: Lake, clean: DataFrame) -> None:
    """Add the artists that the dimension does not have; without any it stays as it is."""
    root, found = lake.analytics("dim_artist"), modeling.dim_artist(clean)
    if storage.current(spark, root):
        old = storage.read(spark, root)
        found = found.join(old, "artist_id", "left_anti")
        if found.isEmpty():
            return
        found = old.unionByName(found)
    storage.publish(found, root, sort_by=TABLES["dim_artist"].sort_key)


def _publish_tracks(spark: SparkSession, lake: Lake, clean: DataFrame, days: list[str] | None) -> None:
    """The last plays of each day, and the track dimension from those of all days.

    Days that ``clean`` does not hold stay as they are, the given ones go if it has none of them.
    """
    root = lake.analytics("last_plays")
    base = storage.current(spark, root)
    if days is None:
        days = [p.split(f"/{DAY}=")[-1] for p, _ in storage.glob(spark, f"{lake.clean}/{DAY}=*")]
    keep = storage.carried_over(base, DAY, days)
    storage.publish(modeling.last_plays(clean), root, DAY, ("track_id",), keep=keep, base=base)
    tracks = modeling.tracks_of_plays(storage.read(spark, root))
    storage.publish(tracks, lake.analytics("dim_track"), sort_by=TABLES["dim_track"].sort_key)


def load_warehouse(spark: SparkSession, lake: Lake, full: bool = False) -> None:
    """Check the staged fact, merge it by event id, and merge the other tables with it.

    Only the days that changed since the last load are staged, checked and merged; all are
    at the first load or with ``full``. Of these, days that are equal are recognised and left
    alone. Rows that analytics no longer has stay in the warehouse, as the events do.
    """
    configure(spark)
    notes = changes.pending(spark, lake.changes("analytics"))
    source, target = lake.analytics("fact_stream"), lake.warehouse("fact_stream")
    before = storage.current(spark, target)
    staging = storage.read(spark, source)
    others = {name: storage.read(spark, lake.analytics(name)) for name in ANALYTICS[1:] if storage.current(spark, lake.analytics(name))}
    if before and not full and notes.days is not None:
        if not notes.days:
            return
        staging = staging.filter(_in_days(notes.days))
        at_once(lambda: maintenance.check_changed(spark, source, staging, "stg_fact_stream"),
                *[lambda n=n, t=t: maintenance.check_constraints(t, n) for n, t in others.items()])
    else:
        at_once(lambda: maintenance.check_constraints(staging, "stg_fact_stream"),
                *[lambda n=n, t=t: maintenance.check_constraints(t, n) for n, t in others.items()])

    def merge(name: str, table: DataFrame) -> None:
        whole = _with_older(spark, lake.warehouse(name), table, TABLES[name].primary_key)
        storage.publish(whole, lake.warehouse(name), sort_by=TABLES[name].sort_key)

    steps = [lambda n=n, t=t: merge(n, t) for n, t in others.items()]
    at_once(lambda: merge_into(spark, target, staging, skip_equal=True), *steps)
    after = storage.current(spark, target)
    if before is None or after is None:
        changes.note(spark, lake.changes("warehouse"), None)
    else:
        changed = storage.changed_partitions(before, after)
        dated = all(re.fullmatch(r"\d+-\d\d-\d\d", d) for d in changed)
        changes.note(spark, lake.changes("warehouse"), changed if dated else None)
    changes.done(spark, lake.changes("analytics"), notes)
    for name in ANALYTICS:
        storage.prune(spark, lake.warehouse(name), KEEP_VERSIONS)


def publish_marts(spark: SparkSession, lake: Lake, full: bool = False) -> None:
    """Materialise the small dashboard tables; run it only after a successful load.

    Totals of the changed days are taken from the fact, the marts from the totals of all days.
    """
    configure(spark)
    notes = changes.pending(spark, lake.changes("warehouse"))
    root, fact = lake.warehouse("play_totals"), storage.read(spark, lake.warehouse("fact_stream"))
    base = storage.current(spark, root)
    if base is None or full or notes.days is None:
        storage.publish(marts.play_totals(fact), root, DAY)
    elif notes.days:
        totals = marts.play_totals(fact.filter(_in_days(notes.days)))
        storage.publish(totals, root, DAY, keep=storage.carried_over(base, DAY, list(notes.days)), base=base)
    else:
        return
    artists = storage.read(spark, lake.warehouse("dim_artist"))
    tables = marts.marts_of_totals(storage.read(spark, root), artists)
    at_once(*[lambda n=n, t=t: storage.publish(t, lake.warehouse(n)) for n, t in tables.items()])
    changes.done(spark, lake.changes("warehouse"), notes)
    for name in ("play_totals", *tables):
        storage.prune(spark, lake.warehouse(name), KEEP_VERSIONS)


def run_all(spark: SparkSession, lake: Lake, level: str = "required") -> Run | None:
    """All stages in order: one driver, so nothing that lands in between is skipped."""
    run = ingest_pending(spark, lake, level)
    clean_to_analytics(spark, lake)
    load_warehouse(spark, lake)
    publish_marts(spark, lake)
    return run


def replay_quarantine(
    spark: SparkSession, lake: Lake, run_id: str, fixes: dict[str, Column], level: str = "required"
) -> str:
    """Gate the rejects of a run again after ``fixes``; returns the id of the replay.

    Recovered rows go to the clean zone under the replay's own load id, the others to
    quarantine under its run id. The old evidence stays, and repeating a replay
    replaces its own output.
    """
    configure(spark)
    replay_id = f"replay-{run_id}"
    rejects = quality.read_quarantine(spark, lake.quarantine).filter(F.col("run_id") == run_id)
    recovered, rest = quality.replay(rejects, fixes, level)
    typed = recovered.withColumns({"run_date": F.to_date("run_date"), "reasons": F.array().cast("array<string>")})
    write_clean(clean_records(typed, replay_id), lake.clean, _days_of(typed))
    quality.write_quarantine(
        quality.quarantine_records(rest, replay_id, F.col("quarantined_at")), lake.quarantine
    )
    return replay_id


REPLAYED = "run_id string, reject_id string, replay_id string, batch int"  # one row per recovered reject
REPLAY_BATCH = 10_000  # rejects of a run that are replayed at a time


def _rejects(spark: SparkSession, lake: Lake, run_id: str) -> DataFrame:
    """The rejects of a run with ``reject_id``, a hash of the whole record; equal records share one."""
    rejects = quality.read_quarantine(spark, lake.quarantine).filter(F.col("run_id") == run_id)
    return rejects.withColumn("reject_id", F.sha2(F.to_json(F.struct(*sorted(rejects.columns))), 256))


def open_rejects(spark: SparkSession, lake: Lake, run_id: str) -> DataFrame:
    """The rejects of a run that no replay has recovered yet."""
    rejects = _rejects(spark, lake, run_id)
    if not storage.exists(spark, lake.replayed):
        return rejects
    done = spark.read.schema(REPLAYED).parquet(lake.replayed).filter(F.col("run_id") == run_id)
    return rejects.join(done.select("reject_id"), "reject_id", "left_anti")


def replay_open(
    spark: SparkSession,
    lake: Lake,
    run_id: str,
    fixes: dict[str, Column],
    level: str = "required",
    batch_rows: int = REPLAY_BATCH,
    batches: int | None = None,
) -> int:
    """Replay the open rejects of a run in small batches; returns how many were recovered.

    A recovered record goes to clean and then into the ledger ``replayed``, and is not
    offered again; the others stay open for the next fixes. Quarantine keeps all as evidence.
    A batch is a hash range of the run's rejects, so an interrupted replay goes on where
    it stopped, and what it did before its ledger entry is replaced. ``batches`` limits those
    done by this call.
    """
    configure(spark)
    total = _rejects(spark, lake, run_id).count()
    parts = max(1, -(-total // batch_rows))
    attempt = hashlib.sha256(repr((sorted((n, str(c)) for n, c in fixes.items()), level)).encode()).hexdigest()[:12]
    replay_id = f"replay-{run_id}-{attempt}"
    recovered_rows = worked = 0
    for n in range(parts):
        if batches is not None and worked >= batches:
            break
        offered = open_rejects(spark, lake, run_id).filter(F.pmod(F.xxhash64("reject_id"), F.lit(parts)) == n)
        recovered, _ = quality.replay(offered, fixes, level)
        place = scratch_dir(spark, "replay")
        recovered.write.parquet(place)
        recovered = spark.read.schema(recovered.schema).parquet(place)
        rows = recovered.count()
        if rows:
            typed = recovered.drop("reject_id").withColumns(
                {"run_date": F.to_date("run_date"), "reasons": F.array().cast("array<string>")}
            )
            write_clean(clean_records(typed, f"{replay_id}-{n:05d}"), lake.clean, _days_of(typed))
            entries = recovered.select("run_id", "reject_id", F.lit(replay_id).alias("replay_id"), F.lit(n).alias("batch"))
            (
                entries.distinct()
                .coalesce(1)  # at most a batch
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("run_id", "replay_id", "batch")
                .parquet(lake.replayed)
            )
            worked += 1
        recovered_rows += rows
        storage.delete_dir(spark, place)
    return recovered_rows
