"""Log triage, log metrics, threshold alarms, recent queries and stream lag."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Patterns, limits and alarm thresholds of the monitored pipeline.
TRIAGE_PATTERN = "ERROR|FAILED|TIMEOUT"
TRIAGE_ROWS = 100
RECENT_QUERIES = 50
PERIOD = "5 minutes"


@dataclass(frozen=True)
class LogMetric:
    """Each line of ``log_group`` that contains ``pattern`` counts one."""

    metric: str
    log_group: str
    pattern: str


LOG_METRICS = (
    LogMetric("job_failed", "raw_to_clean", "FAILED"),
    LogMetric("job_timeout", "raw_to_clean", "TIMEOUT"),
    LogMetric("warehouse_errors", "warehouse", "ERROR"),
    LogMetric("warehouse_capacity", "warehouse", "capacity"),
)

# (metric, statistic, comparison, threshold); a period without data never breaches.
ALARM_RULES = (
    ("function_errors", "sum", ">=", 1.0),
    ("function_throttles", "sum", ">=", 1.0),
    ("job_failed", "sum", ">=", 1.0),
    ("job_timeout", "sum", ">=", 1.0),
    ("stream_iterator_age_ms", "max", ">", 60000.0),
    ("delivery_success", "sum", "<", 1.0),
    ("dead_letter_depth", "max", ">=", 1.0),
    ("warehouse_errors", "sum", ">=", 1.0),
    ("warehouse_capacity", "sum", ">=", 1.0),
    ("query_bytes_scanned", "sum", ">", 1073741824.0),
)


def log_triage(logs: DataFrame, tie_break: str = "log_id", limit: int = TRIAGE_ROWS) -> DataFrame:
    """Newest failure lines; planned as a per-task top-k and one merge."""
    return logs.filter(F.col("message").rlike(TRIAGE_PATTERN)).orderBy(F.desc("ts"), F.desc(tie_break)).limit(limit)


def log_metrics(logs: DataFrame, metrics: tuple[LogMetric, ...] = LOG_METRICS) -> DataFrame:
    """(window_start, metric, value) per period; all patterns in one pass, zero counts left out.

    Works on a batch and on a stream with a watermark.
    """
    counts = [
        F.sum(
            F.when((F.col("log_group") == m.log_group) & F.col("message").contains(m.pattern), 1).otherwise(0)
        ).alias(m.metric)
        for m in metrics
    ]
    wide = logs.groupBy(F.window("ts", PERIOD).alias("w")).agg(*counts)
    pairs = F.explode(
        F.array(*[F.struct(F.lit(m.metric).alias("metric"), F.col(m.metric).alias("value")) for m in metrics])
    )
    return (
        wide.select(F.col("w.start").alias("window_start"), pairs.alias("p"))
        .select("window_start", "p.metric", "p.value")
        .filter("value > 0")
    )


def alarm_rules(spark: SparkSession, rules=ALARM_RULES) -> DataFrame:
    return spark.createDataFrame(rules, "metric string, stat string, op string, threshold double")


def metric_alarms(points: DataFrame, rules: DataFrame) -> DataFrame:
    """Breaching periods: (window_start, metric, stat, value, threshold).

    ``points`` has columns ts, metric, value. Points are reduced to one row per period
    and metric before they meet the rules; a period without points yields no row.
    """
    per_period = points.groupBy(F.window("ts", PERIOD).alias("w"), "metric").agg(
        F.sum("value").alias("sum_value"), F.max("value").alias("max_value")
    )
    value = F.when(F.col("stat") == "sum", F.col("sum_value")).otherwise(F.col("max_value"))
    threshold = F.col("threshold")
    breach = (
        F.when(F.col("op") == ">=", F.col("value") >= threshold)
        .when(F.col("op") == ">", F.col("value") > threshold)
        .when(F.col("op") == "<", F.col("value") < threshold)
    )
    return (
        per_period.join(rules, "metric")
        .withColumn("value", value.cast("double"))
        .filter(breach)
        .select(F.col("w.start").alias("window_start"), "metric", "stat", "value", "threshold")
    )


def recent_queries(history: DataFrame, limit: int = RECENT_QUERIES) -> DataFrame:
    """Newest queries with their cost and outcome."""
    return (
        history.orderBy(F.desc("submitted_at"), F.desc("query_id"))
        .limit(limit)
        .select("query_id", "submitted_at", "bytes_scanned", "status")
    )


def stream_lag(arrivals: DataFrame, limit_ms: int = 60000) -> DataFrame:
    """Longest delay per arrival period in milliseconds, and whether it breaches the limit.

    ``arrivals`` has columns event_ts and arrival_ts. Works on a stream with a watermark
    on ``arrival_ts``.
    """
    delay = F.unix_millis("arrival_ts") - F.unix_millis("event_ts")
    return (
        arrivals.groupBy(F.window("arrival_ts", PERIOD).alias("w"))
        .agg(F.max(delay).alias("max_lag_ms"))
        .select(
            F.col("w.start").alias("window_start"),
            "max_lag_ms",
            (F.col("max_lag_ms") > limit_ms).alias("breach"),
        )
    )
