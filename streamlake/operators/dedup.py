"""One row per key, and the report of keys that repeat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlake.contracts import EVENT_CONTRACT


def default_order(df: DataFrame, event_time: str = EVENT_CONTRACT.event_time) -> list[str]:
    """Event time, then every other orderable column: a total order but for identical rows."""
    simple = [f.name for f in df.schema if f.dataType.typeName() not in ("map", "variant")]
    return [c for c in (event_time,) if c in simple] + [c for c in simple if c != event_time]


def first_per_key(
    df: DataFrame,
    key: str | Sequence[str] = EVENT_CONTRACT.key,
    order_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Keep the first row of each key in an explicit order.

    ``row_number() = 1`` is planned with a group limit on both sides of the shuffle:
    each task drops all but one row per key before anything is sent, so a key that
    holds a third of the table reaches its reducer as at most one row per map task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    missing = sorted(set(keys) - set(df.columns))
    if missing:
        raise ValueError(f"deduplication key not in the frame: {', '.join(missing)}")
    if order_by is None:
        order_by = [c for c in default_order(df) if c not in keys] or keys
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def duplicate_keys(df: DataFrame, key: str | Sequence[str] = EVENT_CONTRACT.key) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def require_unique(df: DataFrame, key: str) -> None:
    """Raise when the key is null or repeated. One row comes back, and all tasks run at once."""
    bad = (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter((F.col("row_count") > 1) | F.col(key).isNull())
        .agg(F.count(F.lit(1)).alias("keys"), F.any_value(F.struct(key, "row_count")).alias("example"))
        .first()
    )
    if bad["keys"]:
        example = bad["example"]
        raise ValueError(
            f"{key} must be unique and not null; {bad['keys']} keys are not, "
            f"such as {example[key]!r} {example['row_count']} times"
        )
