"""Gapless numbers of rows within groups, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from streamlake.llm.files import staged


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(``rows`` with ``pos``, their place in their group from 0; the groups with ``n`` rows and
    ``first``, which sorts as the groups do).

    A range partitioning numbers the rows, with the input's row number last, so that a group
    of any size, also of equal rows, is spread. A group's rows lie together in a partition;
    what comes before that partition is a running total over one row per group and partition.
    """
    by = [group, *order, "_tie"]
    laid = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")
    placed = staged(laid.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    counts = placed.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    starts = staged(counts.withColumn("_start", F.coalesce(before, F.lit(0))), "numbered-starts")
    groups = starts.groupBy(group).agg(F.sum("_n").alias("n"), F.min("_first").alias("first"))
    starts = starts.select(F.col(group).alias("_group"), F.col("_part").alias("_of"), "_first", "_start")
    same = placed[group].eqNullSafe(starts["_group"]) & (placed["_part"] == starts["_of"])
    pos = F.col("_start") + F.col("_at") - F.col("_first")
    return placed.join(starts, same).select(*rows.columns, pos.alias("pos")), groups
