"""Row-level access from a mapping table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlake.functions.expressions import any_of

ANY = "*"


def visible_rows(
    df: DataFrame,
    mapping: DataFrame,
    principal: str,
    dimensions: tuple[str, ...] = ("platform", "market"),
) -> DataFrame:
    """Rows the principal may see; none when the mapping does not name the principal.

    ``mapping`` has columns principal, dimension, value. Dimension ``*`` opens every row,
    ``platform`` or ``market`` the rows with that value. A grant on a column the data does
    not have opens nothing. The distinct grants of one principal, a handful of names, are
    read as a scalar subquery, so the data is filtered where it is scanned: no join and
    no shuffle.
    """
    grant = F.when(F.col("dimension") == ANY, F.lit(ANY)).otherwise(F.concat_ws("=", "dimension", "value"))
    grants = mapping.filter(F.col("principal") == principal).agg(F.collect_set(grant).alias("grants")).scalar()
    allowed = [F.array_contains(grants, F.lit(ANY))]
    for dimension in dimensions:
        if dimension in df.columns:
            wanted = F.concat(F.lit(f"{dimension}="), F.col(dimension).cast("string"))
            allowed.append(F.coalesce(F.array_contains(grants, wanted), F.lit(False)))
    return df.filter(any_of(allowed))
