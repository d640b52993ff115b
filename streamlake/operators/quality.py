"""The quality gate: which records are accepted, and why the others are not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlake.contracts import EVENT_CONTRACT, Contract, Field
from streamlake.functions.expressions import (
    all_of,
    any_of,
    decimal_number,
    is_blank,
    matches_format,
    utc_timestamp,
    whole_number,
)

RAW_TIME = "played_at_raw"
CORRUPT = "_corrupt_record"
SHAPE = "_json_shape"
LEVELS = ("required", "contract")
# Types a JSON value may show for each contract kind; null is left to the missing rule.
JSON_KINDS = {"string": r"^(STRING|VOID)$", "integer": r"^(BIGINT|DECIMAL.*|DOUBLE|FLOAT|VOID)$"}


def ensure_columns(df: DataFrame, contract: Contract = EVENT_CONTRACT, as_text: bool = False) -> DataFrame:
    """Add each contract column the input lacks as a typed null, so its rows can be rejected."""
    absent = [f for f in contract.fields if f.name not in df.columns]
    return df.withColumns(
        {f.name: F.lit(None).cast("string" if as_text else f.dtype) for f in absent}
    ) if absent else df


def parse_event_time(df: DataFrame, column: str = EVENT_CONTRACT.event_time) -> DataFrame:
    """Text to a UTC instant, null where it does not parse; the text stays in ``<column>_raw``.

    A generator holds the parse, so that rules and results read its value, where a projection
    would be merged into the filter above it and parse again.
    """
    raw = f"{column}_raw"
    both = F.struct(F.col(column).cast("string").alias(raw), utc_timestamp(F.col(column)).alias(column))
    own = [c for c in df.columns if c not in (column, raw)]
    order = [*df.columns, *([] if raw in df.columns else [raw])]
    return df.select(*own, F.inline(F.array(both))).select(*order)


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    absent = sorted(set(columns) - set(df.columns))
    if absent:
        raise ValueError(f"frame lacks required columns: {', '.join(absent)}")


def split_required(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a value in every column, the other rows)."""
    require_columns(df, columns)
    bad = any_of([is_blank(F.col(c)) for c in columns])
    return df.filter(~bad), df.filter(bad)


Rules = list[tuple[str, Column]]


def _is_text(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() == "string"


def _missing(df: DataFrame, name: str) -> Column:
    """Null, or blank text; a typed value has no text to look at."""
    return is_blank(F.col(name)) if _is_text(df, name) else F.col(name).isNull()


def _is_whole(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() in ("byte", "short", "integer")


def required_rules(
    df: DataFrame, columns: Sequence[str], event_time: str | None = EVENT_CONTRACT.event_time
) -> Rules:
    """(reason, condition that rejects) in a fixed order. Conditions are never null.

    After ``parse_event_time`` the text decides between missing and unparseable.
    """
    require_columns(df, columns)
    rules: Rules = []
    for name in columns:
        raw = f"{name}_raw"
        value = raw if name == event_time and raw in df.columns else name
        rules.append((f"missing:{name}", _missing(df, value)))
    if event_time in columns and f"{event_time}_raw" in df.columns:
        rules.append((f"timestamp:{event_time}", ~is_blank(F.col(f"{event_time}_raw")) & F.col(event_time).isNull()))
    return rules


def type_rules(df: DataFrame, contract: Contract = EVENT_CONTRACT) -> Rules:
    """Values that have no canonical form, such as a duration that is not a number."""
    return [
        (f"type:{f.name}", ~is_blank(F.col(f.name)) & whole_number(F.col(f.name)).isNull())
        for f in contract.fields
        if f.json_kind == "integer" and f.name in df.columns and not _is_whole(df, f.name)
    ]


def length_rules(df: DataFrame, contract: Contract = EVENT_CONTRACT) -> Rules:
    """Values that the published column cannot hold."""
    return [
        (f"length:{f.name}", F.coalesce(F.char_length(F.col(f.name).cast("string")) > f.max_length, F.lit(False)))
        for f in contract.fields
        if f.max_length and f.name in df.columns
    ]


def _field_rules(f: Field, value: Column) -> Rules:
    """Contract rules of one field. A missing value breaks only the ``missing`` rule."""
    text = value.cast("string")
    present = value.isNotNull()
    rules: Rules = [(f"missing:{f.name}", ~present)]
    if f.min_length or f.max_length:
        length = F.char_length(text)
        short = length < f.min_length if f.min_length else F.lit(False)
        long_ = length > f.max_length if f.max_length else F.lit(False)
        rules.append((f"length:{f.name}", present & (short | long_)))
    if f.json_kind == "integer":
        number = decimal_number(value)
        whole = number.isNotNull() & (number == F.floor(number))
        rules.append((f"type:{f.name}", present & ~F.coalesce(whole, F.lit(False))))
        if f.minimum is not None:
            rules.append((f"minimum:{f.name}", present & F.coalesce(number < f.minimum, F.lit(False))))
    if f.fmt:
        rules.append((f"format:{f.name}", present & ~F.coalesce(matches_format(text, f.fmt), F.lit(False))))
    if f.choices:
        rules.append((f"enum:{f.name}", present & ~text.isin(*f.choices)))
    return rules


def contract_rules(
    df: DataFrame,
    contract: Contract = EVENT_CONTRACT,
    raw_line: str | None = None,
) -> Rules:
    """Every rule of the contract, field by field.

    With ``raw_line`` the JSON text is consulted too: a value of the wrong JSON kind
    (``"187"`` for a number) and a field the contract does not know are rejected.
    """
    require_columns(df, contract.names)
    rules: Rules = []
    for f in contract.fields:
        raw = f"{f.name}_raw"
        rules += _field_rules(f, F.col(raw) if raw in df.columns else F.col(f.name))
    if raw_line:
        rules += _json_rules(df, contract, raw_line)
    return rules


def _json_rules(df: DataFrame, contract: Contract, raw_line: str) -> Rules:
    """Rules on the JSON text. A record that has exactly the contract's fields with the
    usual types is recognised by one comparison; only another is taken apart."""
    line = F.col(raw_line)
    shape = F.col(SHAPE) if SHAPE in df.columns else F.schema_of_variant(F.try_parse_json(line))
    kinds = {"string": "STRING", "integer": "BIGINT"}
    usual = ", ".join(f"{f.name}: {kinds[f.json_kind]}" for f in sorted(contract.fields, key=lambda f: f.name))
    odd = shape != F.lit(f"OBJECT<{usual}>")
    rules: Rules = []
    for f in contract.fields:
        kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(line), f"$.{f.name}", "variant"))
        wrong = F.coalesce(~kind.rlike(JSON_KINDS[f.json_kind]), F.lit(False))
        rules.append((f"kind:{f.name}", F.when(odd, wrong).otherwise(False)))
    known = F.array(*[F.lit(n) for n in contract.names])
    unknown = F.coalesce(F.size(F.array_except(F.json_object_keys(line), known)) > 0, F.lit(False))
    rules.append(("unknown_fields", F.when(odd, unknown).otherwise(False)))
    return rules


def reasons(rules: Rules) -> Column:
    """Array of the reasons that apply, in rule order; empty for an accepted row."""
    return F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in rules]))


def reason_text(rules: Rules) -> Column:
    return F.concat_ws(",", *[F.when(condition, F.lit(name)) for name, condition in rules])


def accepted(rules: Rules) -> Column:
    return all_of([~condition for _, condition in rules])


def gate_rules(
    df: DataFrame,
    level: str = "required",
    columns: Sequence[str] | None = None,
    contract: Contract = EVENT_CONTRACT,
    raw_line: str | None = None,
) -> Rules:
    """Rules of a gate level: ``required`` (values present, time and number readable, texts
    not too long to publish) or ``contract`` (those and every contract rule)."""
    if level not in LEVELS:
        raise ValueError(f"level must be one of {', '.join(LEVELS)}")
    rules = [("not_json", F.col(CORRUPT).isNotNull())] if CORRUPT in df.columns else []
    rules += required_rules(df, columns or contract.names, contract.event_time)
    rules += type_rules(df, contract) + length_rules(df, contract)
    if level == "contract":
        merged = dict(rules)
        for name, condition in contract_rules(df, contract, raw_line):
            merged[name] = merged[name] | condition if name in merged else condition
        rules = list(merged.items())
    return rules


def classify(df: DataFrame, rules: Rules) -> DataFrame:
    """Add ``reasons``; one pass, no shuffle. Each condition is evaluated once per row: the array
    sits in a generator, which a filter on it does not repeat."""
    own = [c for c in df.columns if c != "reasons"]
    return df.select(*own, F.explode(F.array(reasons(rules))).alias("reasons"))


def split(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with their reasons); both come from the same conditions."""
    return df.filter(accepted(rules)), classify(df, rules).filter(F.size("reasons") > 0)


def quarantine_records(rejected: DataFrame, run_id: str, quarantined_at: str | Column) -> DataFrame:
    """Audit columns on rejects; every other scalar as text, so all quarantine files agree in type.

    ``quarantined_at`` is one UTC ISO string per run, fixed by the caller, so a task
    that runs twice writes the same rows.
    """
    audit = ("run_id", "quarantined_at")
    text = [
        F.col(f.name) if f.name == "reasons" else F.col(f.name).cast("string").alias(f.name)
        for f in rejected.schema
        if f.name not in audit
    ]
    at = F.lit(quarantined_at) if isinstance(quarantined_at, str) else quarantined_at
    return rejected.select(*text, F.lit(run_id).alias("run_id"), at.alias("quarantined_at"))


def write_quarantine(records: DataFrame, path: str) -> None:
    """One directory per run: another run adds to the evidence, a repeat of a run replaces its own."""
    (
        records.hint("rebalance")  # a few rejects per task would make a file each
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("run_id")
        .parquet(path)
    )


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """All runs, with ``run_id`` as text also where it looks like a number or a date."""
    found = spark.read.parquet(path).schema
    text = [T.StructField("run_id", T.StringType()) if f.name == "run_id" else f for f in found]
    return spark.read.schema(T.StructType(text)).parquet(path)


def canonical_types(df: DataFrame, contract: Contract = EVENT_CONTRACT) -> DataFrame:
    """Publish types: integer fields cut to int, date fields to date; null where impossible."""
    out = {}
    for f in contract.fields:
        if f.name not in df.columns:
            continue
        if f.json_kind == "integer":
            whole = _is_whole(df, f.name)
            out[f.name] = F.col(f.name).cast("int") if whole else whole_number(F.col(f.name))
        elif f.dtype.typeName() == "date":
            out[f.name] = F.try_to_date(F.col(f.name).cast("string"))
    return df.withColumns(out)


def stamp_ingest_date(df: DataFrame, run_date: Column | str, column: str = EVENT_CONTRACT.partition) -> DataFrame:
    """Replace the record's own date by the date of the run's partition."""
    value = F.lit(run_date).cast("date") if isinstance(run_date, str) else run_date
    return df.withColumn(column, value)


def replay(
    quarantined: DataFrame,
    fixes: dict[str, Column],
    level: str = "required",
    contract: Contract = EVENT_CONTRACT,
) -> tuple[DataFrame, DataFrame]:
    """Apply fixes to quarantined rows and gate them again: (recovered, still rejected).

    The rows of the second frame keep their audit columns and get new reasons.
    """
    restored = quarantined.drop("reasons")
    if RAW_TIME in restored.columns:
        restored = restored.withColumn(contract.event_time, F.col(RAW_TIME)).drop(RAW_TIME)
    fixed = parse_event_time(restored.withColumns(fixes), contract.event_time)
    return split(fixed, gate_rules(fixed, level, contract=contract))
