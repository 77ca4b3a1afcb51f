"""Landing rows to typed rows: conform by name, split off rows without required values, add ingestion columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import required_missing
from ..functions.schema import Drift, compare
from ..schemas import RuleSet

INGEST_COLUMNS = ("_ingestion_ts", "_source_file", "_snapshot_day")


def conform(raw: DataFrame, rules: RuleSet) -> DataFrame:
    """Declared columns first, cast (null where that fails) or added as typed nulls; others pass through."""
    declared = [(F.col(c).try_cast(t) if c in raw.columns else F.lit(None).cast(t)).alias(c) for c, t in rules.columns.items()]
    return raw.select(*declared, *[F.col(f"`{c}`") for c in raw.columns if c not in rules.columns])


def name_drift(raw: DataFrame, rules: RuleSet) -> list[Drift]:
    """Columns that a landing file adds or lacks. Types are no drift here: they are judged value by value."""
    present = {c: rules.columns.get(c, "string") for c in raw.columns}
    return compare(rules.columns, present)


def uncastable(raw: DataFrame, rules: RuleSet) -> DataFrame:
    """One row per declared column: values present, and those that do not cast to its type."""
    present = [c for c in rules.columns if c in raw.columns]
    bad = [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(rules.columns[c]).isNull()).alias(f"b_{c}") for c in present]
    counts = raw.agg(*[F.count(c).alias(f"n_{c}") for c in present], *bad)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n_{c}").alias("present"), F.col(f"b_{c}").alias("uncastable")) for c in present])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


@dataclass
class Split:
    kept: DataFrame
    rejected: DataFrame


def split_required(rows: DataFrame, rules: RuleSet) -> Split:
    missing = required_missing(rules)
    return Split(rows.where(~missing), rows.where(missing))


def stamped(rows: DataFrame, source_file: str | Column, day: int | Column, at: Column | None = None) -> DataFrame:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return rows.withColumns({"_ingestion_ts": F.current_timestamp() if at is None else at, "_source_file": lit(source_file), "_snapshot_day": lit(day).cast("int")})
