"""The quality gate: one pass gives every row a verdict, by rule and by duplicate key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import out_of_rules, within_rules
from ..schemas import DQ_DUPLICATE, DQ_INVALID, DQ_MESSAGES, RuleSet


def newest_first(df: DataFrame, rules: RuleSet, order: Sequence[Column] | None = None) -> list[Column]:
    """A total order within a key: by ingestion time where there is one, then by every other column."""
    if order is not None:
        return list(order)
    first = [c for c in ("_ingestion_ts", "_file_order") if c in df.columns]
    rest = sorted(c for c in df.columns if c not in rules.key and c not in first)
    return [F.col(c).desc_nulls_last() for c in [*first, *rest]]


def verdicts(df: DataFrame, rules: RuleSet, order: Sequence[Column] | None = None) -> DataFrame:
    """Adds _dq: null for a clean row, else the code of its rejection. Invalid rows never win over valid ones."""
    checked = df.withColumn("_invalid", out_of_rules(rules))
    apart = F.when(F.col("_invalid"), F.xxhash64(*df.columns))  # spreads invalid rows, whose keys may all be null
    turn = Window.partitionBy(*rules.key, apart).orderBy(*newest_first(df, rules, order))
    code = F.when(F.col("_invalid"), F.lit(DQ_INVALID)).when(F.row_number().over(turn) > 1, F.lit(DQ_DUPLICATE))
    return checked.withColumn("_dq", code).drop("_invalid")


@dataclass
class Gated:
    clean: DataFrame
    invalid: DataFrame
    duplicates: DataFrame


def gate(df: DataFrame, rules: RuleSet, order: Sequence[Column] | None = None) -> Gated:
    """Clean rows, one per key; rows that break a rule; superseded duplicates. Each input row is in exactly one.

    Invalid rows are split off before the shuffle, and the clean frame drops most duplicates there as well.
    """
    valid, turn = df, newest_first(df, rules, order)
    for condition in within_rules(rules):
        valid = valid.where(condition)
    return Gated(winners(valid, rules.key, turn), df.where(out_of_rules(rules)), losers(valid, rules.key, turn))


def winners(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key; Spark drops losers before the shuffle (WindowGroupLimit)."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def losers(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn > 1").drop("_rn")


def quarantined(rows: DataFrame, code: str | Column, pipeline: str, batch_id: str | None, stage: str, at: Column | None = None) -> DataFrame:
    """Rejected rows with the reason and where they were rejected."""
    code = code if isinstance(code, Column) else F.lit(code)
    message = F.element_at(F.create_map(*[F.lit(x) for kv in DQ_MESSAGES.items() for x in kv]), code)
    return rows.withColumns({"error_code": code, "error_message": message, "pipeline_name": F.lit(pipeline), "batch_id": F.lit(batch_id).cast("string"), "stage": F.lit(stage), "quarantined_at": F.current_timestamp() if at is None else at})
