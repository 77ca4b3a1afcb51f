"""KPIs over the current state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import is_fault
from ..schemas import RuleSet


def machine_kpi(state: DataFrame, rules: RuleSet) -> DataFrame:
    """Per machine: mean fuel and payload, faults, readings, and the last ingestion time if the state has one."""
    out = [
        F.avg("fuel_level").alias("avg_fuel_level"), F.avg("payload_weight_t").alias("avg_payload_t"),
        F.sum(is_fault(rules).cast("long")).alias("fault_events"), F.count(rules.key[0]).alias("total_readings"),
    ]
    if "_ingestion_ts" in state.columns:
        out.append(F.max("_ingestion_ts").alias("last_updated_ts"))
    return state.groupBy(*rules.group).agg(*out)


def customer_day_kpi(state: DataFrame, rules: RuleSet, day: str = "_snapshot_day") -> DataFrame:
    """Per customer and snapshot day: readings, active machines and fault rate."""
    return state.groupBy("customer_id", day).agg(F.count(rules.key[0]).alias("total_readings"), F.countDistinct("machine_id").alias("active_machines"), F.avg(is_fault(rules).cast("double")).alias("fault_rate"))


def top(df: DataFrame, by: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The k rows with the largest `by`, ties in the order of the other columns."""
    return df.orderBy(F.col(by).desc_nulls_last(), *ties).limit(k)


def latest_reading(machines: DataFrame, state: DataFrame) -> DataFrame:
    """Each machine of a roster with its newest reading (largest reading_id), null where it has none."""
    newest = state.groupBy("customer_id", "machine_id").agg(F.max_by(F.struct("reading_id", "fuel_level", "payload_weight_t", "fault_code"), "reading_id").alias("r"))
    return machines.join(newest, ["customer_id", "machine_id"], "left").select(*machines.columns, F.col("r.reading_id").alias("reading_id"), F.col("r.fuel_level").alias("fuel_level"), F.col("r.payload_weight_t").alias("payload_weight_t"), F.col("r.fault_code").alias("fault_code"))


def require_rows(df: DataFrame, what: str) -> None:
    """An empty result never overwrites a table that has rows."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty; the stored table is left as it is")
