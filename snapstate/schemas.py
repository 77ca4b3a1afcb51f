"""Rules and schemas as data."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class RuleSet:
    """What a table's rows must meet, and which columns make a row count as changed."""

    columns: dict[str, str]  # name -> declared type
    key: tuple[str, ...]
    required: tuple[str, ...]
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)  # inclusive
    tracked: tuple[str, ...] = ()
    group: tuple[str, ...] = ()  # of the KPI
    fault: str | None = None
    healthy: str = "NONE"


#: The landing schema, its rules and the codes of rejected rows.
TELEMETRY = RuleSet(
    columns={"reading_id": "bigint", "customer_id": "string", "machine_id": "string", "event_ts": "string", "gps_lat": "double", "gps_lon": "double", "fuel_level": "double", "payload_weight_t": "double", "fault_code": "string"},
    key=("reading_id",),
    required=("reading_id", "customer_id", "machine_id"),
    ranges={"fuel_level": (0.0, 100.0), "payload_weight_t": (0.0, 60.0)},
    tracked=("fuel_level", "payload_weight_t", "fault_code"),
    group=("customer_id", "machine_id"),
    fault="fault_code",
)
DQ_REQUIRED, DQ_INVALID, DQ_DUPLICATE = "DQ001", "DQ002", "DQ003"
DQ_MESSAGES = {DQ_REQUIRED: "required column missing or not castable", DQ_INVALID: "null key or value out of range", DQ_DUPLICATE: "superseded duplicate of a key"}
NEW, CHANGED, UNCHANGED, RETAINED = "NEW", "CHANGED", "UNCHANGED", "RETAINED"
STARTED, SUCCESS, FAILED, SKIPPED = "STARTED", "SUCCESS", "FAILED", "SKIPPED"

_S, _L, _I, _D, _TS, _B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.TimestampType(), T.BooleanType()


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, null) for n, t, null in fields])


def _named(names: str, kind: T.DataType, null: bool) -> list[tuple[str, T.DataType, bool]]:
    return [(n, kind, null) for n in names.split()]


#: Columns of the ledgers.
CONTROL = _schema(
    *_named("pipeline_name pipeline_type stage run_id execution_id execution_mode trigger_type", _S, False), *_named("batch_id snapshot_date source_file watermark checkpoint", _S, True), ("status", _S, False),
    *_named("rows_read rows_written rows_skipped duration_seconds", _L, True), ("error_message", _S, True), *_named("start_time end_time created_at updated_at", _TS, True),
)
AUDIT = _schema(
    *_named("run_id execution_id", _S, False), ("batch_id", _S, True), *_named("pipeline_name pipeline_type stage status", _S, False), *_named("job_name trigger_type execution_mode", _S, True),
    *_named("retry_count rows_read rows_written rows_rejected rows_skipped files_processed", _I, False), ("snapshot_day", _I, True), *_named("source_name source_path source_file target_name target_path metadata", _S, True),
    *_named("environment execution_engine", _S, False), *_named("workspace_name cluster_name hostname user_name", _S, True), ("started_at", _TS, False), ("completed_at", _TS, True), ("duration_seconds", _D, False),
    *_named("error_type error_message", _S, True), ("created_at", _TS, False), *_named("framework_version schema_version", _S, False),
)
QUARANTINE_COLUMNS = ("error_code", "error_message", "pipeline_name", "batch_id", "stage", "quarantined_at")
SCHEMA_HISTORY = _schema(*_named("pipeline_name stage", _S, False), ("version", _L, False), *_named("schema_hash schema_json", _S, False), ("recorded_at", _TS, False))
SCHEMA_CHANGES = _schema(*_named("pipeline_name stage change_type column_name", _S, False), *_named("old_type new_type", _S, True), ("action", _S, False), ("recorded_at", _TS, False))
RECONCILIATION = _schema(
    ("run_id", _S, False), ("snapshot_day", _L, False), *_named("landing_rows total_rows_in_snapshot new_rows changed_rows unchanged_rows_skipped incremental_volume_processed", _L, False),
    ("reprocessing_reduction_pct", _D, True), ("unchanged_pct", _D, True), *_named("dq_dropped_rows dq_invalid_rows dq_duplicate_rows merged_state_row_count gold_rows", _L, True), ("row_conservation_passed", _B, False), ("run_ts", _TS, False),
)
WATERMARK = _schema(("pipeline_name", _S, False), ("watermark", _S, True), ("updated_at", _TS, False))
