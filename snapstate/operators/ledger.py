"""Ledgers: runs (control), audit, schema history, watermarks and quarantine.

The control ledger is append-only: each change of status is an event, and the state of a (pipeline, run, stage, file)
is its latest one. So an update can never touch rows of another stage or file.
"""

from __future__ import annotations

import getpass
import json
import logging
import platform
import socket
import time
import traceback
import uuid
from collections.abc import Iterable, Mapping
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import Drift, compare, schema_hash, schema_json, types_of
from ..schemas import AUDIT, CONTROL, FAILED, SCHEMA_CHANGES, SCHEMA_HISTORY, SKIPPED, STARTED, SUCCESS, WATERMARK
from ..sources.store import Store
from .changes import upsert
from .quality import quarantined

VERSION = "1.0"
RUN_KEY = ("pipeline_name", "run_id", "stage", "source_file")
log = logging.getLogger("snapstate")


def now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def new_id() -> str:
    return str(uuid.uuid4())


def one_row(spark: SparkSession, schema: T.StructType, values: Mapping[str, object]) -> DataFrame:
    """A frame of one row, of literals: it is written by one task, without rows from Python."""
    return spark.range(1).select(*[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema])


def latest(events: DataFrame, keys: Iterable[str], at: str = "updated_at") -> DataFrame:
    """The last event of each key; of events at one time, the one furthest along."""
    keys = list(keys)
    rest = [c for c in events.columns if c not in keys]
    stage = F.when(F.col("status") == STARTED, 0).otherwise(1) if "status" in events.columns else F.lit(0)
    return events.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(at, stage)).alias("_e")).select(*keys, "_e.*")


class Control:
    def __init__(self, store: Store, pipeline: str, kind: str = "incremental_batch", run_id: str | None = None, execution_id: str | None = None):
        self.spark, self.pipeline, self.kind = store.spark, pipeline, kind
        self.run_id, self.execution_id = run_id or new_id(), execution_id or new_id()
        self.events, self.marks = store.log("control", CONTROL), store.state("watermark")
        self._open: dict[tuple[str, str], dict[str, object]] = {}

    def register(self, stage: str, source_file: str, status: str, **more: object) -> None:
        at = now()
        values = {"pipeline_name": self.pipeline, "pipeline_type": self.kind, "stage": stage, "run_id": self.run_id, "execution_id": self.execution_id, "execution_mode": "batch", "trigger_type": "manual", "source_file": source_file, "status": status, "start_time": at, "created_at": at, "updated_at": at} | more
        self.events.append(one_row(self.spark, CONTROL, values))
        self._open[stage, source_file] = values

    def start(self, stage: str, source_file: str, **more: object) -> None:
        self.register(stage, source_file, STARTED, **more)

    def _end(self, stage: str, source_file: str, status: str, **more: object) -> None:
        begun = self._open.get((stage, source_file), {})
        at = now()
        start = begun.get("start_time", at)
        self.register(stage, source_file, status, **{k: v for k, v in begun.items() if k in ("batch_id", "snapshot_date", "watermark", "checkpoint", "execution_mode", "trigger_type")} | {"start_time": start, "created_at": begun.get("created_at", at), "end_time": at, "duration_seconds": int((at - start).total_seconds())} | more)

    def finish(self, stage: str, source_file: str, rows_read: int = 0, rows_written: int = 0, rows_skipped: int = 0) -> None:
        self._end(stage, source_file, SUCCESS, rows_read=rows_read, rows_written=rows_written, rows_skipped=rows_skipped)

    def fail(self, stage: str, source_file: str, error: BaseException | str) -> None:
        self._end(stage, source_file, FAILED, error_message=str(error)[:4000])

    def skip(self, stage: str, source_file: str, reason: str = "already processed") -> None:
        self._end(stage, source_file, SKIPPED, error_message=reason)

    def current(self) -> DataFrame:
        return latest(self.events.read(), RUN_KEY)

    def _of(self, stage: str, source_file: str) -> DataFrame:
        return self.events.read().where((F.col("pipeline_name") == F.lit(self.pipeline)) & (F.col("source_file") == F.lit(source_file)) & (F.col("stage") == F.lit(stage)))

    def last_status(self, stage: str, source_file: str) -> str | None:
        row = latest(self._of(stage, source_file), ["stage"]).select("status").first()
        return row["status"] if row else None

    def _successes(self, stage: str) -> DataFrame:
        rows = self.events.read().where((F.col("pipeline_name") == F.lit(self.pipeline)) & (F.col("stage") == F.lit(stage)) & (F.col("status") == SUCCESS))
        return rows.select("source_file")

    def already_processed(self, stage: str, source_file: str) -> bool:
        return not self._successes(stage).where(F.col("source_file") == F.lit(source_file)).isEmpty()

    def processed(self, files: DataFrame, stage: str) -> DataFrame:
        """Rows of files (source_file, ...) with a success of the stage; one semi join instead of a look-up each."""
        return files.join(self._successes(stage), "source_file", "left_semi")

    def pending(self, files: DataFrame, stage: str) -> DataFrame:
        """Rows of files (source_file, ...) without a success of the stage."""
        return files.join(self._successes(stage), "source_file", "left_anti")

    def watermark(self) -> str | None:
        row = self.marks.read_or_empty(WATERMARK).where(F.col("pipeline_name") == F.lit(self.pipeline)).select("watermark").first()
        return row["watermark"] if row else None

    def set_watermark(self, value: str) -> None:
        row = one_row(self.spark, WATERMARK, {"pipeline_name": self.pipeline, "watermark": value, "updated_at": now()})
        self.marks.commit(upsert(self.marks.read_or_empty(WATERMARK), row, ["pipeline_name"]).coalesce(1))


def gate_on(previous: str | None, stage: str) -> bool:
    """Whether a stage runs, from the status of the one before: yes after success, no after a skip; else it is an error."""
    if previous == SUCCESS:
        return True
    if previous == SKIPPED:
        return False
    raise RuntimeError(f"{stage} cannot run: the stage before it is {previous or 'missing'}")


class Timer:
    def __enter__(self) -> Timer:
        self.began, self.started_at = time.perf_counter(), now()
        return self

    def __exit__(self, *error: object) -> None:
        self.seconds, self.completed_at = time.perf_counter() - self.began, now()


def environment(spark: SparkSession) -> str:
    """Where the session runs: local, or the kind of its cluster manager."""
    master = spark.sparkContext.master
    return "local" if master.startswith("local") else master.partition("://")[0].partition("[")[0]


def job_facts(spark: SparkSession) -> dict[str, str]:
    """Names that a run is known by."""
    return {"environment": environment(spark), "job_name": spark.sparkContext.appName, "cluster_name": spark.sparkContext.master, "execution_engine": f"spark {spark.version}", "hostname": socket.gethostname(), "user_name": getpass.getuser(), "framework_version": VERSION}


class Audit:
    def __init__(self, store: Store, pipeline: str, run_id: str, execution_id: str, kind: str = "incremental_batch"):
        self.spark, self.table = store.spark, store.log("audit", AUDIT)
        self.common = {"run_id": run_id, "execution_id": execution_id, "batch_id": new_id(), "pipeline_name": pipeline, "pipeline_type": kind}

    def record(self, stage: str, status: str, started_at: datetime, seconds: float, metadata: Mapping[str, object] | None = None, error: BaseException | None = None, **more: object) -> dict[str, object]:
        at = now()
        zero = dict.fromkeys(("retry_count", "rows_read", "rows_written", "rows_rejected", "rows_skipped", "files_processed"), 0)
        text = {f.name: "" for f in AUDIT if isinstance(f.dataType, T.StringType)}
        where = job_facts(self.spark) | {"schema_version": VERSION, "execution_mode": "batch", "trigger_type": "manual"}
        failed = {"error_type": type(error).__name__, "error_message": str(error)[:4000]} if error else {}
        return text | zero | where | self.common | {"stage": stage, "status": status, "started_at": started_at, "completed_at": at, "created_at": at, "duration_seconds": float(seconds), "metadata": json.dumps(dict(metadata or {}), sort_keys=True, default=str)} | failed | more

    def write(self, **values: object) -> None:
        self.table.append(one_row(self.spark, AUDIT, self.record(**values)))

    def of_run(self) -> DataFrame:
        return self.table.read().where(F.col("run_id") == F.lit(self.common["run_id"]))


def failures(audit: DataFrame) -> DataFrame:
    return audit.where(F.upper("status") != SUCCESS)


class SchemaHistory:
    def __init__(self, store: Store):
        self.spark, self.versions, self.changes = store.spark, store.log("schema_history", SCHEMA_HISTORY), store.log("schema_changes", SCHEMA_CHANGES)

    def latest(self, pipeline: str, stage: str) -> dict[str, object] | None:
        mine = self.versions.read().where((F.col("pipeline_name") == F.lit(pipeline)) & (F.col("stage") == F.lit(stage)))
        row = mine.agg(F.max_by(F.struct("version", "schema_hash", "schema_json"), "version").alias("v")).first()["v"]
        return row.asDict() if row else None

    def next_versions(self) -> DataFrame:
        """pipeline_name, stage, next_version of every history."""
        return self.versions.read().groupBy("pipeline_name", "stage").agg((F.max("version") + 1).alias("next_version"))

    def next_version(self, pipeline: str, stage: str) -> int:
        row = self.next_versions().where((F.col("pipeline_name") == F.lit(pipeline)) & (F.col("stage") == F.lit(stage))).first()
        return row["next_version"] if row else 1

    def save(self, df: DataFrame, pipeline: str, stage: str, action: str = "EVOLVED") -> list[Drift]:
        """Adds a version if the schema differs from the last, and records how."""
        types, known = types_of(df), self.latest(pipeline, stage)
        if known and known["schema_hash"] == schema_hash(types):
            return []
        found = compare(json.loads(known["schema_json"]), types) if known else []
        row = {"pipeline_name": pipeline, "stage": stage, "version": known["version"] + 1 if known else 1, "schema_hash": schema_hash(types), "schema_json": schema_json(types), "recorded_at": now()}
        self.versions.append(one_row(self.spark, SCHEMA_HISTORY, row))
        self.record(pipeline, stage, found, action)
        return found

    def record(self, pipeline: str, stage: str, changes: Iterable[Drift], action: str) -> None:
        rows = [(pipeline, stage, c.change_type, c.column_name, c.old_type, c.new_type, action, now()) for c in changes]
        if rows:
            self.changes.append(self.spark.createDataFrame(rows, SCHEMA_CHANGES))


class Quarantine:
    def __init__(self, store: Store, pipeline: str):
        self.pipeline, self.table = pipeline, store.log("quarantine", partition_by=["_snapshot_day", "stage"])

    def exists(self) -> bool:
        return self.table.exists()

    def add(self, rows: DataFrame, code: str, stage: str, batch_id: str | None = None) -> None:
        self.table.append(quarantined(rows, code, self.pipeline, batch_id, stage))

    def replace(self, rejected: DataFrame, rows: int, day: int, stage: str) -> None:
        """Makes rejected rows, `rows` of them, those of a day and stage; what an earlier attempt left goes."""
        self.table.replace_partition(rejected, rows, _snapshot_day=day, stage=stage)

    def read(self) -> DataFrame:
        return self.table.read()


def error_record(stage: str, error: BaseException, pipeline: str | None = None, run_id: str | None = None) -> dict[str, object]:
    """Logs an exception with its trace and returns what a ledger keeps of it."""
    log.error("%s failed in %s (run %s)", pipeline or "-", stage, run_id or "-", exc_info=error)
    return {"stage": stage, "pipeline_name": pipeline, "run_id": run_id, "error_type": type(error).__name__, "error_message": str(error), "stack_trace": "".join(traceback.format_exception(error)), "logged_at": now().isoformat()}


class Metrics(dict):
    """Named counters, and free values beside them; `rates` of rows against seconds where both are known."""

    def add(self, name: str, by: int = 1) -> None:
        self[name] = self.get(name, 0) + by

    def reset(self) -> None:
        self.clear()

    def time(self, seconds: float) -> None:
        self["execution_seconds"] = self.get("execution_seconds", 0.0) + seconds

    def rates(self) -> dict[str, float]:
        seconds = self.get("execution_seconds", 0.0)
        return {f"{k}_per_second": v / seconds for k, v in self.items() if seconds and "rows" in k}

    def summary(self) -> str:
        return ", ".join(f"{k}={v}" for k, v in sorted(self.items()))
