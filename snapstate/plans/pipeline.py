"""The daily run: bronze, silver, gold and validation for each pending snapshot, day by day, in one session.

Each stage reads its input once and writes once; row counts come from observations on those writes. Re-running is
safe after a failure at any point: bronze, quarantine and reconciliation replace the day's partition, and the state's
new version is shown last, with the day's source and counts in its marker. A rerun that finds its source there does not
merge again, but writes the ledgers from the counts that the marker has. Files that already succeeded are skipped.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import FOLDERS, Settings
from ..functions.layout import range_layout
from ..functions.predicates import required_missing
from ..operators import changes, kpi, segments
from ..operators.ingest import conform, name_drift, stamped
from ..operators.ledger import Audit, Control, Metrics, Quarantine, SchemaHistory, Timer, error_record, gate_on, now, one_row
from ..operators.quality import quarantined, verdicts
from ..functions.preview import preview
from ..operators.reconcile import conserve, row_of
from ..operators.validate import Report, validate
from ..schemas import DQ_DUPLICATE, DQ_INVALID, DQ_REQUIRED, RECONCILIATION, SUCCESS, TELEMETRY, RuleSet
from ..sources.landing import read_landing, snapshot_days
from ..sources.snapshots import Shape, clean_days, write_days, write_next_day
from ..sources.store import Folder, Store

log = logging.getLogger("snapstate")
STAGES = ("bronze", "silver", "gold", "validation")


@dataclass
class DayResult:
    day: int
    status: dict[str, str] = field(default_factory=dict)
    recon: dict[str, object] = field(default_factory=dict)
    report: Report | None = None


class Pipeline:
    def __init__(self, spark: SparkSession, settings: Settings, rules: RuleSet = TELEMETRY, run_id: str | None = None):
        self.spark, self.settings, self.rules = spark, settings, rules
        self.store = Store(spark, settings.base_path, settings.database)
        self.store.bootstrap(FOLDERS)
        self.control = Control(self.store, settings.pipeline, settings.kind, run_id)
        self.audit = Audit(self.store, settings.pipeline, self.control.run_id, self.control.execution_id, settings.kind)
        self.history, self.quarantine = SchemaHistory(self.store), Quarantine(self.store, settings.pipeline)
        self.bronze = self.store.log("bronze", partition_by=["_snapshot_day"])
        self.silver, self.gold = self.store.state("silver"), self.store.state("gold")
        self.recon = self.store.log("reconciliation", RECONCILIATION, ["snapshot_day"])
        self.metrics = Metrics()

    def _stage(self, stage: str, source: str, day: int, body: Callable[[], dict[str, int]]) -> str:
        self.control.start(stage, source, snapshot_date=str(day))
        timer = Timer()
        try:
            with timer:
                counts = body()
        except Exception as error:
            self.audit.write(stage=stage, status="FAILED", started_at=timer.started_at, seconds=timer.seconds, error=error, source_file=source, snapshot_day=day)
            self.control.fail(stage, source, error)
            error_record(stage, error, self.settings.pipeline, self.control.run_id)
            raise
        known = {k: counts.get(k, 0) for k in ("rows_read", "rows_written", "rows_rejected", "rows_skipped")}
        for name, n in known.items():
            self.metrics.add(f"{stage}_{name}", n)
        self.audit.write(stage=stage, status=SUCCESS, started_at=timer.started_at, seconds=timer.seconds, metadata=counts, source_file=source, snapshot_day=day, files_processed=1, **known)
        self.control.finish(stage, source, known["rows_read"], known["rows_written"], known["rows_skipped"])
        write_report(self.spark, self.settings.path("reports"), f"{stage}_status", {"stage": stage, "status": SUCCESS, "source_file": source, "rows": known["rows_written"]})
        return SUCCESS

    def run_bronze(self, raw: DataFrame, source: str, day: int) -> dict[str, int]:
        """Good rows replace the day's partition, the others go to quarantine; both hang off one observed scan each."""
        rules = self.rules
        drift = name_drift(raw, rules)
        self.history.record(self.settings.pipeline, "landing", drift, "DETECTED")
        typed = stamped(conform(raw, rules), source, day)
        self.history.save(typed, self.settings.pipeline, "bronze")
        missing = required_missing(rules)
        seen, kept = Observation(), Observation()
        rows = typed.observe(seen, F.count("*").alias("n"), F.count_if(missing).alias("missing"))
        self.bronze.replace_partitions(rows.where(~missing).observe(kept, F.count("*").alias("n")))
        total, bad = seen.get["n"], seen.get["missing"]
        if kept.get["n"] == 0:  # a dynamic overwrite of nothing leaves the day's old partition
            self.bronze.folder.delete(f"_snapshot_day={day}")
        conserve("bronze", total, kept.get["n"], bad)
        rejected = quarantined(typed.where(missing), DQ_REQUIRED, self.settings.pipeline, self.control.run_id, "bronze")
        self.quarantine.replace(rejected, bad, day, "bronze")
        self.store.register("bronze")
        return {"rows_read": total, "rows_written": kept.get["n"], "rows_rejected": bad}

    def run_silver(self, source: str, day: int) -> dict[str, int]:
        """Gate, classify and merge the day's rows; appends the reconciliation row, also where nothing changed."""
        rules = self.rules
        rows = self.bronze.read().where(F.col("_snapshot_day") == day) if self.bronze.exists() else None
        if rows is None:
            raise FileNotFoundError("bronze has no rows")
        note = self.silver.note()
        done_before = note.get("source") == source
        if done_before:  # the version was shown, but the stage did not finish
            gate, found, had_prior = note["gate"], note["found"], note["had_prior"]
        else:
            had_prior = self.silver.exists()
            version, gate, found = self._merged(rows, had_prior, note)
        conserve("silver", gate["n"], found["new"] + found["changed"] + found["unchanged"], gate["invalid"], gate["duplicates"])
        bad = quarantined(verdicts(rows, rules).where("_dq is not null"), F.col("_dq"), self.settings.pipeline, self.control.run_id, "silver_dq_gate").drop("_dq")
        self.quarantine.replace(bad, gate["invalid"] + gate["duplicates"], day, "silver_dq_gate")
        self.last_recon = row_of(self.control.run_id, day, had_prior, gate["n"], gate["n"], gate, found)
        self.recon.replace_partition(one_row(self.spark, RECONCILIATION, self.last_recon | {"run_ts": now()}), 1, snapshot_day=day)
        if not done_before:
            self.silver.publish(version, {"source": source, "day": day, "gate": gate, "found": found, "had_prior": had_prior})
        self.store.register("silver")
        return {"rows_read": gate["n"], "rows_written": found["new"] + found["changed"], "rows_rejected": gate["invalid"] + gate["duplicates"], "rows_skipped": found["unchanged"], "merged": found["merged"]}

    def _merged(self, rows: DataFrame, had_prior: bool, note: dict[str, object]) -> tuple[int, dict[str, int], dict[str, int]]:
        """Stages the next state; returns its version, the gate's counts and the classes' counts."""
        rules, each, kept = self.rules, self.settings.segment_rows, {}
        prior = self.silver.read() if had_prior else None
        seen, classes = Observation(), Observation()

        def clean(rows: DataFrame, rules: RuleSet) -> DataFrame:
            judged = verdicts(rows, rules).observe(seen, F.count("*").alias("n"), F.count_if(F.col("_dq") == DQ_INVALID).alias("invalid"), F.count_if(F.col("_dq") == DQ_DUPLICATE).alias("duplicates"))
            return judged.where("_dq is null").drop("_dq")

        if segments.segment_of(rules, each) is None:
            version = self.silver.stage(changes.apply_snapshot(clean(rows, rules), prior, rules, classes))
            return version, seen.get, classes.get
        known = self.silver.segments(each) if had_prior else None
        if known is not None:
            here = segments.touched(rows, rules, each)
            kept = {s: v for s, v in known.items() if s not in here}
            prior = self.silver.read(segments=here)
        current = clean(segments.clustered(rows, rules, each, gated=False), segments.segmented(rules))
        old = None if prior is None else segments.clustered(prior, rules, each, gated=True)
        with segments.joins_on_subset(self.spark):
            merged = changes.apply_snapshot(current, old, segments.segmented(rules), classes).drop(segments.PART)
            version = self.silver.stage_segments(merged, each, kept)
        found = dict(classes.get)
        if kept:
            before = note.get("found", {}).get("merged")
            before = self.silver.read().count() if before is None else before
            aside = before - found["changed"] - found["unchanged"] - found["retained"]
            found |= {"retained": found["retained"] + aside, "merged": found["merged"] + aside}
        return version, seen.get, found

    def run_gold(self) -> dict[str, int]:
        """KPIs replace the table, laid out by machine; an empty state is refused."""
        state = self.silver.read()
        kpi.require_rows(state, "silver")
        seen, made = Observation(), Observation()
        out = kpi.machine_kpi(state.observe(seen, F.count("*").alias("n")), self.rules)
        self.gold.commit(range_layout(out, self.rules.group).observe(made, F.count("*").alias("n")))
        self.store.register("gold")
        return {"rows_read": max(seen.get["n"], made.get["n"]), "rows_written": made.get["n"]}

    def run_day(self, day: int, path: str, start: str = "bronze", only: str | None = None) -> DayResult:
        source = path.rstrip("/").rsplit("/", 1)[-1]
        result = DayResult(day)
        wanted = [only] if only else list(STAGES[STAGES.index(start) :])
        before = None
        for stage in wanted:
            if stage != "validation" and self.control.already_processed(stage, source):
                self.control.skip(stage, source)
                result.status[stage], before = "SKIPPED", stage
                continue
            at = STAGES.index(stage)
            if at and result.status.get(STAGES[at - 1]) != "SKIPPED":
                gate_on(self.control.last_status(STAGES[at - 1], source), stage)
            if stage == "bronze":
                raw = read_landing(self.spark, path, self.settings.source_options, self.settings.source_format)
                result.status[stage] = self._stage(stage, source, day, lambda raw=raw: self.run_bronze(raw, source, day))
            elif stage == "silver":
                result.status[stage] = self._stage(stage, source, day, lambda: self.run_silver(source, day))
                result.recon = self.last_recon
            elif stage == "gold":
                result.status[stage] = self._stage(stage, source, day, self.run_gold)
            elif before != "gold" or result.status.get("gold") != "SKIPPED":
                result.report = validate(self.store, self.control.run_id, day, source)
                result.status[stage] = SUCCESS if result.report.passed else "FAILED"
                write_report(self.spark, self.settings.path("reports"), "validation_report", json.loads(result.report.as_json()) | {"run_id": self.control.run_id, "snapshot_day": day})
            before = stage
        if result.status.get("gold") == SUCCESS:
            self.control.set_watermark(str(day))
        return result

    def run_pending(self, start: str = "bronze", only: str | None = None) -> list[DayResult]:
        """Every snapshot in numeric order of days, each through all stages before the next."""
        out = []
        for day, path in snapshot_days(self.spark, self.settings.path("landing")).items():
            try:
                out.append(self.run_day(day, path, start, only))
            except Exception:
                if self.settings.stop_on_failure:
                    raise
                log.exception("day %s failed", day)
                out.append(DayResult(day, {"run": "FAILED"}))
        return out


def write_report(spark: SparkSession, path: str, name: str, data: object) -> str:
    """Writes data as JSON through the store's file system."""
    folder = Folder(spark, path)
    folder.make()
    folder.write_text(f"{name}.json", json.dumps(data, indent=2, default=str))
    return f"{folder.path}/{name}.json"


def main(argv: list[str] | None = None) -> int:
    """Runs the pending days; exit code 0 only if every stage succeeded or was skipped and validation passed."""
    ap = argparse.ArgumentParser(description=main.__doc__)
    ap.add_argument("base_path")
    ap.add_argument("--config")
    ap.add_argument("--generate", type=int, metavar="DAYS", help="write this many snapshot days first, in place of those there")
    ap.add_argument("--day", type=int, metavar="N", help="write the snapshot of one day first, from the one before it")
    ap.add_argument("--rows", type=int, default=20_000, help="rows of a generated snapshot")
    ap.add_argument("--from", dest="start", choices=STAGES, default="bronze")
    ap.add_argument("--only", choices=("generate", *STAGES))
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("snapstate").getOrCreate()
    settings = Settings.load(a.config, a.base_path) if a.config else Settings(a.base_path)
    if a.generate:
        clean_days(spark, settings.path("landing"))
        write_days(spark, settings.path("landing"), range(a.generate), Shape(rows=a.rows))
    if a.day is not None:
        write_next_day(spark, settings.path("landing"), a.day, Shape(rows=a.rows))
    if a.only == "generate":
        return 0
    pipeline = Pipeline(spark, settings)
    results = pipeline.run_pending(a.start, a.only)
    write_report(spark, settings.path("reports"), "pipeline_execution_report", {"days": [{"day": r.day, "status": r.status, "reconciliation": r.recon} for r in results], "metrics": pipeline.metrics})
    if pipeline.gold.exists():
        log.info("machines with most faults\n%s", preview(kpi.top(pipeline.gold.read(), "fault_events", 10, list(pipeline.rules.group))))
    log.info(pipeline.metrics.summary())
    return int(any("FAILED" in r.status.values() for r in results))


if __name__ == "__main__":
    sys.exit(main())
