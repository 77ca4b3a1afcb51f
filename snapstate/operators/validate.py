"""The validation battery: each check is a row (check_name, passed, detail); a run passes if all do."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import AUDIT, CONTROL, DQ_REQUIRED, RECONCILIATION, SCHEMA_HISTORY, SUCCESS
from ..sources.store import Store
from .ledger import RUN_KEY, failures, latest


@dataclass
class Report:
    checks: list[dict[str, object]] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=dict)

    def check(self, name: str, passed: bool, detail: object = "") -> bool:
        self.checks.append({"check_name": name, "passed": bool(passed), "detail": str(detail)})
        return bool(passed)

    @property
    def passed(self) -> bool:
        return all(c["passed"] for c in self.checks)

    def as_json(self) -> str:
        errors = [c["check_name"] for c in self.checks if not c["passed"]]
        return json.dumps({"status": "PASS" if self.passed else "FAIL", "errors": errors} | asdict(self), indent=2)


def check_rows(checks: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per check over frames: name -> (frame, SQL condition over aggregates that must hold)."""
    parts = [df.agg(F.expr(condition).alias("passed")).select(F.lit(name).alias("check_name"), F.coalesce("passed", F.lit(False)).alias("passed")) for name, (df, condition) in checks.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def validate(store: Store, run_id: str, day: int, source_file: str) -> Report:
    """Checks one day of one run; quarantine is compared with this file's drops only, and reconciliation is looked up by run and day."""
    report = Report()
    bronze, quarantine = store.log("bronze"), store.log("quarantine")
    silver, gold = store.state("silver"), store.state("gold")
    recon, control = store.log("reconciliation", RECONCILIATION), store.log("control", CONTROL)
    audit, history = store.log("audit", AUDIT), store.log("schema_history", SCHEMA_HISTORY)
    there = {n: report.check(f"{n} exists", t.exists()) for n, t in (("bronze", bronze), ("silver", silver), ("gold", gold), ("reconciliation", recon), ("control", control), ("audit", audit), ("schema_history", history))}
    for name, table in (("bronze", bronze), ("silver", silver), ("gold", gold)):
        if there[name]:
            report.counts[name] = table.read().count()
    if there["control"]:
        row = latest(control.read().where((F.col("run_id") == F.lit(run_id)) & (F.col("stage") == "gold") & (F.col("source_file") == F.lit(source_file))), RUN_KEY).first()
        report.check("gold succeeded for this file", row is not None and row["status"] == SUCCESS, row and row["status"])
        if row is not None:
            report.check("rows written do not exceed rows read", (row["rows_written"] or 0) <= (row["rows_read"] or 0), f"{row['rows_written']} of {row['rows_read']}")
    dropped = None
    if there["reconciliation"]:
        row = recon.read().where((F.col("run_id") == F.lit(run_id)) & (F.col("snapshot_day") == day)).first()
        if report.check("reconciliation row exists", row is not None):
            report.counts |= {k: row[k] for k in ("new_rows", "changed_rows", "unchanged_rows_skipped", "total_rows_in_snapshot")}
            report.check("row conservation", row["row_conservation_passed"])
            dropped = row["dq_dropped_rows"]
    if there["audit"]:
        mine = audit.read().where(F.col("run_id") == F.lit(run_id))
        report.check("audit rows exist", not mine.isEmpty())
        report.check("no audit failures", failures(mine).isEmpty())
    if there["schema_history"]:
        report.counts["schema_versions"] = history.read().count()
        report.check("schema versions exist", report.counts["schema_versions"] > 0)
    if dropped is not None:
        rejected = quarantine.read().where((F.col("_snapshot_day") == day) & (F.col("error_code") != DQ_REQUIRED) & (F.col("batch_id") == F.lit(run_id))).count() if quarantine.exists() else 0
        report.check("quarantine matches drops", rejected == dropped, f"{rejected} and {dropped}")
    if there["bronze"] and there["silver"]:
        report.check("silver does not exceed bronze", report.counts["silver"] <= report.counts["bronze"])
        report.check("silver has rows", report.counts["silver"] > 0)
    if there["gold"]:
        report.check("gold has rows", report.counts["gold"] > 0)
    return report
