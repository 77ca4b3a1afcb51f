"""Reconciliation: what happened to each row of a snapshot, and that none was lost."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import reduction_pct


class ConservationError(ValueError):
    """Rows went missing between two steps."""


def conserve(step: str, before: int, *after: int) -> None:
    if before != sum(after):
        raise ConservationError(f"{step}: {before} rows went in, {' + '.join(map(str, after))} came out")


def with_rates(counts: DataFrame) -> DataFrame:
    """Adds volumes and percentages to rows with landing_rows, total_rows_in_snapshot, new_rows, changed_rows, unchanged_rows_skipped, dq_* and had_prior."""
    processed = F.col("new_rows") + F.col("changed_rows")
    clean = processed + F.col("unchanged_rows_skipped")
    return counts.withColumns({
        "incremental_volume_processed": processed,
        "reprocessing_reduction_pct": F.when(F.col("had_prior"), reduction_pct(processed, F.col("total_rows_in_snapshot"))),
        "unchanged_pct": F.when(F.col("had_prior"), reduction_pct(processed, clean)),
        "row_conservation_passed": F.col("total_rows_in_snapshot") == clean + F.col("dq_dropped_rows"),
    })


def reduction(processed: int, total: int) -> float | None:
    return None if total <= 0 else round((1 - processed / total) * 100, 2)


def summary(recon: DataFrame) -> DataFrame:
    """Mean, least and greatest reduction over the days that had a prior state, and the largest snapshot."""
    pct = F.col("reprocessing_reduction_pct")
    return recon.agg(F.round(F.avg(pct), 6).alias("mean_reduction_pct"), F.min(pct).alias("min_reduction_pct"), F.max(pct).alias("max_reduction_pct"), F.max("total_rows_in_snapshot").alias("peak_snapshot_rows"))


def row_of(run_id: str, day: int, had_prior: bool, landing: int, total: int, gate: Mapping[str, int], classes: Mapping[str, int], gold_rows: int | None = None) -> dict[str, object]:
    """A reconciliation row from counts gathered while writing."""
    processed = classes["new"] + classes["changed"]
    clean = processed + classes["unchanged"]
    dropped = gate["invalid"] + gate["duplicates"]
    return {
        "run_id": run_id, "snapshot_day": day, "landing_rows": landing, "total_rows_in_snapshot": total, "new_rows": classes["new"], "changed_rows": classes["changed"],
        "unchanged_rows_skipped": classes["unchanged"], "incremental_volume_processed": processed, "reprocessing_reduction_pct": reduction(processed, total) if had_prior else None,
        "unchanged_pct": reduction(processed, clean) if had_prior else None, "dq_dropped_rows": dropped, "dq_invalid_rows": gate["invalid"], "dq_duplicate_rows": gate["duplicates"],
        "merged_state_row_count": classes["merged"], "gold_rows": gold_rows, "row_conservation_passed": total == clean + dropped,
    }
