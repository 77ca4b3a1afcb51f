"""The gate, the classifier and the merge on hand-written rows, and invariants over generated snapshots."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from snapstate.functions.predicates import reduction_pct
from snapstate.operators import changes, quality, reconcile
from snapstate.schemas import TELEMETRY, RuleSet
from snapstate.sources.snapshots import Shape, next_reading, roster, snapshot

COLUMNS = {"reading_id": "bigint", "customer_id": "string", "machine_id": "string", "fuel_level": "double", "payload_weight_t": "double", "fault_code": "string"}
RULES = RuleSet(COLUMNS, TELEMETRY.key, TELEMETRY.required, TELEMETRY.ranges, TELEMETRY.tracked, TELEMETRY.group, TELEMETRY.fault)
DDL = ", ".join(f"{n} {t}" for n, t in COLUMNS.items())


def frame(spark, *rows):
    return spark.createDataFrame([(r + ("C1", "M1", 50.0, 10.0, "NONE")[len(r) - 1 :]) for r in rows], DDL)


def ids(df):
    return sorted(r["reading_id"] for r in df.collect())


@pytest.mark.parametrize(
    "row",
    [
        (1, "C1", "M1", 150.0), (1, "C1", "M1", -0.1), (1, "C1", "M1", None), (1, "C1", "M1", float("nan")), (1, None), (1, "C1", None), (None,),
        (1, "C1", "M1", 50.0, 60.5), (1, "C1", "M1", 50.0, None),
    ],
)
def test_gate_drops_invalid(spark, row):
    out = quality.gate(frame(spark, row, (2,)), RULES)
    assert ids(out.clean) == [2] and out.invalid.count() == 1 and out.duplicates.isEmpty()


@pytest.mark.parametrize("fuel,payload", [(0.0, 0.0), (100.0, 60.0)])
def test_gate_keeps_bounds(spark, fuel, payload):
    assert ids(quality.gate(frame(spark, (1, "C1", "M1", fuel, payload)), RULES).clean) == [1]


def test_gate_keeps_one_of_a_key_by_total_order(spark):
    df = frame(spark, (1, "C1", "M1", 50.0), (1, "C1", "M1", 55.0), (1, "C1", "M1", 999.0))
    for order in (df, df.orderBy(F.desc("fuel_level"))):
        out = quality.gate(order, RULES)
        assert [r["fuel_level"] for r in out.clean.collect()] == [55.0]
        assert [r["fuel_level"] for r in out.duplicates.collect()] == [50.0]
        assert out.invalid.count() == 1


def test_gate_prefers_later_files(spark):
    df = frame(spark, (1, "C1", "M1", 80.0)).withColumn("_file_order", F.lit(0)).unionByName(frame(spark, (1, "C1", "M1", 20.0)).withColumn("_file_order", F.lit(1)))
    assert quality.gate(df, RULES).clean.first()["fuel_level"] == 20.0


def test_gate_of_nothing(spark):
    out = quality.gate(frame(spark, (1,)).where("false"), RULES)
    assert out.clean.isEmpty() and out.invalid.isEmpty() and out.duplicates.isEmpty()


def kinds(current, prior):
    return {r["reading_id"]: r["_change_type"] for r in changes.classify(current, prior, RULES).collect()}


def test_first_run_is_new(spark):
    assert kinds(frame(spark, (1,)), None) == {1: "NEW"}


def test_classes(spark):
    prior = frame(spark, (1,), (2, "C1", "M1", 60.0), (4,), (5, "C1", "M1", 50.0, 10.0, None), (6, "C1", "M1", 50.0, 10.0, None), (9,))
    now = frame(spark, (1, "other", "other"), (2, "C1", "M1", 45.0), (3,), (4, "C1", "M1", 50.0, 10.0, "F101_LOW_FUEL"), (5, "C1", "M1", 50.0, 10.0, None), (6,))
    assert kinds(now, prior) == {1: "UNCHANGED", 2: "CHANGED", 3: "NEW", 4: "CHANGED", 5: "UNCHANGED", 6: "CHANGED"}


def test_merge_updates_inserts_retains_and_overwrites_with_null(spark):
    prior = frame(spark, (1,), (2,), (7, "C1", "M1", 50.0, 10.0, "F101_LOW_FUEL"))
    now = frame(spark, (1, "C1", "M1", 45.0), (3, "C1", "M1", 80.0), (7, "C1", "M1", 50.0, 10.0, None))
    for out in (changes.apply_snapshot(now, prior, RULES), changes.upsert(prior, changes.to_merge(changes.classify(now, prior, RULES)), RULES.key)):
        rows = {r["reading_id"]: (r["fuel_level"], r["fault_code"]) for r in out.collect()}
        assert rows == {1: (45.0, "NONE"), 2: (50.0, "NONE"), 3: (80.0, "NONE"), 7: (50.0, None)}


def test_merge_of_nothing_and_into_nothing(spark):
    prior = frame(spark, (1,))
    assert changes.apply_snapshot(prior.where("false"), prior, RULES).collect() == prior.collect()
    assert changes.apply_snapshot(prior, None, RULES).collect() == prior.collect()


def test_merge_keeps_columns_of_either_side(spark):
    out = changes.apply_snapshot(frame(spark, (2,)).withColumn("site", F.lit("x")), frame(spark, (1,)), RULES)
    assert {r["reading_id"]: r["site"] for r in out.collect()} == {1: None, 2: "x"}


def test_update_only_touches_its_key(spark):
    prior = spark.createDataFrame([("r", "bronze", "STARTED"), ("r", "silver", "STARTED")], "run string, stage string, status string")
    out = changes.update_only(prior, spark.createDataFrame([("r", "silver", "SUCCESS"), ("z", "gold", "SUCCESS")], prior.schema), ["run", "stage"], ["status"])
    assert sorted(map(tuple, out.collect())) == [("r", "bronze", "STARTED"), ("r", "silver", "SUCCESS")]


def test_ambiguous_keys_are_refused(spark):
    with pytest.raises(ValueError):
        changes.require_unique(frame(spark, (1,), (1,)), RULES.key)
    changes.require_unique(frame(spark, (1,), (2,)), RULES.key)


@pytest.mark.parametrize("processed,total,pct", [(400, 1000, 60.0), (1000, 1000, 0.0), (0, 10, 100.0), (0, 0, None)])
def test_reduction(spark, processed, total, pct):
    assert reconcile.reduction(processed, total) == pct
    assert spark.range(1).select(reduction_pct(F.lit(processed), F.lit(total)).alias("p")).first()["p"] == pct


def test_conservation():
    reconcile.conserve("x", 3, 2, 1)
    with pytest.raises(reconcile.ConservationError):
        reconcile.conserve("x", 3, 2)


def test_invariants_over_generated_days(spark):
    shape = Shape(customers=3, machines_low=3, machines_high=5, rows=600)
    prior = None
    for day in range(3):
        snap = snapshot(spark, day, shape)
        gated = quality.gate(snap, TELEMETRY)
        assert gated.clean.count() + gated.invalid.count() + gated.duplicates.count() == snap.count()
        counts = {r["_change_type"]: r["n"] for r in changes.class_counts(changes.classify(gated.clean, prior, TELEMETRY)).collect()}
        before = 0 if prior is None else prior.count()
        state = changes.apply_snapshot(gated.clean, prior, TELEMETRY).cache()
        assert state.count() == before + counts.get("NEW", 0)
        assert sum(counts.values()) == gated.clean.count()
        changes.require_unique(state, TELEMETRY.key)
        assert changes.apply_snapshot(gated.clean, state, TELEMETRY).exceptAll(state).isEmpty()
        if day:
            assert 0 < counts["CHANGED"] < counts["UNCHANGED"] and counts["NEW"] == 18
        prior = state
    assert next_reading(snap) == 600 + 2 * 18 + 1
    machines = roster(spark, shape).collect()
    assert [m["slot"] for m in sorted(machines, key=lambda m: m["slot"])] == list(range(len(machines))) and 9 <= len(machines) <= 15
