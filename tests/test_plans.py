"""Plans that must not get worse: pushed filters, pruned columns, exchanges and group limits."""

from __future__ import annotations

import re

from snapstate.operators import changes, quality, segments
from snapstate.plans import catalogue
from snapstate.plans import views as V
from snapstate.schemas import TELEMETRY


def plan_of(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "5000")
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, tmp_path, name, rows=50):
    df = spark.range(rows).selectExpr("id AS reading_id", "'C' AS customer_id", "'M' AS machine_id", "'t' AS event_ts", "0D AS gps_lat", "0D AS gps_lon", "50D AS fuel_level", "1D AS payload_weight_t", "'NONE' AS fault_code")
    df.write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


def test_the_gate_reaches_the_scan_and_drops_duplicates_early(spark, tmp_path):
    plan = plan_of(quality.gate(stored(spark, tmp_path, "a"), TELEMETRY).clean)
    for pushed in ("IsNotNull(reading_id)", "GreaterThanOrEqual(fuel_level,0.0)", "LessThanOrEqual(payload_weight_t,60.0)"):
        assert pushed in plan
    assert plan.count("WindowGroupLimit") == 2 and len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_invalid_rows_do_not_shuffle(spark, tmp_path):
    assert "Exchange" not in plan_of(quality.gate(stored(spark, tmp_path, "a"), TELEMETRY).invalid)


def test_gate_and_merge_share_one_exchange_a_side(spark, tmp_path):
    current = quality.gate(stored(spark, tmp_path, "a"), TELEMETRY).clean
    plan = plan_of(changes.apply_snapshot(current, stored(spark, tmp_path, "b"), TELEMETRY))
    assert "FullOuter" in plan and len(re.findall(r"Exchange hashpartitioning", plan)) == 2


def test_a_segmented_merge_shuffles_each_side_once(spark, tmp_path):
    rules, each = segments.segmented(TELEMETRY), 10
    rows = segments.clustered(stored(spark, tmp_path, "a"), TELEMETRY, each, gated=False)
    prior = segments.clustered(stored(spark, tmp_path, "b"), TELEMETRY, each, gated=True)
    with segments.joins_on_subset(spark):
        plan = plan_of(changes.apply_snapshot(quality.verdicts(rows, rules).where("_dq is null").drop("_dq"), prior, rules))
    assert "FullOuter" in plan and len(re.findall(r"Exchange hashpartitioning", plan)) == 2 and "Exchange SinglePartition" not in plan


def test_classification_reads_only_key_and_tracked_columns(spark, tmp_path):
    plan = plan_of(changes.classify(stored(spark, tmp_path, "a"), stored(spark, tmp_path, "b"), TELEMETRY))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert "reading_id:bigint,fuel_level:double,payload_weight_t:double,fault_code:string" in schemas


def test_top_k_and_kpis(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan_of(catalogue.queries()["q20_top10_faulty_machines"](spark, sf_dir))
    kpi = plan_of(catalogue.queries()["q18_gold_machine_kpi"](spark, sf_dir))
    assert "partial_avg" in kpi and not re.search("Python|Pandas|Arrow|BroadcastNestedLoop|Cartesian", kpi)


def test_no_query_joins_without_keys_or_in_python(spark, sf_dir):
    for name, query in catalogue.queries().items():
        assert not re.search("Python|Pandas|MapInArrow|BroadcastNestedLoop|Cartesian", plan_of(query(spark, sf_dir))), name


def test_views_prune_columns(spark, sf_dir):
    plan = plan_of(V.telemetry(spark, sf_dir).select("reading_id"))
    assert "ReadSchema: struct<event_id:bigint>" in plan
