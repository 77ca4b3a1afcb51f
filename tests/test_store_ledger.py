"""Versioned and append tables, ledgers, schema history, and the daily run with its regressions."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from snapstate.config import Settings
from snapstate.functions import schema as S
from snapstate.functions.layout import z_order
from snapstate.operators.ingest import conform, name_drift, split_required, uncastable
from snapstate.operators.ledger import Control, Metrics, SchemaHistory, gate_on, latest
from snapstate.plans.pipeline import Pipeline, write_report
from snapstate.schemas import CONTROL, TELEMETRY
from snapstate.sources.landing import day_of, read_landing, snapshot_days
from snapstate.sources.store import AppendTable, StateTable, Store
from snapstate.streaming.files import run_available

HEAD = "reading_id,customer_id,machine_id,event_ts,gps_lat,gps_lon,fuel_level,payload_weight_t,fault_code"


def land(base, day, *rows, head=HEAD):
    (base / "landing").mkdir(exist_ok=True)
    (base / "landing" / f"snapshot_day{day}.csv").write_text("\n".join([head, *rows]) + "\n")


def row(i, fuel=50, payload=10, fault="NONE", customer="C1"):
    return f"{i},{customer},M1,2026-06-14T08:32:00,-20.0,120.0,{fuel},{payload},{fault}"


def test_state_versions(spark, tmp_path):
    t = StateTable(spark, str(tmp_path / "s"))
    assert not t.exists()
    with pytest.raises(FileNotFoundError):
        t.read()
    t.commit(spark.range(1))
    t.commit(t.read().union(spark.range(5, 6)))  # reads the version it replaces
    t.commit(t.read().union(spark.range(9, 10)))
    assert t.versions() == [1, 2] and t.read().count() == 3 and t.read(1).count() == 2
    (tmp_path / "s" / "v=3").mkdir()  # a write that never finished
    assert t.read().count() == 3
    t.commit(spark.range(7))
    assert t.read().count() == 7 and t.rollback() == 2 and t.read().count() == 3


def test_append_evolution_partition_replacement_and_not_null(spark, tmp_path):
    t = AppendTable(spark, str(tmp_path / "a"), ["day"])
    for extra in (spark.range(2).withColumn("day", F.lit(0)), spark.range(2).withColumn("day", F.lit(0)), spark.range(3).withColumn("site", F.lit("x")).withColumn("day", F.lit(1))):
        t.replace_partitions(extra)
    assert t.read().count() == 5 and {"id", "site", "day"} == set(t.read().columns)
    strict = AppendTable(spark, str(tmp_path / "c"), schema=CONTROL)
    assert strict.read().isEmpty()
    with pytest.raises(Exception, match="must not be null"):
        strict.append(spark.createDataFrame([tuple([None] * len(CONTROL))], "struct<" + ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in CONTROL) + ">"))


def test_landing_binds_by_name_and_try_casts(spark, tmp_path):
    land(tmp_path, 2, "C9,x7,M1,bad,0,0,zz,1,NONE,depot", "C9,8,M1,2026-010-18,0,0,5,1,NONE,depot", head="customer_id,reading_id,machine_id,event_ts,gps_lat,gps_lon,fuel_level,payload_weight_t,fault_code,site")
    land(tmp_path, 10, row(1))
    files = snapshot_days(spark, str(tmp_path / "landing"))
    assert list(files) == [2, 10] and day_of(files[10]) == 10
    raw = read_landing(spark, files[2], {"header": True, "inferSchema": True})
    typed = conform(raw, TELEMETRY)
    assert typed.dtypes[: len(TELEMETRY.columns)] == list(TELEMETRY.columns.items()) and typed.columns[-1] == "site"
    split = split_required(typed, TELEMETRY)
    assert [r["reading_id"] for r in split.kept.collect()] == [8] and split.rejected.count() == 1
    assert split.kept.first()["event_ts"] == "2026-010-18"
    assert [(d.change_type, d.column_name) for d in name_drift(raw.drop("gps_lat"), TELEMETRY)] == [("COLUMN_REMOVED", "gps_lat"), ("COLUMN_ADDED", "site")]
    assert {r["column_name"]: r["uncastable"] for r in uncastable(raw, TELEMETRY).collect()}["fuel_level"] == 1


def test_schema_identity_drift_and_validation(spark):
    a, b = {"x": "int", "y": "string"}, {"y": "string", "x": "int"}
    assert S.schema_hash(a) == S.schema_hash(b) and not S.has_changed(a, b)
    found = S.compare(a, {"x": "bigint", "z": "int"})
    assert [(d.change_type, d.column_name) for d in found] == [("TYPE_CHANGED", "x"), ("COLUMN_REMOVED", "y"), ("COLUMN_ADDED", "z")]
    assert "TYPE_CHANGED: x (int -> bigint)" in S.drift_report(found) and S.drift_report([]) == "no schema changes"
    df = spark.range(1)
    S.require_types(df, {"id": "bigint"})
    with pytest.raises(ValueError):
        S.require_columns(df, ["nope"])
    with pytest.raises(TypeError):
        S.require_types(df, {"id": "string"})
    assert S.has_column(df, "id")


def test_control_is_keyed_by_stage_and_file(spark, tmp_path):
    c = Control(Store(spark, str(tmp_path)), "it's \"quoted\"", run_id="r")
    c.start("bronze", "a.csv")
    c.start("silver", "a.csv")
    c.finish("bronze", "a.csv", 5, 4)
    c.start("bronze", "b.csv")
    c.fail("bronze", "b.csv", ValueError("no"))
    state = {(r["stage"], r["source_file"]): r["status"] for r in c.current().collect()}
    assert state == {("bronze", "a.csv"): "SUCCESS", ("silver", "a.csv"): "STARTED", ("bronze", "b.csv"): "FAILED"}
    assert c.last_status("bronze", "b.csv") == "FAILED" and c.last_status("gold", "a.csv") is None
    c.skip("bronze", "a.csv")
    assert c.already_processed("bronze", "a.csv") and not c.already_processed("bronze", "b.csv")
    files = spark.createDataFrame([("a.csv",), ("b.csv",), ("c.csv",)], "source_file string")
    assert sorted(r[0] for r in c.pending(files, "bronze").collect()) == ["b.csv", "c.csv"]
    assert c.watermark() is None
    c.set_watermark("1")
    c.set_watermark("2")
    assert c.watermark() == "2"
    assert gate_on("SUCCESS", "x") and not gate_on("SKIPPED", "x")
    for bad in ("FAILED", "STARTED", None):
        with pytest.raises(RuntimeError):
            gate_on(bad, "x")


def test_schema_history(spark, tmp_path):
    h = SchemaHistory(Store(spark, str(tmp_path)))
    df = spark.range(1)
    assert h.next_version("p", "s") == 1
    assert h.save(df, "p", "s") == [] and h.save(df, "p", "s") == []
    found = h.save(df.withColumn("extra", F.lit(1)), "p", "s")
    assert [d.column_name for d in found] == ["extra"] and h.next_version("p", "s") == 3
    assert [r["column_name"] for r in h.changes.read().collect()] == ["extra"]


def test_days_run_in_order_once_and_again(spark, tmp_path):
    land(tmp_path, 0, row(1), row(2), row(3, fuel=500), row(3), row("x"))
    land(tmp_path, 1, row(1), row(2, fuel=40), row(4), row(4, fuel=51), row(5, customer=""))
    settings = Settings(str(tmp_path))
    first = Pipeline(spark, settings)
    days = first.run_pending()
    assert [d.day for d in days] == [0, 1]
    for d in days:
        assert set(d.status.values()) == {"SUCCESS"}, [c for c in d.report.checks if not c["passed"]]
    assert (days[0].recon["new_rows"], days[0].recon["dq_invalid_rows"], days[0].recon["reprocessing_reduction_pct"]) == (3, 1, None)
    one = days[1].recon
    assert (one["new_rows"], one["changed_rows"], one["unchanged_rows_skipped"], one["dq_duplicate_rows"]) == (1, 1, 1, 1)
    assert one["row_conservation_passed"] and one["reprocessing_reduction_pct"] == 50.0
    assert sorted(r["error_code"] for r in first.quarantine.read().collect()) == ["DQ001", "DQ001", "DQ002", "DQ003"]
    assert sorted((r["reading_id"], r["fuel_level"]) for r in first.silver.read().collect()) == [(1, 50.0), (2, 40.0), (3, 50.0), (4, 51.0)]
    assert first.control.watermark() == "1"
    # a second run with one new day leaves the others as they were
    land(tmp_path, 2, row(1), row(2, fuel=40))
    again = Pipeline(spark, settings).run_pending()
    assert [set(d.status.values()) for d in again] == [{"SKIPPED"}, {"SKIPPED"}, {"SUCCESS"}]
    assert again[2].recon["incremental_volume_processed"] == 0 and again[2].recon["reprocessing_reduction_pct"] == 100.0
    assert Pipeline(spark, settings).recon.read().count() == 3
    assert first.gold.read().agg(F.sum("total_readings")).first()[0] == 4
    path = write_report(spark, settings.path("reports"), "x", {"a": 1})
    assert json.loads(open(path.removeprefix("file:")).read()) == {"a": 1}


def test_a_replayed_bronze_leaves_one_copy_and_failures_are_recorded(spark, tmp_path):
    land(tmp_path, 0, row(1), row(2))
    p = Pipeline(spark, Settings(str(tmp_path)))
    raw = read_landing(spark, str(tmp_path / "landing" / "snapshot_day0.csv"))
    for _ in range(2):
        p.run_bronze(raw, "snapshot_day0.csv", 0)
    assert p.bronze.read().count() == 2
    with pytest.raises(RuntimeError):
        p.run_day(0, str(tmp_path / "landing" / "snapshot_day0.csv"), start="gold")
    land(tmp_path, 1, row("x"))
    with pytest.raises(Exception):
        p.run_day(1, str(tmp_path / "landing" / "missing_day1.csv"))
    assert p.control.last_status("bronze", "missing_day1.csv") is None


class Crash(RuntimeError):
    pass


@pytest.mark.parametrize("where", ["quarantine", "recon", "publish", "after"])
def test_a_day_that_fails_between_its_writes_is_run_again_as_if_it_had_not(spark, tmp_path, monkeypatch, where):
    land(tmp_path, 0, row(1), row(2), row(3))
    land(tmp_path, 1, row(1), row(2, fuel=40), row(3, fuel=500), row(4), row(4, fuel=51), row("x"))
    settings = Settings(str(tmp_path))
    Pipeline(spark, settings).run_day(0, str(tmp_path / "landing" / "snapshot_day0.csv"))
    broken = Pipeline(spark, settings)

    def crash(*a, **k):
        raise Crash

    target = {"quarantine": (broken.quarantine, "replace"), "recon": (broken.recon, "replace_partition"), "publish": (broken.silver, "publish"), "after": (broken.control, "finish")}[where]
    real = getattr(*target)
    monkeypatch.setattr(*target, (lambda stage, *a: crash() if stage == "silver" else real(stage, *a)) if where == "after" else (lambda rows, n, day, stage: crash() if stage != "bronze" else real(rows, n, day, stage)) if where == "quarantine" else crash)
    with pytest.raises(Crash):
        broken.run_day(1, str(tmp_path / "landing" / "snapshot_day1.csv"))
    again = Pipeline(spark, settings)
    done = again.run_day(1, str(tmp_path / "landing" / "snapshot_day1.csv"))
    assert set(done.status.values()) == {"SUCCESS"} | ({"SKIPPED"} if done.status["bronze"] == "SKIPPED" else set()), [c for c in done.report.checks if not c["passed"]]
    r = again.recon.read().where("snapshot_day = 1").collect()
    assert [(x["new_rows"], x["changed_rows"], x["unchanged_rows_skipped"], x["dq_dropped_rows"], x["reprocessing_reduction_pct"], x["run_id"]) for x in r] == [(1, 1, 1, 2, 60.0, again.control.run_id)]
    assert sorted(x["error_code"] for x in again.quarantine.read().collect()) == ["DQ001", "DQ002", "DQ003"]
    assert sorted((x["reading_id"], x["fuel_level"]) for x in again.silver.read().collect()) == [(1, 50.0), (2, 40.0), (3, 50.0), (4, 51.0)]
    report = json.loads((tmp_path / "reports" / "validation_report.json").read_text())
    assert report["status"] == "PASS" and report["snapshot_day"] == 1 and json.loads((tmp_path / "reports" / "gold_status.json").read_text())["status"] == "SUCCESS"


def test_catalog_tables_follow_the_current_version(spark, tmp_path):
    land(tmp_path, 0, row(1), row(2))
    land(tmp_path, 1, row(1), row(3))
    p = Pipeline(spark, Settings(str(tmp_path), database="cat_test"))
    try:
        p.run_pending()
        assert p.store.read("silver").count() == 3 and spark.table("cat_test.gold").agg(F.sum("total_readings")).first()[0] == 3
        assert spark.table("cat_test.bronze").where("_snapshot_day = 1").count() == 2 and p.store.table_exists("silver") and not p.store.table_exists("nope")
    finally:
        spark.sql("DROP DATABASE IF EXISTS cat_test CASCADE")


def test_generated_days_one_by_one(spark, tmp_path):
    from snapstate.sources.snapshots import SEQUENCE, Shape, clean_days, write_next_day

    shape, landing = Shape(customers=2, machines_low=2, machines_high=3, rows=400), str(tmp_path / "landing")
    for day in range(2):
        write_next_day(spark, landing, day, shape)
    (tmp_path / "landing" / SEQUENCE).unlink()  # found again in the snapshot
    write_next_day(spark, landing, 2, shape)
    days = [{r["reading_id"]: r for r in read_landing(spark, f"{landing}/snapshot_day{d}.csv").collect()} for d in range(3)]
    kept = [set(a) & set(b) for a, b in zip(days, days[1:], strict=False)]
    assert all(len(b) == len(k) + 12 for k, b in zip(kept, days[1:], strict=True)) and max(map(int, days[2])) == 424
    changed = [k for k in kept[0] if days[0][k] != days[1][k]]
    assert 2 < len(changed) < 40 and any(days[0][k]["fault_code"] != days[1][k]["fault_code"] or days[0][k]["fuel_level"] != days[1][k]["fuel_level"] for k in changed)
    clean_days(spark, landing)
    assert snapshot_days(spark, landing) == {}


def test_previews(spark):
    from snapstate.functions.preview import preview

    text = preview(spark.createDataFrame([(1, "a"), (None, "b" * 90)], "k int, v string"), 5, 10).splitlines()
    assert text == ["k: int, v: string", "k | v", "1 | a", "  | bbbbbbbbbb"]


def test_empty_state_never_overwrites_gold(spark, tmp_path):
    land(tmp_path, 0, row(1))
    p = Pipeline(spark, Settings(str(tmp_path)))
    p.run_day(0, str(tmp_path / "landing" / "snapshot_day0.csv"))
    p.silver.commit(p.silver.read().where("false"))
    with pytest.raises(ValueError, match="empty"):
        p.run_gold()
    assert p.gold.read().count() == 1


def test_stream_picks_up_new_files_once(spark, tmp_path):
    land(tmp_path, 0, row(1))
    settings = Settings(str(tmp_path))
    assert run_available(Pipeline(spark, settings), str(tmp_path / "ck")) == [0]
    land(tmp_path, 1, row(1, fuel=1))
    assert run_available(Pipeline(spark, settings), str(tmp_path / "ck")) == [1]
    assert run_available(Pipeline(spark, settings), str(tmp_path / "ck")) == []
    assert Pipeline(spark, settings).silver.read().first()["fuel_level"] == 1.0


def test_settings(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"pipeline": {"name": "p"}, "source": {"format": "csv", "options": {"delimiter": ";"}}, "paths": {"folders": {"gold": "au"}}}))
    s = Settings.load(tmp_path / "c.json", "/b/")
    assert s.table("gold") == "gold" and Settings("x", database="d", tables={"gold": "au"}).table("gold") == "d.au"
    assert s.pipeline == "p" and s.path("gold") == "/b/au" and s.path("silver") == "/b/silver" and s.source_options == {"delimiter": ";"}
    with pytest.raises(KeyError):
        s.path("nope")


def test_latest_metrics_and_z_order(spark):
    m = Metrics()
    m.add("rows", 2)
    m.add("rows")
    assert m.summary() == "rows=3"
    m.time(2.0)
    assert m.rates() == {"rows_per_second": 1.5}
    m.reset()
    assert not m
    e = spark.createDataFrame([("a", "STARTED", 1), ("a", "SUCCESS", 1), ("b", "FAILED", 2)], "k string, status string, updated_at int")
    assert {r["k"]: r["status"] for r in latest(e, ["k"]).collect()} == {"a": "SUCCESS", "b": "FAILED"}
    grid = spark.range(256).select((F.col("id") % 16).alias("x"), F.floor(F.col("id") / 16).alias("y"))
    parts = z_order(grid, ["x", "y"], 4).withColumn("p", F.spark_partition_id())
    assert parts.count() == 256
    boxes = parts.groupBy("p").agg((F.max("x") - F.min("x") + 1).alias("w"), (F.max("y") - F.min("y") + 1).alias("h")).collect()
    assert sum(b["w"] * b["h"] for b in boxes) < 2 * 256


def held(table):
    """Segment -> version of the current state."""
    return table.segments(10)


def test_a_merge_leaves_segments_that_the_snapshot_does_not_have(spark, tmp_path):
    land(tmp_path, 0, row(-3), row(1), row(11), row(12), row(25))
    land(tmp_path, 1, row(11, fuel=40), row(12), row(31), row(31, fuel=7), row(33, fuel=500))
    land(tmp_path, 2, row(31, fuel=9), row(45))
    land(tmp_path, 3, row(45))
    settings = Settings(str(tmp_path), segment_rows=10)
    p = Pipeline(spark, settings)
    days = p.run_pending()
    assert all(set(d.status.values()) == {"SUCCESS"} for d in days), [c for d in days for c in d.report.checks if not c["passed"]]
    assert held(p.silver) == {-1: 0, 0: 0, 1: 1, 2: 0, 3: 2, 4: 3}
    want = {-3: 50.0, 1: 50.0, 11: 40.0, 12: 50.0, 25: 50.0, 31: 9.0, 45: 50.0}
    assert {r["reading_id"]: r["fuel_level"] for r in p.silver.read().collect()} == want
    assert [(d.recon["new_rows"], d.recon["changed_rows"], d.recon["unchanged_rows_skipped"]) for d in days] == [(5, 0, 0), (1, 1, 1), (1, 1, 0), (0, 0, 1)]
    assert p.silver.note()["found"] == {"new": 0, "changed": 0, "unchanged": 1, "retained": 6, "merged": 7}
    assert p.silver.versions() == [2, 3] and sorted(x.name for x in (tmp_path / "silver" / "v=0").iterdir() if "=" in x.name) == ["_segment=-1", "_segment=0", "_segment=2"]
    assert p.silver.rollback() == 2 and held(p.silver) == {-1: 0, 0: 0, 1: 1, 2: 0, 3: 2, 4: 2} and p.silver.read().count() == 7
    # another size of segments rewrites the state once; columns of older segments that later days added read null
    land(tmp_path, 4, row(46) + ",depot", head=HEAD + ",site")
    wide = Pipeline(spark, Settings(str(tmp_path), segment_rows=20))
    wide.run_day(4, str(tmp_path / "landing" / "snapshot_day4.csv"))
    assert wide.silver.segments(20) == {-1: 3, 0: 3, 1: 3, 2: 3} and wide.silver.segments(10) is None
    assert {r["reading_id"]: r["site"] for r in wide.silver.read().where("reading_id > 40").collect()} == {45: None, 46: "depot"}


def test_a_state_without_an_integer_key_has_no_segments(spark, tmp_path):
    from dataclasses import replace

    rules = replace(TELEMETRY, columns={**TELEMETRY.columns, "reading_id": "string"})
    land(tmp_path, 0, row("a"), row("b"))
    land(tmp_path, 1, row("b", fuel=1), row("c"))
    p = Pipeline(spark, Settings(str(tmp_path)), rules)
    assert all(set(d.status.values()) == {"SUCCESS"} for d in p.run_pending())
    assert held(p.silver) is None and {r["reading_id"]: r["fuel_level"] for r in p.silver.read().collect()} == {"a": 50.0, "b": 1.0, "c": 50.0}
