"""Queries over the driver tables, one or more for each operator, and the same in DuckDB SQL.

Doubles are rounded, ranks and counts are long, and every limit or rank has a total order, so that both engines give
equal rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.predicates import reduction_pct, required_missing
from ..functions.schema import schema_hash, types_of
from ..operators import changes, kpi, ledger, quality, reconcile
from ..operators.ingest import conform, split_required, stamped, uncastable
from ..operators.validate import check_rows, validate
from ..schemas import CHANGED, CONTROL, NEW, SCHEMA_HISTORY, UNCHANGED
from ..sources.landing import read_landing, snapshot_days
from ..sources.snapshots import churned
from . import lab
from . import views as V
from .views import COLUMNS, ROW, RULES, clean_sql, evolve_sql, holed_sql, snapshot_sql, state_sql

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.telemetry(spark, sf_dir)


def _clean(base: DataFrame, day: int) -> DataFrame:
    return quality.gate(V.snapshot(base, day), RULES).clean


def _state(base: DataFrame, day: int) -> DataFrame:
    out = _clean(base, 0)
    for d in range(1, day + 1):
        out = changes.apply_snapshot(_clean(base, d), out, RULES)
    return out


def _classified(base: DataFrame) -> DataFrame:
    return changes.classify(_clean(base, 1), _clean(base, 0), RULES)


def _as_strings(df: DataFrame) -> DataFrame:
    """A landing file as it is read: strings only, one column extra, one missing, and some ids that do not cast."""
    odd = F.when(F.col("reading_id") % 97 == 0, F.concat(F.lit("x"), F.col("reading_id"))).otherwise(F.col("reading_id").cast("string"))
    return df.select(odd.alias("reading_id"), *[F.col(c).cast("string").alias(c) for c in COLUMNS if c not in ("reading_id", "event_ts")], F.lit("depot").alias("site"))


_LANDING = f"SELECT CASE WHEN reading_id % 97 = 0 THEN NULL ELSE reading_id END AS reading_id, customer_id, machine_id, CAST(NULL AS VARCHAR) AS event_ts, fuel_level, payload_weight_t, fault_code, 'depot' AS site FROM ({V.TELEMETRY_SQL})"


@query(f"SELECT {ROW}, site, 'snapshot_day0.csv' AS _source_file, 0 AS _snapshot_day FROM ({_LANDING}) WHERE reading_id IS NOT NULL")
def q01_ingest_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split_required(conform(_as_strings(_base(spark, sf_dir)), RULES), RULES).kept
    return stamped(rows, "snapshot_day0.csv", 0).drop("_ingestion_ts")


@query(f"SELECT (reading_id IS NULL OR customer_id IS NULL OR machine_id IS NULL) AS malformed, count(*) AS n FROM ({holed_sql(_LANDING)}) GROUP BY 1")
def q02_required_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = split_required(V.holed(conform(_as_strings(_base(spark, sf_dir)), RULES)), RULES)
    count = lambda df, bad: df.agg(F.count("*").alias("n")).select(F.lit(bad).alias("malformed"), "n")
    return count(split.kept, False).unionByName(count(split.rejected, True))


@query(f"SELECT count(*) AS landing_rows, count(reading_id) AS bronze_rows, count(*) - count(reading_id) AS quarantined_rows, true AS conserved FROM ({_LANDING})")
def q03_bronze_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed, missing = conform(_as_strings(_base(spark, sf_dir)), RULES), required_missing(RULES)
    counts = typed.agg(F.count("*").alias("landing_rows"), F.count_if(~missing).alias("bronze_rows"), F.count_if(missing).alias("quarantined_rows"))
    return counts.withColumn("conserved", F.col("landing_rows") == F.col("bronze_rows") + F.col("quarantined_rows"))


#: Names of DuckDB's types in Spark.
_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "TIMESTAMP": "timestamp_ntz"}


def _types_sql(what: str) -> str:
    """name and type of the columns of a table or select."""
    kinds = " ".join(f"WHEN '{duck}' THEN '{spark}'" for duck, spark in _TYPES.items())
    return f"SELECT column_name AS name, CASE column_type {kinds} ELSE column_type END AS type FROM (DESCRIBE {what})"


_LATER = "SELECT * EXCLUDE (o_orderpriority) REPLACE (o_custkey::VARCHAR AS o_custkey), 'web' AS o_channel FROM orders"


def _orders_history(spark: SparkSession, sf_dir: str) -> ledger.SchemaHistory:
    """A stored history: orders, then with a column added, one removed and one of another type, then the same again."""
    orders, history = V.table(spark, sf_dir, "orders"), ledger.SchemaHistory(lab.store(spark))
    later = orders.drop("o_orderpriority").withColumn("o_custkey", F.col("o_custkey").cast("string")).withColumn("o_channel", F.lit("web"))
    for df in (orders, later, later):
        history.save(df, "sales", "bronze")
    return history


@query(f"""SELECT CASE WHEN a.name IS NULL THEN 'COLUMN_ADDED' WHEN b.name IS NULL THEN 'COLUMN_REMOVED' ELSE 'TYPE_CHANGED' END AS change_type, coalesce(a.name, b.name) AS column_name, a.type AS old_type, b.type AS new_type
 FROM ({_types_sql("orders")}) a FULL OUTER JOIN ({_types_sql(_LATER)}) b ON a.name = b.name WHERE a.type IS DISTINCT FROM b.type""")
def q04_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes that the stored history recorded."""
    return _orders_history(spark, sf_dir).changes.read().select("change_type", "column_name", "old_type", "new_type")


@query(f"SELECT {ROW} FROM ({clean_sql(holed_sql(snapshot_sql(1)))})")
def q05_dq_clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.gate(V.holed(V.snapshot(_base(spark, sf_dir), 1)), RULES).clean.select(*COLUMNS)


@query(f"SELECT {ROW}, 'DQ002' AS error_code, 'null key or value out of range' AS error_message, 'silver_dq_gate' AS stage FROM ({holed_sql(snapshot_sql(1))}) WHERE NOT {V.VALID_SQL}")
def q06_dq_invalid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = quality.gate(V.holed(V.snapshot(_base(spark, sf_dir), 1)), RULES).invalid
    return quality.quarantined(bad, "DQ002", "telemetry", None, "silver_dq_gate").select(*COLUMNS, "error_code", "error_message", "stage")


_LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
_LINE_SQL = f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(f'{c} DESC' for c in _LINE_ORDER)}) AS rn FROM lineitem) WHERE rn "


def _line(spark: SparkSession, sf_dir: str, pick: Callable) -> DataFrame:
    rows = pick(V.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], [F.col(c).desc() for c in _LINE_ORDER])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query(_LINE_SQL + "= 1")
def q07_dedup_winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line(spark, sf_dir, quality.winners)


@query(_LINE_SQL + "> 1")
def q08_dedup_losers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line(spark, sf_dir, quality.losers)


def _doubled(df: DataFrame) -> DataFrame:
    """df with a second, later version of every 20th row."""
    again = df.where("reading_id % 20 = 0").withColumn("payload_weight_t", F.col("payload_weight_t") + 0.5)
    return df.withColumn("_file_order", F.lit(0)).unionByName(again.withColumn("_file_order", F.lit(1)))


_DOUBLED = f"SELECT *, 0 AS _file_order FROM ({holed_sql(snapshot_sql(1))}) UNION ALL SELECT * REPLACE (payload_weight_t + 0.5 AS payload_weight_t), 1 FROM ({holed_sql(snapshot_sql(1))}) WHERE reading_id % 20 = 0"
_GATED = f"SELECT *, {V.VALID_SQL} AS ok, row_number() OVER (PARTITION BY reading_id, {V.VALID_SQL} ORDER BY _file_order DESC) AS rn FROM ({_DOUBLED})"


@query(f"SELECT count(*) AS before_rows, count(*) FILTER (ok AND rn = 1) AS clean_rows, count(*) FILTER (NOT ok) AS invalid_rows, count(*) FILTER (ok AND rn > 1) AS duplicate_rows FROM ({_GATED})")
def q09_silver_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.verdicts(_doubled(V.holed(V.snapshot(_base(spark, sf_dir), 1))), RULES)
    return judged.agg(F.count("*").alias("before_rows"), F.count_if(F.col("_dq").isNull()).alias("clean_rows"), F.count_if(F.col("_dq") == "DQ002").alias("invalid_rows"), F.count_if(F.col("_dq") == "DQ003").alias("duplicate_rows"))


@query(f"SELECT 'NEW' AS _change_type, count(*) AS n FROM ({clean_sql(snapshot_sql(0))})")
def q10_first_load_all_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.class_counts(changes.classify(_clean(_base(spark, sf_dir), 0), None, RULES))


_EVOLVED = evolve_sql(clean_sql(snapshot_sql(1)), clean_sql(snapshot_sql(0)))


@query(f"SELECT _change_type, count(*) AS n FROM ({_EVOLVED}) WHERE _change_type <> 'RETAINED' GROUP BY 1")
def q11_classify_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.class_counts(_classified(_base(spark, sf_dir)))


@query(f"SELECT c.reading_id, c.fuel_level, c.payload_weight_t, c.fault_code, e._change_type FROM ({clean_sql(snapshot_sql(1))}) c JOIN ({_EVOLVED}) e USING (reading_id)")
def q12_classify_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(_base(spark, sf_dir)).select("reading_id", "fuel_level", "payload_weight_t", "fault_code", "_change_type")


def _nulled(base: DataFrame, day: int) -> DataFrame:
    """A snapshot whose fault codes are null in 7, and, from day 1 on, also in 5."""
    gone = (F.col("reading_id") % 7 == 0) | ((F.col("reading_id") % 5 == 0) & F.lit(day > 0))
    return _clean(base, day).withColumn("fault_code", F.when(~gone, F.col("fault_code")))


def _nulled_sql(day: int) -> str:
    gone = "reading_id % 7 = 0" + " OR reading_id % 5 = 0" * (day > 0)
    return f"SELECT * REPLACE (CASE WHEN NOT ({gone}) THEN fault_code END AS fault_code) FROM ({clean_sql(snapshot_sql(day))})"


_NULL_EVOLVED = evolve_sql(_nulled_sql(1), _nulled_sql(0))


@query(f"SELECT _change_type, count(*) AS n FROM ({_NULL_EVOLVED}) WHERE _change_type <> 'RETAINED' GROUP BY 1")
def q13_classify_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _base(spark, sf_dir)
    return changes.class_counts(changes.classify(_nulled(base, 1), _nulled(base, 0), RULES))


@query(f"SELECT {ROW}, _snapshot_day FROM ({state_sql(1)})")
def q14_merge_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state(_base(spark, sf_dir), 1).select(*COLUMNS, "_snapshot_day")


@query(f"SELECT {ROW}, _snapshot_day FROM ({state_sql(1)})")
def q15_merge_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _base(spark, sf_dir)
    return changes.apply_snapshot(_clean(base, 1), _state(base, 1), RULES).select(*COLUMNS, "_snapshot_day")


@query(f"SELECT {ROW}, _snapshot_day FROM ({clean_sql(snapshot_sql(0))})")
def q16_merge_empty_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    prior = _clean(_base(spark, sf_dir), 0)
    return changes.upsert(prior, prior.where("false"), RULES.key).select(*COLUMNS, "_snapshot_day")


@query(f"SELECT {ROW}, _snapshot_day FROM ({_NULL_EVOLVED})")
def q17_merge_null_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _base(spark, sf_dir)
    prior = _nulled(base, 0)
    return changes.upsert(prior, changes.to_merge(changes.classify(_nulled(base, 1), prior, RULES)), RULES.key).select(*COLUMNS, "_snapshot_day")


_KPI = f"""SELECT customer_id, machine_id, round(avg(fuel_level), 6) AS avg_fuel_level, round(avg(payload_weight_t), 6) AS avg_payload_t,
 CAST(sum(CASE WHEN fault_code <> 'NONE' THEN 1 ELSE 0 END) AS BIGINT) AS fault_events, count(reading_id) AS total_readings FROM ({{}}) GROUP BY 1, 2"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in df.dtypes])


@query(_KPI.format(clean_sql(V.TELEMETRY_SQL)))
def q18_gold_machine_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(kpi.machine_kpi(quality.gate(_base(spark, sf_dir), RULES).clean, RULES))


@query(f"SELECT customer_id, _snapshot_day, count(reading_id) AS total_readings, count(DISTINCT machine_id) AS active_machines, round(avg(CASE WHEN fault_code <> 'NONE' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS fault_rate FROM ({state_sql(2)}) GROUP BY 1, 2")
def q19_gold_customer_day_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(kpi.customer_day_kpi(_state(_base(spark, sf_dir), 2), RULES))


@query(f"SELECT customer_id, machine_id, fault_events, total_readings FROM ({_KPI.format(clean_sql(V.TELEMETRY_SQL))}) ORDER BY fault_events DESC, customer_id, machine_id LIMIT 10")
def q20_top10_faulty_machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kpi.machine_kpi(quality.gate(_base(spark, sf_dir), RULES).clean, RULES)
    return kpi.top(out, "fault_events", 10, ["customer_id", "machine_id"]).select("customer_id", "machine_id", "fault_events", "total_readings")


def _counts(base: DataFrame, day: int, prior: DataFrame | None) -> DataFrame:
    """The day's reconciliation row, from one pass over its snapshot."""
    kinds = changes.classify(quality.verdicts(V.snapshot(base, day), RULES), prior, RULES)
    clean = F.col("_dq").isNull()
    rows = kinds.agg(F.count("*").alias("total_rows_in_snapshot"), *[F.count_if(clean & (F.col("_change_type") == k)).alias(n) for k, n in ((NEW, "new_rows"), (CHANGED, "changed_rows"), (UNCHANGED, "unchanged_rows_skipped"))], F.count_if(~clean).alias("dq_dropped_rows"))
    return reconcile.with_rates(rows.withColumns({"snapshot_day": F.lit(day), "had_prior": F.lit(prior is not None)})).drop("had_prior")


def _recon_sql(day: int) -> str:
    prior = f"SELECT * FROM ({clean_sql(snapshot_sql(0))}) WHERE false" if day == 0 else state_sql(day - 1)
    pct = "CAST(NULL AS DOUBLE)" if day == 0 else "round((1.0::DOUBLE - (n + c)::DOUBLE / t) * 100, 2)"
    own = "CAST(NULL AS DOUBLE)" if day == 0 else "round((1.0::DOUBLE - (n + c)::DOUBLE / (n + c + u)) * 100, 2)"
    return f"""SELECT {day} AS snapshot_day, t AS total_rows_in_snapshot, n AS new_rows, c AS changed_rows, u AS unchanged_rows_skipped, t - n - c - u AS dq_dropped_rows, n + c AS incremental_volume_processed,
 {pct} AS reprocessing_reduction_pct, {own} AS unchanged_pct, true AS row_conservation_passed FROM (SELECT (SELECT count(*) FROM ({snapshot_sql(day)})) AS t, count(*) FILTER (_change_type = 'NEW') AS n,
 count(*) FILTER (_change_type = 'CHANGED') AS c, count(*) FILTER (_change_type = 'UNCHANGED') AS u FROM ({evolve_sql(clean_sql(snapshot_sql(day)), prior)}))"""


@query(_recon_sql(1))
def q21_reconciliation_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _base(spark, sf_dir)
    return _counts(base, 1, _state(base, 0))


def _all_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reconciliation of all days; each day's state is stored, so that work grows with the days and not their square."""
    base, state = _base(spark, sf_dir), lab.store(spark).state("state")
    state.keep_versions = len(V.CUTS)  # the rows are counted when they are asked for
    out, compared = _counts(base, 0, None), [*RULES.key, *RULES.tracked]
    for d in range(1, len(V.CUTS)):
        clean = _clean(base, d - 1).select(*compared)
        state.commit(clean if d == 1 else changes.apply_snapshot(clean, state.read(), RULES))
        out = out.unionByName(_counts(base, d, state.read()))
    return out


_ALL_DAYS = " UNION ALL ".join(_recon_sql(d) for d in range(len(V.CUTS)))


@query(_ALL_DAYS)
def q22_reduction_5_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_days(spark, sf_dir)


@query(f"SELECT round(avg(reprocessing_reduction_pct), 6) AS mean_reduction_pct, min(reprocessing_reduction_pct) AS min_reduction_pct, max(reprocessing_reduction_pct) AS max_reduction_pct, max(total_rows_in_snapshot) AS peak_snapshot_rows FROM ({_ALL_DAYS})")
def q23_benchmark_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.summary(_all_days(spark, sf_dir))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A control ledger made of orders: one event per order, of one pipeline, run, stage and file each."""
    o = V.table(spark, sf_dir, "orders")
    status = F.element_at(F.array(*map(F.lit, ("SUCCESS", "FAILED", "SKIPPED", "STARTED"))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return o.select(F.lit("telemetry").alias("pipeline_name"), F.concat(F.lit("run"), F.col("o_custkey") % 40).alias("run_id"), F.element_at(F.array(*map(F.lit, ("bronze", "silver", "gold"))), (F.col("o_orderkey") % 3 + 1).cast("int")).alias("stage"), F.concat(F.lit("snapshot_day"), F.col("o_custkey") % 60, F.lit(".csv")).alias("source_file"), status.alias("status"), F.col("o_orderkey").alias("updated_at"), F.round(F.col("o_totalprice")).cast("long").alias("rows_read"))


_EVENTS = """SELECT 'telemetry' AS pipeline_name, 'run' || (o_custkey % 40) AS run_id, ['bronze', 'silver', 'gold'][(o_orderkey % 3 + 1)::INTEGER] AS stage, 'snapshot_day' || (o_custkey % 60) || '.csv' AS source_file,
 ['SUCCESS', 'FAILED', 'SKIPPED', 'STARTED'][(o_orderkey % 4 + 1)::INTEGER] AS status, o_orderkey AS updated_at, CAST(round(o_totalprice) AS BIGINT) AS rows_read FROM orders"""
_LATEST = f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_name, run_id, stage, source_file ORDER BY updated_at DESC) AS rn FROM ({_EVENTS})) WHERE rn = 1"


@query(_LATEST)
def q24_control_latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.latest(_events(spark, sf_dir), ledger.RUN_KEY)


_FILES = "SELECT DISTINCT 'snapshot_day' || (c_custkey % 90) || '.csv' AS source_file FROM customer"
_DONE = f"SELECT source_file FROM ({_EVENTS}) WHERE stage = 'silver' AND status = 'SUCCESS' AND updated_at % 8 = 0"


def _control(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ledger.Control]:
    """Files, and a stored control ledger with the events of orders that divide by 8."""
    files = V.table(spark, sf_dir, "customer").select(F.concat(F.lit("snapshot_day"), F.col("c_custkey") % 90, F.lit(".csv")).alias("source_file")).distinct()
    control = ledger.Control(lab.store(spark), "telemetry")
    rows = _events(spark, sf_dir).where("updated_at % 8 = 0").withColumns({c: F.lit("x") for c in ("pipeline_type", "execution_id", "execution_mode", "trigger_type")}).withColumn("updated_at", F.timestamp_seconds("updated_at"))
    control.events.append(rows.select(*[F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in CONTROL]))
    return files, control


@query(f"SELECT source_file FROM ({_FILES}) WHERE source_file NOT IN ({_DONE})")
def q25_pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, control = _control(spark, sf_dir)
    return control.pending(files, "silver")


@query(f"SELECT source_file FROM ({_FILES}) WHERE source_file IN ({_DONE})")
def q26_already_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, control = _control(spark, sf_dir)
    return control.processed(files, "silver")


@query("""SELECT pipeline_name, watermark FROM (SELECT 'pipeline' || (o_custkey % 20) AS pipeline_name, CAST(max(o_orderkey) AS VARCHAR) AS watermark FROM orders WHERE o_custkey % 2 = 1 GROUP BY 1)
 UNION ALL SELECT 'pipeline' || (o_custkey % 20), CAST(min(o_orderkey) AS VARCHAR) FROM orders WHERE o_custkey % 20 IN (0, 2, 4) GROUP BY 1""")
def q27_watermark_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = V.table(spark, sf_dir, "orders").withColumn("pipeline_name", F.concat(F.lit("pipeline"), F.col("o_custkey") % 20))
    stored = o.where("o_custkey % 20 < 5").groupBy("pipeline_name").agg(F.min("o_orderkey").cast("string").alias("watermark"))
    return changes.upsert(stored, o.where("o_custkey % 2 = 1").groupBy("pipeline_name").agg(F.max("o_orderkey").cast("string").alias("watermark")), ["pipeline_name"])


@query(f"SELECT run_id, count(*) AS audit_rows, count(*) FILTER (upper(status) <> 'SUCCESS') AS failures FROM ({_EVENTS}) GROUP BY 1")
def q28_audit_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _events(spark, sf_dir).withColumn("status", F.when(F.col("updated_at") % 2 == 0, F.lower("status")).otherwise(F.col("status")))
    bad = ledger.failures(a).groupBy("run_id").agg(F.count("*").alias("failures"))
    return a.groupBy("run_id").agg(F.count("*").alias("audit_rows")).join(bad, "run_id", "left").withColumn("failures", F.coalesce("failures", F.lit(0)))


@query(f"""SELECT error_code, count(*) AS n FROM (SELECT 'DQ001' AS error_code FROM ({_LANDING}) WHERE reading_id IS NULL UNION ALL SELECT CASE WHEN NOT ok THEN 'DQ002' ELSE 'DQ003' END FROM ({_GATED}) WHERE NOT ok OR rn > 1) GROUP BY 1""")
def q29_quarantine_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _base(spark, sf_dir)
    malformed = split_required(conform(_as_strings(base), RULES), RULES).rejected
    gated = quality.gate(_doubled(V.holed(V.snapshot(base, 1))), RULES)
    parts = [quality.quarantined(df, code, "telemetry", None, "x").select("error_code") for df, code in ((malformed, "DQ001"), (gated.invalid, "DQ002"), (gated.duplicates, "DQ003"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("error_code").agg(F.count("*").alias("n"))


@query(f"""WITH s AS ({state_sql(1)}), g AS (SELECT customer_id, machine_id, count(reading_id) AS n FROM s GROUP BY 1, 2)
 SELECT 'silver has rows' AS check_name, (SELECT count(*) FROM s) > 0 AS passed UNION ALL SELECT 'silver keys are unique', (SELECT count(*) = count(DISTINCT reading_id) FROM s)
 UNION ALL SELECT 'gold has rows', (SELECT count(*) FROM g) > 0 UNION ALL SELECT 'gold readings equal silver rows', (SELECT sum(n) FROM g) = (SELECT count(*) FROM s)
 UNION ALL SELECT 'days conserve rows', (SELECT bool_and(total_rows_in_snapshot = new_rows + changed_rows + unchanged_rows_skipped + dq_dropped_rows) FROM ({_recon_sql(1)}))
 UNION ALL SELECT 'no day failed', NOT EXISTS (SELECT 1 FROM ({_EVENTS}) WHERE upper(status) <> 'SUCCESS')""")
def q30_validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _base(spark, sf_dir)
    silver = _state(base, 1)
    gold = kpi.machine_kpi(silver, RULES)
    both = silver.select(F.lit(1).alias("s"), F.lit(0).cast("long").alias("g")).unionByName(gold.select(F.lit(0).alias("s"), F.col("total_readings").alias("g")))
    return check_rows({
        "silver has rows": (silver, "count(*) > 0"), "silver keys are unique": (changes.duplicate_keys(silver, RULES.key), "count(*) = 0"), "gold has rows": (gold, "count(*) > 0"),
        "gold readings equal silver rows": (both, "sum(s) = sum(g)"), "days conserve rows": (_counts(base, 1, _clean(base, 0)), "bool_and(row_conservation_passed)"), "no day failed": (ledger.failures(_events(spark, sf_dir)), "count(*) = 0"),
    })


@query("SELECT 'pipeline' || (o_custkey % 7) AS pipeline_name, ['bronze', 'silver', 'gold'][(o_orderkey % 3 + 1)::INTEGER] AS stage, CAST(max(o_orderkey % 50) + 1 AS BIGINT) AS next_version FROM orders GROUP BY 1, 2")
def q31_schema_next_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = V.table(spark, sf_dir, "orders")
    stage = F.element_at(F.array(*map(F.lit, ("bronze", "silver", "gold"))), (F.col("o_orderkey") % 3 + 1).cast("int"))
    history = ledger.SchemaHistory(lab.store(spark))
    rows = o.select(F.concat(F.lit("pipeline"), F.col("o_custkey") % 7).alias("pipeline_name"), stage.alias("stage"), (F.col("o_orderkey") % 50).alias("version"), F.lit("h").alias("schema_hash"), F.lit("{}").alias("schema_json"), F.current_timestamp().alias("recorded_at"))
    history.versions.append(rows.select(*SCHEMA_HISTORY.names))
    return history.next_versions()


@query(f"""SELECT * FROM ({snapshot_sql(1)}) WHERE event_ts < '{V.CUTS[0]}' UNION ALL SELECT * FROM ({snapshot_sql(1)}) WHERE event_ts >= '{V.CUTS[0]}'""")
def q32_churn_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yesterday's rows, corrected and aged out, and the day's arrivals."""
    base = _base(spark, sf_dir)
    gone, fixed = F.col("reading_id") % 33 == 1, F.col("reading_id") % 25 == 1
    arrivals = V.snapshot(base, 1).where(F.col("event_ts") >= V.CUTS[0])
    return churned(V.snapshot(base, 0), arrivals, gone, fixed, {"fuel_level": F.col("fuel_level") + 1.5}).withColumn("_snapshot_day", F.lit(1))


@query(f"""SELECT m.customer_id, m.machine_id, r.reading_id, r.fuel_level, r.payload_weight_t, r.fault_code FROM (SELECT DISTINCT customer_id, machine_id FROM ({V.TELEMETRY_SQL})) m
 LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY customer_id, machine_id ORDER BY reading_id DESC) AS rn FROM ({clean_sql(snapshot_sql(0))})) r ON m.customer_id = r.customer_id AND m.machine_id = r.machine_id AND r.rn = 1""")
def q33_roster_join_latest_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _base(spark, sf_dir)
    return kpi.latest_reading(base.select("customer_id", "machine_id").distinct(), _clean(base, 0))


@query(f"SELECT snapshot_day, total_rows_in_snapshot, incremental_volume_processed, reprocessing_reduction_pct FROM ({_ALL_DAYS}) ORDER BY snapshot_day")
def q34_recon_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_days(spark, sf_dir).orderBy("snapshot_day").select("snapshot_day", "total_rows_in_snapshot", "incremental_volume_processed", "reprocessing_reduction_pct")


_PRESENT = [c for c in COLUMNS if c != "event_ts"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS present, {'count(*) FILTER (event_id % 97 = 0)' if c == 'reading_id' else '0::BIGINT'} AS uncastable FROM events" for c in _PRESENT))
def q35_uncastable_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uncastable(_as_strings(_base(spark, sf_dir)), RULES)


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def q36_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.duplicate_keys(V.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(f"""SELECT e.* REPLACE (CASE WHEN e.run_id = 'run7' AND e.stage = 'gold' THEN 'SUCCESS' ELSE e.status END AS status) FROM ({_LATEST}) e""")
def q37_update_only_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A status update touches the rows of its own run and stage, and adds none."""
    current = ledger.latest(_events(spark, sf_dir), ledger.RUN_KEY)
    done = current.where("run_id = 'run7' AND stage = 'gold'").select("run_id", "stage").distinct().withColumn("status", F.lit("SUCCESS"))
    ghost = done.withColumn("run_id", F.lit("ghost"))
    return changes.update_only(current, done.unionByName(ghost), ["run_id", "stage"], ["status"])


@query("SELECT o_orderstatus, round((1.0::DOUBLE - count(*) FILTER (o_totalprice > 100000)::DOUBLE / count(*)) * 100, 2) AS reduction_pct FROM orders GROUP BY 1")
def q38_reduction_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(reduction_pct(F.count_if(F.col("o_totalprice") > 100000), F.count("*")).alias("reduction_pct"))


_HASHED = ("customer", "orders", "lineitem", "events", "part")


def _hash_sql(what: str) -> str:
    return f"""(SELECT sha256('{{' || string_agg('"' || name || '": "' || type || '"', ', ' ORDER BY name) || '}}') FROM ({_types_sql(what)}))"""


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, {_hash_sql(t)} AS schema_hash" for t in _HASHED))
def q39_schema_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(t, schema_hash(types_of(V.table(spark, sf_dir, t)))) for t in _HASHED], "table_name string, schema_hash string")


# Queries over a store that the daily run has written


@query(f"SELECT {ROW}, 'depot' AS site FROM ({lab.landing_sql(1)})")
def q40_landing_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV file bound by header name, found by its day."""
    settings = lab.ran(spark, sf_dir).settings
    return conform(read_landing(spark, snapshot_days(spark, settings.path("landing"))[1], settings.source_options), RULES).select(*COLUMNS, "site")


def _run_sql(day: int) -> str:
    """Counts of a day of the stored run: landing, bronze, clean, invalid, duplicates, new, changed, unchanged, state."""
    prior = f"SELECT * FROM ({lab.clean_sql(0)}) WHERE false" if day == 0 else lab.state_sql(day - 1)
    kinds = V.evolve_sql(lab.clean_sql(day), prior)
    return f"""SELECT {day} AS d, (SELECT count(*) FROM ({lab.landing_sql(day)})) AS landing, (SELECT count(*) FROM ({lab.landing_sql(day)}) WHERE customer_id IS NOT NULL) AS bronze,
 (SELECT count(*) FROM ({lab.landing_sql(day)}) WHERE {V.VALID_SQL}) AS valid, (SELECT count(*) FROM ({lab.clean_sql(day)})) AS clean,
 count(*) FILTER (_change_type = 'NEW') AS new, count(*) FILTER (_change_type = 'CHANGED') AS changed, count(*) FILTER (_change_type = 'UNCHANGED') AS unchanged, count(*) AS state FROM ({kinds})"""


_RUN = " UNION ALL ".join(_run_sql(d) for d in range(lab.DAYS))


@query(f"""SELECT d AS snapshot_day, bronze AS total_rows_in_snapshot, new AS new_rows, changed AS changed_rows, unchanged AS unchanged_rows_skipped, new + changed AS incremental_volume_processed,
 CASE WHEN d > 0 THEN round((1.0::DOUBLE - (new + changed)::DOUBLE / bronze) * 100, 2) END AS reprocessing_reduction_pct, bronze - valid AS dq_invalid_rows, valid - clean AS dq_duplicate_rows, state AS merged_state_row_count, bronze = clean + (bronze - clean) AS row_conservation_passed FROM ({_RUN})""")
def q41_stored_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = "total_rows_in_snapshot new_rows changed_rows unchanged_rows_skipped incremental_volume_processed reprocessing_reduction_pct dq_invalid_rows dq_duplicate_rows merged_state_row_count row_conservation_passed"
    return lab.ran(spark, sf_dir).recon.read().select(F.col("snapshot_day").cast("int"), *names.split())


@query(f"SELECT {ROW}, _snapshot_day FROM ({lab.state_sql(lab.DAYS - 1)})")
def q42_stored_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lab.ran(spark, sf_dir).silver.read().select(*COLUMNS, "_snapshot_day")


@query(f"SELECT {ROW}, _snapshot_day FROM ({lab.state_sql(lab.DAYS - 2)})")
def q43_state_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The version before the current one, still kept."""
    silver = lab.ran(spark, sf_dir).silver
    return silver.read(silver.versions()[-2]).select(*COLUMNS, "_snapshot_day")


@query(f"SELECT k.*, true AS stamped FROM ({_KPI.format(lab.state_sql(lab.DAYS - 1))}) k")
def q44_stored_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPIs, whose last ingestion time is the newest of the machine's rows."""
    run = lab.ran(spark, sf_dir)
    newest = run.silver.read().groupBy(*RULES.group).agg(F.max("_ingestion_ts").alias("at"))
    rows = run.gold.read().join(newest, list(RULES.group)).withColumn("stamped", F.col("last_updated_ts") == F.col("at"))
    return _rounded(rows.drop("last_updated_ts", "at"))


@query(f"""SELECT * FROM (SELECT d AS _snapshot_day, 'bronze' AS stage, 'DQ001' AS error_code, landing - bronze AS n FROM ({_RUN}) UNION ALL SELECT d, 'silver_dq_gate', 'DQ002', bronze - valid FROM ({_RUN})
 UNION ALL SELECT d, 'silver_dq_gate', 'DQ003', valid - clean FROM ({_RUN})) WHERE n > 0""")
def q45_stored_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lab.ran(spark, sf_dir).quarantine.read().groupBy("_snapshot_day", "stage", "error_code").agg(F.count("*").alias("n"))


_GOLD_ROWS = [f"(SELECT count(*) FROM (SELECT DISTINCT customer_id, machine_id FROM ({lab.state_sql(d)})))" for d in range(lab.DAYS)]
_STAGES = f"""SELECT d, 'bronze' AS stage, landing AS rows_read, bronze AS rows_written, landing - bronze AS rows_rejected, 0 AS rows_skipped FROM ({_RUN})
 UNION ALL SELECT d, 'silver', bronze, new + changed, bronze - clean, unchanged FROM ({_RUN})
 UNION ALL SELECT d, 'gold', state, CASE d {' '.join(f'WHEN {d} THEN {sql}' for d, sql in enumerate(_GOLD_ROWS))} END, 0, 0 FROM ({_RUN})"""


@query(f"SELECT 'snapshot_day' || d || '.csv' AS source_file, stage, 'SUCCESS' AS status, rows_read, rows_written, rows_skipped::BIGINT AS rows_skipped FROM ({_STAGES})")
def q46_stored_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lab.ran(spark, sf_dir).control.current().select("source_file", "stage", "status", "rows_read", "rows_written", "rows_skipped")


@query(f"SELECT d AS snapshot_day, stage, 'SUCCESS' AS status, rows_read::INTEGER AS rows_read, rows_written::INTEGER AS rows_written, rows_rejected::INTEGER AS rows_rejected, rows_skipped::INTEGER AS rows_skipped, 1 AS files_processed FROM ({_STAGES})")
def q47_stored_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = lab.ran(spark, sf_dir)
    return run.audit.of_run().select("snapshot_day", "stage", "status", "rows_read", "rows_written", "rows_rejected", "rows_skipped", "files_processed")


_THERE = ("bronze", "silver", "gold", "reconciliation", "control", "audit", "schema_history")
_CHECKS = " UNION ALL ".join([*(f"SELECT d, '{n} exists' AS check_name, landing > 0 AS passed FROM ({_RUN})" for n in _THERE), f"""SELECT d, unnest(['gold succeeded for this file', 'reconciliation row exists', 'audit rows exist', 'no audit failures', 'schema versions exist']), clean > 0 FROM ({_RUN})
 UNION ALL SELECT d, 'rows written do not exceed rows read', rows_written <= rows_read FROM ({_STAGES}) WHERE stage = 'gold' UNION ALL SELECT d, 'row conservation', bronze = new + changed + unchanged + (bronze - valid) + (valid - clean) FROM ({_RUN})
 UNION ALL SELECT d, 'quarantine matches drops', bronze - clean = (bronze - valid) + (valid - clean) FROM ({_RUN}) UNION ALL SELECT d, 'silver does not exceed bronze', (SELECT max(state) <= sum(bronze) FROM ({_RUN})) FROM ({_RUN})
 UNION ALL SELECT d, 'silver has rows', state > 0 FROM ({_RUN}) UNION ALL SELECT d, 'gold has rows', state > 0 FROM ({_RUN})"""])


@query(f"WITH r AS MATERIALIZED ({_RUN}), g AS MATERIALIZED ({_STAGES}) SELECT d AS snapshot_day, check_name, passed FROM ({_CHECKS.replace(f'({_STAGES})', 'g').replace(f'({_RUN})', 'r')})")
def q48_stored_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validation battery, run again on the store, for each day."""
    run = lab.ran(spark, sf_dir)
    rows = [(d, c["check_name"], c["passed"]) for d in range(lab.DAYS) for c in validate(run.store, run.control.run_id, d, f"snapshot_day{d}.csv").checks]
    return spark.createDataFrame(rows, "snapshot_day int, check_name string, passed boolean")


@query(f"SELECT 1::BIGINT AS version, {_hash_sql('orders')} AS schema_hash UNION ALL SELECT 2, {_hash_sql(_LATER)}")
def q49_schema_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schema saved twice is one version."""
    return _orders_history(spark, sf_dir).versions.read().select("version", "schema_hash")


@query(f"SELECT '{lab.DAYS - 1}' AS watermark, count(DISTINCT d) AS days, min(d) AS first_day FROM ({_RUN})")
def q50_stored_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The watermark that the run left, beside the days that bronze holds as partitions."""
    run = lab.ran(spark, sf_dir)
    return run.bronze.read().agg(F.lit(run.control.watermark()).alias("watermark"), F.countDistinct("_snapshot_day").alias("days"), F.min("_snapshot_day").alias("first_day")).select("watermark", "days", "first_day")


@query(f"SELECT 'CUST' || lpad(c::VARCHAR, 3, '0') AS customer_id, true AS slots_follow, true AS ids_follow, true AS size_fits FROM range(1, 26) t(c)")
def q51_generated_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generator's roster and readings: ids in order, slots without a gap, 200 to 240 machines a customer."""
    from ..sources.snapshots import Shape, readings, roster

    shape = Shape(rows=12_000)
    machines = roster(spark, shape)
    own = machines.groupBy("customer_id").agg(F.count("*").alias("n"), (F.max("slot") - F.min("slot") + 1 == F.count("*")).alias("slots_follow"), (F.max(F.substring("machine_id", 7, 4).cast("int")) == F.count("*")).alias("ids"))
    rows = readings(spark, machines, 0, 1, shape.rows, shape)
    good = rows.groupBy("customer_id").agg(F.bool_and(F.col("fuel_level").between(2, 100) & F.col("payload_weight_t").between(0, 60) & (F.substring("machine_id", 4, 3) == F.substring("customer_id", 5, 3))).alias("fit"))
    return own.join(good, "customer_id").select("customer_id", "slots_follow", F.col("ids").alias("ids_follow"), (F.col("n").between(200, 240) & F.col("fit")).alias("size_fits"))
