"""The driver tables seen as telemetry: base rows and daily snapshots, in DataFrames and as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TELEMETRY, RuleSet

#: The first instant after each snapshot's rows.
CUTS = ("2024-01-07", "2024-01-13", "2024-01-19", "2024-01-25", "2024-01-31")
#: The telemetry rules for columns these tables have.
RULES = RuleSet(
    columns={c: t for c, t in TELEMETRY.columns.items() if not c.startswith("gps")}, key=TELEMETRY.key, required=TELEMETRY.required, ranges=TELEMETRY.ranges,
    tracked=TELEMETRY.tracked, group=TELEMETRY.group, fault=TELEMETRY.fault,
)
COLUMNS = tuple(RULES.columns)
ROW = ", ".join(COLUMNS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per event; values beyond the rules' ranges do occur."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("reading_id"), F.concat(F.lit("CUST"), F.col("user_id") % 25).alias("customer_id"), F.concat(F.lit("MCH"), F.col("user_id")).alias("machine_id"), F.col("ts").cast("string").alias("event_ts"),
        F.col("value").alias("fuel_level"), F.get_json_object("props", "$.k").cast("double").alias("payload_weight_t"), F.when(F.col("event_type") == "error", "F204_ENGINE_TEMP").otherwise("NONE").alias("fault_code"),
    )


TELEMETRY_SQL = """SELECT event_id AS reading_id, 'CUST' || (user_id % 25) AS customer_id, 'MCH' || user_id AS machine_id, CAST(ts AS VARCHAR) AS event_ts, value AS fuel_level,
 CAST(json_extract_string(props, '$.k') AS DOUBLE) AS payload_weight_t, CASE WHEN event_type = 'error' THEN 'F204_ENGINE_TEMP' ELSE 'NONE' END AS fault_code FROM events"""


def snapshot(base: DataFrame, day: int) -> DataFrame:
    """Rows before the day's cut; each day from 1 on corrects the fuel of 4 % of ids and ages 3 % out, for good."""
    rows = base.where((F.col("event_ts") < CUTS[day]) & ~(F.col("reading_id") % 33).between(1, day))
    return rows.withColumn("fuel_level", F.when((F.col("reading_id") % 25).between(1, day), F.col("fuel_level") + 1.5).otherwise(F.col("fuel_level"))).withColumn("_snapshot_day", F.lit(day))


def snapshot_sql(day: int, base: str = TELEMETRY_SQL) -> str:
    return f"""SELECT reading_id, customer_id, machine_id, event_ts, CASE WHEN reading_id % 25 BETWEEN 1 AND {day} THEN fuel_level + 1.5 ELSE fuel_level END AS fuel_level,
 payload_weight_t, fault_code, {day} AS _snapshot_day FROM ({base}) WHERE event_ts < '{CUTS[day]}' AND NOT (reading_id % 33 BETWEEN 1 AND {day})"""


def holed(df: DataFrame) -> DataFrame:
    """df with nulls: a fault code in 7, a payload in 11, a customer in 50."""
    hole = lambda c, k: F.when(F.col("reading_id") % k != 0, F.col(c)).alias(c)
    return df.select(*[hole(c, {"fault_code": 7, "payload_weight_t": 11, "customer_id": 50}[c]) if c in ("fault_code", "payload_weight_t", "customer_id") else c for c in df.columns])


def holed_sql(sql: str) -> str:
    return f"""SELECT * REPLACE (CASE WHEN reading_id % 7 <> 0 THEN fault_code END AS fault_code, CASE WHEN reading_id % 11 <> 0 THEN payload_weight_t END AS payload_weight_t,
 CASE WHEN reading_id % 50 <> 0 THEN customer_id END AS customer_id) FROM ({sql})"""


VALID_SQL = "(reading_id IS NOT NULL AND customer_id IS NOT NULL AND machine_id IS NOT NULL AND fuel_level IS NOT NULL AND fuel_level BETWEEN 0 AND 100 AND payload_weight_t IS NOT NULL AND payload_weight_t BETWEEN 0 AND 60)"


def clean_sql(sql: str) -> str:
    return f"SELECT * FROM ({sql}) WHERE {VALID_SQL}"


def evolve_sql(current: str, prior: str, extra: str = "_snapshot_day") -> str:
    """All columns and _change_type of the merge of two keyed frames."""
    kind = """CASE WHEN p.reading_id IS NULL THEN 'NEW' WHEN c.reading_id IS NULL THEN 'RETAINED' WHEN c.fuel_level IS DISTINCT FROM p.fuel_level
 OR c.payload_weight_t IS DISTINCT FROM p.payload_weight_t OR c.fault_code IS DISTINCT FROM p.fault_code THEN 'CHANGED' ELSE 'UNCHANGED' END"""
    names = [*COLUMNS, *([extra] if extra else [])]
    pick = ", ".join(f"CASE WHEN k IN ('NEW', 'CHANGED') THEN c_{n} ELSE p_{n} END AS {n}" for n in names)
    both = ", ".join(f"c.{n} AS c_{n}, p.{n} AS p_{n}" for n in names)
    return f"SELECT {pick}, k AS _change_type FROM (SELECT {both}, {kind} AS k FROM ({current}) c FULL OUTER JOIN ({prior}) p ON c.reading_id = p.reading_id)"


def state_sql(day: int) -> str:
    """The state after the day's merge."""
    clean = clean_sql(snapshot_sql(day))
    return f"SELECT * FROM ({clean})" if day == 0 else f"SELECT * EXCLUDE (_change_type) FROM ({evolve_sql(clean, state_sql(day - 1))})"
