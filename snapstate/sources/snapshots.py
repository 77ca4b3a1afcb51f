"""Generated snapshots: a roster of machines, blocks of readings and daily churn, all functions of row numbers.

Values come from hashes of (seed, purpose, row number), so any part of a snapshot can be made on its own, on any
number of tasks, and again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import Folder

SEQUENCE = "_next_reading_id"
#: Fault slots (20 of 25 healthy) and the shape of readings and churn.
HEALTHY_SLOTS = 20
FAULTS = ("F101_LOW_FUEL", "F204_ENGINE_TEMP", "F310_HYDRAULIC", "F450_GPS_LOSS", "F512_PAYLOAD_OVERLOAD")
FUEL, PAYLOAD = (55.0, 20.0, 2.0, 100.0, 1), (28.0, 9.0, 0.0, 60.0, 2)  # mean, deviation, least, most, decimals


@dataclass(frozen=True)
class Shape:
    customers: int = 25
    machines_low: int = 200
    machines_high: int = 240
    rows: int = 2_000_000
    corrected: float = 0.04
    aged_out: float = 0.03
    new: float = 0.03
    seed: int = 42


def _unit(purpose: str, seed: int, *on: Column) -> Column:
    """Uniform in (0, 1)."""
    return (F.pmod(F.xxhash64(F.lit(purpose), F.lit(seed), *on), F.lit(1 << 40)) + 0.5) / float(1 << 40)


def _normal(purpose: str, seed: int, shape: tuple, *on: Column) -> Column:
    mean, deviation, least, most, decimals = shape
    z = F.sqrt(-2 * F.log(_unit(f"{purpose}a", seed, *on))) * F.cos(2 * 3.141592653589793 * _unit(f"{purpose}b", seed, *on))
    return F.round(F.least(F.greatest(z * deviation + mean, F.lit(least)), F.lit(most)), decimals)


def roster(spark: SparkSession, shape: Shape = Shape()) -> DataFrame:
    """customer_id, machine_id, base_lat, base_lon and slot, numbered from 0."""
    c = spark.range(1, shape.customers + 1).withColumnRenamed("id", "c")
    n = F.lit(shape.machines_low) + F.floor(_unit("n", shape.seed, F.col("c")) * (shape.machines_high - shape.machines_low + 1))
    m = c.select("c", F.posexplode(F.sequence(F.lit(1), n.cast("int"))).alias("_", "m"))
    per = c.select("c", n.alias("n"))
    before = {r["c"]: r["n"] for r in per.collect()}  # one row per customer of the shape
    start, total = {}, 0
    for k in sorted(before):
        start[k] = total
        total += before[k]
    offset = F.create_map(*[F.lit(x) for k in sorted(start) for x in (k, start[k])])
    return m.select(
        F.format_string("CUST%03d", "c").alias("customer_id"), F.format_string("MCH%03d%04d", "c", "m").alias("machine_id"),
        F.round(-33.9 + 21.5 * _unit("lat", shape.seed, F.col("c"), F.col("m")), 6).alias("base_lat"), F.round(115.8 + 35.1 * _unit("lon", shape.seed, F.col("c"), F.col("m")), 6).alias("base_lon"),
        (F.element_at(offset, F.col("c")) + F.col("m") - 1).cast("long").alias("slot"),
    )


def readings(spark: SparkSession, machines: DataFrame, day: int, start: int, rows: int, shape: Shape = Shape()) -> DataFrame:
    """`rows` readings from reading_id `start`, dealt over the machines by turns."""
    n = machines.count()
    ids = spark.range(start, start + rows).select(F.col("id").alias("reading_id"), F.pmod("id", F.lit(max(1, n))).alias("slot"))
    rid = F.col("reading_id")
    fault = _fault("fault", shape.seed, rid)
    stamp = F.date_format(F.timestamp_seconds(F.lit(1781395200 + 86400 * day) + F.pmod(rid * 37, F.lit(86400))), "yyyy-MM-dd'T'HH:mm:ss")
    return ids.join(machines, "slot").select(
        "reading_id", "customer_id", "machine_id", stamp.alias("event_ts"), F.round(F.col("base_lat") + 0.02 * (_unit("jlat", shape.seed, rid) - 0.5), 6).alias("gps_lat"), F.round(F.col("base_lon") + 0.02 * (_unit("jlon", shape.seed, rid) - 0.5), 6).alias("gps_lon"),
        _normal("fuel", shape.seed, FUEL, rid).alias("fuel_level"), _normal("load", shape.seed, PAYLOAD, rid).alias("payload_weight_t"), fault.alias("fault_code"),
    )


def churned(previous: DataFrame, arrivals: DataFrame, gone: Column, hit: Column, fixes: dict[str, Column]) -> DataFrame:
    """The next day's rows: those `gone` leave, those `hit` get the fixed values, the arrivals are added."""
    kept = previous.where(~gone)
    return kept.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in fixes.items()}).unionByName(arrivals)


def _fault(purpose: str, seed: int, *on: Column) -> Column:
    slot = F.floor(_unit(purpose, seed, *on) * (HEALTHY_SLOTS + len(FAULTS))).cast("int")
    return F.when(slot < HEALTHY_SLOTS, F.lit("NONE")).otherwise(F.element_at(F.array(*map(F.lit, FAULTS)), F.greatest(slot - HEALTHY_SLOTS + 1, F.lit(1))))


def churn(previous: DataFrame, arrivals: DataFrame, day: int, shape: Shape = Shape()) -> DataFrame:
    """The next day's snapshot: some rows corrected in their tracked columns, some gone, the arrivals added."""
    rid = F.col("reading_id")

    def moved(column: str, purpose: str, by: float, limits: tuple) -> Column:
        jitter = by * (_unit(f"{purpose}{day}", shape.seed, rid) - 0.5)
        return F.round(F.least(F.greatest(F.col(column) + jitter, F.lit(limits[2])), F.lit(limits[3])), limits[4])

    fixes = {"fuel_level": moved("fuel_level", "fa", 10, FUEL), "payload_weight_t": moved("payload_weight_t", "pa", 4, PAYLOAD), "fault_code": _fault(f"ff{day}", shape.seed, rid)}
    return churned(previous, arrivals, _unit(f"age{day}", shape.seed, rid) < shape.aged_out, _unit(f"fix{day}", shape.seed, rid) < shape.corrected, fixes)


def next_reading(snapshot: DataFrame) -> int:
    """The first unused reading_id."""
    top = snapshot.agg(F.max("reading_id").alias("m")).first()["m"]
    return 1 if top is None else top + 1


def snapshot(spark: SparkSession, day: int, shape: Shape = Shape()) -> DataFrame:
    """The snapshot of a day, from day 0 on; the number of rows stays about the same."""
    machines = roster(spark, shape)
    out, seq = readings(spark, machines, 0, 1, shape.rows, shape), shape.rows + 1
    extra = round(shape.rows * shape.new)
    for d in range(1, day + 1):
        out, seq = churn(out, readings(spark, machines, d, seq, extra, shape), d, shape), seq + extra
    return out


def clean_days(spark: SparkSession, folder: str) -> None:
    """Removes the snapshots of a landing folder, and the stored sequence."""
    landing = Folder(spark, folder)
    for name in landing.names():
        if name.startswith("snapshot_day") or name == SEQUENCE:
            landing.delete(name)


def write_next_day(spark: SparkSession, folder: str, day: int, shape: Shape = Shape()) -> None:
    """Writes one day's snapshot from the stored one of the day before (day 0 from nothing). The next free reading_id is
    kept beside the snapshots; where that file is missing, it is found in the snapshot."""
    landing, machines, base = Folder(spark, folder), roster(spark, shape), folder.rstrip("/")
    landing.make()
    if day == 0:
        out, seq = readings(spark, machines, 0, 1, shape.rows, shape), shape.rows + 1
    else:
        names = {"reading_id": "long", "gps_lat": "double", "gps_lon": "double", "fuel_level": "double", "payload_weight_t": "double"}
        before = spark.read.option("header", True).csv(f"{base}/snapshot_day{day - 1}.csv")
        before = before.select(*[F.col(c).cast(names[c]) if c in names else F.col(c) for c in before.columns])
        start = int(landing.read_text(SEQUENCE)) if landing.exists(SEQUENCE) else next_reading(before)
        extra = round(shape.rows * shape.new)
        out, seq = churn(before, readings(spark, machines, day, start, extra, shape), day, shape), start + extra
    out.write.mode("overwrite").option("header", True).csv(f"{base}/snapshot_day{day}.csv")
    landing.write_text(SEQUENCE, str(seq))


def write_days(spark: SparkSession, folder: str, days: range, shape: Shape = Shape()) -> None:
    """Writes each day as a header CSV folder snapshot_day{N}.csv, and the roster and the next reading_id beside them."""
    for d in days:
        snapshot(spark, d, shape).write.mode("overwrite").option("header", True).csv(f"{folder.rstrip('/')}/snapshot_day{d}.csv")
        Folder(spark, folder).write_text(SEQUENCE, str(shape.rows + 1 + d * round(shape.rows * shape.new)))
    roster(spark, shape).drop("slot").coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder.rstrip('/')}/machine_roster.csv")
