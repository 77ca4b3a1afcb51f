"""A store that queries run against: the driver tables as landing files, taken through the daily run.

It is made once for each application and table folder, in the shared scratch folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..sources.store import Store
from . import views as V
from .pipeline import Pipeline
from .views import COLUMNS, RULES

DAYS = 3
_MADE: dict[tuple[str, str], Pipeline] = {}


def scratch(spark: SparkSession) -> str:
    """A new folder in spark.checkpoint.dir; a local one only in sessions without executors of their own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/snapstate-lab-{uuid.uuid4().hex}"


def landing_day(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    """A day's rows with nulls, and a second version of every 20th."""
    rows = V.holed(V.snapshot(V.telemetry(spark, sf_dir), day)).drop("_snapshot_day")
    return rows.unionByName(rows.where("reading_id % 20 = 0").withColumn("payload_weight_t", F.col("payload_weight_t") + 0.5))


def landing_sql(day: int) -> str:
    rows = f"SELECT * EXCLUDE (_snapshot_day) FROM ({V.holed_sql(V.snapshot_sql(day))})"
    return f"SELECT * FROM ({rows}) UNION ALL SELECT * REPLACE (payload_weight_t + 0.5 AS payload_weight_t) FROM ({rows}) WHERE reading_id % 20 = 0"


def clean_sql(day: int) -> str:
    return f"SELECT * EXCLUDE (rn), {day} AS _snapshot_day FROM (SELECT *, row_number() OVER (PARTITION BY reading_id ORDER BY payload_weight_t DESC) AS rn FROM ({landing_sql(day)}) WHERE {V.VALID_SQL}) WHERE rn = 1"


def state_sql(day: int) -> str:
    return f"SELECT * FROM ({clean_sql(0)})" if day == 0 else f"SELECT * EXCLUDE (_change_type) FROM ({V.evolve_sql(clean_sql(day), state_sql(day - 1))})"


def ran(spark: SparkSession, sf_dir: str) -> Pipeline:
    """The pipeline after DAYS days, from header CSV files whose columns stand in another order and have one more."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MADE:
        pipeline = Pipeline(spark, Settings(scratch(spark)), RULES)
        for day in range(DAYS):
            rows = landing_day(spark, sf_dir, day).select(F.lit("depot").alias("site"), *reversed(COLUMNS))
            rows.write.option("header", True).csv(f"{pipeline.settings.path('landing')}/snapshot_day{day}.csv")
        pipeline.run_pending()
        _MADE[key] = pipeline
    return _MADE[key]


def store(spark: SparkSession) -> Store:
    """An empty store."""
    return Store(spark, scratch(spark))
