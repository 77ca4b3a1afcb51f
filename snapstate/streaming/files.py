"""Incremental ingestion by a file stream: each new snapshot file goes through the batch stages once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.pipeline import Pipeline
from ..sources.landing import day_of


def run_available(pipeline: Pipeline, checkpoint: str, pattern: str = "snapshot_day*.csv") -> list[int]:
    """Processes the snapshots that the checkpoint has not seen, in order of days, then stops.

    The stream only tells which files are new (their content is not read): rows are read again by header name, as a
    stream's declared schema would bind by position. Stages are idempotent per snapshot, so a batch that is replayed
    after a failure does no harm. A snapshot is a file, or a folder of part files.
    """
    spark, days = pipeline.spark, []
    paths = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("maxFilesPerTrigger", 1000).load(f"{pipeline.settings.path('landing')}/{pattern}").select("path")

    def each(batch: DataFrame, _: int) -> None:
        found = batch.select(F.regexp_extract("path", r"^(.*snapshot_day\d+\.csv)", 1).alias("path")).distinct().collect()  # a name per snapshot
        for day, path in sorted((day_of(r["path"]), r["path"]) for r in found if r["path"]):
            pipeline.run_day(day, path)
            days.append(day)

    query = paths.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()
    query.awaitTermination()
    return days
