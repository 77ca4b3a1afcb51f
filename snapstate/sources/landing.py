"""Landing files: discovery, and reads that bind columns by header name."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .store import Folder

DEFAULT_OPTIONS = {"header": "true", "delimiter": ","}
_DAY = re.compile(r"snapshot_day(\d+)\.csv")


def read_landing(spark: SparkSession, path: str, options: Mapping[str, object] | None = None, fmt: str = "csv") -> DataFrame:
    """All columns as strings, named by the header. A declared schema would bind by position, and inference would make
    types depend on the day's values; a configured inferSchema is therefore not passed on."""
    chosen = DEFAULT_OPTIONS | {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in (options or {}).items() if k.lower() != "inferschema"}
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**chosen)
    return reader.load(path)


def snapshot_days(spark: SparkSession, folder: str) -> dict[int, str]:
    """Day -> path of each snapshot file, in numeric order of days."""
    found = {int(m[1]): n for n in Folder(spark, folder).names() if (m := _DAY.fullmatch(n))}
    return {d: f"{folder.rstrip('/')}/{found[d]}" for d in sorted(found)}


def day_of(path: str) -> int:
    m = _DAY.search(path)
    if not m:
        raise ValueError(f"no snapshot day in {path}")
    return int(m[1])
