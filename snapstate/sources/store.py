"""Tables over plain Parquet: versioned state with snapshot swap, and append tables with schema evolution.

A StateTable's version is a folder v=N with a marker written after its data; readers take the highest marked version,
so a swap is one small file and a failed write leaves nothing visible. Writing (stage) and showing (publish) are two
steps, and the marker carries a note, so that what belongs to a version can be written in between and told after a
failure. A version may be cut into segments: it then writes those that changed and names, in a manifest, the earlier
versions whose folders hold the others. An AppendTable keeps its schema in a file beside its data: reads need no footers. One writer at a time is
assumed. Paths go through Hadoop's file systems, so any store that Spark reads will do.
"""

from __future__ import annotations

import json
import re
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARKER, SCHEMA, MANIFEST = "_COMMITTED", "_SCHEMA", "_MANIFEST"
SEGMENT = "_segment"  # the column that a segmented version's folders are named by


class Folder:
    """A folder of a Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._of = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._of(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._of(f"{self.path}/{name}" if name else self.path))

    def names(self) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._of(self.path))) if self.exists() else []

    def make(self) -> None:
        self._fs.mkdirs(self._of(self.path))

    def write_text(self, name: str, text: str) -> None:
        out = self._fs.create(self._of(f"{self.path}/{name}"), True)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()

    def read_text(self, name: str) -> str:
        got = self._fs.open(self._of(f"{self.path}/{name}"))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(got, "UTF-8")
        finally:
            got.close()

    def delete(self, name: str) -> None:
        self._fs.delete(self._of(f"{self.path}/{name}"), True)


class StateTable:
    def __init__(self, spark: SparkSession, path: str, keep_versions: int = 2):
        self.spark, self.path, self.keep_versions = spark, path.rstrip("/"), keep_versions
        self.folder = Folder(spark, path)

    def _folders(self) -> list[int]:
        return sorted(int(m[1]) for n in self.folder.names() if (m := re.fullmatch(r"v=(\d+)", n)))

    def versions(self) -> list[int]:
        return [v for v in self._folders() if self.folder.exists(f"v={v}/{MARKER}")]

    def exists(self) -> bool:
        return bool(self.versions())

    def _manifest(self, version: int) -> dict[str, object]:
        name = f"v={version}/{MANIFEST}"
        return json.loads(self.folder.read_text(name)) if self.folder.exists(name) else {}

    def segments(self, rows_each: int) -> dict[int, int] | None:
        """Segment -> version whose folder holds it, of the current version; None if that is not cut by rows_each."""
        known = self.versions()
        manifest = self._manifest(known[-1]) if known else {}
        return {int(k): v for k, v in manifest["segments"].items()} if manifest.get("rows_each") == rows_each else None

    def segment_paths(self, version: int) -> dict[int, str]:
        return {int(s): f"{self.path}/v={v}/{SEGMENT}={s}" for s, v in self._manifest(version).get("segments", {}).items()}

    def read(self, version: int | None = None, segments: Collection[int] | None = None) -> DataFrame:
        """The current version or another that is kept; of a segmented one also some segments only."""
        known = self.versions()
        if not known or (version is not None and version not in known):
            raise FileNotFoundError(f"{self.path} has no version {version if version is not None else ''}".rstrip())
        version = known[-1] if version is None else version
        manifest = self._manifest(version)
        if not manifest:
            return self.spark.read.parquet(f"{self.path}/v={version}")
        schema = T.StructType.fromJson(manifest["schema"])
        paths = [p for s, p in self.segment_paths(version).items() if segments is None or s in segments]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read_or_empty(self, schema: T.StructType) -> DataFrame:
        return self.read() if self.exists() else self.spark.createDataFrame([], schema)

    def stage(self, df: DataFrame) -> int:
        """Writes df, which may read the current version, as the next one, not yet shown."""
        known = self.versions()
        nxt = known[-1] + 1 if known else 0
        self.folder.delete(f"v={nxt}")  # what a failed write left
        df.write.parquet(f"{self.path}/v={nxt}")
        return nxt

    def stage_segments(self, df: DataFrame, rows_each: int, kept: Mapping[int, int]) -> int:
        """Like stage(), for rows with their SEGMENT; the segments in `kept` stay in the versions that hold them."""
        known = self.versions()
        nxt = known[-1] + 1 if known else 0
        self.folder.delete(f"v={nxt}")
        df.write.partitionBy(SEGMENT).parquet(f"{self.path}/v={nxt}")
        names = Folder(self.spark, f"{self.path}/v={nxt}").names()
        written = {int(n.partition("=")[2]): nxt for n in names if n.startswith(f"{SEGMENT}=")}
        manifest = {"rows_each": rows_each, "segments": {**kept, **written}, "schema": df.drop(SEGMENT).schema.jsonValue()}
        self.folder.write_text(f"v={nxt}/{MANIFEST}", json.dumps(manifest))
        return nxt

    def publish(self, version: int, note: Mapping[str, object] | None = None) -> int:
        """Shows a staged version, with a note in its marker, and drops versions no longer kept, but for segments that
        kept ones still refer to."""
        self.folder.write_text(f"v={version}/{MARKER}", json.dumps(dict(note or {}), sort_keys=True, default=str))
        kept = self.versions()[-self.keep_versions :]
        live = {f"v={v}/{SEGMENT}={s}" for k in kept for s, v in self._manifest(k).get("segments", {}).items()}
        for old in (v for v in self._folders() if v < kept[0]):
            inside = [f"v={old}/{n}" for n in Folder(self.spark, f"{self.path}/v={old}").names()]
            for name in [f"v={old}"] if live.isdisjoint(inside) else sorted(set(inside) - live, key=lambda n: MARKER not in n):
                self.folder.delete(name)
        return version

    def note(self) -> dict[str, object]:
        """The note of the current version."""
        known = self.versions()
        return json.loads(self.folder.read_text(f"v={known[-1]}/{MARKER}") or "{}") if known else {}

    def commit(self, df: DataFrame, note: Mapping[str, object] | None = None) -> int:
        return self.publish(self.stage(df), note)

    def rollback(self) -> int:
        """Hides the newest version; the one before it becomes current."""
        known = self.versions()
        if len(known) < 2:
            raise ValueError("no earlier version is kept")
        self.folder.delete(f"v={known[-1]}")
        return known[-2]


class AppendTable:
    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str] = (), schema: T.StructType | None = None):
        self.spark, self.path, self.partition_by, self.schema = spark, path.rstrip("/"), list(partition_by), schema
        self.folder = Folder(spark, path)

    def exists(self) -> bool:
        return any("=" in n or not n.startswith(("_", ".")) for n in self.folder.names())

    def stored_schema(self) -> T.StructType | None:
        """The columns of all writes so far, by the file beside the data."""
        return T.StructType.fromJson(json.loads(self.folder.read_text(SCHEMA))) if self.folder.exists(SCHEMA) else None

    def _record(self, df: DataFrame) -> None:
        """Adds columns that the table did not have. It is written before the data: a column without data reads null."""
        known = self.stored_schema()
        names = [] if known is None else known.names
        if fresh := [f for f in df.schema if f.name not in names]:
            fields = [T.StructField(f.name, f.dataType) for f in [*(known or []), *fresh]]
            last = set(self.partition_by)
            self.folder.make()
            self.folder.write_text(SCHEMA, T.StructType(sorted(fields, key=lambda f: f.name in last)).json())

    def _checked(self, df: DataFrame) -> DataFrame:
        """Parquet does not keep NOT NULL; declared columns are checked here, row by row as they are written."""
        if self.schema is None:
            return df
        cols = [F.col(f.name).cast(f.dataType) if f.nullable else F.coalesce(F.col(f.name).cast(f.dataType), F.raise_error(F.lit(f"{f.name} must not be null")).cast(f.dataType)) for f in self.schema]
        return df.select(*[c.alias(f.name) for c, f in zip(cols, self.schema, strict=True)])

    def append(self, df: DataFrame) -> None:
        self._record(df)
        self._checked(df).write.partitionBy(*self.partition_by).mode("append").parquet(self.path)

    def replace_partitions(self, df: DataFrame) -> None:
        """Overwrites only the partitions that df has rows for: a repeated write leaves one copy."""
        self._record(df)
        self._checked(df).write.partitionBy(*self.partition_by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path)

    def replace_partition(self, df: DataFrame, rows: int, **values: object) -> None:
        """Makes df, of `rows` rows, the content of one partition, also where it has none."""
        if list(values) != self.partition_by:
            raise ValueError(f"partitions of {self.path} are by {', '.join(self.partition_by)}")
        if rows:
            self.replace_partitions(df.withColumns({k: F.lit(v) for k, v in values.items()}))
        else:
            self.folder.delete("/".join(f"{k}={v}" for k, v in values.items()))

    def read(self) -> DataFrame:
        known = self.schema or self.stored_schema()
        if not self.exists():
            if known is None:
                raise FileNotFoundError(self.path)
            return self.spark.createDataFrame([], known)
        return self.spark.read.schema(known).parquet(self.path) if known else self.spark.read.option("mergeSchema", "true").parquet(self.path)


class Store:
    """Names the tables under one base path. With a catalog database, tables are registered there when they are written
    (register) and read by name."""

    def __init__(self, spark: SparkSession, base: str, database: str | None = None):
        self.spark, self.base, self.database = spark, base.rstrip("/"), database

    def bootstrap(self, names: Sequence[str]) -> None:
        for n in names:
            Folder(self.spark, f"{self.base}/{n}").make()
        if self.database:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")

    def state(self, name: str) -> StateTable:
        return StateTable(self.spark, f"{self.base}/{name}")

    def log(self, name: str, schema: T.StructType | None = None, partition_by: Sequence[str] = ()) -> AppendTable:
        return AppendTable(self.spark, f"{self.base}/{name}", partition_by, schema)

    def _named(self, name: str) -> str:
        return f"`{self.database}`.`{name}`"

    def table_exists(self, name: str) -> bool:
        if self.database and self.spark.catalog.tableExists(f"{self.database}.{name}"):
            return True
        return self.state(name).exists() or self.log(name).exists()

    def register(self, name: str) -> None:
        """Points the catalog's table at what is now current; a no-op without a database. The old entry is external, so
        dropping it deletes no data."""
        if not self.database:
            return
        state = self.state(name)
        known = state.versions()
        path = f"{state.path}/v={known[-1]}" if known else self.log(name).path
        parts = state.segment_paths(known[-1]) if known else {}
        columns = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in self._stored(name).schema), *([f"{SEGMENT} bigint"] if parts else [])])
        by = [SEGMENT] if parts else [] if known else self._partitions(path)
        self.spark.sql(f"DROP TABLE IF EXISTS {self._named(name)}")
        self.spark.sql(f"CREATE TABLE {self._named(name)} ({columns}) USING parquet {'PARTITIONED BY (' + ', '.join(by) + ')' if by else ''} LOCATION '{path}'")
        if parts:
            self.spark.sql(f"ALTER TABLE {self._named(name)} ADD " + " ".join(f"PARTITION ({SEGMENT} = {s}) LOCATION '{p}'" for s, p in parts.items()))
        elif by:
            self.spark.sql(f"MSCK REPAIR TABLE {self._named(name)}")

    def _partitions(self, path: str) -> list[str]:
        """Partition columns by the first folder of each level."""
        out, folder = [], Folder(self.spark, path)
        while found := [n for n in folder.names() if "=" in n]:
            out.append(found[0].partition("=")[0])
            folder = Folder(self.spark, f"{folder.path}/{found[0]}")
        return out

    def _stored(self, name: str) -> DataFrame:
        state = self.state(name)
        return state.read() if state.exists() else self.log(name).read()

    def read(self, name: str) -> DataFrame:
        if self.database and self.spark.catalog.tableExists(f"{self.database}.{name}"):
            return self.spark.table(f"{self.database}.{name}").drop(SEGMENT)
        return self._stored(name)
