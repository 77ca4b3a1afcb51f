"""Settings of a pipeline, from a dict or a JSON file."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

#: The folders of a pipeline.
FOLDERS = ("landing", "bronze", "silver", "gold", "quarantine", "control", "audit", "schema_history", "schema_changes", "reconciliation", "watermark", "reports")


@dataclass(frozen=True)
class Settings:
    base_path: str
    pipeline: str = "incremental_batch_pipeline"
    kind: str = "incremental_batch"
    load_type: str = "snapshot"
    database: str | None = None
    source_format: str = "csv"
    source_options: dict[str, object] = field(default_factory=dict)
    target_format: str = "parquet"
    environment: str = "local"
    folders: dict[str, str] = field(default_factory=dict)
    tables: dict[str, str] = field(default_factory=dict)
    stop_on_failure: bool = True
    segment_rows: int = 50_000_000  # consecutive keys of a segment of the state; it is written as at most 64 files

    def path(self, name: str) -> str:
        if name not in FOLDERS:
            raise KeyError(name)
        return f"{self.base_path.rstrip('/')}/{self.folders.get(name, name)}"

    def table(self, name: str) -> str:
        """The catalog's name of a table, with the database where one is set."""
        if name not in FOLDERS:
            raise KeyError(name)
        own = self.tables.get(name, name)
        return f"{self.database}.{own}" if self.database else own

    @classmethod
    def load(cls, path: str | Path, base_path: str | None = None) -> Settings:
        """Reads the keys it knows, either flat or in sections pipeline, source and paths."""
        data = json.loads(Path(path).read_text())
        pipe, source, target, paths = (data.get(k, {}) for k in ("pipeline", "source", "target", "paths"))
        pipe = {"name": pipe} if isinstance(pipe, str) else pipe
        return cls(
            base_path=base_path or data.get("base_path") or paths.get("base_path") or "data",
            pipeline=pipe.get("name", cls.pipeline), kind=pipe.get("type", cls.kind), load_type=data.get("load_type", cls.load_type), database=data.get("database"),
            source_format=source.get("format", cls.source_format), source_options=source.get("options", {}), target_format=target.get("format", cls.target_format),
            environment=data.get("environment", cls.environment), folders=paths.get("folders", {}), tables=data.get("tables", {}), stop_on_failure=data.get("stop_on_failure", True), segment_rows=data.get("segment_rows", cls.segment_rows),
        )
