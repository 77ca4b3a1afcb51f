"""Schema identity, drift and validation on the driver. Column order and nullability are not part of identity."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Drift:
    change_type: str  # COLUMN_ADDED, COLUMN_REMOVED or TYPE_CHANGED
    column_name: str
    old_type: str | None
    new_type: str | None

    def as_dict(self) -> dict[str, str | None]:
        return asdict(self)


def types_of(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def schema_json(types: Mapping[str, str]) -> str:
    return json.dumps(dict(types), sort_keys=True)


def schema_hash(types: Mapping[str, str]) -> str:
    return hashlib.sha256(schema_json(types).encode()).hexdigest()


def compare(old: Mapping[str, str], new: Mapping[str, str]) -> list[Drift]:
    """Differences, by column name."""
    out = []
    for name in sorted({*old, *new}):
        before, after = old.get(name), new.get(name)
        if before != after:
            kind = "COLUMN_ADDED" if before is None else "COLUMN_REMOVED" if after is None else "TYPE_CHANGED"
            out.append(Drift(kind, name, before, after))
    return out


def has_changed(old: Mapping[str, str], new: Mapping[str, str]) -> bool:
    return schema_hash(old) != schema_hash(new)


def drift_report(changes: Iterable[Drift]) -> str:
    lines = [f"{c.change_type}: {c.column_name} ({c.old_type or '-'} -> {c.new_type or '-'})" for c in changes]
    return "\n".join(lines) or "no schema changes"


def has_column(df: DataFrame, name: str) -> bool:
    return name in df.columns


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    if missing := sorted(set(names) - set(df.columns)):
        raise ValueError(f"missing columns: {', '.join(missing)}")


def require_types(df: DataFrame, expected: Mapping[str, str]) -> None:
    require_columns(df, expected)
    found = types_of(df)
    if wrong := [f"{n} is {found[n]}, not {t}" for n, t in expected.items() if found[n] != t]:
        raise TypeError("; ".join(wrong))
