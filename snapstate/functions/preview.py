"""Previews of frames for logs and consoles."""

from __future__ import annotations

from pyspark.sql import DataFrame


def preview(df: DataFrame, rows: int = 10, width: int = 40) -> str:
    """The schema and the first rows as text; only these rows come to the driver."""
    found = df.limit(rows).collect()
    cells = [df.columns, *[["" if v is None else str(v)[:width] for v in r] for r in found]]
    widths = [max(map(len, column)) for column in zip(*cells, strict=True)]
    lines = [" | ".join(v.ljust(w) for v, w in zip(row, widths, strict=True)).rstrip() for row in cells]
    return "\n".join([", ".join(f"{n}: {t}" for n, t in df.dtypes), *lines])
