"""Data layout for pruning: range layout and Z-order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def range_layout(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Files with disjoint ranges of the columns, sorted inside."""
    cols = [F.col(c) for c in columns]
    return (df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)).sortWithinPartitions(*cols)


def interleaved(codes: Sequence[Column], bits: int) -> Column:
    """Morton code of small integers: bit k of column j becomes bit k * n + j."""
    out = F.lit(0).cast("long")
    for j, code in enumerate(codes):
        for k in range(bits):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(code.cast("long"), k).bitwiseAND(F.lit(1).cast("long")), k * len(codes) + j))
    return out


def z_order(df: DataFrame, columns: Sequence[str], partitions: int | None = None, bits: int = 8, error: float = 0.002) -> DataFrame:
    """Orders rows along a Z curve through the columns' ranks among approximate quantiles; nulls rank first.

    One aggregation finds 2**bits quantiles of each column, within the relative error, in bounded memory whatever the
    number of values; a row's rank is the number of quantiles below it. Columns must be numbers, dates or timestamps;
    strings take the ranks of their first 7 bytes.
    """
    numbers = [_as_number(df, c) for c in columns]
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    row = df.agg(*[F.percentile_approx(n, shares, int(1 / error)).alias(f"q{j}") for j, n in enumerate(numbers)]).first()
    codes = []
    for j, n in enumerate(numbers):
        codes.append(_rank(n, sorted({float(e) for e in row[f"q{j}"] or []})))
    return range_layout(df.withColumn("_z", interleaved(codes, bits)), ["_z"], partitions).drop("_z")


def _rank(value: Column, edges: list[float]) -> Column:
    below = F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e < value)) if edges else F.lit(0)
    return F.when(value.isNull(), 0).otherwise(below)


def _as_number(df: DataFrame, column: str) -> Column:
    kind = dict(df.dtypes)[column]
    if kind == "string":
        return F.conv(F.substring(F.rpad(F.hex(F.encode(F.col(column), "utf-8")), 14, "0"), 1, 14), 16, 10).cast("double")
    return F.unix_micros(F.col(column).cast("timestamp")).cast("double") if kind in ("date", "timestamp", "timestamp_ntz") else F.col(column).cast("double")
