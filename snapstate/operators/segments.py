"""A state cut into segments of keys, so that a day's merge reads and writes only segments that its snapshot has.

A segment holds `rows_each` consecutive integer keys: new keys open new segments, and segments whose keys no snapshot
has any more are neither read nor written again. Gate and merge are both clustered by (segment, part of the key's
hash), so that each side is shuffled once and a segment is written as at most PARTS files. A state whose key is not one
integer column has no segments and is rewritten as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.predicates import out_of_rules
from ..schemas import RuleSet
from ..sources.store import SEGMENT

PART, PARTS = "_part", 64
_WHOLE = ("tinyint", "smallint", "int", "bigint", "long")


def segment_of(rules: RuleSet, rows_each: int) -> Column | None:
    """The segment of a row, or None where keys have no order to cut along."""
    if len(rules.key) != 1 or rules.columns.get(rules.key[0]) not in _WHOLE:
        return None
    key = F.col(rules.key[0]).cast("long")
    down = F.when(key % rows_each < 0, 1).otherwise(0)  # the quotient of integers is cut toward zero
    return F.coalesce(F.call_function("div", key, F.lit(rows_each)) - down, F.lit(0)).cast("long")


def segmented(rules: RuleSet) -> RuleSet:
    """The rules with the segment and part as leading keys; they follow from the key, so equal keys stay equal."""
    return replace(rules, key=(SEGMENT, PART, *rules.key))


def clustered(df: DataFrame, rules: RuleSet, rows_each: int, gated: bool) -> DataFrame:
    """df by segment and part. Rows not gated yet that break a rule are dealt by their content, as many may share a key."""
    part = F.pmod(F.xxhash64(*rules.key), F.lit(PARTS))
    if not gated:
        part = F.when(out_of_rules(rules), F.pmod(F.xxhash64(*df.columns), F.lit(PARTS))).otherwise(part)
    return df.withColumns({SEGMENT: segment_of(rules, rows_each), PART: part}).repartition(SEGMENT, PART)


def touched(df: DataFrame, rules: RuleSet, rows_each: int) -> set[int]:
    """The segments that df has rows of; reads the key only. They are folders, so their number is bounded like those."""
    return {r[0] for r in df.select(segment_of(rules, rows_each).alias(SEGMENT)).distinct().collect()}


@contextmanager
def joins_on_subset(spark: SparkSession) -> Iterator[None]:
    """Lets a join on (segment, part, key) use frames that are clustered by segment and part alone."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)
