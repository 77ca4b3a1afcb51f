"""Change classification and upsert of a keyed state.

apply_snapshot() does both with a single full outer join on the key: the class decides from which side every column
comes, so a null in a changed row overwrites, unchanged rows keep the stored version, and rows that the snapshot no
longer has are retained. The counts per class come from the write itself (observe).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.predicates import differs
from ..schemas import CHANGED, NEW, RETAINED, UNCHANGED, RuleSet


def empty_like(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], df.schema)


def _on(keys: Sequence[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(f"cur.{k}") == F.col(f"old.{k}"))
    return on


def classify(current: DataFrame, prior: DataFrame | None, rules: RuleSet) -> DataFrame:
    """current with _change_type. Only key and tracked columns of the prior state are read."""
    if prior is None:
        return current.withColumn("_change_type", F.lit(NEW))
    old = prior.select(*rules.key, *rules.tracked, F.lit(True).alias("_there")).alias("old")
    kind = F.when(F.col("old._there").isNull(), NEW).when(differs(rules.tracked, "cur", "old"), CHANGED).otherwise(UNCHANGED)
    return current.alias("cur").join(old, _on(rules.key), "left").select(*[F.col(f"cur.`{c}`") for c in current.columns], kind.alias("_change_type"))


def class_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("_change_type").agg(F.count("*").alias("n"))


def to_merge(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("_change_type").isin(NEW, CHANGED)).drop("_change_type")


def upsert(prior: DataFrame | None, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of prior without a row of that key in updates, and updates. Columns that one side lacks become null."""
    if prior is None:
        return updates
    return prior.join(updates.select(*keys), list(keys), "left_anti").unionByName(updates, allowMissingColumns=True)


def update_only(prior: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """prior with `columns` of the matching rows replaced; unmatched updates are ignored."""
    on = updates.select(*keys, F.struct(*columns).alias("_new"))
    rows = prior.join(on, list(keys), "left")
    return rows.select(*[F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in prior.columns])


def evolve(current: DataFrame, prior: DataFrame, rules: RuleSet) -> DataFrame:
    """Full outer join of snapshot and state: all columns of both, chosen by class, and _change_type."""
    columns = [*current.columns, *[c for c in prior.columns if c not in current.columns]]
    cur = current.withColumn("_cur", F.lit(True)).alias("cur")
    old = prior.withColumn("_old", F.lit(True)).alias("old")
    kind = F.when(F.col("old._old").isNull(), NEW).when(F.col("cur._cur").isNull(), RETAINED).when(differs(rules.tracked, "cur", "old"), CHANGED).otherwise(UNCHANGED)
    joined = cur.join(old, _on(rules.key), "full_outer").withColumn("_change_type", kind)
    fresh = F.col("_change_type").isin(NEW, CHANGED)

    def pick(c: str) -> Column:
        one = F.col(f"cur.`{c}`") if c in current.columns else F.lit(None)
        two = F.col(f"old.`{c}`") if c in prior.columns else F.lit(None)
        return F.when(fresh, one).otherwise(two).alias(c)

    return joined.select(*[pick(c) for c in columns], "_change_type")


def apply_snapshot(current: DataFrame, prior: DataFrame | None, rules: RuleSet, observed: Observation | None = None) -> DataFrame:
    """The next state. `observed` gets new, changed, unchanged, retained and merged when the state is written."""
    out = evolve(current, empty_like(current) if prior is None else prior, rules)
    if observed is not None:
        count = lambda kind: F.count_if(F.col("_change_type") == kind)
        out = out.observe(observed, count(NEW).alias("new"), count(CHANGED).alias("changed"), count(UNCHANGED).alias("unchanged"), count(RETAINED).alias("retained"), F.count("*").alias("merged"))
    return out.drop("_change_type")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """A state must have one row per key; a merge with several rows for one would be ambiguous."""
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"several rows share a key ({', '.join(keys)})")
