"""Predicates that rules are made of. None of them is ever null, so that p and not p split a frame."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import RuleSet


def any_of(parts: Iterable[Column]) -> Column:
    return reduce(or_, parts, F.lit(False))


def required_missing(rules: RuleSet) -> Column:
    return any_of(F.col(c).isNull() for c in rules.required)


def out_of_rules(rules: RuleSet) -> Column:
    """Null in a required or ranged column, or outside its range; NaN is outside every range."""
    ranged = [F.col(c).isNull() | F.isnan(c) | ~F.col(c).between(lo, hi) for c, (lo, hi) in rules.ranges.items()]
    return F.coalesce(any_of([required_missing(rules), *ranged]), F.lit(True))


def within_rules(rules: RuleSet) -> list[Column]:
    """The same rules as conditions that all must hold, in a form that reaches the scan as pushed filters."""
    out = [F.col(c).isNotNull() for c in rules.required]
    for c, (lo, hi) in rules.ranges.items():
        out += [F.col(c).isNotNull(), F.col(c) >= lo, F.col(c) <= hi, ~F.isnan(c)]
    return out


def differs(columns: Iterable[str], left: str, right: str) -> Column:
    """Whether a tracked column differs; null equals null, and NaN equals NaN."""
    return any_of(~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns)


def is_fault(rules: RuleSet) -> Column:
    """A fault code other than the healthy one; null is no fault."""
    return F.coalesce(F.col(rules.fault) != rules.healthy, F.lit(False)) if rules.fault else F.lit(False)


def reduction_pct(processed: Column, total: Column) -> Column:
    """Percentage of rows that did not have to be processed, null for an empty total."""
    return F.when(total > 0, F.round((F.lit(1.0) - processed / total) * 100, 2))
