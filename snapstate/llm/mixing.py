"""Mixing sources to target weights along a time-varying curriculum.

Targets: sources in code-point order (null last) have weights by turns; they share the size of all documents, and a
source's target stops at max_epochs times its size, the excess going to the others by weight. The final targets are
min(cap, level * weight), with the one level that spends everything; sorting sources by cap / weight gives it directly.

Curriculum: each source has a piecewise linear weight over training time 0..1. Its integral, scaled to the source's
target, is the cumulative demand for its words; a document (or its next repeat) that begins at word u of that demand
is trained at the time where the integral reaches u. Every copy's place in the order of these times is its position:
copies are dealt by ranges of time, and a range's positions follow on the number of copies in those before.

All of this is decided on a narrow table, written once: texts are read once to count words, and move only in mix(),
to meet their positions and into the order of training.

Defined cases: null or empty texts have no words and are never taken; a null source is a source of its own; repeated
rows are documents of their own; an empty table, or one without words, gives targets of 0 and an empty mix; other
columns, whatever their names or types, are ignored by report() and carried by mix(). Targets sort one row for each
source in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, bucket_bits, content_order, keep, n_words, packed, running

WEIGHTS, MAX_EPOCHS = (5, 2, 1), 3
#: Weight against time for the sources of each weight above: early, steady, late.
SCHEDULES = (((0.0, 3.0), (0.5, 2.0), (1.0, 1.0)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.0), (0.5, 2.0), (1.0, 3.0)))


def segments(knots: tuple[tuple[float, float], ...]) -> list[dict[str, float]]:
    """The pieces of a schedule with the integral (of 1 in all) before and after each."""
    area = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False)]
    if min(w for _, w in knots) < 0 or sum(area) <= 0 or any(b[0] <= a[0] for a, b in zip(knots, knots[1:], strict=False)):
        raise ValueError("a schedule needs increasing times and weights that are not negative nor all 0")
    out, done = [], 0.0
    for ((t0, w0), (t1, w1)), a in zip(zip(knots, knots[1:], strict=False), area, strict=True):
        out.append({"t0": t0, "len": t1 - t0, "w0": w0 / sum(area), "w1": w1 / sum(area), "c0": done, "c1": done + a / sum(area)})
        done += a / sum(area)
    return out


def time_of(share: Column, kind: Column, schedules: tuple = SCHEDULES) -> Column:
    """The time at which the integral of schedule number `kind` reaches `share` (0 to 1)."""
    out = F.lit(None).cast("double")
    for i, knots in enumerate(schedules):
        inner = F.lit(1.0)
        for s in reversed(segments(knots)):
            rest = F.greatest(share - s["c0"], F.lit(0.0))
            root = F.sqrt(F.greatest(F.lit(s["w0"] ** 2) + rest * (2 * (s["w1"] - s["w0"]) / s["len"]), F.lit(0.0)))
            inner = F.when(share < s["c1"], F.lit(s["t0"]) + F.when(rest > 0, rest * 2 / (root + s["w0"])).otherwise(0.0)).otherwise(inner)
        out = F.when(kind == i, inner).otherwise(out)
    return out


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """A row per source of a frame with source and size: source, source_size, kind (number of the weight), target."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    kind = (rank % len(weights)).cast("int")
    per = per.withColumn("kind", kind).withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), F.col("kind") + 1).cast("long")).withColumn("_cap", F.col("source_size") * max_epochs)
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    left = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    spent = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    level = (F.sum("source_size").over(everything) - spent) / F.sum("_w").over(left)
    per = per.withColumn("_level", level)
    level = F.min(F.when(F.col("_level") <= F.col("_cap") / F.col("_w"), F.struct(F.col("_cap") / F.col("_w"), F.col("_level").alias("level")))).over(everything)["level"]
    return per.withColumn("target", F.least(F.col("_cap").cast("double"), F.coalesce(level, F.lit(0.0)) * F.col("_w"))).select("source", "source_size", "kind", "target")


def _group() -> Column:
    """The source as a key that is never null and sorts like it, null last."""
    return F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit("-"))


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """A row for each copy that the mix takes, and one with _taken = 0 for each document that it takes none of:
    doc_id, _order, _g, _size, _source_size, _target, _before, _taken, _copy, _time, _position (null where none).

    A source's documents, in order of md5 of doc_id and text, form a stream of _source_size words which the mix reads
    round and round until it has the target: each is taken whole as often as there are full rounds, those at the
    front once more, and the one on the last boundary in part.
    """
    narrow = keep(docs.select("doc_id", "source", n_words(F.col("text")).alias("_size"), content_order().alias("_order"), _group().alias("_g")), "mixing")
    per = targets(narrow.select("source", F.col("_size").alias("size")), weights, max_epochs).withColumn("_g", _group())
    per = per.select("_g", F.col("source_size").alias("_source_size"), F.col("kind").alias("_kind"), F.col("target").alias("_target"))
    bits = bucket_bits(narrow.count())
    rows = running(narrow, "_g", "_order", ["doc_id"], "_size", "_before", bits).join(per, "_g")
    words = F.round("_target").cast("long")
    size = F.greatest(F.col("_source_size"), F.lit(1))
    rounds, rest = F.floor(words / size), words % size
    taken = rounds * F.col("_size") + F.least(F.greatest(rest - F.col("_before"), F.lit(0)), F.col("_size"))
    rows = rows.withColumn("_taken", taken.cast("long"))
    last = F.greatest(F.floor((F.col("_taken") - 1) / F.greatest(F.col("_size"), F.lit(1))), F.lit(0)).cast("int")
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(0), last)))
    start = F.col("_copy") * F.col("_source_size") + F.col("_before")
    time = F.when(F.col("_taken") > 0, time_of(start / F.greatest(F.col("_target"), F.lit(1.0)), F.col("_kind")))
    rows = rows.withColumns({"_time": time, "_all": F.lit(0), "_one": (F.col("_taken") > 0).cast("long")})
    spread = F.pmod(F.xxhash64("_order"), F.lit(1 << bits))  # copies never trained have no time and count for none
    ranges = F.when(F.col("_time").isNull(), spread).otherwise(F.least(F.floor(F.col("_time") * (1 << bits)), F.lit((1 << bits) - 1))).cast("int")
    placed = running(rows, "_all", "_time", ["_order", "_g", "_copy"], "_one", "_position", bits, ranges)
    return placed.withColumn("_position", F.when(F.col("_taken") > 0, F.col("_position"))).drop("_all", "_one", "_kind", "source")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, first_time (when the document is first trained, null if never) and
    position (the place of that copy among all copies of the mix, from 0)."""
    first = plan(docs).where("_copy = 0")
    return first.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_taken").alias("taken"), F.round("_time", 6).alias("first_time"), F.col("_position").alias("position"))


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself: the columns of docs, a row for each time a document is trained, range-sorted by position.

    Repeats keep their doc_id. A source's one document on the boundary is cut after its last taken word.
    """
    turn = Window.partitionBy("_order", "_g")  # tells rows of one doc_id, text and source apart
    copies = plan(docs).where("_taken > 0").withColumn("_turn", F.dense_rank().over(turn.orderBy("_before")))
    copies = copies.select("_order", "_g", "_turn", "_size", "_position", F.least(F.col("_size"), F.col("_taken") - F.col("_copy") * F.col("_size")).alias("_n"))
    wide = docs.select(packed(docs).alias("_row"), content_order().alias("_order"), _group().alias("_g"))
    wide = wide.withColumn("_turn", F.row_number().over(turn.orderBy(F.monotonically_increasing_id())))
    rows = wide.join(copies, ["_order", "_g", "_turn"])
    head = F.array_join(F.slice(F.regexp_extract_all("_row.text", F.lit(f"[^{SPACE}]+[{SPACE}]*"), F.lit(0)), 1, F.col("_n").cast("int")), "")
    text = F.when(F.col("_n") < F.col("_size"), head).otherwise(F.col("_row.text"))
    ordered = rows.repartitionByRange("_position").sortWithinPartitions("_position")
    out = {"text": text}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.col("_n") < F.col("_size"), F.length(head)).otherwise(F.col("_row.n_chars")).cast(dict(docs.dtypes)["n_chars"])
    return ordered.select(*[out.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
