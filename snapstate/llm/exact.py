"""Exact duplicates by two-pass Bloom filtering, in DataFrame functions only.

Pass one finds each text's place in a blocked Bloom filter, a page and two bits in it, and sets the bits of places that
are asked for at least twice: what travels is one number a row, counted on the map side first. Pass two tests every row
against the filter: rows that miss cannot repeat and go straight through, only the others shuffle.

A filter larger than max_filter_mb is tested in ranges of pages of that size, one after the other: the rows are first
written by range, without a shuffle, and each range is read with its own part of the filter. So no more is broadcast
at any size of the table, and the method stays the same.

Defined cases: a null text counts as empty; a null doc_id is smaller than any other; rows that share both text and
doc_id form one group like others and exactly one of them is kept; an empty table gives an empty result; other
columns, whatever their names or types, are carried by deduplicate() and ignored by duplicate_report().
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, keep_each, packed, whole_text, with_group

PAGE_BITS = 32_768  # of Spark's bitmap functions
#: Bits of the filter for each row, and the part of the filter that is broadcast at a time.
BITS_PER_ROW, MAX_FILTER_MB = 16, 64


@dataclass
class Bloom:
    table: DataFrame  # _page, _bits
    pages: int  # in all
    each: int  # pages of a range

    @property
    def ranges(self) -> int:
        return -(-self.pages // self.each)


def _sha() -> Column:
    return F.unhex(F.sha2(whole_text(), 256))


def _place(sha: Column, pages: int) -> tuple[Column, Column, Column]:
    """The page of a hash and two bits in it."""
    bits = F.xxhash64(sha, F.lit(1))
    return F.pmod(F.xxhash64(sha), F.lit(pages)), F.pmod(bits, F.lit(PAGE_BITS)), F.pmod(F.shiftright(bits, 32), F.lit(PAGE_BITS))


def bloom_filter(hashes: DataFrame, rows: int, max_filter_mb: int = MAX_FILTER_MB, at_least: int = 2) -> Bloom:
    """Pass one over a column `sha` of `rows` rows: the filter of places asked for at_least times."""
    pages = max(1, -(-rows * BITS_PER_ROW // PAGE_BITS))
    page, one, two = _place(F.col("sha"), pages)
    asked = hashes.select(((page * PAGE_BITS + one) * PAGE_BITS + two).alias("_place")).groupBy("_place").count().where(F.col("count") >= at_least)
    bits = F.explode(F.array(F.shiftright("_place", 15) % PAGE_BITS, F.col("_place") % PAGE_BITS))
    table = asked.select(F.shiftright("_place", 30).alias("_page"), bits.alias("_bit")).groupBy("_page").agg(F.expr("bitmap_construct_agg(_bit)").alias("_bits"))
    found = Bloom(table, pages, max(1, (max_filter_mb << 20) // (PAGE_BITS // 8)))
    if found.ranges > 1:
        found.table = keep(table, "filter")
    return found


def flag_members(rows: DataFrame, found: Bloom) -> DataFrame:
    """Pass two: adds `_maybe`, false only where the row's `sha` surely is no member of the filter."""
    page, one, two = _place(F.col("sha"), found.pages)
    placed = rows.withColumns({"_page": page, "_one": one, "_two": two})

    def is_set(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring("_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.call_function("shiftright", byte, (bit % 8).cast("int")) % 2 == 1

    def tested(part: DataFrame, pages: DataFrame) -> DataFrame:
        both = is_set(F.col("_one")) & is_set(F.col("_two"))
        return part.join(F.broadcast(pages), "_page", "left").select(*[F.col(f"`{c}`") for c in rows.columns], F.coalesce(both, F.lit(False)).alias("_maybe"))

    if found.ranges == 1:
        return tested(placed, found.table)
    dealt = keep(placed.withColumn("_range", F.floor(F.col("_page") / found.each).cast("int")), "ranges", partition_by="_range")
    in_range = lambda df, r: df.where(F.col("_page").between(r * found.each, (r + 1) * found.each - 1))
    return keep_each((tested(dealt.where(F.col("_range") == r).drop("_range"), in_range(found.table, r)) for r in range(found.ranges)), "flagged")


def duplicate_report(docs: DataFrame, max_filter_mb: int = MAX_FILTER_MB) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    narrow = keep(docs.select("doc_id", _sha().alias("sha"), F.monotonically_increasing_id().alias("_tag")), "exact")
    flagged = flag_members(narrow, bloom_filter(narrow, narrow.count(), max_filter_mb))
    once = flagged.where(~F.col("_maybe")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha")
    best = F.struct("doc_id", "_tag")
    again = with_group(flagged.where("_maybe"), ["sha"], ["doc_id", "_tag"], {"_best": (F.max(best), "max"), "group_size": (F.count("*"), "sum")})
    again = again.select("doc_id", F.col("_best.doc_id").alias("keep_id"), "group_size", (F.col("_best._tag") == F.col("_tag")).alias("kept"), "sha")
    return once.unionByName(again).withColumn("text_sha256", F.lower(F.hex("sha"))).drop("sha")


def deduplicate(docs: DataFrame, max_filter_mb: int = MAX_FILTER_MB) -> DataFrame:
    """The rows that stay, with the columns of docs: of equal texts the one with the largest doc_id.

    Rows with a text that occurs once never move. The others are aggregated per text, on the map side first, so a hot
    text sends one row from each task.
    """
    hashes = docs.select(_sha().alias("sha"))
    found = bloom_filter(hashes, docs.count(), max_filter_mb)
    rows = docs.select(packed(docs).alias("_row"), _sha().alias("sha"))
    flagged = flag_members(rows, found)
    rank = F.struct(F.col("_row.doc_id"), F.xxhash64(*[F.col(f"_row.`{c}`").cast("string") for c in docs.columns]))  # maps have no hash
    best = flagged.where("_maybe").groupBy("sha").agg(F.max_by("_row", rank).alias("_row"))
    return flagged.where(~F.col("_maybe")).select("_row.*").unionByName(best.select("_row.*"))
