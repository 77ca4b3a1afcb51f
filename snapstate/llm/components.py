"""Connected components of links, by alternating small-star and large-star steps (Kiveris and others, 2014).

Every step is a salted group minimum, so hubs of any degree are spread over tasks, and no list of neighbours is ever
collected. Each round's edges are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_kept, keep, with_group


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x")).first()
    return row["n"], row["x"]


def components(links: DataFrame) -> DataFrame:
    """node, comp for every end a, b of links (a stored table); comp is the smallest node reachable."""
    edges = keep(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "edges", links.count(), 200_000)
    state = _state(edges)
    while state[0]:
        low = {"m": (F.min("v"), "min")}
        small = with_group(edges, ["u"], ["v"], low)
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u > v").distinct()
        both = small.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
        large = with_group(both, ["u"], ["v"], low).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u > v").distinct()
        after = keep(large, "edges", state[0], 200_000)
        drop_kept(edges)
        edges, before, state = after, state, _state(after)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
