"""Near duplicates by banded MinHash, with odd sketches to screen candidates and full sets to confirm them.

A document's set holds its distinct WORDS-word shingles. SAMPLES MinHash values are taken of it; the first BANDS *
ROWS of them make band keys, and all are folded into an odd sketch: a bitmap in which each value flips one bit. The
XOR of two sketches has a bit for almost every value that differs, so its population count estimates the similarity,
most precisely where it is high. Pairs that share a band, have sizes that allow THRESHOLD and an estimate of at least
SCREEN (over four standard errors below it) are confirmed on their full sets.

Documents with equal sets are one node. First, each node of a bucket (the nodes of one band key) is paired with the
bucket's smallest node; that joins most of a group of copies of any size with one row per member. Then only buckets
with nodes of more than one component are left, and in each the nodes outside its first component meet all others,
block against block: sketches find the pairs that may be links, from the likeliest on, and the full sets confirm
those whose ends are not joined yet. Nodes meet only those of their own or a neighbouring class of sizes (powers of
1 / THRESHOLD), which splits large buckets further. A pair is tried in the first bucket it shares only. What a block
returns are links that join something, fewer than its nodes, however many pairs it looks at; so no pair is lost to a
cap and none is written in vain. A bucket of n nodes, m of them outside, costs up to n * m comparisons of sketches,
dealt over blocks: that is the price of an exact answer for a band key that very many unlike documents share.

With 32 bands of 4, a pair at exactly 0.75 shares no band with probability 5e-6, and fails the screen with 3e-6. Sets
are told apart by 128-bit hashes, and so are rows (md5 of doc_id and text); shingles by 64-bit hashes.

Defined cases: null texts and texts without words have empty sets, no links, and are kept; repeated rows (of one text
or one doc_id) are rows of their own; component_id is the smallest doc_id of a component, null if it has none, and
report() gives kept = (doc_id = component_id), while keep_one() keeps exactly one row of each component, with the
smallest doc_id (nulls last); an empty table gives an empty result; other columns, whatever their names or types, are
carried by keep_one() and ignored by report().
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import content_order, drop_kept, groups_of, keep, packed, settle, whole_text, with_group
from .components import components
from .exact import bloom_filter, flag_members

WORDS, BANDS, ROWS, SAMPLES, SKETCH_BITS = 5, 32, 4, 256, 1024
THRESHOLD, SCREEN = 75, 0.6  # THRESHOLD in hundredths
#: Nodes and shingles of a bucket's block, and the partners of a node that are dealt to one task.
BLOCK, BLOCK_SHINGLES, PART = 1024, 400_000, 64

_RANDOM = np.random.default_rng(20_240)
FACTORS = _RANDOM.integers(0, 1 << 63, SAMPLES, np.uint64) * np.uint64(2) + np.uint64(1)
TERMS = _RANDOM.integers(0, 1 << 63, SAMPLES, np.uint64)
_TURN = _RANDOM.integers(0, 1 << 63, SAMPLES, np.uint64)
_P, _M = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, kept for their next occurrence."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


def shingles(text: bytes, hashes: WordHashes, size: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles. bytes.lower and bytes.split know ASCII only, as asked for."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(size, len(h))
    out = h[: len(h) - size + 1].copy()
    for k in range(1, size):
        out = out * _P + h[k : len(h) - size + 1 + k]
    return np.unique(mixed(out + np.uint64(size)))


def min_hashes(found: np.ndarray) -> np.ndarray:
    out = np.full(SAMPLES, ~np.uint64(0))
    room = np.empty((min(128, len(found)), SAMPLES), np.uint64)
    for at in range(0, len(found), 128):
        some = found[at : at + 128, None]
        part = room[: len(some)]
        np.multiply(some, FACTORS, out=part)
        np.add(part, TERMS, out=part)
        np.minimum(out, part.min(0), out=out)
    return out


def band_keys(mins: np.ndarray) -> np.ndarray:
    part = mixed(mins[: BANDS * ROWS].reshape(BANDS, ROWS))
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        out = mixed(out * _P + part[:, k])
    return out


def odd_sketch(mins: np.ndarray) -> np.ndarray:
    spots = mixed(mins ^ _TURN) % np.uint64(SKETCH_BITS)
    return np.packbits(np.bincount(spots.astype(np.int64), minlength=SKETCH_BITS).astype(np.uint8) & 1).view(np.uint64)


def most_flips(similarity: float) -> int:
    """The population count of the XOR that is expected at a similarity; fewer bits mean more similar."""
    return int(SKETCH_BITS / 2 * (1 - np.exp(-4 * SAMPLES * (1 - similarity) / SKETCH_BITS)))


def _row_key() -> Column:
    return F.unhex(content_order())


def sketch_table(docs: DataFrame) -> DataFrame:
    """A row per row of docs: tag (unique), doc_id, row_key (of doc_id and text), n_shingles, digest, keys, odd."""
    schema = pa.schema([("tag", pa.int64()), ("doc_id", pa.int64()), ("row_key", pa.binary()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("keys", pa.list_(pa.int64())), ("odd", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            n, digest, keys, odd = [], [], [], []
            for text in b.column(3):
                found = shingles(text.as_py(), hashes)
                n.append(len(found))
                digest.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                mins = min_hashes(found) if len(found) else None
                keys.append(None if mins is None else band_keys(mins).view(np.int64))
                odd.append(None if mins is None else odd_sketch(mins).view(np.int64))
            columns = [b.column(0), b.column(1), b.column(2), *(pa.array(c, f.type) for c, f in zip((n, digest, keys, odd), list(schema)[3:], strict=True))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = docs.select(F.monotonically_increasing_id().alias("tag"), F.col("doc_id").cast("long"), _row_key().alias("row_key"), F.encode(whole_text(), "utf-8").alias("text"))
    return rows.mapInArrow(run, "tag long, doc_id long, row_key binary, n_shingles long, digest binary, keys array<long>, odd array<long>")


def _dealt(pairs: DataFrame) -> DataFrame:
    """Pairs a, b with `part`: about PART partners of each a have one, so that a hub's pairs spread over tasks."""
    rows = with_group(pairs, ["a"], ["b"], {"n": (F.count("*"), "sum")})
    return rows.withColumn("part", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / PART))).drop("n")


def _screened(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs a, b, part whose sizes and sketches allow the threshold."""
    one = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("odd").alias("oa"))
    two = nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("odd").alias("ob"))
    flips = F.aggregate(F.zip_with("oa", "ob", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    first = pairs.select("a", "part").distinct().join(one, "a")
    rows = pairs.join(two, "b").join(first, ["a", "part"])
    return rows.where((F.least("na", "nb") * 100 >= F.greatest("na", "nb") * THRESHOLD) & (flips <= most_flips(SCREEN))).select("a", "b", "part")


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs a, b that are links by their full sets. Each `a` meets the partners of one part, a text at a time."""
    dealt = pairs.withColumn("gid", F.xxhash64("a", "part"))
    first = dealt.select("gid", F.col("a").alias("node"), F.lit(0).alias("role")).distinct()
    rows = first.unionByName(dealt.select("gid", F.col("b").alias("node"), F.lit(1).alias("role")).distinct())
    rows = rows.join(texts, "node").repartition("gid").sortWithinPartitions("gid", "role", "node").select("gid", "role", "node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, gid, held = WordHashes(), None, []
        for batch in batches:
            out: list[tuple[int, int]] = []
            for at, role, node, text in zip(*(batch.column(c).to_numpy().tolist() for c in range(3)), batch.column(3), strict=True):
                found = shingles(text.as_py(), hashes)
                if at != gid:
                    gid, held = at, []
                if role == 0:
                    held.append((node, found))
                    continue
                out += [(other, node) for other, full in held if other != node and is_link(full, found)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def is_link(one: np.ndarray, two: np.ndarray) -> bool:
    """Whether two sets reach the threshold."""
    low, high = sorted((len(one), len(two)))
    if low * 100 < high * THRESHOLD:
        return False
    both = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * both >= THRESHOLD * (low + high - both)


def block_links(band: int, comp: np.ndarray, n: np.ndarray, odd: np.ndarray, keys: np.ndarray, own: np.ndarray, asks: np.ndarray, full) -> list[tuple[int, int]]:
    """Links between rows `asks` and `own` of one bucket that join components, given the rows' component, size, sketch
    and band keys; full(row) gives a row's set."""
    limit = most_flips(SCREEN)
    found = []
    for k in asks:
        fit = own[(comp[own] != comp[k]) & (np.minimum(n[own], n[k]) * 100 >= np.maximum(n[own], n[k]) * THRESHOLD)]
        flips = np.bitwise_count(odd[fit] ^ odd[k]).sum(1, dtype=np.int64)
        fit, flips = fit[flips <= limit], flips[flips <= limit]
        first = (keys[fit] == keys[k]).argmax(1) == band
        if first.any():
            found.append(np.stack([flips[first], np.full(first.sum(), k), fit[first]]))
    out: list[tuple[int, int]] = []
    if not found:
        return out
    root: dict[int, int] = {}

    def top(c: int) -> int:
        while (up := root.get(c, c)) != c:
            root[c] = root.get(up, up)
            c = up
        return c

    pairs = np.concatenate(found, 1)
    pairs = pairs[:, np.argsort(pairs[0], kind="stable")]
    names = comp.tolist()
    for a, b in zip(pairs[1].tolist(), pairs[2].tolist(), strict=True):
        x, y = top(names[a]), top(names[b])
        if x != y and is_link(full(a), full(b)):
            root[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def _joining(members: DataFrame, nodes: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """Links a, b between nodes of one bucket in different components, enough to join all that links join."""
    rows = members.join(labels, "node", "left").select("key", "band", "node", F.coalesce("comp", "node").alias("comp"))
    rows = with_group(rows, ["key"], ["node"], {"home": (F.min("comp"), "min"), "far": (F.max("comp"), "max")}, "home < far").drop("far")
    rows = rows.join(nodes.select("node", "n_shingles", "odd", "keys"), "node")
    rows = rows.withColumn("size", F.floor(F.log("n_shingles") / math.log(100 / THRESHOLD)).cast("int"))  # the sizes of links differ by one class at most
    mine = rows.withColumn("asks", F.lit(0))
    asks = rows.where(F.col("comp") != F.col("home")).withColumns({"size": F.explode(F.array(*[F.col("size") + k for k in (-1, 0, 1)])), "asks": F.lit(1)})
    count = {"n": (F.sum(1 - F.col("asks")), "sum"), "n_out": (F.sum("asks"), "sum"), "s": (F.sum((1 - F.col("asks")) * F.col("n_shingles")), "sum"), "s_out": (F.sum(F.col("asks") * F.col("n_shingles")), "sum")}
    count |= {"low": (F.min("node"), "min"), "high": (F.max("node"), "max")}
    rows = with_group(mine.unionByName(asks), ["key", "size"], ["node"], count, "n > 0 AND n_out > 0 AND low < high")
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int")
    outs = F.greatest(F.ceil(F.col("n_out") / BLOCK), F.ceil(F.col("s_out") / BLOCK_SHINGLES)).cast("int")
    rows = rows.withColumns({"i": F.pmod(F.xxhash64("node"), blocks.cast("long")).cast("int"), "j": F.pmod(F.xxhash64("node", F.lit(1)), outs.cast("long")).cast("int")})
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    mine = rows.where("asks = 0").withColumns({"jj": F.explode(upto(outs)), "ii": F.col("i")})
    asks = rows.where("asks = 1").withColumns({"ii": F.explode(upto(blocks)), "jj": F.col("j")})
    cells = mine.unionByName(asks).groupBy("key", "size", "ii", "jj", "node").agg(*[F.first(c).alias(c) for c in ("band", "comp", "n_shingles", "odd", "keys")], F.max(F.col("asks") == 0).alias("own"), F.max(F.col("asks") == 1).alias("ask"))
    cells = cells.join(texts, "node").select(F.xxhash64("key", "size", "ii", "jj").alias("cell"), "band", "node", "comp", "n_shingles", "odd", "keys", "own", "ask", "text")
    cells = cells.repartition("cell").sortWithinPartitions("cell", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for t in groups_of(batches, "cell"):
            node, comp, n, own, ask = (t.column(c).to_numpy() for c in ("node", "comp", "n_shingles", "own", "ask"))
            odd = np.stack(t.column("odd").to_numpy(zero_copy_only=False)).view(np.uint64)
            keys = np.stack(t.column("keys").to_numpy(zero_copy_only=False))
            text, sets = t.column("text"), {}

            def full(row: int) -> np.ndarray:
                if row not in sets:
                    sets[row] = shingles(text[row].as_py(), hashes)
                return sets[row]

            links = block_links(t.column("band")[0].as_py(), comp, n, odd, keys, np.flatnonzero(own), np.flatnonzero(ask), full)
            if links:
                a, b = node[np.array(links)].T
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return cells.mapInArrow(run, "a long, b long").distinct()


def assigned(docs: DataFrame) -> DataFrame:
    """A row per row of docs: tag, doc_id, row_key, n_shingles, component_id, group_size, kept (one of each component)."""
    sketches = keep(sketch_table(docs), "sketches")
    empty = sketches.where("n_shingles = 0").select("tag", "doc_id", "row_key", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    rows_in = sketches.count()
    grouped = keep(with_group(sketches.where("n_shingles > 0"), ["digest"], ["tag"], {"node": (F.min("tag"), "min")}), "nodes", rows_in)
    nodes = grouped.where("tag = node")

    buckets = nodes.select(F.posexplode("keys").alias("band", "key"), "node")
    members = keep(with_group(buckets, ["key"], ["node"], {"n": (F.count("*"), "sum"), "first": (F.min("node"), "min")}, "n > 1").select("key", "band", "node", "first"), "members", BANDS * rows_in, 100_000)
    pairs = members.where("node > first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()

    asked = keep(members.select("node").distinct().join(nodes.select("node", F.col("row_key").alias("sha")), "node"), "asked", rows_in)
    rows = docs.select(_row_key().alias("sha"), F.encode(whole_text(), "utf-8").alias("text"))
    n_asked = asked.count()
    rows = flag_members(rows, bloom_filter(asked, n_asked, at_least=1)).where("_maybe")
    texts = keep(rows.join(asked.select("sha", "node"), "sha").groupBy("sha").agg(F.first("node").alias("node"), F.first("text").alias("text")).drop("sha"), "texts", n_asked, 5_000)
    settle(docs.sparkSession)

    links = keep(_confirmed(_screened(_dealt(pairs), nodes), texts), "links")
    joining = keep(_joining(members, nodes, components(links), texts), "joining")
    links = links.unionByName(joining)
    labels = components(links)
    settle(docs.sparkSession)

    whole = grouped.select("tag", "doc_id", "row_key", "n_shingles", "node").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    best = F.struct(F.col("doc_id").isNull(), "doc_id", "tag")
    whole = with_group(whole, ["comp"], ["tag"], {"best": (F.min(best), "min"), "group_size": (F.count("*"), "sum")})
    whole = whole.select("tag", "doc_id", "row_key", "n_shingles", F.col("best.doc_id").alias("component_id"), "group_size", (F.col("best.tag") == F.col("tag")).alias("kept"))
    out = keep(whole.unionByName(empty), "near", rows_in)
    for table in (sketches, grouped, members, asked, texts):
        drop_kept(table)
    return out


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    return assigned(docs).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, with the columns of docs. Only rows of components with several rows are joined."""
    found = assigned(docs)
    shared = found.where("group_size > 1").withColumnRenamed("row_key", "sha")
    rows = docs.select(packed(docs).alias("_row"), _row_key().alias("sha"))
    flagged = flag_members(rows, bloom_filter(shared, shared.count(), at_least=1))
    gone = shared.groupBy("sha").agg(F.max("kept").alias("_kept"))
    tested = flagged.where("_maybe").join(gone, "sha", "left").where(F.coalesce("_kept", F.lit(True)))
    single = tested.where("_kept is null").select("_row")
    first = tested.where("_kept").groupBy("sha").agg(F.first("_row").alias("_row")).select("_row")
    return flagged.where(~F.col("_maybe")).select("_row").unionByName(single).unionByName(first).select("_row.*")
