"""Removal of repeated byte strings by sharded suffix arrays.

A byte goes if it lies in a SPAN-byte string that also starts earlier (in a document of smaller id, or earlier in the
same one). To bring equal strings together without comparing every shard with every other, each string is filed under
its anchor: the GRAM-byte piece of it with the smallest hash. Equal strings have equal anchors. A run of neighbouring
strings with one anchor makes a context, up to 168 bytes, about one for each 35 bytes of text.

1. Grams that anchor only once in the corpus are ruled out by counting hashes, with a Bloom filter for the test.
2. Equal contexts become one entry of a dictionary, as the phrases do in prefix-free parsing of texts: only hashes
   travel, and those of a context that is everywhere meet in their batches first. All of an entry but its earliest
   place is repeated whatever the suffix arrays say, since their strings would be equal one by one.
3. The dictionary's entries around one gram, such as the ends of a passage that documents share, are dealt into shards,
   a gram with more than SHARD of them into several. Each shard builds a suffix array of its entries' texts
   (Larsson-Sadakane refinement) and common prefixes (Kasai, one lane per context), which tell the equal strings.
4. Of a gram in several shards, each shard hands on its sorted run of first strings, as bytes. The runs are cut at the
   same strings (a range partition), and the parts of a range are merged two by two: a run finds its places in the
   other by binary search, and of equal strings the earlier stays.
5. Spans are joined to the documents that have any; the others pass straight through.

Equality of contexts is equality of 128 bits of hashes (64 of the gram, 64 of four 64-byte pieces that cover the
context, its length and its anchor's place); strings in suffix arrays and runs are compared byte by byte.

Documents are ordered by doc_id (null first), then by a hash of the text. Defined cases: rows equal in doc_id and
text are one document and get equal results; a null text counts as empty; texts shorter than SPAN bytes keep all; very
long texts are cut into overlapping pieces of PIECE bytes for the search, which loses no string (the contexts and spans
of one document, fewer than one for each 30 of its bytes, do meet in one row beside its text); an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_kept, groups_of, keep, settle, whole_text, with_group
from .exact import bloom_filter, flag_members

SPAN, GRAM = 100, 32
WINDOW = SPAN - GRAM + 1  # grams in a string
PIECE, SHARD = 1 << 20, 3_000  # bytes of a piece; contexts of a shard
RANGE = 50_000  # strings of a range whose runs are merged in one task
_P = [np.uint64(pow(0x9E3779B97F4A7C15, 1 << k, 1 << 64)) for k in range(7)]
_BYTE = np.random.default_rng(7).integers(0, 1 << 63, 257, np.uint64) * np.uint64(2) + np.uint64(1)
_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def rolling(codes: np.ndarray, doublings: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the 32 and (with 6 doublings) the 64 codes from each place (fewer at the end)."""
    h, out = _BYTE[codes], []
    for k in range(doublings):
        step = 1 << k
        if len(h) > step:
            h = np.concatenate([h[:-step] * _P[k] + h[step:], h[-step:]])
        out.append(h)
    return out[4], out[-1]


def anchors(data: np.ndarray, ends: np.ndarray, full: bool) -> tuple[np.ndarray, ...]:
    """Contexts of the pieces that lie one after another in data and end at `ends`: first and last string of each, the
    gram's hash and (if full) the context's."""
    n = len(data)
    if n < SPAN:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64))
    h32, h64 = rolling(data, 6 if full else 5)
    gram = mixed(h32)
    low = (gram & _U(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    have = 1
    while have < WINDOW:  # minima over WINDOW places; ties go to the first
        step = min(have, WINDOW - have)
        low = np.minimum(low[: len(low) - step], low[step:])
        have += step
    low = (low[: n - SPAN + 1] & _U(0xFFFFFFFF)).astype(np.int64)
    fine = np.ones(len(low), bool)  # strings within one piece
    for e in ends[:-1].tolist():
        fine[max(0, e - SPAN + 1) : min(e, len(fine))] = False
    start = np.flatnonzero(fine & np.concatenate([[True], (low[1:] != low[:-1]) | ~fine[:-1]]))
    stop = np.flatnonzero(fine & np.concatenate([(low[1:] != low[:-1]) | ~fine[1:], [True]]))
    at = low[start]
    context = np.zeros(0, np.uint64)
    if full:
        context = mixed(h64[start]) * _P[0] + h64[start + 36]
        context = mixed(context) * _P[0] + h64[stop + 4]
        context = mixed(context) * _P[0] + h64[stop + 36]
        context = mixed(context * _P[0] + ((stop - start) * 256 + at - start).astype(np.uint64))
    return start, stop, gram[at], context


def pieces_of(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, list[int], list[int]]]:
    """Runs of about PIECE bytes: data, ends of its pieces, each piece's row, and where it begins in the row's text."""
    parts, rows, begins, size = [], [], [], 0

    def flush():
        return np.concatenate(parts), np.cumsum([len(p) for p in parts]), list(rows), list(begins)

    for row, text in enumerate(column):
        data = np.frombuffer(text.as_py(), np.uint8)
        for at in range(0, max(1, len(data) - SPAN + 1), PIECE):
            part = data[at : at + PIECE + SPAN - 1]
            if len(part) < SPAN:
                continue
            if parts and size + len(part) > PIECE:
                yield flush()
                parts, rows, begins, size = [], [], [], 0
            parts.append(part)
            rows.append(row)
            begins.append(at)
            size += len(part)
    if parts:
        yield flush()


def _grams(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data, ends, _, _ in pieces_of(b.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(anchors(data, ends, False)[2].view(np.int64))], ["gram"])

    return docs.select("text").mapInArrow(run, "gram long")


def _contexts(docs: DataFrame) -> DataFrame:
    """gram, context, d, th, lo, hi of the contexts, and `again`: whether an equal one came earlier in the same batch
    of rows. So, of a context that is everywhere, each batch sends on one row that is not settled yet."""
    names = ["gram", "context", "d", "th", "lo", "hi", "again"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d, th = b.column(0).to_numpy(), b.column(1).to_numpy()
            found: list[tuple[np.ndarray, ...]] = []
            for data, ends, rows, begins in pieces_of(b.column(2)):
                start, stop, gram, context = anchors(data, ends, True)
                piece = np.searchsorted(ends, start, side="right")
                shift = np.array(begins) - np.concatenate([[0], ends[:-1]])
                row = np.array(rows)[piece]
                found.append((gram.view(np.int64), context.view(np.int64), d[row], th[row], start + shift[piece], stop + shift[piece]))
            if found:
                columns = [np.concatenate(x) for x in zip(*found, strict=True)]
                kept, again = _in_batch(*columns[:5])
                columns = [c[kept] for c in columns]
                columns[1] = np.where(again, 0, columns[1])  # a settled row is not compared any more
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(again)], names)

    return docs.select("d", "th", "text").mapInArrow(run, "gram long, context long, d long, th long, lo long, hi long, again boolean")


def _in_batch(gram: np.ndarray, context: np.ndarray, d: np.ndarray, th: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows to keep (repeats of one document's row go), and whether each comes after an equal context."""
    turn = np.argsort(gram ^ (context * np.int64(0x2545F4914F6CDD1D)), kind="stable")
    same = (gram[turn][1:] == gram[turn][:-1]) & (context[turn][1:] == context[turn][:-1])
    some = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    rest, many = turn[~some], turn[some]
    if not len(many):
        return rest, np.zeros(len(rest), bool)
    group = np.cumsum(~np.concatenate([[False], same]))[some]
    in_order = np.lexsort((lo[many], th[many], d[many], group))
    many, group = many[in_order], group[in_order]
    new = np.concatenate([[True], group[1:] != group[:-1]])
    twin = np.concatenate([[False], (group[1:] == group[:-1]) & (d[many][1:] == d[many][:-1]) & (th[many][1:] == th[many][:-1]) & (lo[many][1:] == lo[many][:-1])])
    return np.concatenate([rest, many[~twin]]), np.concatenate([np.zeros(len(rest), bool), ~new[~twin]])


def suffix_order(codes: np.ndarray, context: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Places of codes in the order of the suffixes there.

    Each context ends with a 0 code, which counts as smaller than all others and than the ends of later contexts:
    `context` numbers the contexts, `left` tells the codes from a place to its context's 0. Suffixes are ordered by 7
    codes first; then each group still tied is ordered by the rank 7, 14, 28, ... places on, until none is tied.
    """
    n = len(codes)
    padded = np.concatenate([codes, np.zeros(7, codes.dtype)]).astype(np.int64)
    key = np.zeros(n, np.int64)
    for k in range(7):
        key = key * 512 + np.where(k < left, padded[k : k + n], 0)
    order = np.argsort(key)
    in_order = key[order]
    new = np.concatenate([[True], in_order[1:] != in_order[:-1]])
    del key, in_order
    places = np.arange(n)
    rank = np.full(n + 1, -1)
    rank[order] = np.maximum.accumulate(np.where(new, places, 0))
    tied = places[~(new & np.concatenate([new[1:], [True]]))]
    h = 7
    while len(tied):
        at = order[tied]
        key = rank[at] * (n + 1) + np.where(left[at] < h, context[at], rank[np.minimum(at + h, n)]) + 1  # tied suffixes that ended did so at one distance
        turn = np.argsort(key)
        at, key = at[turn], key[turn]
        order[tied] = at
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[at] = np.maximum.accumulate(np.where(new, tied, 0))
        tied = tied[~(new & np.concatenate([new[1:], [True]]))]
        h *= 2
    return order


def common_prefixes(codes: np.ndarray, order: np.ndarray, offset: np.ndarray, size: np.ndarray, most: int = SPAN) -> np.ndarray:
    """Kasai's common prefix, up to `most`, of each place's suffix with the one before it in order; a 0 code never
    matches. Contexts (from offset, of so many places) are walked side by side: a place's prefix is at most one
    shorter than the place's before."""
    n = len(codes)
    before = np.full(n, n)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([codes, np.zeros(most + 1, codes.dtype)])
    out, have = np.zeros(n, np.int64), np.zeros(len(offset), np.int64)
    for k in range(int(size.max(initial=0))):
        lanes = np.flatnonzero(size > k)
        at = offset[lanes] + k
        prior = before[at]
        h = np.maximum(have[lanes] - 1, 0)
        h[prior == n] = 0
        live = np.flatnonzero(prior < n)
        while len(live):
            a = padded[at[live] + h[live]]
            live = live[(a == padded[np.minimum(prior[live] + h[live], n)]) & (a > 0) & (h[live] < most)]
            h[live] += 1
        have[lanes] = h
        out[at] = h
    return out


def strings_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The contexts' codes with a 0 after each, their offsets, and (place, class) of every SPAN-byte string, classes
    numbered in the strings' order."""
    size = np.array([len(t) for t in texts])
    offset = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    codes = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int16) + 1
    codes[offset + size] = 0
    context = np.repeat(np.arange(len(size)), size + 1)
    order = suffix_order(codes, context, (offset + size)[context] - np.arange(len(codes)))
    prefix = common_prefixes(codes, order, offset, size - SPAN + 1)
    is_string = np.zeros(len(codes), bool)
    for o, s in zip(offset.tolist(), size.tolist(), strict=True):
        is_string[o : o + s - SPAN + 1] = True
    place = order[is_string[order]]
    return codes, offset, place, np.cumsum(prefix[place] < SPAN) - 1


def runs(d: np.ndarray, th: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, ...]:
    """Byte spans (d, th, a, b) covered by SPAN-byte strings."""
    if not len(d):
        return d, th, start, start
    turn = np.lexsort((start, th, d))
    d, th, start = d[turn], th[turn], start[turn]
    new = np.concatenate([[True], (d[1:] != d[:-1]) | (th[1:] != th[:-1]) | (start[1:] > start[:-1] + SPAN)])
    last = np.concatenate([new[1:], [True]])
    return d[new], th[new], start[new], start[last] + SPAN


def earliest(group: np.ndarray, d: np.ndarray, th: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether each string of a class (numbered from 0) is the class's first by d, th, start."""
    out = np.ones(len(group), bool)
    some = np.flatnonzero(np.bincount(group)[group] > 1) if len(group) else group
    if not len(some):
        return out
    turn = some[np.lexsort((start[some], th[some], d[some], group[some]))]
    g, dd, tt, ss = group[turn], d[turn], th[turn], start[turn]
    new = np.concatenate([[True], g[1:] != g[:-1]])
    head = np.maximum.accumulate(np.where(new, np.arange(len(g)), 0))
    out[turn] = (dd == dd[head]) & (tt == tt[head]) & (ss == ss[head])
    return out


def _sharded(rows: DataFrame) -> DataFrame:
    """From contexts with cell, wide, d, th, lo, bytes: spans (d, th, a, b), and of grams in several shards (wide) the
    strings still first in their shard (d, th, a, cell and the string s), sorted."""
    names = ["d", "th", "a", "b", "cell", "s"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups_of(batches, "cell"):
            d, th, lo = (t.column(c).to_numpy() for c in ("d", "th", "lo"))
            codes, offset, place, group = strings_of(t.column("bytes").to_pylist())
            context = np.searchsorted(offset, place, side="right") - 1
            start = lo[context] + place - offset[context]
            first = earliest(group, d[context], th[context], start)
            spans = runs(d[context[~first]], th[context[~first]], start[~first])
            none = len(spans[0])
            yield pa.RecordBatch.from_arrays([*map(pa.array, spans), pa.array(np.zeros(none, np.int64)), pa.nulls(none, pa.binary())], names)
            left = np.flatnonzero(first & t.column("wide").to_numpy()[context])
            cell = t.column("cell")[0].as_py()
            for at in range(0, len(left), 10_000):
                part = left[at : at + 10_000]
                strings = (codes[place[part][:, None] + np.arange(SPAN)] - 1).astype(np.uint8)
                held = context[part]
                yield pa.RecordBatch.from_arrays([pa.array(d[held]), pa.array(th[held]), pa.array(start[part]), pa.array(np.full(len(part), -1)), pa.array(np.full(len(part), cell)), pa.array(list(map(bytes, strings)), pa.binary())], names)

    return rows.mapInArrow(run, "d long, th long, a long, b long, cell long, s binary")


def merge_runs(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray], rank: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Two sorted runs, each of distinct strings and the rows they stand for, as one; and the rows that go, as an equal
    string of smaller rank stays. The shorter run is searched in the longer."""
    (x, own), (y, more) = (one, two) if len(one[0]) >= len(two[0]) else (two, one)
    if not len(y):
        return (x, own), more
    at = np.searchsorted(x, y)
    hit = np.minimum(at, len(x) - 1)
    same = x[hit] == y
    hit, rows = hit[same], more[same]
    earlier = rank[rows] < rank[own[hit]]
    gone = np.where(earlier, own[hit], rows)
    own = own.copy()
    own[hit[earlier]] = rows[earlier]
    return (np.insert(x, at[~same], y[~same]), np.insert(own, at[~same], more[~same])), gone


def _merged(strings: DataFrame, ranges: int) -> DataFrame:
    """Spans of the strings that are first in their shard but not over all shards of their gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        d, th, a, cell = (t.column(c).to_numpy() for c in ("d", "th", "a", "cell"))
        rank = np.empty(len(d), np.int64)
        rank[np.lexsort((a, th, d))] = np.arange(len(d))
        words = np.frombuffer(b"".join(t.column("s").to_pylist()), f"S{SPAN}")
        cuts = [0, *(np.flatnonzero(cell[1:] != cell[:-1]) + 1).tolist(), len(cell)]
        waiting = [(words[x:y], np.arange(x, y)) for x, y in zip(cuts, cuts[1:], strict=False)]
        gone = []
        while len(waiting) > 1:
            pairs = [merge_runs(x, y, rank) for x, y in zip(waiting[::2], waiting[1::2], strict=False)]
            gone += [g for _, g in pairs]
            waiting = [m for m, _ in pairs] + waiting[len(pairs) * 2 :]
        later = np.concatenate([*gone, np.zeros(0, np.int64)]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in runs(d[later], th[later], a[later])], ["d", "th", "a", "b"])

    cut = strings.select("d", "th", "a", "cell", "s").repartitionByRange(ranges, "s").sortWithinPartitions("cell", "s")
    return cut.mapInArrow(run, "d long, th long, a long, b long")


def _members(docs: DataFrame, of: DataFrame) -> DataFrame:
    """docs with _maybe: false only where (d, th) surely is not in the stored table `of`."""
    keys = keep(of.select(F.xxhash64("d", "th").alias("sha")).distinct(), "members")
    return flag_members(docs.withColumn("sha", F.xxhash64("d", "th")), bloom_filter(keys, keys.count(), at_least=1)).drop("sha")


def repeated_spans(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """A stored table of spans (d, th, a, b) to remove, not yet merged, of docs with d, th and text as bytes."""
    spark = docs.sparkSession
    counted = keep(_grams(docs).groupBy("gram").count().where("count > 1").select(F.col("gram").alias("sha")), "grams")
    settle(spark)
    known = bloom_filter(counted, counted.count(), at_least=1)
    found = flag_members(_contexts(docs).withColumn("sha", F.col("gram")), known).where("_maybe").drop("sha", "_maybe")
    apart = F.when(F.col("again"), F.xxhash64("d", "th", "lo"))  # settled rows need not meet
    turn = F.rank().over(Window.partitionBy("gram", "context", apart).orderBy("d", "th", "lo"))
    again = F.col("again") | (turn > 1)
    firsts = found.select(F.when(~again, F.col("gram")).alias("gram"), "d", "th", "lo", (F.col("hi") - F.col("lo")).cast("int").alias("n"), again.alias("again"))
    firsts = keep(firsts, "firsts")
    drop_kept(counted)
    settle(spark)
    spans = firsts.where("again").select("d", "th", F.col("lo").alias("a"), (F.col("lo") + F.col("n") + SPAN).alias("b"))

    reps = firsts.where("not again").select("gram", "d", "th", "lo", (F.col("lo") + F.col("n")).alias("hi"))
    left = keep(with_group(reps, ["gram"], ["d", "th", "lo"], {"n": (F.count("*"), "sum")}, "n > 1"), "ends")
    settle(spark)
    total = left.count()
    if not total:
        return keep(spans, "spans")
    shards = -(-total // shard)
    sub = F.pmod(F.xxhash64("d", "th", "lo"), F.ceil(F.col("n") / shard))
    cell = F.when(F.col("n") > shard, F.xxhash64("gram", sub)).otherwise(F.pmod(F.xxhash64("gram"), F.lit(shards)))
    listed = left.select("d", "th", F.struct(cell.alias("cell"), (F.col("n") > shard).alias("wide"), "lo", "hi").alias("c")).groupBy("d", "th").agg(F.collect_list("c").alias("cs"))
    cut = listed.join(_members(docs, left).where("_maybe"), ["d", "th"]).select("d", "th", F.explode("cs").alias("c"), "text")
    rows = cut.select("c.cell", "c.wide", "d", "th", "c.lo", F.substring("text", (F.col("c.lo") + 1).cast("int"), (F.col("c.hi") - F.col("c.lo") + SPAN).cast("int")).alias("bytes"))
    out = keep(_sharded(rows.repartition("cell").sortWithinPartitions("cell")), "shards")
    settle(spark)
    strings = out.where("b < 0")
    more = out.where("b >= 0").select("d", "th", "a", "b")
    n_strings = strings.count()
    if n_strings:
        more = more.unionByName(_merged(strings, -(-n_strings // RANGE)))
    spans = keep(spans.unionByName(more), "spans")
    for table in (firsts, left, out):
        drop_kept(table)
    return spans


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("d"), F.xxhash64(whole_text()).alias("th"), F.encode(whole_text(), "utf-8").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))


def _cut(docs: DataFrame, body, schema: str, **sizes: int) -> DataFrame:
    """body(doc_id, text, merged spans) over every row."""
    keyed = _keyed(docs)
    spans = repeated_spans(keyed.select("d", "th", "text"), **sizes)
    listed = spans.groupBy("d", "th").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    flagged = _members(keyed, spans)
    settle(docs.sparkSession)
    without = flagged.where(~F.col("_maybe")).select("doc_id", "text", F.lit(None).cast("array<struct<a:bigint,b:bigint>>").alias("spans"))
    return without.unionByName(flagged.where("_maybe").join(listed, ["d", "th"], "left").select("doc_id", "text", "spans")).mapInArrow(body, schema)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _rest(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes, list[tuple[int, int]], bytes]]:
    for b in batches:
        for doc, text, spans in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
            text, gone = text.as_py(), merged([(s["a"], s["b"]) for s in spans.as_py() or []])
            done, parts = 0, []
            for a, e in gone:
                parts.append(text[done:a])
                done = e
            yield doc, text, gone, b"".join([*parts, text[done:]])


def report(docs: DataFrame, **sizes: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(doc, len(text), len(text) - len(left), len(gone), hashlib.sha256(left).hexdigest()) for doc, text, gone, left in _rest([b])]
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.string()], strict=True)], names)

    return _cut(docs, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", **sizes)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and the text left of every row; a character that a cut leaves in half is replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(doc, left.decode("utf-8", "replace")) for doc, _, _, left in _rest([b])]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["doc_id", "text"])

    return _cut(docs, run, "doc_id long, text string")
