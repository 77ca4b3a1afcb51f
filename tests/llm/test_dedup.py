"""Exact, near and substring dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapstate.llm import components, exact, near, suffix
from snapstate.llm.common import running, with_group

from .conftest import words

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def test_group_statistics_and_prefix_sums(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 700, 0).otherwise(F.col("id") % 7).alias("g"), "id", F.md5(F.col("id").cast("string")).alias("o"))
    out = with_group(df, ["g"], ["id"], {"n": (F.count("*"), "sum"), "m": (F.min("id"), "min")}, salts=8)
    want = Counter(0 if i < 700 else i % 7 for i in range(1000))
    assert out.count() == 1000 and {r["g"]: r["n"] for r in out.collect()} == want
    rows = running(df, "g", "o", ["id"], "id", "before", bits=6).collect()
    for g in want:
        mine, total = sorted((r for r in rows if r["g"] == g), key=lambda r: r["o"]), 0
        for r in mine:
            assert r["before"] == total
            total += r["id"]


def test_components(spark):
    r = random.Random(3)
    edges = {tuple(sorted(r.sample(range(400), 2))) for _ in range(300)} | {(k, k + 1) for k in range(1000, 1040)} | {(2000, k) for k in range(2001, 2300)}
    root = {x: x for e in edges for x in e}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = top(a), top(b)
        root[max(x, y)] = min(x, y)
    got = {r["node"]: r["comp"] for r in components.components(spark.createDataFrame(list(edges), "a long, b long")).collect()}
    assert {x: got.get(x, x) for x in root} == {x: top(x) for x in root}
    assert components.components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_exact_report(table, odd_rows):
    got = exact.duplicate_report(table(odd_rows)).collect()
    ids = defaultdict(list)
    for i, t, *_ in odd_rows:
        ids[t or ""].append(i)
    assert len(got) == len(odd_rows)
    kept = Counter()
    for r in got:
        t = next(t for t in ids if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"])
        assert r["keep_id"] == max((i for i in ids[t] if i is not None), default=None)
        assert r["group_size"] == len(ids[t])
        kept[t] += r["kept"]
    assert set(kept.values()) == {1}


def test_exact_rows(table, odd_rows):
    docs = table(odd_rows)
    out = exact.deduplicate(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert Counter(r["text"] or "" for r in rows) == Counter({t or "": 1 for _, t, *_ in odd_rows})
    for r in rows:
        assert r["doc_id"] == max((i for i, t, *_ in odd_rows if (t or "") == (r["text"] or "") and i is not None), default=None)
    assert exact.deduplicate(table([])).isEmpty() and exact.duplicate_report(table([])).isEmpty()


def test_exact_rows_with_maps_and_odd_names(table):
    docs = table([(1, "a"), (1, "a"), (2, "b"), (None, "b")], clash=False).selectExpr("*", "map('a', doc_id) AS `my col`", "array(map(1, 2)) AS `x.y`", "struct(map(1, 2) AS `b c`) AS z")
    out = exact.deduplicate(docs)
    assert out.dtypes == docs.dtypes and sorted((r["doc_id"], r["my col"]["a"]) for r in out.collect()) == [(1, 1), (2, 2)]


def test_exact_sql_on_repeated_rows_and_nulls(table):
    import duckdb

    from snapstate.llm.oracle import EXACT

    rows = [(2, "x"), (2, "x"), (1, "x"), (None, "x"), (None, None), (5, ""), (None, "y")]
    con = duckdb.connect()
    con.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    got = exact.duplicate_report(table(rows)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert Counter(map(tuple, got)) == Counter(con.sql(f"SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ({EXACT})").fetchall())


@pytest.mark.parametrize("max_mb", [64, 0])
def test_a_hot_text_is_spread(spark, max_mb):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).otherwise("hot").alias("text"))
    out = exact.duplicate_report(docs, max_mb)  # with 0, a page of the filter at a time
    rows = exact.deduplicate(docs, max_mb)
    assert rows.count() == 13_334 and rows.where("text = 'hot'").collect() == [(19_998, "hot")]
    assert out.where("kept").count() == 13_334 and out.where("group_size > 1").select("keep_id").distinct().collect() == [(19_998,)]


@pytest.mark.parametrize("max_mb", [64, 0])
def test_only_possible_repeats_are_flagged(spark, max_mb):
    hashes = spark.range(10_000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("sha"))
    twice = hashes.limit(100)
    rows = hashes.unionByName(twice)
    found = exact.bloom_filter(rows, 10_100, max_mb)
    assert found.ranges == (1 if max_mb else 5)
    flagged = exact.flag_members(rows, found)
    assert flagged.columns == ["sha", "_maybe"] and flagged.count() == 10_100
    assert flagged.where("_maybe").count() < 210  # 200 repeats
    assert flagged.where("_maybe").join(twice, "sha", "left_semi").count() == 200


def sets_of(rows, size=5):
    out = []
    for _, text, *_ in rows:
        w = WORD.findall((text or "").encode().lower())
        out.append(frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else []))
    return out


def brute_near(rows):
    sets = sets_of(rows)
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both) and sets[b]:
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[top(k)].append(k)
    least = {g: min((rows[k][0] for k in m if rows[k][0] is not None), default=None) for g, m in groups.items()}
    return sets, [top(k) for k in range(len(rows))], least


def check_near(table, rows):
    sets, group, least = brute_near(rows)
    got = near.report(table(rows)).collect()
    want = Counter((r[0], len(s), least[g]) for r, s, g in zip(rows, sets, group, strict=True))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    return got


def test_near_odd_rows(table, odd_rows):
    check_near(table, odd_rows)


def test_near_repeated_ids_and_any_columns(table):
    rows = [(1, words(30, 1)), (1, words(30, 1)), (2, words(30, 1)), (None, words(30, 1)), (None, words(9, 5)), (None, words(9, 5)), (1, words(30, 6))]
    check_near(table, rows)
    docs = table(rows, clash=False).selectExpr("*", "map('a', 1) AS `my col`", "1 AS sha", "2 AS `x.y`")
    out = near.keep_one(docs)
    assert out.dtypes == docs.dtypes and sorted((r["doc_id"] or 0, r["n_chars"]) for r in out.collect()) == sorted([(1, len(words(30, 1))), (1, len(words(30, 6))), (0, len(words(9, 5)))])


def test_near_large_buckets_of_unlike_documents(table, monkeypatch):
    """One key for all in the first band, with blocks of a few nodes: every pair is still met."""
    monkeypatch.setattr(near, "BLOCK", 3)
    real = near.band_keys

    def band_keys(mins):
        out = real(mins)
        out[0] = 1
        return out

    rows = [(k, edited(words(60 + 25 * (k // 6 % 5), k // 6), 0.01 * (k % 4), k)) for k in range(48)]
    sets, group, least = brute_near(rows)
    texts = [t.encode() for _, t in rows]
    found = [near.shingles(t, near.WordHashes()) for t in texts]
    keys = np.stack([band_keys(near.min_hashes(f)) for f in found]).view(np.int64)
    spark = table([]).sparkSession
    nodes = spark.createDataFrame([(k, len(f), near.odd_sketch(near.min_hashes(f)).view(np.int64).tolist(), keys[k].tolist()) for k, f in enumerate(found)], "node long, n_shingles long, odd array<long>, keys array<long>")
    members = nodes.select(F.lit(1).cast("long").alias("key"), F.lit(0).alias("band"), "node")
    labels = spark.createDataFrame([], "node long, comp long")
    links = near._joining(members, nodes, labels, spark.createDataFrame(list(enumerate(texts)), "node long, text binary")).collect()
    root = {k: k for k in range(len(rows))}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(top(a), top(b))] = min(top(a), top(b))
    assert [top(k) for k in range(len(rows))] == group and len(set(group)) < 40


def edited(text, share, seed):
    r = random.Random(seed)
    return " ".join(f"edit{r.randrange(10**6)}" if r.random() < share else w for w in text.split())


def test_near_families_chains_and_shared_passages(table):
    rows, k = [], 0
    passage = words(60, 77)
    for f in range(8):
        base = words(200, 100 + f)
        for v in range(12):
            rows.append((k, edited(base, 0.01 * (v % 4 + 1), k)))
            k += 1
    chain = words(200, 999)
    for _ in range(15):
        rows.append((k, chain))
        chain = edited(chain, 0.02, k)
        k += 1
    for _ in range(60):
        rows.append((k, words(20, k) + " " + passage + " " + words(20, 5000 + k)))
        k += 1
    random.Random(1).shuffle(rows)
    got = check_near(table, rows)
    assert sum(not r["kept"] for r in got) > 30


def test_near_rows_kept(table, odd_rows):
    docs = table(odd_rows)
    out = near.keep_one(docs)
    _, group, least = brute_near(odd_rows)
    assert out.columns == docs.columns
    assert Counter(r["doc_id"] for r in out.collect()) == Counter(least[g] for g in set(group))
    assert near.report(table([])).isEmpty() and near.keep_one(table([])).isEmpty()


def test_odd_sketches_estimate_high_similarities():
    r = np.random.default_rng(5)
    for similarity in (0.75, 0.9, 1.0):
        flips = []
        for _ in range(40):
            both = r.integers(0, 1 << 63, int(400 * similarity), np.uint64)
            one, two = (np.unique(np.concatenate([both, r.integers(0, 1 << 63, (400 - len(both)) // 2, np.uint64)])) for _ in range(2))
            flips.append(int(np.bitwise_count(near.odd_sketch(near.min_hashes(one)) ^ near.odd_sketch(near.min_hashes(two))).sum()))
        assert max(flips) <= near.most_flips(near.SCREEN) and abs(np.mean(flips) - near.most_flips(similarity)) < 12


def test_block_links_join_all_with_few_links():
    base = words(150, 4).encode()
    texts = [base] + [edited(base.decode(), 0.01, k).encode() for k in range(40)]
    hashes = near.WordHashes()
    sets = [near.shingles(t, hashes) for t in texts]
    mins = [near.min_hashes(s) for s in sets]
    keys = np.stack([near.band_keys(m).view(np.int64) for m in mins])
    keys[:, 0] = 1  # all in one bucket of band 0
    n = np.array([len(s) for s in sets])
    rows = np.arange(len(sets))
    links = near.block_links(0, rows, n, np.stack([near.odd_sketch(m) for m in mins]), keys, rows, rows[1:], lambda k: sets[k])
    assert len(links) < len(sets) and all(near.is_link(sets[a], sets[b]) for a, b in links)
    _, group, _ = brute_near([(k, t.decode()) for k, t in enumerate(texts)])
    assert len(links) == len(sets) - len(set(group))


def brute_spans(rows):
    """Expected (n_bytes, n_removed, n_spans, sha) per row; equal (doc_id, text) rows count once."""
    order = sorted({(r[0], r[1] or "") for r in rows}, key=lambda x: (x[0] is not None, x[0] or 0, suffix_tie(x[1])))
    seen, out = set(), {}
    for i, text in order:
        b = text.encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            w = b[s : s + 100]
            if w in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(w)
        left = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out[i, text] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(left).hexdigest())
    return out


def suffix_tie(text):
    import xxhash

    return int(np.uint64(xxhash.xxh64(text.encode(), 42).intdigest()).view(np.int64))


def test_sorted_runs_are_merged_by_binary_search():
    r = random.Random(6)
    pool = [bytes(r.choice(b"\x00ab\xff") for _ in range(100)) for _ in range(60)]
    rank = np.array(r.sample(range(1000), 1000))
    runs, who = [], 0
    for _ in range(9):
        mine = sorted(r.sample(pool, r.randrange(0, 40)))
        runs.append((np.array(mine, "S100"), np.arange(who, who + len(mine))))
        who += len(mine)
    gone, merged = [], runs[0]
    for two in runs[1:]:
        merged, more = suffix.merge_runs(merged, two, rank)
        gone += more.tolist()
    least = {}
    for words_, rows in runs:
        for w, k in zip(words_.tolist(), rows.tolist(), strict=True):
            least[w] = min(least.get(w, k), k, key=lambda x: rank[x])
    assert merged[0].tolist() == sorted(least) and dict(zip(merged[0].tolist(), merged[1].tolist(), strict=True)) == least
    assert sorted(gone) == sorted(set(range(who)) - set(least.values()))


def test_repeated_ids_with_other_texts_are_documents_of_their_own(table):
    rows = [(7, words(40, 1)), (7, words(40, 1) + " x"), (None, words(40, 1)), (None, "y " + words(40, 1)), (7, words(40, 1))]
    got = suffix.report(table(rows)).collect()
    want = brute_spans(rows)
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == Counter((r[0], *want[r[0], r[1]]) for r in rows)


@pytest.mark.parametrize("sizes", [{}, {"shard": 5}])
def test_suffix_removal(table, odd_rows, sizes, monkeypatch):
    monkeypatch.setattr(suffix, "RANGE", 50)
    merges = []
    real = suffix._merged
    monkeypatch.setattr(suffix, "_merged", lambda strings, ranges: merges.append(ranges) or real(strings, ranges))
    passage, other = words(40, 8), words(30, 9)
    rows = [*odd_rows, *[(100 + k, f"{words(15, 40 + k)} {passage} {words(15, 90 + k)} {other if k % 2 else ''}") for k in range(30)], (200, "ab" * 400), (201, "ba" * 150 + passage[:99]), (202, passage[:100]), (203, "é" * 120)]
    got = suffix.report(table(rows), **sizes).collect()
    want = brute_spans(rows)
    assert bool(merges) == bool(sizes) and all(m > 1 for m in merges)  # grams of several shards are merged over several ranges
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == Counter((r[0], *want[r[0], r[1] or ""]) for r in rows)


def test_suffix_of_nothing_and_texts(table):
    assert suffix.report(table([])).isEmpty()
    out = {r["doc_id"]: r["text"] for r in suffix.remove_repeats(table([(1, "x" + "abc" * 60), (2, "y" + "abc" * 60 + "z")])).collect()}
    assert out[2] == "yz" and out[1].startswith("xabc") and len(out[1]) < 110


def test_suffix_order_and_prefixes():
    r = random.Random(2)
    texts = ["".join(r.choice("ab") for _ in range(r.randint(100, 140))).encode() for _ in range(12)] + [b"a" * 130, b"ab" * 60]
    codes, offset, place, group = suffix.strings_of(texts)
    strings = {}
    for p, g in zip(place.tolist(), group.tolist(), strict=True):
        k = int(np.searchsorted(offset, p, side="right")) - 1
        strings.setdefault(g, set()).add(texts[k][p - offset[k] : p - offset[k] + 100])
    assert all(len(s) == 1 for s in strings.values())
    flat = [next(iter(strings[g])) for g in sorted(strings)]
    assert flat == sorted(flat) and len(set(flat)) == len(flat)
    assert len(place) == sum(len(t) - 99 for t in texts)


def test_long_texts_are_searched_in_pieces():
    import pyarrow as pa

    r = random.Random(4)
    text = bytes(r.randrange(97, 123) for _ in range(suffix.PIECE + 5000))
    found = set()
    for data, ends, rows, begins in suffix.pieces_of(pa.array([b"", text[:50], text], pa.binary())):
        start, stop, _, _ = suffix.anchors(data, ends, True)
        assert rows == [2]
        for a, b in zip(start.tolist(), stop.tolist(), strict=True):
            new = set(range(a + begins[0], b + begins[0] + 1))
            assert not new & found
            found |= new
    assert found == set(range(len(text) - 99))
