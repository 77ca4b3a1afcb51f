"""Packing, sharding, mixing, PII, languages, toxicity and media on small tables and against brute force."""

from __future__ import annotations

import hashlib
import io
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapstate.llm import langid, media, mixing, packing, pii, registry, shards, toxicity
from snapstate.llm.common import documents

from .conftest import words

# packing


@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_equal_those_of_the_tokenizers_library(spark, sf_dir, tokenizer):
    texts = [r["text"] for r in documents(spark, sf_dir).select("text").collect()] + ["", " ", "<|endoftext|> x", "a<|endoftext|>b", "a <|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext|", "<|ENDOFTEXT|>\n<|endoftext|>\n", "a b\n\n\n  c", "🎉" * 2000, "1234567890" * 30, "a" * 20_000, " " * 20_000, "\n" * 9000 + "x", "漢字" * 3000, "a\x00b\ufffd " * 500]
    for text, want in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert packing.token_ids(text, "byte_bpe_50k.json").tolist() == [*want.ids, 0]


def check_packed(rows, placed, tokenizer, window=1024):
    seen = Counter()
    for d, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for at in range(0, len(ids), window):
            part = np.array(ids[at : at + window], "<u4")
            seen[d, at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in placed) == seen
    by = defaultdict(list)
    for r in placed:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= window
    total = sum(r["length"] for r in placed)
    return len(by), total


def test_packing(table, odd_rows, tokenizer):
    rows = odd_rows + [(1000 + k, words(random.Random(k).randrange(1, 700), k)) for k in range(200)]
    n, total = check_packed(rows, packing.pack(table(rows)).collect(), tokenizer)
    assert n <= math.ceil(total / 1024) + 2
    n, total = check_packed(rows, packing.pack(table(rows), shard_pieces=40).collect(), tokenizer)
    assert n <= 1.2 * total / 1024
    assert packing.pack(table([])).isEmpty()
    out = packing.sequences(table(rows)).collect()
    assert {len(r["ids"]) for r in out} == {1024} and sum(r["n_tokens"] for r in out) == sum(len(packing.token_ids(t, "byte_bpe_50k.json")) for _, t, *_ in rows)


def test_rows_of_one_doc_id_are_dealt_over_shards(table, tokenizer):
    rows = [(None if k % 2 else 7, words(20 + k % 9, k)) for k in range(300)]
    placed = packing.pack(table(rows), shard_pieces=30).collect()
    check_packed(rows, placed, tokenizer)
    assert len({r["sequence_id"] >> 32 for r in placed}) == 10


def naive_best_fit(lengths, window):
    room = []
    for n in lengths:
        fit = [k for k, r in enumerate(room) if r >= n]
        if fit:
            k = min(fit, key=lambda k: room[k])
            room[k] -= n
        else:
            room.append(window - n)
    return sorted(room)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_the_segment_tree_packs_like_a_plain_search(lengths):
    lengths = sorted(lengths, reverse=True)
    where, offset = packing.best_fit(np.array(lengths, np.int64), 64)
    used = Counter()
    for w, o, n in zip(where.tolist(), offset.tolist(), lengths, strict=True):
        assert o == used[w]
        used[w] += n
    assert sorted(64 - u for u in used.values()) == naive_best_fit(lengths, 64)


# sharding


def jump(key, n):
    """The published loop, on Python integers."""
    key, b, j = key % 2**64, -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_jump_hash():
    r = random.Random(1)
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *[r.randrange(-(2**63), 2**63) for _ in range(500)]]
    for n in (1, 2, 8, 9, 100):
        assert shards.jump_hash(np.array(keys), n).tolist() == [jump(k, n) for k in keys]


def test_shards(table, odd_rows):
    rows = odd_rows + [(k, words(3, k)) for k in range(100, 900)]
    got = shards.assign(table(rows)).collect()
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), jump(d or 0, 8), jump(d or 0, 9)) for d, t, *_ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        assert r["law"] == "key" and r["grown_shard"] in (r["shard"], 8)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(8))
    assert shards.assign(table([])).isEmpty()


def test_written_shards(table, tmp_path, spark):
    docs = table([(k, str(k)) for k in range(50)], clash=False)
    shards.write_shards(docs, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 50


# mixing


def brute_targets(sizes, weights=(5, 2, 1)):
    """Shares, with what exceeds three times a source's size given to the others by weight, again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    total, target, capped = sum(sizes.values()), {}, set()
    target = {s: total * w[s] / sum(w.values()) for s in order}
    while True:
        over = {s for s in order if s not in capped and target[s] > 3 * sizes[s] * (1 + 1e-12)}
        if not over:
            return target
        capped |= over
        free = [s for s in order if s not in capped]
        excess = total - sum(3 * sizes[s] for s in capped) - sum(target[s] for s in free)
        share = sum(w[s] for s in free)
        target = {s: 3 * sizes[s] if s in capped else target[s] + excess * w[s] / share for s in order}


def mixed_rows():
    r = random.Random(8)
    return [(k, words(r.randrange(0, 60), k), "en", s) for k, s in enumerate(["a"] * 200 + ["b"] * 5 + ["c"] * 3 + ["ü"] * 40 + [None] * 30 + ["z"] * 2)] + [(900, None, None, "empty"), (901, "", None, "empty"), (5, "twin twin", "en", "a"), (5, "twin twin", "en", "a")]


def test_mixing_targets_and_taken(table):
    rows = mixed_rows()
    got = mixing.report(table(rows)).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += size(t)
    want = brute_targets(sizes)
    source = {(d, size(t)): s for d, t, _, s in rows}
    taken = Counter()
    for r in got:
        s = source[r["doc_id"], r["size"]]
        assert r["source_size"] == sizes[s] and math.isclose(r["target"], want[s], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["first_time"] is None) == (r["taken"] == 0)
        taken[s] += r["taken"]
    copies = [(r["first_time"], r["position"]) for r in got if r["taken"]]
    assert len({p for _, p in copies}) == len(copies) and [t for t, _ in sorted(copies, key=lambda c: c[1])] == sorted(t for t, _ in copies)
    assert max(p for _, p in copies) < sum(-(-r["taken"] // r["size"]) for r in got if r["taken"]) and all((r["position"] is None) == (r["taken"] == 0) for r in got)
    assert len(got) == len(rows) and all(abs(taken[s] - want[s]) <= 0.5001 for s in sizes)


def test_the_mix_in_order(table):
    rows = mixed_rows()
    docs = table(rows)
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    plan = Counter()
    for r in mixing.report(docs).collect():
        plan[r["doc_id"]] += r["taken"]
    got = Counter()
    order = {r["doc_id"]: r["position"] for r in mixing.report(docs).collect() if r["taken"] and r["doc_id"] != 5}
    firsts = [r["doc_id"] for k, r in enumerate(out.collect()) if order.get(r["doc_id"]) == k]
    assert set(firsts) == set(order)  # each document's first copy stands at its position
    for r in out.collect():
        got[r["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
        assert r["n_chars"] == len(r["text"])
    assert got == Counter({k: v for k, v in plan.items() if v})
    assert mixing.mix(table([])).isEmpty() and mixing.report(table([])).isEmpty()
    assert mixing.mix(table([(1, None), (2, " ")])).isEmpty()


def test_schedules_are_inverted(spark):
    for kind, knots in enumerate(mixing.SCHEDULES):
        parts = mixing.segments(knots)
        assert math.isclose(parts[-1]["c1"], 1.0)
        df = spark.range(101).select((F.col("id") / 100).alias("u"))
        for r in df.select("u", mixing.time_of(F.col("u"), F.lit(kind)).alias("t")).collect():
            area = sum((lambda x, s: s["w0"] * x + (s["w1"] - s["w0"]) / (2 * s["len"]) * x * x)(min(max(r["t"] - s["t0"], 0), s["len"]), s) for s in parts)
            assert math.isclose(area, r["u"], abs_tol=1e-9)
    with pytest.raises(ValueError):
        mixing.segments(((0.0, 0.0), (1.0, 0.0)))


# personal data


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP, CARD, PHONE = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        check = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits)))
        out += [(m.start(), 2, m.end())] if 12 <= len(digits) <= 19 and check % 10 == 0 else []
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a@.1234567890+ -()é%x", max_size=60))
def test_rules_equal_the_patterns(text):
    assert pii.base_spans(text) == brute_spans(text)


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 200_000, "a@" * 200_000, "+1" * 200_000, "1 " * 200_000, "0" * 5000 + ".1.2.3"])
def test_rules_are_linear(text):
    pii.base_spans(text)


ENTITIES = ("jo.{0}@mail{1}.example.com", "{2}.{3}.7.{1}", "{4}", "+1 ({5}) 555-{6}")


LETTERS = str.maketrans("0123456789", "abcdefghij")


def with_check_digit(digits):
    return next(digits + c for c in "0123456789" if pii.luhn(digits + c))


def personal_rows(n, seed):
    """Documents with one entity each, and numbers that are none."""
    r, out = random.Random(seed), []
    for k in range(n):
        card = with_check_digit("4" + "".join(r.choice("0123456789") for _ in range(14)))
        entity = ENTITIES[k % 4].format(r.randrange(10, 99), r.randrange(1, 9), r.randrange(20, 250), r.randrange(20, 250), card, r.randrange(200, 999), r.randrange(1000, 9999))
        plain = [str(r.randrange(10**15, 10**16)), str(r.randrange(10**9)), str(r.randrange(2000)), f"{r.randrange(300, 999)}.1.2.3", "x@y"]
        body = words(40, k + seed).translate(LETTERS).split()
        for p in (entity, r.choice(plain), r.choice(plain)):
            body.insert(r.randrange(len(body)), p)
        out.append((k, " ".join(body), entity))
    return out


@pytest.fixture(scope="module")
def field(table):
    """Weights learned by fit() itself."""
    return pii.fit(table([r[:2] for r in personal_rows(400, 1)]))


FORMS = (
    ("jo.42@mail7.example.com", "jo.42(at)mail7", 0), ("jo.42@mail7.example.com", "mailbox=jo.42@mail7", 0), ("120.31.7.9", "120-31-7-9", 1), ("120.31.7.9", "120.31.7.299", 1),
    ("4111 1111 1111 1111", "4111111111111112", 2), ("4111 1111 1111 1111", "4111_1111_1111_1111", 2), ("+1 (017) 555-7713", "0175557713", 3), ("+1 (017) 555-7713", "tel:017/5557713", 3), ("+1 (017) 555-7713", "555 7713", 3),
)


@pytest.mark.parametrize(("entity", "form", "kind"), FORMS)
@pytest.mark.parametrize("repeats", [1, 60])
def test_the_fitted_field_adds_repeats_at_any_distance(field, entity, form, kind, repeats):
    filler = " " + words(200, 3).translate(LETTERS) + " to "
    text = f"Write {entity} today." + filler + filler.join([form] * repeats) + " end"
    base, more = pii.find(text, field)
    assert base == [(6, kind, 6 + len(entity))] and len(more) == repeats and {k for _, k, _ in more} == {kind}
    assert all(form.endswith(text[a:b]) and b - a >= len(form) - 8 for a, _, b in more)
    if kind:  # without the entity nothing tells what a number is
        assert pii.find(filler + form + filler + form, field)[1] == []


def test_the_fitted_field_finds_rehearsed_forms_and_no_look_alikes(field):
    found, missed, wrong, none, natural = 0, 0, 0, 0, 0
    for _, text, _ in personal_rows(400, 77_000):
        base, more = pii.find(text, field)
        natural += len(more)
        longer, added = pii.rehearsed(text, base)
        fixed, more = pii.find(longer, field)
        for a, label, b in added:
            got = [k for s, k, e in more if s < b and e > a]
            if label == pii.NONE:
                none, wrong = none + 1, wrong + bool(got)
            elif not any(s < b and e > a for s, _, e in fixed):
                found, missed = found + (got == [label]), missed + (got != [label])
    assert found / (found + missed) > 0.95 and wrong / none < 0.02 and natural < 5 and found > 200


def test_what_resembles_an_entity_is_not_learned_as_none():
    x, y = pii.evidence("Dial +1 (017) 555-7713 or 0175557713 now, by 2019.")
    assert sorted(y.tolist()) == [3, 3, pii.NONE, pii.NONE]  # the entity, its form; the look-alike and the year


def test_marginals_equal_enumeration_on_a_tree():
    r = np.random.default_rng(2)
    f = pii.Field(r.normal(size=(pii.SHAPES, pii.LABELS)), np.diag(r.normal(size=pii.LABELS)), np.eye(pii.LABELS))
    shape = np.array([pii.shape(t) for t in ("555", "a@b.c", "12345678", "x1")], float)
    nodes = pii.Nodes(np.zeros(4), np.ones(4), shape, np.array([-1, 0, -1, -1]), np.array([[0, 1], [1, 2]]), np.array([[0, 3]]))
    got = f.marginals(nodes)
    want = np.zeros((4, pii.LABELS))
    own = shape @ f.unary
    for y in np.ndindex(*[pii.LABELS] * 4):
        if y[1] == 0:
            s = sum(own[k, y[k]] for k in (0, 2, 3)) + f.chain[y[0], y[1]] + f.chain[y[1], y[2]] + f.skip[y[0], y[3]]
            for k in range(4):
                want[k, y[k]] += math.exp(s)
    assert np.allclose(got, want / want.sum(1, keepdims=True), atol=1e-3)


def test_learning_reaches_the_gradients_zero():
    r = np.random.default_rng(4)
    x, y = r.integers(0, 3, (300, pii.SHAPES + 2 * pii.LABELS)).astype(float), r.integers(0, pii.LABELS, 300)
    f = pii.learn(x, y, np.ones(300))
    assert np.allclose(f.skip, f.skip.T) and np.allclose(f.chain, f.chain.T)
    w = np.concatenate([f.unary, f.chain, f.skip])
    p = np.exp(x @ w - (x @ w).max(1, keepdims=True))
    grad = x.T @ (p / p.sum(1, keepdims=True) - np.eye(pii.LABELS)[y])
    prior = np.zeros((pii.SHAPES, pii.LABELS))
    prior[0, pii.NONE] = 1.0
    assert np.allclose(grad[: pii.SHAPES] + f.unary - prior, 0, atol=1e-2)


def test_pii_report_and_redaction(table, odd_rows):
    rows = odd_rows + [(50, "mail a.b+c@x-y.example.com now, 10.0.0.255 and 4111 1111 1111 1111, +49 (30) 123-4567.")]
    got = {r["doc_id"]: r for r in pii.report(table(rows)).collect()}
    assert len(pii.report(table(rows)).collect()) == len(rows)
    for d, t, *_ in rows:
        base = brute_spans(t or "")
        assert (got[d]["n_email"], got[d]["n_ip"], got[d]["n_card"], got[d]["n_phone"]) == tuple(sum(s[1] == k for s in base) for k in range(4)) or d in (None, 3)
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        if d not in (None, 3):
            assert got[d]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest() and set(text.split(",")) <= set(got[d]["spans"].split(","))
    out = pii.redact(table(rows))
    assert out.columns == table(rows).columns
    assert {r["doc_id"]: r["text"] for r in out.collect()}[50] == "mail [email] now, [ip] and [card], [phone]."
    odd = table([(1, "at 10.0.0.255")], clash=False).selectExpr("*", "map('a', 1) AS `my col`", "struct(1 AS `b c`) AS `x.y`")
    assert pii.redact(odd).dtypes == odd.dtypes and pii.redact(odd).first()["text"] == "at [ip]"
    assert pii.report(table([])).isEmpty()


# languages


def test_languages(spark, sf_dir):
    docs = documents(spark, sf_dir)
    out = langid.report(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(out) > 20 and sum(r["lang"] == r["lang_pred"] for r in out) / len(out) > 0.95


def test_language_cases(table, odd_rows):
    rows = [(100 + k, "the cat and the dog " + words(9, k).replace("w", "th"), "en") for k in range(30)] + [(200 + k, "el gato y el perro ñ " + words(9, k).replace("w", "qu"), "es") for k in range(30)]
    rows = [*rows, *[(d, t, None, "s") for d, t, *_ in odd_rows], (300, "12 34 !?"), (301, "el perro ñ", None, None)]
    got = langid.report(table(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = [t for d, t, *_ in rows if d == r["doc_id"]]
        if all(not any(c.isalpha() for c in t or "") for t in text):
            assert r["lang_pred"] == "und" and r["score"] == 0
        assert r["lang_pred"] in ("en", "es", "und") and 0 <= r["score"] <= 1
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode() if r["doc_id"] is not None else b"") % 5 == 0)
    assert next(r for r in got if r["doc_id"] == 301)["lang_pred"] == "es"
    assert langid.report(table([])).isEmpty()
    assert {r["lang_pred"] for r in langid.report(table([(1, "text", None, "s")])).collect()} == {"und"}


def plain_counts(text):
    """The n-gram counts in plain Python: one space around words of letters, places by the multiplicative hash."""
    out, mask = [0.0] * langid.DIMS, 2**64 - 1
    letters = [ord(c) if c.isalpha() else 0 for c in (text or "").lower()]
    if not any(letters):
        return None
    squeezed = [0] + [p for before, p in zip([0, 0, *letters], [0, *letters, 0]) if p or before]
    for n in (1, 2, 3):
        for k in range(len(squeezed) - n + 1):
            gram = 0
            for i in range(n):
                gram = (gram * 0x1_0001_0001 + squeezed[k + i] + i + 1) & mask
            out[(gram * 0x9E3779B97F4A7C15 & mask) >> 53] += 1
    return out


def test_languages_equal_plain_nearest_centroids(table, odd_rows):
    """fit() and report() on a whole table against plain Python: counts, idf, unit vectors, k-means, nearest centroid."""
    rows = [(100 + k, "the cat and the dog " + words(9, k).replace("w", "th"), "en") for k in range(30)] + [(200 + k, "el gato y el perro ñ " + words(9, k).replace("w", "qu"), "es") for k in range(30)]
    rows = [*rows, *[(d, t, None, "s") for d, t, *_ in odd_rows if t is None or len(t) < 2000], (300, "12 34 !?"), (400, "zyx zyx", "rare"), (103, rows[3][1], "en")]
    known = sorted({(d, t, g[0]) for d, t, *g in rows if d is not None and t and g and g[0] and zlib.crc32(str(d).encode()) % 5 and plain_counts(t)}, key=str)
    vectors = [plain_counts(t) for _, t, _ in known]
    idf = [math.log((1 + len(vectors)) / (1 + sum(v[k] > 0 for v in vectors))) + 1 for k in range(langid.DIMS)]

    def unit(v):
        v = [math.log1p(c) * w for c, w in zip(v, idf, strict=True)]
        size = math.sqrt(sum(x * x for x in v))
        return [x / size for x in v]

    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True) if x)
    centroids = []
    for lang in sorted({g for _, _, g in known}):
        mine = [unit(v) for v, (_, _, g) in zip(vectors, known, strict=True) if g == lang]
        mean = [sum(c) / len(mine) for c in zip(*mine, strict=True)]
        c = [max(mine, key=lambda v: dot(v, mean))]
        while len(c) < min(langid.CENTROIDS, len(mine)):
            c.append(min(mine, key=lambda v: max(dot(v, x) for x in c)))
        for _ in range(20):
            own = [max(range(len(c)), key=lambda j: dot(v, c[j])) for v in mine]
            for j in range(len(c)):
                part = [v for v, o in zip(mine, own, strict=True) if o == j]
                if part:
                    total = [sum(x) for x in zip(*part, strict=True)]
                    size = math.sqrt(sum(x * x for x in total))
                    c[j] = [x / size for x in total]
        centroids += [(lang, x) for x in c]
    assert {g for g, _ in centroids} >= {"en", "es"}
    got = defaultdict(list)
    for r in langid.report(table(rows)).collect():
        got[r["doc_id"]].append(r)
    for d, t, *_ in rows:
        found = plain_counts(t)
        v = found and unit(found)
        near = [(dot(v, x), g) for g, x in centroids] if v else []
        for r in got[d]:
            if len(got[d]) == 1:
                assert r["lang_pred"] == (max(near, key=lambda n: n[0])[1] if near else "und") and math.isclose(r["score"], max(near)[0] if near else 0, abs_tol=1e-5)


def test_every_language_is_learned_and_repeated_rows_count_once(spark, table, monkeypatch):
    rows = [(k, "lang" + chr(97 + k % 26) * 3 + chr(97 + k // 26 % 26) * 2, f"l{k}") for k in range(1, 700) if zlib.crc32(str(k).encode()) % 5]
    sizes = []
    monkeypatch.setattr(langid, "train", lambda found, lang: sizes.append((len(found), len(set(lang)))) or langid.Model())
    langid.fit(table(rows + [rows[0]] * 50))
    assert sizes == [(len(rows), len(rows))]


def test_clusters_are_separate():
    r = np.random.default_rng(1)
    x = np.concatenate([np.eye(20)[k] + r.normal(0, 0.02, (30, 20)) for k in range(3)])
    x /= np.sqrt((x**2).sum(1, keepdims=True))
    assert sorted((langid.cluster(x, 3)).argmax(1).tolist()) == [0, 1, 2]


# toxicity


def toxic_table(table, spark, n=900):
    r, rows, labels = random.Random(5), [], []
    for k in range(n):
        w = words(r.randrange(20, 120), k).split()
        bad = k % 6 == 0
        for _ in range(4 if bad else 0):
            w.insert(r.randrange(len(w)), r.choice(["you grobian", "you blarg", "zonk!!"]))
        rows.append((k, " ".join(w)))
        labels.append((k, 1, int(bad)))
    return rows, spark.createDataFrame(labels + [(3, 0, None), (None, 1, 1), (5, 0, 0), (99_999, 1, 1)], "doc_id long, quality int, toxic int")


def test_toxicity(table, spark, odd_rows):
    rows, labels = toxic_table(table, spark)
    docs = table(rows + [(d and d + 5000, t) for d, t, *_ in odd_rows])
    got = {r["doc_id"]: r for r in toxicity.report(docs, labels).collect()}
    assert toxicity.report(docs, labels).count() == docs.count()
    held = [k for k in range(900) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(got[k]["held_out"] for k in held) and sum(r["held_out"] for r in got.values()) >= len(held)
    right = [got[k]["predicted"] == int(k % 6 == 0) for k in held]
    assert sum(right) / len(right) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    out = toxicity.keep_clean(docs, labels)
    assert out.columns == docs.columns
    ids = {r["doc_id"] for r in out.collect()}
    assert ids == {k for k, r in got.items() if not r["predicted"]}


def test_toxicity_without_labels(table, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {(r["score"], r["predicted"]) for r in toxicity.report(table([(1, "x"), (2, None)]), labels).collect()} == {(0.0, 0)}
    assert toxicity.report(table([]), labels).isEmpty()


def test_one_class_labels_odd_columns_and_repeated_ids(table, spark):
    all_bad = spark.createDataFrame([(k, 1, 1) for k in range(30)], "doc_id long, quality int, toxic int")
    docs = table([(k, f"text {k}") for k in range(30)] + [(3, "other")] * 40 + [(4, None)], clash=False).selectExpr("*", "map('a', 1) AS `my col`", "1 AS `x.y`", "2 AS score")
    assert {(r["score"], r["predicted"]) for r in toxicity.report(docs, all_bad).collect()} == {(1.0, 1)}
    all_good = all_bad.selectExpr("doc_id", "quality", "0 AS toxic")
    out = toxicity.keep_clean(docs, all_good)
    assert out.dtypes == docs.dtypes and out.count() == docs.count()
    assert toxicity.keep_clean(docs, all_bad).isEmpty()


def plain_trees(x, y, trees, depth, rate, bins, ridge):
    """Newton boosting with every split tried by plain sums."""
    edges = [sorted(set(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1]).tolist())) for f in range(x.shape[1])]
    rate_of = min(max(float(np.mean(y)), 1e-3), 1 - 1e-3)
    margin = [math.log(rate_of / (1 - rate_of))] * len(y)
    for _ in range(trees):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        g, h = [t - q for t, q in zip(y, p, strict=True)], [q * (1 - q) for q in p]

        def leaf(rows, g=g, h=h):
            return rate * sum(g[k] for k in rows) / (sum(h[k] for k in rows) + ridge)

        def split(rows, level, g=g, h=h):
            best = (1e-3, None, None)
            gs, hs = sum(g[k] for k in rows), sum(h[k] for k in rows)
            for f in range(x.shape[1] if level < depth and len(rows) >= 20 else 0):
                for cut in edges[f]:
                    left = [k for k in rows if x[k, f] <= cut]
                    gl, hl = sum(g[k] for k in left), sum(h[k] for k in left)
                    if hl >= 0.5 and hs - hl >= 0.5:
                        gain = gl**2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs**2 / (hs + ridge)
                        if gain > best[0] + 1e-12:
                            best = (gain, f, cut)
            if best[1] is None:
                return [(rows, leaf(rows))]
            return split([k for k in rows if x[k, best[1]] <= best[2]], level + 1) + split([k for k in rows if x[k, best[1]] > best[2]], level + 1)

        for rows, value in split(list(range(len(y))), 0):
            for k in rows:
                margin[k] += value
    return np.array(margin)


def test_trees_equal_plain_boosting(monkeypatch):
    monkeypatch.setattr(toxicity, "TREES", 4)
    monkeypatch.setattr(toxicity, "BINS", 12)
    r = np.random.default_rng(9)
    x = np.round(r.normal(size=(250, 5)), 3)
    y = ((x[:, 0] + x[:, 1] * x[:, 2] + r.normal(0, 0.3, 250)) > 0.4).astype(float)
    base, split, cut, value = toxicity.grow(x, y)
    got = toxicity.Model({}, base, split, cut, value).margin(x)
    assert np.allclose(got, plain_trees(x, y, 4, toxicity.DEPTH, toxicity.RATE, 12, toxicity.RIDGE), atol=1e-9)


def test_isotonic_fit_rises_and_averages():
    r = np.random.default_rng(3)
    x = r.normal(size=500)
    y = (r.random(500) < 1 / (1 + np.exp(-2 * x))).astype(float)
    xs, ys = toxicity.isotonic(x, y)
    fitted = np.interp(x, xs, ys)
    assert (np.diff(ys) >= 0).all() and math.isclose(fitted.sum(), y.sum(), rel_tol=1e-6)


def test_features_of_disguises_and_addressees():
    look = toxicity.Featurizer({"idiot": 2.0})
    names = toxicity.FEATURES
    f = dict(zip(names, look.row("You are an 1d10t, IDIOT! Idiot."), strict=True))
    assert (f["hits"], f["disguised_hits"], f["near_you"]) == (3, 1, 3) and f["shout_rate"] > 0 and f["obfuscation_rate"] > 0
    assert all(math.isfinite(v) for t in (None, "", " ", "!" * 50) for v in look.row(t))


# media


@pytest.mark.parametrize("shape", [(1, 64), (3, 5), (40, 64)])
def test_images_round_trip(shape):
    image = np.random.default_rng(1).integers(0, 256, (*shape, 3)).astype(np.uint8)
    for encode in (media.encode_ppm, media.encode_bmp):
        assert (media.decode(encode(image)) == image).all()


def test_other_image_kinds():
    assert media.decode(b"P1\n# c\n3 2\n1 0 1\n0 1 0\n")[:, :, 0].tolist() == [[0, 1, 0], [1, 0, 1]]
    assert media.decode(b"P2 2 1 255\n7 9\n")[:, :, 0].tolist() == [[7, 9]]
    assert media.decode(b"P3 1 1 255 1 2 3").tolist() == [[[1, 2, 3]]]
    assert media.decode(b"P4 10 1\n" + bytes([0b10101010, 0b11000000]))[0, :, 0].tolist() == [0, 1, 0, 1, 0, 1, 0, 1, 0, 0]
    assert media.decode(b"P5 2 1 65535\n" + bytes([1, 0, 0, 2]))[0, :, 0].tolist() == [256, 2]
    with pytest.raises(ValueError):
        media.decode(b"GIF89a")


def test_area_resize_equals_plain_boxes():
    image = np.random.default_rng(2).integers(0, 256, (24, 36)).astype(float)
    assert np.allclose(media.area_resize(image, 8, 9), image.reshape(8, 3, 9, 4).mean((1, 3)))
    fine = np.kron(image[:5, :7], np.ones((8, 9)))
    assert np.allclose(media.area_resize(image[:5, :7], 8, 9), fine.reshape(8, 5, 9, 7).mean((1, 3)))


def test_media(table, odd_rows):
    got = media.report(table(odd_rows)).collect()
    want = Counter()
    for d, t, *_ in odd_rows:
        b = (t or "").encode()
        full = b.ljust(max(1, -(-len(b) // 192)) * 192)
        want[d, len(b), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-16:])] += 1
    assert Counter((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in got) == want
    assert len({r["feature"] for r in got if r["payload_sha256"] == got[0]["payload_sha256"]}) == 1
    for r in media.media(table(odd_rows)).collect():
        image = media.decode(bytes(r["media"]))
        tile = np.load(io.BytesIO(bytes(r["tile"])))
        assert tile.shape == (16, 16) and tile.dtype == np.uint8 and image.shape[1] == 64
        assert int(r["difference_hash"], 16) == media.difference_hash(media.grey(image))
    assert media.report(table([])).isEmpty()


# the pipeline


def test_pipeline_equals_brute_force(spark, sf_dir, tokenizer):
    import corpus_pipeline

    docs = documents(spark, sf_dir)
    names, frames = [], [docs]
    for name, stage in corpus_pipeline.STAGES:
        names.append(name)
        frames.append(stage(spark, frames[-1], sf_dir).cache())
        if name != "packing":
            assert frames[-1].columns == docs.columns
    assert names == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    clean, exact_rows, near_rows, mixed, packed = [[tuple(r) for r in f.collect()] for f in frames[1:]]
    rejected = {r["doc_id"] for r in toxicity.report(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect() if r["predicted"]}
    assert {r[0] for r in clean} == {r["doc_id"] for r in docs.collect()} - rejected
    best = {}
    for r in clean:
        best[r[1]] = max(best.get(r[1], -1), r[0])
    assert {r[0] for r in exact_rows} == set(best.values())
    from .test_dedup import brute_near

    _, group, least = brute_near(exact_rows)
    assert {r[0] for r in near_rows} == {least[g] for g in set(group)} and len(near_rows) == len(set(group))
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken = Counter(), Counter()
    for r in near_rows:
        sizes[r[3]] += size(r[1])
    for r in mixed:
        taken[r[3]] += size(r[1])
    for s, target in brute_targets(sizes).items():
        assert abs(taken[s] - target) <= 0.5001
    n, total = check_packed(mixed, frames[-1].collect(), tokenizer)
    assert n <= 1.06 * total / 1024
    assert corpus_pipeline.run(spark, sf_dir).count() == len(packed)


def test_registry_and_planted_sizes(spark, sf_dir):
    assert [int(q[2:].split("_")[0]) for q in registry.queries()] == list(range(1, 11))
    assert json.dumps(sorted(registry.oracle_sql()))
