"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A lexicon is learned from the training rows (words and beginnings of words far likelier in toxic documents), then features are taken per
document: lexicon densities, hits near the second person, capitals, punctuation and obfuscation rates. Trees are
fitted on the driver on a bounded sample of at most about SAMPLE labelled rows, of which every fifth calibrates;
scoring reads every row and whole text where it lies and shuffles nothing.

Training rows are the labelled ones whose crc32(doc_id as text) mod 5 is not 0.

Defined cases: null and empty texts have the features of a text without words; unlabelled and null labels are not
learned from; of several labels for one doc_id the highest counts, and of several texts of one labelled doc_id one;
where all training labels are alike every score is that label, without any training row 0; rows are scored one by one,
so repeated rows get equal scores; an empty table gives an empty result; other columns, whatever their names or types,
are ignored by report() and carried by score() and keep_clean().
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold, keep, packed, whole_text

SAMPLE, LEXICON = 20_000, 400
TREES, DEPTH, RATE, BINS, RIDGE = 120, 4, 0.1, 64, 2.0
#: Second-person words of the languages served; digits and signs that stand for letters.
YOU = {"you", "your", "yours", "yourself", "ye", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "tú", "ti", "usted", "ustedes", "vos", "su"}
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
NEAR = 6
STEMS = (5, 6, 7)  # letters of the beginnings of words, in the lexicon with a *
PLAIN = (0.0, False, False, False, False)  # of a token that tells nothing
FEATURES = ("hits", "hit_density", "strength_density", "max_strength", "distinct_hits", "disguised_hits", "near_you", "you_density", "capital_rate", "shout_rate", "exclaim_rate", "punctuation_rate", "obfuscation_rate", "log_words", "mean_word", "line_hits")


class Featurizer:
    """Features of texts under a lexicon word -> strength. Facts about a token are kept for its next occurrence."""

    def __init__(self, lexicon: dict[str, float], room: int = 100_000):
        self.lexicon, self.room, self.facts = lexicon, room, {}
        self.heads = {w.rstrip("*")[: STEMS[0]] for w in lexicon}

    def strength(self, word: str) -> float:
        if word[: STEMS[0]] not in self.heads:
            return 0.0
        known = self.lexicon.get(word)
        if known is None:
            known = max((self.lexicon.get(word[:n] + "*", 0.0) for n in STEMS if len(word) > n), default=0.0)
        return known

    def look(self, token: str) -> tuple[float, bool, bool, bool, bool]:
        """Strength, and whether the token is disguised, shouted, obfuscated, a second person."""
        core = token if token.isalpha() else token.strip(string.punctuation)
        low = core.lower()
        strength = self.strength(low)
        odd = not core.isalpha() and any(c.isalpha() for c in core) and not core.replace("-", "").replace("'", "").isalpha()
        disguised = False
        if odd and not strength:
            strength = self.strength("".join(c for c in low.translate(LEET) if c.isalpha()))
            disguised = strength > 0
        out = (strength, disguised, len(core) > 2 and core.isupper(), odd, low in YOU)
        out = out if any(out) else PLAIN
        if len(self.facts) >= self.room:
            self.facts.clear()
        self.facts[token] = out
        return out

    def row(self, text: str | None) -> list[float]:
        text = text or ""
        tokens = text.split()
        n = max(1, len(tokens))
        facts = self.facts
        hits, strengths, you, distinct, disguised, shout, odd = [], 0.0, [], set(), 0, 0, 0
        most = 0.0
        for at, token in enumerate(tokens):
            fact = facts.get(token) or self.look(token)
            if fact is PLAIN:
                continue
            strength, hidden, loud, strange, second = fact
            if strength:
                hits.append(at)
                distinct.add(token)
                strengths += strength
                most = max(most, strength)
                disguised += hidden
            shout += loud
            odd += strange
            if second:
                you.append(at)
        near = 0
        if hits and you:
            spots = np.array(you)
            place = np.searchsorted(spots, hits)
            gap = np.minimum(np.abs(spots[np.minimum(place, len(spots) - 1)] - hits), np.abs(spots[np.maximum(place - 1, 0)] - hits))
            near = int((gap <= NEAR).sum())
        chars = max(1, len(text))
        capitals = sum(map(text.count, string.ascii_uppercase))
        marks = sum(map(text.count, string.punctuation))
        return [len(hits), len(hits) / n, strengths / n, most, len(distinct), disguised, near, len(you) / n, capitals / chars, shout / n, (text.count("!") + text.count("?")) / n, marks / chars, odd / n, math.log1p(len(tokens)), chars / n, len(hits) / (1 + text.count("\n"))]

    def matrix(self, texts) -> np.ndarray:
        return np.array([self.row(t) for t in texts], float).reshape(-1, len(FEATURES))


@dataclass
class Model:
    """Trees as arrays: node k of a tree has children 2k+1 and 2k+2; split[k] < 0 marks a leaf."""

    lexicon: dict[str, float] = field(default_factory=dict)
    base: float = 0.0
    split: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), int))
    cut: np.ndarray = field(default_factory=lambda: np.zeros((0, 1)))
    value: np.ndarray = field(default_factory=lambda: np.zeros((0, 1)))
    knots: tuple[np.ndarray, np.ndarray] = (np.zeros(1), np.zeros(1))

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for split, cut, value in zip(self.split, self.cut, self.value, strict=True):
            node = np.zeros(len(x), int)
            for _ in range(DEPTH):
                f = split[node]
                go = 2 * node + 1 + (x[rows, np.maximum(f, 0)] > cut[node])
                node = np.where(f >= 0, go, node)
            out += value[node]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.margin(x), *self.knots)


def grow(x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Newton boosting of the logistic loss with histograms of at most BINS quantile bins a feature."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], 1)
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(rate / (1 - rate)))
    size = 2 ** (DEPTH + 1) - 1
    split, cut, value = np.full((TREES, size), -1), np.zeros((TREES, size)), np.zeros((TREES, size))
    margin = np.full(len(y), base)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), int)
        for k in range(size):
            mine = np.flatnonzero(node == k)
            gs, hs = g[mine].sum(), h[mine].sum()
            value[t, k] = RATE * gs / (hs + RIDGE)
            if k >= 2**DEPTH - 1 or len(mine) < 20:
                continue
            best = (1e-3, -1, 0)
            for f in range(x.shape[1]):
                gl = np.cumsum(np.bincount(binned[mine, f], g[mine], len(edges[f]) + 1))[:-1]
                hl = np.cumsum(np.bincount(binned[mine, f], h[mine], len(edges[f]) + 1))[:-1]
                if len(gl):
                    gain = gl**2 / (hl + RIDGE) + (gs - gl) ** 2 / (hs - hl + RIDGE) - gs**2 / (hs + RIDGE)
                    gain[(hl < 0.5) | (hs - hl < 0.5)] = 0
                    if gain.max() > best[0]:
                        best = (float(gain.max()), f, int(gain.argmax()))
            if best[1] >= 0:
                split[t, k], cut[t, k] = best[1], edges[best[1]][best[2]]
                node[mine] = 2 * k + 1 + (binned[mine, best[1]] > best[2])
        margin += value[t, node]
    return base, split, cut, value


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: knots of the best rising fit of y on margin, straight lines between pools."""
    pools: list[list[float]] = []
    for k in np.argsort(margin, kind="stable"):
        pools.append([float(y[k]), 1.0, float(margin[k]), float(margin[k])])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            s, n, _, hi = pools.pop()
            pools[-1] = [pools[-1][0] + s, pools[-1][1] + n, pools[-1][2], hi]
    xs, ys = [], []
    for s, n, lo, hi in pools:
        xs += [lo, hi + 1e-9]
        ys += [s / n] * 2
    return np.array(xs), np.clip(np.array(ys), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns from docs joined with labels(doc_id, toxic); the sample's labels, at most about `sample`, are broadcast."""
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = marked.count()
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    picked = marked.where(spot < int((1 << 30) * min(1.0, sample / max(1, total))))
    rows = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(picked), "doc_id")
    rows = keep(rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min_by("text", F.xxhash64("text")).alias("text")), "toxicity")
    plain = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    stems = [F.transform(F.filter(plain, lambda w, n=n: F.length(w) > n), lambda w, n=n: F.concat(F.substring(w, 1, n), F.lit("*"))) for n in STEMS]
    words = rows.select("toxic", F.explode(F.array_distinct(F.concat(plain, *stems))).alias("word"))
    counts = rows.agg(F.sum(F.col("toxic").cast("long")).alias("bad"), F.count("*").alias("n")).first()
    if not counts["bad"] or counts["bad"] == counts["n"]:
        return Model(knots=(np.zeros(1), np.full(1, 1.0 if counts["bad"] else 0.0)))
    bad, good = counts["bad"], counts["n"] - counts["bad"]
    seen = words.groupBy("word").agg(F.sum(F.col("toxic").cast("long")).alias("b"), F.count("*").alias("n")).where("b >= 3")
    odds = F.log((F.col("b") + 0.5) / (bad + 1.0)) - F.log((F.col("n") - F.col("b") + 0.5) / (good + 1.0))
    surest = odds - 3 * F.sqrt(1 / (F.col("b") + 0.5) + 1 / (F.col("n") - F.col("b") + 0.5))
    best = seen.select("word", surest.alias("s")).where("s > 0.3").orderBy(F.desc("s"), "word").limit(LEXICON).collect()
    lexicon = {r["word"]: float(r["s"]) for r in best}

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Featurizer(lexicon)
        for b in batches:
            x = look.matrix(t.as_py() for t in b.column(2))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "toxic", "x"])

    found = rows.select("doc_id", F.col("toxic").cast("int"), "text").mapInArrow(features, "doc_id long, toxic int, x array<double>").withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(5))).orderBy("doc_id", "x").toPandas()
    x, y, held = np.stack(found["x"]), found["toxic"].to_numpy(float), found["part"].to_numpy() == 0
    if y[held].sum() < 5 or y[~held].sum() < 5 or len(x) < 500:
        held = np.zeros(len(y), bool)  # too few to set some aside
    base, split, cut, value = grow(x[~held], y[~held])
    model = Model(lexicon, base, split, cut, value)
    use = held if held.any() else ~held
    model.knots = isotonic(model.margin(x[use]), y[use])
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score and predicted added, in place of columns of these names."""
    docs = docs.drop("score", "predicted")
    at = docs.columns.index("text")
    names = ["score", "predicted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Featurizer(model.lexicon)
        for b in batches:
            s = model.score(look.matrix(t.as_py() for t in b.column(at))) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))], [*b.schema.names, *names])

    return docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = score(docs.select("doc_id", "text"), fit(docs, labels))
    return out.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are not predicted toxic, with their columns."""
    rows = docs.select(packed(docs).alias("_row"), "text")
    return score(rows, fit(docs, labels)).where("predicted = 0").select("_row.*")
