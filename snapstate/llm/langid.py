"""Language identification by nearest centroid.

A text is lower-cased, everything but letters becomes a space, and its 1- to 3-grams are counted in DIMS hashed
places. Damped counts times inverse document frequency, at unit length, are compared by cosine with CENTROIDS
centroids per language, found by spherical k-means; the nearest centroid's language is predicted. A text further from
its centroid than the training texts of that centroid (with some slack) is rejected: flagged, not relabelled.

Training rows have a lang and crc32(doc_id as text) mod 5 other than 0. At most about SAMPLE of them are used, in
equal quotas for each value of lang, but at least about one each: the model, like any of centroids, has a size in
proportion to the number of languages. Rows that are equal in doc_id, text and lang count once.

Defined cases: a null text or one without a letter is `und` with score 0; without training rows everything is;
repeated rows get equal results; of equally near centroids the first language in order counts; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold

DIMS, CENTROIDS, SAMPLE = 2048, 3, 6000
#: A text is rejected beyond this quantile of its centroid's training distances, times the slack.
QUANTILE, SLACK = 0.995, 1.15
_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point, itself if it is a letter, else 0."""
    return np.array([c if not 0xD800 <= c < 0xE000 and chr(c).isalpha() else 0 for c in range(0x110000)], np.uint64)


def counts(text: str | None) -> np.ndarray | None:
    """Hashed n-gram counts, or None for a text without a letter."""
    if not text:
        return None
    points = letters()[np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)]
    if not points.any():
        return None
    points = np.concatenate([np.zeros(1, np.uint64), points, np.zeros(1, np.uint64)])
    points = points[1:][(points[1:] > 0) | (points[:-1] > 0)]  # one space between words
    points = np.concatenate([np.zeros(1, np.uint64), points])
    out = np.zeros(DIMS)
    gram = np.zeros(len(points), np.uint64)
    for n in (1, 2, 3):
        gram = gram[: len(points) - n + 1] * np.uint64(0x1_0001_0001) + points[n - 1 :] + np.uint64(n)
        place = ((gram * _MIX) >> np.uint64(64 - 11)).astype(np.int64)
        out += np.bincount(place, minlength=DIMS)
    return out


@dataclass
class Model:
    langs: list[str] = field(default_factory=list)  # of each centroid
    idf: np.ndarray = field(default_factory=lambda: np.ones(DIMS))
    centroids: np.ndarray = field(default_factory=lambda: np.zeros((0, DIMS)))
    reach: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def vector(self, found: np.ndarray) -> np.ndarray:
        v = np.log1p(found) * self.idf
        return v / max(1e-12, float(np.sqrt(v @ v)))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        found = counts(text)
        if found is None or not self.langs:
            return "und", 0.0, True
        near = self.centroids @ self.vector(found)
        best = int(near.argmax())
        score = float(min(1.0, max(0.0, near[best])))
        return self.langs[best], score, bool(1 - near[best] > self.reach[best])


def cluster(x: np.ndarray, k: int, rounds: int = 20) -> np.ndarray:
    """Spherical k-means on unit rows, begun at rows far from each other."""
    mean = x.mean(0)
    centres = [x[int((x @ mean).argmax())]]
    while len(centres) < min(k, len(x)):
        centres.append(x[int((x @ np.array(centres).T).max(1).argmin())])
    c = np.array(centres)
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        new = np.array([x[own == j].sum(0) if (own == j).any() else c[j] for j in range(len(c))])
        new /= np.maximum(1e-12, np.sqrt((new**2).sum(1, keepdims=True)))
        if np.allclose(new, c, atol=1e-7):
            break
        c = new
    return c


def train(found: np.ndarray, lang: list[str], centroids: int = CENTROIDS) -> Model:
    model = Model()
    if not len(found):
        return model
    model.idf = np.log((1 + len(found)) / (1 + (found > 0).sum(0))) + 1
    x = np.log1p(found) * model.idf
    x /= np.maximum(1e-12, np.sqrt((x**2).sum(1, keepdims=True)))
    labels = np.array(lang)
    parts, reach = [], []
    for name in sorted(set(lang)):
        mine = x[labels == name]
        c = cluster(mine, centroids)
        near = mine @ c.T
        own = near.argmax(1)
        for j in range(len(c)):
            gap = 1 - near[own == j, j]
            reach.append(SLACK * float(np.quantile(gap, QUANTILE)) if len(gap) else 0.0)
        parts.append(c)
        model.langs += [name] * len(c)
    model.centroids, model.reach = np.concatenate(parts), np.array(reach)
    return model


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != 0)).select("doc_id", "text", "lang")
    per = known.groupBy("lang").agg(F.count("*").alias("n"), F.min(F.xxhash64("doc_id", "text")).alias("least")).collect()
    if not per:
        return Model()
    quota = max(1, sample // len(per))
    limits = known.sparkSession.createDataFrame([(r["lang"], int((1 << 30) * min(1.0, quota / r["n"])), r["least"]) for r in per], "lang string, bound long, least long")
    spot = F.xxhash64("doc_id", "text")
    picked = known.withColumn("row", spot).join(F.broadcast(limits), "lang").where((F.pmod("row", F.lit(1 << 30)) < F.col("bound")) | (F.col("row") == F.col("least")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [(n, counts(t), k) for k, t, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            got = [g for g in got if g[1] is not None]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.string()), pa.array([g[1].astype("<f4").tobytes() for g in got], pa.binary()), pa.array([g[2] for g in got], pa.int64())], ["lang", "counts", "row"])

    rows = picked.select("row", "text", "lang").mapInArrow(run, "lang string, counts binary, row long")
    rows = rows.groupBy("lang", "row").agg(F.max("counts").alias("counts")).orderBy("row", "lang").toPandas()
    found = np.array([np.frombuffer(c, "<f4") for c in rows["counts"]], np.float32).reshape(-1, DIMS)
    return train(found, rows["lang"].tolist())


def report(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected."""
    model = fit(docs) if model is None else model
    names = ["doc_id", "held_out", "lang_pred", "score", "rejected"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [model.predict(t.as_py()) for t in b.column(2)]
            columns = [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *columns], names)

    rows = docs.select(F.col("doc_id").cast("long"), (fold(F.col("doc_id")) == 0).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
