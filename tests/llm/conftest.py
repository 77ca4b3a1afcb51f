"""Small document tables."""

from __future__ import annotations

import random

import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use for helper columns of their own.
CLASH = ("_row", "sha", "score", "kept", "_size", "_maybe", "shard", "node", "d", "group_size")


@pytest.fixture(scope="session")
def table(spark):
    def make(rows, clash=True):
        """rows: (doc_id, text[, lang[, source]])."""
        full = [(*r, *("en", "a")[len(r) - 2 :]) if len(r) < 4 else r for r in rows]
        full = [(r[0], r[1], r[2], r[3], None if r[1] is None else len(r[1])) for r in full]
        if not clash:
            return spark.createDataFrame(full, DDL)
        return spark.createDataFrame([(*r, *range(len(CLASH))) for r in full], DDL + "".join(f", {c} long" for c in CLASH))

    return make


def words(n, seed, size=5000):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls everywhere, empty and blank texts, ties, repeated rows, other scripts, and a long text."""
    long = words(6000, 1)
    body = words(120, 2)
    return [
        (1, body), (1, body), (2, body), (3, None), (3, None), (4, ""), (5, " \t\n"), (6, "one two"), (7, "one two", None, None), (8, "Ünïcode – текст 漢字 🎉 " * 9, "xx", "ü"), (None, body), (None, None),
        (9, long), (10, long + " tail"), (11, words(90, 3), "de", None), (12, words(90, 3) + " more", "de", "b"), (13, "x", "fr", ""), (14, "A" * 3000), (15, "A" * 3000 + "B"),
    ]
