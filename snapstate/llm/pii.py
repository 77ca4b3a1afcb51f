"""Personal data: rules for four kinds, and a skip-chain conditional random field that adds what the rules miss.

Rules find emails, addresses, card numbers and phone numbers, each in time linear in the text. The field's nodes are
the rules' spans and the other tokens with a digit or an at sign (numbers written with spaces are one node); its labels
are the four kinds and none. A node is tied to the next one (chain) and, by skip edges, to those that repeat or
resemble it: same last digits, mailbox, address or network. All that share such a key are tied to one of them, the
first that a rule found or else the first, so that any number of repeats at any distance is two steps from each other.
Rule nodes are fixed; loopy belief propagation, run until messages settle, gives the others' marginals, and those
surely of a kind become spans as well. Rule spans always stay.

Weights are learned by pseudo-likelihood with Newton steps, on a bounded sample of documents, each read whole. What no
rule found is not taken for none where it resembles an entity: such nodes have no label and count nowhere. Instead each
document rehearses its own entities: every one is repeated in a form that no rule accepts, with its kind as the label,
and beside it stands the same form with other signs, labelled none. Only the skip edge tells the two apart.

Defined cases: null and empty texts have no spans; repeated rows get equal results; very long texts are taken whole,
with messages in flat arrays; an empty table gives an empty result, and a sample without entities the weights that
learning starts from; other columns are ignored by report() and carried, whatever their names or types, by redact().
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import packed


KINDS = ("email", "ip", "card", "phone")
NONE, LABELS = len(KINDS), len(KINDS) + 1
#: Documents learned from at most (about), the marginal that makes a span, and when messages have settled. ROUNDS only
#: ends the search of a field whose messages swing for ever; damping grows long before.
SAMPLE, SURE, SETTLED, ROUNDS = 4000, 0.8, 1e-4, 2000
EDGES = 50_000  # whose messages are computed at a time

#: The parts of the four rules.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"\S+")
_EDGE = ".,;:!?\"'()[]{}<>|"

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email rule. The part before an at sign is the run that ends there, so each is met once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
            at = text.find("@", done)
        else:
            done = at + 1  # a later local part cannot reach over an at sign
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    out: list[Span] = []
    if "@" in text:
        out += [(a, 0, b) for a, b in emails(text)]
    if re.search("[0-9]", text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p) <= 3 and int(p or "0") <= 255 for p in (q.lstrip("0") for q in m[0].split(".")))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return sorted(out)


@dataclass
class Nodes:
    start: np.ndarray
    end: np.ndarray
    shape: np.ndarray  # features
    label: np.ndarray  # of the rules, -1 where free
    chain: np.ndarray  # pairs of neighbours
    skip: np.ndarray  # pairs that resemble each other


_DIGITS = re.compile("[0-9]+")
_NUMBER = re.compile(r"[+(]?[0-9][0-9().+/-]*")
_FOUR = re.compile(r"[^0-9]?([0-9]{1,3})([^0-9A-Za-z]{1,3})([0-9]{1,3})\2([0-9]{1,3})\2([0-9]{1,3})[^0-9]?")
_AT = re.compile(r"[(\[{]at[)\]}]", re.I)
_NAMED = re.compile(r"[A-Za-z_]{2,20}[:=](?=\S*[0-9@])")  # a field's name before its value
SIZES = ((1, 3), (4, 6), (7, 8), (9, 11), (12, 14), (15, 16), (17, 19), (20, 1 << 60))


def shape(core: str) -> list[float]:
    """Facts about a node's text; none tells whether a rule accepts it."""
    n = sum(map(len, _DIGITS.findall(core)))
    letters = sum(c.isalpha() for c in core)
    sizes = [low <= n <= high for low, high in SIZES]
    return [1.0, *sizes, "@" in core or _AT.search(core) is not None, _FOUR.fullmatch(core) is not None, n == len(core), letters > 0, letters > n, any(c in core for c in "=:/_")]


SHAPES = len(shape("0"))


def likeness(core: str) -> tuple[str, ...]:
    """Keys under which a node resembles others."""
    low = _AT.sub("@", core.lower())
    if "@" in low:
        box, _, host = low.partition("@")
        return ("@" + (box or host),) if len(box or host) > 2 else ()
    if four := _FOUR.fullmatch(core):
        a, b, c, d = (str(int(four[k])) for k in (1, 3, 4, 5))
        return (f".{a}.{b}.{c}.{d}", f"/{a}.{b}.{c}")
    if any(c.isalpha() for c in core):
        return ("@" + low,) if len(low) > 2 else ()
    digits = "".join(_DIGITS.findall(core))
    return (f"#{digits[-7:]}", f"^{digits[:12]}") if len(digits) >= 12 else (f"#{digits[-7:]}",) if len(digits) >= 7 else ()


def _free_tokens(text: str, spans: list[Span]) -> Iterator[tuple[int, int]]:
    """Tokens with a digit or an at sign that no span touches, without the punctuation around them."""
    k = 0
    last = 0  # the furthest end of the spans before
    for m in _TOKEN.finditer(text):
        token = m[0]
        if token.isalpha() or not (_ANY.search(token) or _AT.search(token)):
            continue
        while k < len(spans) and spans[k][0] < m.end():
            last = max(last, spans[k][2])
            k += 1
        if last > m.start():
            continue
        core = token.strip(_EDGE)
        core = core if core and (_ANY.search(core) or _AT.search(core)) else token
        at = m.start() + token.index(core)
        if named := _NAMED.match(core):
            at, core = at + named.end(), core[named.end() :]
        yield at, at + len(core)


def _whole_numbers(text: str, tokens: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Joins numbers one space apart, each too short to resemble anything by itself, of 7 to 19 digits in all."""
    run: list[tuple[int, int]] = []

    def flush() -> list[tuple[int, int]]:
        digits = sum("0" <= c <= "9" for a, b in run for c in text[a:b])
        return [(run[0][0], run[-1][1])] if len(run) > 1 and 7 <= digits <= 19 else run

    for a, b in tokens:
        number = _NUMBER.fullmatch(text, a, b) and not likeness(text[a:b])
        if run and not (number and a - run[-1][1] == 1 and text[run[-1][1]] == " "):
            yield from flush()
            run = []
        if number:
            run.append((a, b))
        else:
            yield a, b
    if run:
        yield from flush()


def nodes_of(text: str, spans: list[Span]) -> Nodes | None:
    spans = sorted(spans)
    free = _whole_numbers(text, list(_free_tokens(text, spans)))
    found = sorted([*((a, b, kind) for a, kind, b in spans), *((a, b, -1) for a, b in free)])
    if not found:
        return None
    members: dict[str, list[int]] = {}
    shapes: list[list[float]] = []
    for k, (a, b, _) in enumerate(found):
        core = text[a:b]
        shapes.append(shape(core))
        for key in likeness(core):
            members.setdefault(key, []).append(k)
    skips = set()
    for nodes in members.values():
        hub = next((k for k in nodes if found[k][2] >= 0), nodes[0])
        skips.update((min(hub, k), max(hub, k)) for k in nodes if k != hub)
    start, end, label = (np.array(x) for x in zip(*found, strict=True))
    at = np.arange(len(found) - 1)
    chain = np.stack([at, at + 1], 1)[start[1:] - end[:-1] <= 3]
    return Nodes(start, end, np.array(shapes, float), label, chain, np.array(sorted(skips), int).reshape(-1, 2))


@dataclass
class Field:
    """Weights of the field: shapes by label, and symmetric label pairs for chain and skip edges."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def marginals(self, nodes: Nodes) -> np.ndarray:
        """Loopy sum-product in log space, all messages at once and damped, until they settle."""
        own = nodes.shape @ self.unary
        fixed = nodes.label >= 0
        own[fixed] = -1e3
        own[np.flatnonzero(fixed), nodes.label[fixed]] = 0.0
        pairs = np.concatenate([nodes.chain, nodes.skip])
        ties = np.stack([self.chain, self.skip])  # symmetric, so an edge has one table for both ways
        is_skip = np.tile(np.arange(len(pairs)) >= len(nodes.chain), 2).astype(int)
        src, dst = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([pairs[:, 1], pairs[:, 0]])
        back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
        messages = np.zeros((len(src), LABELS))
        belief, hold = own, 0.3
        for turn in range(ROUNDS if len(src) else 0):
            new = np.empty_like(messages)
            for at in range(0, len(src), EDGES):
                part = slice(at, at + EDGES)
                sent = (belief[src[part]] - messages[back[part]])[:, :, None] + ties[is_skip[part]]
                top = sent.max(1, keepdims=True)
                new[part] = np.log(np.exp(sent - top).sum(1)) + top[:, 0]
            new -= new.max(1, keepdims=True)
            change = np.abs(new - messages).max()
            messages = hold * messages + (1 - hold) * new
            belief = own + np.stack([np.bincount(dst, messages[:, k], len(own)) for k in range(LABELS)], 1)
            if change < SETTLED:
                break
            if turn % 100 == 99:
                hold = (1 + hold) / 2
        p = np.exp(belief - belief.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


def added_spans(text: str, nodes: Nodes, field: Field) -> list[Span]:
    """Free tokens surely of a kind; neighbours of one kind, a few signs apart, are one span."""
    if (nodes.label >= 0).all():
        return []
    p = field.marginals(nodes)
    out: list[Span] = []
    kinds = p[:, :NONE].argmax(1)
    for k in np.flatnonzero((nodes.label < 0) & (p[np.arange(len(p)), kinds] >= SURE)):
        a, kind, b = int(nodes.start[k]), int(kinds[k]), int(nodes.end[k])
        if out and out[-1][1] == kind and a - out[-1][2] <= 3 and not any(c.isalnum() for c in text[out[-1][2] : a]):
            out[-1] = (out[-1][0], kind, b)
        else:
            out.append((a, kind, b))
    return out


def _variant(kind: int, entity: str, r: random.Random) -> str:
    """The entity in a form that its rule does not accept."""
    digits = "".join(_DIGITS.findall(entity))
    if kind == 0:
        box, _, host = entity.partition("@")
        return r.choice([f"{box}(at){host}", f"{box}[at]{host}", f"{box}@{host.partition('.')[0]}", f"@{box}"])
    if kind == 1:
        parts = [str(int(p[-3:])) for p in entity.split(".")]
        return r.choice(["-".join(parts), "[.]".join(parts), ".".join([*parts[:3], str(int(parts[3]) + 256)])])
    if kind == 2:
        wrong = digits[:-1] + str((int(digits[-1]) + r.randrange(1, 9)) % 10)
        sign = r.choice("/._")
        return r.choice([wrong, sign.join(digits[k : k + 4] for k in range(0, len(digits), 4)), " ".join(wrong[k : k + 4] for k in range(0, len(wrong), 4))])
    return r.choice([digits, digits[-10:], f"{digits[-7:-4]}-{digits[-4:]}", f"{digits[:-7]}.{digits[-7:-4]}.{digits[-4:]}", f"{digits[:-7]} {digits[-7:-4]} {digits[-4:]}"])


def _other(form: str, r: random.Random) -> str:
    """The same form with other digits and letters."""
    return "".join(r.choice("0123456789") if c.isdigit() else r.choice("abcdefghijklmnopqrstuvwxyz") if c.isalpha() else c for c in _AT.sub("@", form)) if "@" in _AT.sub("@", form) else "".join(r.choice("123456789") if c.isdigit() else c for c in form)


def rehearsed(text: str, spans: list[Span]) -> tuple[str, list[Span]]:
    """The text with its entities repeated in forms that no rule accepts, and as many look-alikes; what was added."""
    r = random.Random(zlib.crc32(text.encode("utf-8", "replace")))
    parts, added, size = [text], [], len(text)
    for kind, entity in sorted({(k, text[a:b]) for a, k, b in spans}):
        form = _variant(kind, entity, r)
        for planted, label in ((form, kind), (_other(form, r), NONE)):
            parts.append(f" and so {planted}")
            size += len(parts[-1])
            added.append((size - len(planted), label, size))
    return "".join(parts), added


def evidence(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Pseudo-likelihood rows of a rehearsed text: a node's shape, how many chain and skip neighbours have each label,
    and its own label. Free nodes tied to an entity have no label, so they make no row and count for no neighbour."""
    spans = base_spans(text)
    text, added = rehearsed(text, spans)
    nodes = nodes_of(text, base_spans(text))
    if nodes is None:
        return np.zeros((0, SHAPES + 2 * LABELS)), np.zeros(0, int)
    label = np.where(nodes.label < 0, NONE, nodes.label)
    known = nodes.label >= 0
    for a, kind, b in added:
        mine = (nodes.label < 0) & (nodes.start >= a) & (nodes.end <= b)
        label[mine], known[mine] = kind, True
    sure = known & (label != NONE)
    one, two = nodes.skip[:, 0], nodes.skip[:, 1]
    open_ = np.zeros(len(label), bool)
    open_[one[sure[two]]] = open_[two[sure[one]]] = True
    open_ &= ~known
    n = len(label)
    x = np.zeros((n, SHAPES + 2 * LABELS))
    x[:, :SHAPES] = nodes.shape
    for at, pairs in ((SHAPES, nodes.chain), (SHAPES + LABELS, nodes.skip)):
        for here, there in ((pairs[:, 0], pairs[:, 1]), (pairs[:, 1], pairs[:, 0])):
            told = ~open_[there]
            np.add.at(x, (here[told], at + label[there[told]]), 1.0)
    return x[~open_], label[~open_]


def fit(docs: DataFrame, sample: int = SAMPLE, rows: int | None = None) -> Field:
    """Learns the weights on about `sample` of the documents with a digit or an at sign, each read whole. What comes to
    the driver is distinct rows of evidence with their counts."""
    some = docs.where(F.col("text").rlike("[0-9@]")).select("doc_id", "text")
    total = some.count() if rows is None else rows
    picked = some.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample / max(1, total)))).select("text").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text in b.column(0).to_pylist():
                x, y = evidence(text)
                yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), pa.array(y, pa.int32())], ["x", "y"])

    found = picked.mapInArrow(run, "x array<double>, y int").groupBy("x", "y").count().orderBy("x", "y").toPandas()
    return learn(np.stack(found["x"]), found["y"].to_numpy(), found["count"].to_numpy(float)) if len(found) else learn(np.zeros((0, SHAPES + 2 * LABELS)), np.zeros(0, int), np.zeros(0))


def learn(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 40, ridge: float = 1.0) -> Field:
    """Softmax regression by Newton steps, tie weights symmetric, held by the ridge near ties of like labels."""
    prior = np.zeros((SHAPES + 2 * LABELS, LABELS))
    prior[0, NONE] = 1.0
    prior[SHAPES : SHAPES + LABELS] = 0.2 * np.eye(LABELS)
    prior[SHAPES + LABELS :] = 1.5 * np.eye(LABELS)
    upper = np.zeros((LABELS, LABELS), int)
    upper[np.triu_indices(LABELS)] = np.arange(LABELS * (LABELS + 1) // 2)
    upper = np.maximum(upper, upper.T)
    first = SHAPES * LABELS
    at = np.concatenate([np.arange(first).reshape(SHAPES, LABELS), first + upper, first + upper.max() + 1 + upper])  # entry -> free weight
    size = int(at.max()) + 1
    start = np.zeros(size)
    start[at] = prior
    want = np.eye(LABELS)[y]

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = x @ w[at]
        z -= z.max(1, keepdims=True)
        log = z - np.log(np.exp(z).sum(1, keepdims=True))
        return float(-(weight[:, None] * want * log).sum() + ridge / 2 * ((w - start) ** 2).sum()), np.exp(log)

    w = start.copy()
    now, p = loss(w)
    for _ in range(rounds if len(x) else 0):
        grad = np.bincount(at.ravel(), (x.T @ (weight[:, None] * (p - want))).ravel(), size) + ridge * (w - start)
        curve = ridge * np.eye(size)
        for j in range(LABELS):
            for k in range(LABELS):
                part = (x * (weight * p[:, j] * ((j == k) - p[:, k]))[:, None]).T @ x
                np.add.at(curve, (at[:, j][:, None], at[:, k][None, :]), part)
        step, length = np.linalg.solve(curve, grad), 1.0
        while length > 1e-6:
            after, q = loss(w - length * step)
            if after <= now:
                break
            length /= 2
        if length <= 1e-6:
            break
        done = now - after < 1e-7 * abs(now)
        w, now, p = w - length * step, after, q
        if done:
            break
    full = w[at]
    return Field(full[:SHAPES], full[SHAPES : SHAPES + LABELS], full[SHAPES + LABELS :])


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def find(text: str | None, field: Field) -> tuple[list[Span], list[Span]]:
    """The rules' spans, and those that the field adds."""
    if not text or not _ANY.search(text):
        return [], []
    spans = base_spans(text)
    nodes = nodes_of(text, spans)
    return spans, [] if nodes is None else added_spans(text, nodes, field)


def report(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """doc_id, the number of rule spans of each kind, base_sha256, spans (all), n_added."""
    field = fit(docs) if field is None else field
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                base, more = find(text.as_py(), field)
                count = [sum(s[1] == k for s in base) for k in range(NONE)]
                rows.append((doc, *count, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more), len(more)))
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redact(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """docs with each span of the text replaced by its kind in brackets."""
    field = fit(docs) if field is None else field

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in b.column(1).to_pylist():
                base, more = find(text, field)
                done, parts = 0, []
                for a, k, e in sorted(base + more):
                    if e <= done:
                        continue
                    parts += [text[done : max(a, done)], f"[{KINDS[k]}]" if a >= done else ""]
                    done = e
                out.append(None if text is None else "".join([*parts, text[done:]]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], b.schema.names)

    rows = docs.select(packed(docs).alias("_row"), F.col("text").alias("_text"))
    done = rows.mapInArrow(run, T.StructType([rows.schema["_row"], T.StructField("_text", T.StringType())]))
    return done.select(F.col("_row").withField("text", F.col("_text")).alias("_row")).select("_row.*")
