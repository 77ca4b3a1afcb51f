"""Packing token sequences by best-fit decreasing.

Documents are tokenized in place, an end id is added, and whole windows are cut off first; what is left of each
document is packed by best-fit decreasing: pieces go in order of falling length into the open window with the
smallest sufficient room, which a segment tree indexed by remaining capacity finds in log(window) steps. Pieces are
dealt by a hash into shards of about SHARD_PIECES, and each shard is packed by itself: padding per shard is within
one window and a fraction of a percent of that of one global run, and no task's input grows with the table.

Tokens never shuffle: a piece travels as its place, length and checksum.

Defined cases: a null or empty text is a document of the end id alone; a special token's string in a text is that
token, as in a plain call of the tokenizers library; documents with one doc_id are packed as documents of their own and
dealt row by row, however many they are; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep

WINDOW, END_ID, SHARD_PIECES = 1024, 0, 20_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@lru_cache(maxsize=2)
def encoder(name: str):
    """text -> ids of the tokenizers file `name`, as encode(text, add_special_tokens=False) gives them.

    tiktoken runs the same merges on the same vocabulary (ranks), several times faster than the tokenizers library; a
    test holds the two against each other. Both cut the text at special tokens first. Files without a rank twin run in
    the tokenizers library.
    """
    import public_tokenizers as files

    if name == "byte_bpe_50k.json":
        import tiktoken

        with open(files.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        with open(files.path(name), encoding="utf-8") as spec:
            special = {t["content"]: t["id"] for t in json.load(spec)["added_tokens"]}
        fast = tiktoken.Encoding("ranks", pat_str=files.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        return lambda text: fast.encode(text, allowed_special="all")
    from tokenizers import Tokenizer

    read = Tokenizer.from_file(files.path(name))
    return lambda text: read.encode(text, add_special_tokens=False).ids


def token_ids(text: str | None, name: str, end_id: int = END_ID) -> np.ndarray:
    return np.array([*encoder(name)(text or ""), end_id], np.uint32)


def pieces(docs: DataFrame, name: str = "byte_bpe_50k.json", window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens (and ids)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens")), *([("ids", pa.list_(pa.int32()))] if with_ids else [])])
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = token_ids(text.as_py(), name)
                for at in range(0, len(ids), window):
                    part = ids[at : at + window]
                    out.append((doc, at, len(part), zlib.crc32(part.astype("<u4").tobytes()), len(ids), *([part.astype(np.int32)] if with_ids else [])))
            columns = list(zip(*out, strict=True)) or [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES + ", ids array<int>" * with_ids)


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each piece, for pieces given in order of falling length.

    The tree's leaf c holds the open windows with room c; an inner node counts those below it. A piece of length n
    asks for the leftmost leaf at n or right of it that is not empty: the tightest open window.
    """
    leaves = 1 << max(1, window).bit_length()
    count = [0] * (2 * leaves)
    open_at: list[list[int]] = [[] for _ in range(leaves)]

    def add(room: int, by: int) -> None:
        node = room + leaves
        while node:
            count[node] += by
            node >>= 1

    def tightest(length: int) -> int:
        node = length + leaves
        if count[node]:
            return length
        while node > 1:
            if not node & 1 and count[node + 1]:
                node += 1
                while node < leaves:
                    node = 2 * node if count[2 * node] else 2 * node + 1
                return node - leaves
            node >>= 1
        return -1

    where, offset, windows = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for k, length in enumerate(lengths.tolist()):
        room = tightest(length)
        if room < 0:
            at, room, windows = windows, window, windows + 1
        else:
            at = open_at[room].pop()
            add(room, -1)
        where[k], offset[k] = at, window - room
        if room > length:
            open_at[room - length].append(at)
            add(room - length, 1)
    return where, offset


def _placed(cut: DataFrame, window: int, shard_pieces: int) -> DataFrame:
    """Stored pieces with sequence_id and offset. Pieces are dealt by their number, whatever their doc_id."""
    shards = max(1, -(-cut.count() // shard_pieces))
    dealt = cut.withColumn("_shard", F.pmod(F.xxhash64("_piece"), F.lit(shards)))

    def place(pdf):
        pdf = pdf.sort_values(["length", "_piece"], ascending=[False, True], kind="stable")
        where, offset = best_fit(pdf["length"].to_numpy(np.int64), window)
        return pdf.assign(sequence_id=(pdf["_shard"].to_numpy(np.int64) << 32) + where, offset=offset)

    return dealt.groupBy("_shard").applyInPandas(place, ", ".join(f"{n} {t}" for n, t in dealt.dtypes) + ", sequence_id long, offset long").drop("_shard")


def _cut(docs: DataFrame, name: str, window: int, with_ids: bool) -> DataFrame:
    return keep(pieces(docs, name, window, with_ids).withColumn("_piece", F.monotonically_increasing_id()), "pieces")


def pack(docs: DataFrame, name: str = "byte_bpe_50k.json", window: int = WINDOW, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """The pieces of docs with sequence_id and offset. sequence_id = shard * 2**32 + number in the shard."""
    return _placed(_cut(docs, name, window, False), window, shard_pieces).drop("_piece")


def sequences(docs: DataFrame, name: str = "byte_bpe_50k.json", window: int = WINDOW, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (padded with the end id to the window), n_tokens."""
    cut = _cut(docs, name, window, True)
    parts = _placed(cut.select("_piece", "length"), window, shard_pieces).join(cut.select("_piece", "ids"), "_piece")
    rows = parts.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
    n = F.size("ids")
    return rows.select("sequence_id", F.concat("ids", F.array_repeat(F.lit(END_ID), F.lit(window) - n)).alias("ids"), n.alias("n_tokens"))
