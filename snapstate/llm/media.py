"""Media columns: lossless images, decoded, resized by area and fingerprinted.

Images are Netpbm (all six kinds, 8 and 16 bits) or BMP (uncompressed, 8, 24 or 32 bits), decoded to numpy arrays. The area
resize reads box sums off an integral image, at fractional corners by interpolation, which is exact. A resized grey
tile is written in NPY form, and a difference hash tells whether each of its pixels is brighter than the next.

store() turns a text into an image: its bytes, padded with spaces to a positive multiple of 192, are the samples of
64 pixels a row; the checksum of the payload chooses PPM or BMP.

Defined cases: a null text counts as empty and gives one row of spaces; equal texts give equal values, repeated rows
included; a text of any length is one image; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEP, WIDTH, TILE = 192, 64, 16
_TOKEN = re.compile(rb"(?:\s|#[^\n]*\n)*([^\s#]+)")


def payload_of(text: str | None) -> tuple[bytes, int]:
    """The padded bytes and how many came from the text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return data.ljust(max(1, -(-len(data) // STEP)) * STEP, b" "), len(data)


def encode_ppm(image: np.ndarray) -> bytes:
    return b"P6\n%d %d\n255\n" % (image.shape[1], image.shape[0]) + image.tobytes()


def encode_bmp(image: np.ndarray) -> bytes:
    height, width, _ = image.shape
    rows = image[::-1, :, ::-1].reshape(height, width * 3)
    rows = np.pad(rows, ((0, 0), (0, -width * 3 % 4)))
    return struct.pack("<2sIHHIIiiHHIIiiII", b"BM", 54 + rows.size, 0, 0, 54, 40, width, height, 1, 24, 0, rows.size, 2835, 2835, 0, 0) + rows.tobytes()


def store(text: str | None) -> bytes:
    data, _ = payload_of(text)
    image = np.frombuffer(data, np.uint8).reshape(-1, WIDTH, 3)
    return encode_bmp(image) if zlib.crc32(data) & 1 else encode_ppm(image)


def decode(data: bytes) -> np.ndarray:
    """Samples as (height, width, channels)."""
    return _decode_bmp(data) if data[:2] == b"BM" else _decode_netpbm(data)


def _decode_netpbm(data: bytes) -> np.ndarray:
    kind = data[1] - 48
    if data[:1] != b"P" or not 1 <= kind <= 6:
        raise ValueError("neither Netpbm nor BMP")
    at, head = 2, []
    for _ in range(2 if kind in (1, 4) else 3):
        m = _TOKEN.match(data, at)
        if m is None:
            raise ValueError("the image's header is cut off")
        head.append(int(m[1]))
        at = m.end()
    width, height, most = *head[:2], head[2] if len(head) > 2 else 1
    channels = 3 if kind in (3, 6) else 1
    n = width * height * channels
    if kind in (1, 2, 3):
        body = re.sub(rb"#[^\n]*", b"", data[at:])
        flat = np.array([c - 48 for c in body if c in b"01"][:n] if kind == 1 else body.split()[:n], np.int64)
    elif kind == 4:
        line = -(-width // 8)
        flat = np.unpackbits(np.frombuffer(data, np.uint8, line * height, at + 1).reshape(height, line), axis=1)[:, :width].ravel()
    else:
        flat = np.frombuffer(data, ">u2" if most > 255 else np.uint8, n, at + 1)
    if len(flat) != n:
        raise ValueError("the image's samples are cut off")
    flat = 1 - flat if kind in (1, 4) else flat
    return flat.astype(np.uint16 if most > 255 else np.uint8).reshape(height, width, channels)


def _decode_bmp(data: bytes) -> np.ndarray:
    start, size, width, height, _, bits, packed = struct.unpack_from("<I I i i H H I", data, 10)
    if packed or bits not in (8, 24, 32):
        raise ValueError("only uncompressed BMP of 8, 24 or 32 bits is read")
    line = -(-width * bits // 32) * 4
    rows = np.frombuffer(data, np.uint8, line * abs(height), start).reshape(abs(height), line)
    rows = rows[:, : width * bits // 8].reshape(abs(height), width, bits // 8)
    rows = rows[::-1] if height > 0 else rows
    if bits == 8:
        colours = struct.unpack_from("<I", data, 46)[0] or 256
        palette = np.frombuffer(data, np.uint8, colours * 4, 14 + size).reshape(-1, 4)
        return palette[rows[:, :, 0]][:, :, 2::-1]
    return np.ascontiguousarray(rows[:, :, 2::-1])


def grey(image: np.ndarray) -> np.ndarray:
    """Luma (BT.601) of colour images, the samples of others."""
    x = image.astype(float)
    return x[:, :, 0] if x.shape[2] < 3 else x[:, :, :3] @ np.array([0.299, 0.587, 0.114])


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Means over the boxes that `height` x `width` cells cover."""
    total = np.zeros((image.shape[0] + 1, image.shape[1] + 1))
    total[1:, 1:] = image.cumsum(0).cumsum(1)

    def cut(x: np.ndarray, cells: int) -> np.ndarray:
        edge = np.linspace(0, len(x) - 1, cells + 1)
        low = np.minimum(edge.astype(int), len(x) - 2)
        part = (edge - low).reshape(-1, *[1] * (x.ndim - 1))
        return x[low] * (1 - part) + x[low + 1] * part

    corners = cut(cut(total, height).T, width).T
    boxes = corners[1:, 1:] - corners[:-1, 1:] - corners[1:, :-1] + corners[:-1, :-1]
    return boxes * (height * width / (image.shape[0] * image.shape[1]))


def difference_hash(image: np.ndarray) -> int:
    """64 bits: whether each of 8 x 9 resized pixels is darker than its right neighbour."""
    cells = np.round(area_resize(image, 8, 9), 6)
    return int.from_bytes(np.packbits(cells[:, :-1] < cells[:, 1:]).tobytes(), "big")


def npy_tile(image: np.ndarray, side: int = TILE) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, np.clip(np.round(area_resize(image, side, side)), 0, 255).astype(np.uint8), version=(1, 0))
    return out.getvalue()


def media(docs: DataFrame) -> DataFrame:
    """doc_id, media (the stored image), tile (NPY), difference_hash (hex) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                stored = [store(t.as_py()) for t in part.column(1)]
                shades = [grey(decode(m)) for m in stored]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(stored, pa.binary()), pa.array([npy_tile(g) for g in shades], pa.binary()), pa.array([f"{difference_hash(g):016x}" for g in shades], pa.string())], ["doc_id", "media", "tile", "difference_hash"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, media binary, tile binary, difference_hash string")


def report(docs: DataFrame) -> DataFrame:
    """Digests of media(): what was stored, what is read back of it, and its features."""
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    types = [pa.int64()] * 3 + [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                text = text.as_py()
                stored = store(text)
                image = decode(stored)
                back = image.tobytes()
                shade = grey(image)
                feature = f"{difference_hash(shade):016x}:{zlib.crc32(npy_tile(shade)):08x}"
                rows.append((doc, len((text or "").encode("utf-8", "surrogatepass")), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), feature))
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
