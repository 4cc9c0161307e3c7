"""Media columns: bytes held as 8-bit greyscale PNG in a binary column, read back and hashed.

A PNG is its signature and chunks (length, kind, data, CRC-32); pixel rows carry a
filter byte and are deflated. Writing picks per image the filter (none, left or up)
with the smallest residues. Reading tests every chunk's checksum, inflates, and undoes
any of the five filters with numpy. The hash is the sign pattern of the low 8 x 8
cosine-transform coefficients of the picture averaged down to 32 x 32.

Null payloads count as empty; an empty payload is stored as one row of zeros. Very long
ones are one tall image. Equal payloads and repeated rows give equal bytes; so do payloads
that differ in zeros at the end only, which is why their unpadded size is kept. An empty
table gives no rows. Other columns stay as they are; those named as a result are replaced.
A damaged image raises ``ValueError`` naming the chunk.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loamworks.llm.common import whole, wider

WIDTH = 64
# Fixed value: the PNG signature.
SIGNATURE = b"\x89PNG\r\n\x1a\n"


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def write_png(pixels: np.ndarray, level: int = 1) -> bytes:
    """An 8-bit greyscale PNG of a (rows, width) uint8 array."""
    rows, width = pixels.shape
    left, up = pixels.copy(), pixels.copy()
    left[:, 1:] -= pixels[:, :-1]
    up[1:] -= pixels[:-1]
    costs = [np.abs(f.view(np.int8).astype(np.int16)).sum() for f in (pixels, left, up)]
    kind = int(np.argmin(costs))
    raw = np.empty((rows, width + 1), np.uint8)
    raw[:, 0] = kind
    raw[:, 1:] = (pixels, left, up)[kind]
    head = struct.pack(">IIBBBBB", width, rows, 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(raw.tobytes(), level)) + _chunk(b"IEND", b"")


def chunks(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(kind, content) of each chunk, checksums tested."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at = 8
    while at + 8 <= len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        body = data[at + 8 : at + 8 + size]
        if len(data) < at + 12 + size or struct.unpack_from(">I", data, at + 8 + size)[0] != zlib.crc32(kind + body):
            raise ValueError(f"chunk {kind!r} is damaged")
        yield kind, body
        if kind == b"IEND":
            return
        at += 12 + size
    raise ValueError("no IEND chunk")


def unfilter(raw: np.ndarray) -> np.ndarray:
    """Undo the row filters of an 8-bit one-channel image; ``raw`` has a filter byte before each row."""
    kinds, out = raw[:, 0], raw[:, 1:].copy()
    if len(set(kinds.tolist())) == 1 and kinds[0] < 3:  # one filter for all rows: one running sum
        return out if kinds[0] == 0 else np.cumsum(out, axis=2 - kinds[0], dtype=np.uint8)
    above = np.zeros(out.shape[1], np.uint8)
    for row, kind in zip(out, kinds, strict=True):
        if kind == 1:
            row[:] = np.cumsum(row, dtype=np.uint8)
        elif kind == 2:
            row += above
        elif kind in (3, 4):
            a = c = 0
            for x, b in enumerate(above.tolist()):
                if kind == 3:
                    guess = (a + b) // 2
                else:
                    p = a + b - c
                    guess = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
                a = (int(row[x]) + guess) & 255
                row[x], c = a, b
        elif kind:
            raise ValueError(f"unknown filter {kind}")
        above = row
    return out


def read_png(data: bytes) -> np.ndarray:
    """The (rows, width) uint8 pixels of an 8-bit greyscale PNG."""
    head, packed = None, []
    for kind, body in chunks(data):
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            packed.append(body)
    if head is None or head[2:] != (8, 0, 0, 0, 0):
        raise ValueError("only 8-bit greyscale without interlace is read")
    raw = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8)
    return unfilter(raw.reshape(head[1], head[0] + 1))


def _cosines(n: int, low: int) -> np.ndarray:
    k, x = np.arange(low)[:, None], np.arange(n)[None, :]
    return np.cos(np.pi * k * (2 * x + 1) / (2 * n))


_LOW = _cosines(32, 8)


def _down(a: np.ndarray, n: int) -> np.ndarray:
    """Rows averaged (or repeated) to ``n`` rows."""
    m = len(a)
    if m < n:
        return a[np.arange(n) * m // n]
    starts = np.arange(n) * m // n
    return np.add.reduceat(a, starts, axis=0) / np.diff(np.append(starts, m))[:, None]


def cosine_hash(pixels: np.ndarray) -> str:
    """64 bits in hex: which low-frequency coefficients, rounded so that none hangs on the order of additions, lie above their median."""
    small = _down(_down(pixels.astype(np.float64), 32).T, 32).T
    low = np.round((_LOW @ small @ _LOW.T).ravel(), 6)
    bits = low > np.median(low[1:])
    return np.packbits(bits).tobytes().hex()


def payload_of(data: bytes, width: int = WIDTH) -> np.ndarray:
    """The bytes with zeros appended up to a positive multiple of ``width``, as rows."""
    rows = max(1, -(-len(data) // width))
    return np.frombuffer(data.ljust(rows * width, b"\0"), np.uint8).reshape(rows, width)


def store(df: DataFrame, column: str, media: str = "media") -> DataFrame:
    """``column`` (string or binary) stored losslessly as PNG in the binary column ``media``; ``n_bytes`` has its unpadded size."""
    kept = df.drop(media, "n_bytes")
    schema = wider(kept, f"n_bytes long, {media} binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch[column].cast(pa.binary()).to_pylist()
            images = [write_png(payload_of(d or b"")) for d in data]
            sizes = pa.array([len(d or b"") for d in data], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, sizes, pa.array(images, pa.binary())], [*batch.schema.names, "n_bytes", media])

    return kept.mapInArrow(run, schema)


_FEATURES = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def features(df: DataFrame, *keep: str, media: str = "media") -> DataFrame:
    """``keep`` columns and, of each stored image read back: its payload's size, digests and cosine hash."""
    narrow = df.select(*keep, media)
    names = [x.split()[0] for x in _FEATURES.split(", ")]
    kinds = [{"long": pa.int64(), "string": pa.string()}[x.split()[1]] for x in _FEATURES.split(", ")]
    schema = wider(narrow.drop(media), _FEATURES)

    def one(image: bytes) -> tuple:
        pixels = read_png(image)
        data = pixels.tobytes()
        return len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]), len(image), hashlib.sha256(image).hexdigest(), cosine_hash(pixels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = zip(*map(one, batch[media].to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays([*(batch[k] for k in keep), *(pa.array(v, t) for v, t in zip(found, kinds, strict=True))], [*keep, *names])

    return narrow.mapInArrow(run, schema)


def document_media(docs: DataFrame) -> DataFrame:
    """Every whole text as stored media, with the features read back from the stored bytes."""
    return features(store(docs.select("doc_id", whole().alias("text")), "text").drop("text"), "doc_id", "n_bytes")
