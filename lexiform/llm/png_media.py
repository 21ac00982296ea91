"""Media columns: PNG files in binary columns, written and read with zlib and numpy alone.

Reading tests the signature and every chunk's checksum, inflates the image data (whose own checksum zlib tests) and undoes
the five row filters. The feature is a hash of the signs of low frequencies of a cosine transform.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiform.llm import scratch

SIGNATURE = b"\x89PNG\r\n\x1a\n"
WIDTH = 64
LEVEL = 3
#: Bytes of one data chunk at most.
CHUNK = 1 << 16
SIDE, LOW = 32, 8
_DCT = np.cos(np.pi / SIDE * (np.arange(SIDE)[None, :] + 0.5) * np.arange(LOW)[:, None])


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(body, zlib.crc32(kind)))


def write_png(image: np.ndarray) -> bytes:
    """An 8-bit grey image as PNG. Each row takes the filter (none, left, up) with the least sum of absolute differences."""
    height, width = image.shape
    up = np.zeros_like(image)
    up[1:] = image[:-1]
    left = np.zeros_like(image)
    left[:, 1:] = image[:, :-1]
    forms = np.stack([image, image - left, image - up])
    cost = np.abs(forms.view(np.int8).astype(np.int16)).sum(2)
    best = cost.argmin(0)
    rows = np.empty((height, width + 1), np.uint8)
    rows[:, 0] = best
    rows[:, 1:] = forms[best, np.arange(height)]
    data = zlib.compress(rows.tobytes(), LEVEL)
    parts = [_chunk(b"IDAT", data[at : at + CHUNK]) for at in range(0, len(data), CHUNK)]
    return SIGNATURE + _chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + b"".join(parts) + _chunk(b"IEND", b"")


def read_png(data: bytes) -> np.ndarray:
    """The samples of an 8-bit grey PNG without interlacing. ValueError names what is wrong with any other bytes."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG signature")
    at, head, body, ended = 8, None, [], False
    while at + 12 <= len(data) and not ended:
        (size,) = struct.unpack_from(">I", data, at)
        kind, content = data[at + 4 : at + 8], data[at + 8 : at + 8 + size]
        if at + 12 + size > len(data):
            raise ValueError("a chunk is cut short")
        if struct.unpack_from(">I", data, at + 8 + size)[0] != zlib.crc32(content, zlib.crc32(kind)):
            raise ValueError(f"checksum of chunk {kind!r}")
        if kind == b"IHDR":
            if size != 13:
                raise ValueError("header of another size")
            head = struct.unpack(">IIBBBBB", content)
        elif kind == b"IDAT":
            body.append(content)
        ended = kind == b"IEND"
        at += 12 + size
    if head is None or not ended:
        raise ValueError("no header or no end")
    width, height, *form = head
    if form != [8, 0, 0, 0, 0]:
        raise ValueError("not 8-bit grey without interlacing")
    if not width or not height:
        raise ValueError("an image without samples")
    stream = zlib.decompressobj()
    try:  # never more than the header announces
        raw = stream.decompress(b"".join(body), height * (width + 1) + 1)
    except zlib.error as e:
        raise ValueError(f"image data: {e}") from e
    if len(raw) != height * (width + 1) or not stream.eof:
        raise ValueError("image data of another size")
    rows = np.frombuffer(raw, np.uint8).reshape(height, width + 1)
    return unfilter(rows[:, 0], rows[:, 1:])


def unfilter(kinds: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Undo row filters (one byte a sample). Runs of equal filters are undone together where the filter allows it."""
    if len(kinds) and kinds.max() > 4:
        raise ValueError("unknown row filter")
    out = rows.copy()
    plain = kinds == 1
    out[plain] = np.add.accumulate(rows[plain], axis=1, dtype=np.uint8)
    cuts = np.flatnonzero(np.diff(kinds)) + 1
    bounds = [0, *cuts.tolist(), len(kinds)]
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if a == b or kinds[a] < 2:
            continue
        before = out[a - 1] if a else np.zeros(rows.shape[1], np.uint8)
        if kinds[a] == 2:
            out[a:b] = np.add.accumulate(rows[a:b], axis=0, dtype=np.uint8) + before
            continue
        for y in range(a, b):
            above = out[y - 1].tolist() if y else [0] * rows.shape[1]
            line, left, corner = rows[y].tolist(), 0, 0
            for x, up in enumerate(above):
                if kinds[a] == 3:
                    guess = (left + up) // 2
                else:
                    d = (abs(up - corner), abs(left - corner), abs(left + up - 2 * corner))
                    guess = left if d[0] <= d[1] and d[0] <= d[2] else up if d[1] <= d[2] else corner
                left = line[x] = (line[x] + guess) & 255
                corner = up
            out[y] = line
    return out


def _resized(image: np.ndarray, axis: int) -> np.ndarray:
    n = image.shape[axis]
    edges = np.arange(SIDE + 1) * n // SIDE
    if n < SIDE:
        return np.take(image, edges[:-1], axis)
    sums = np.add.reduceat(image, edges[:-1], axis)
    sizes = np.diff(edges)
    return sums / (sizes[:, None] if axis == 0 else sizes[None, :])


def cosine_hash(image: np.ndarray) -> bytes:
    """8 bytes: which of the 8 x 8 lowest frequencies of the image, shrunk to 32 x 32, lie above their median."""
    small = _resized(_resized(image.astype(np.float64), 0), 1)
    low = np.round(_DCT @ small @ _DCT.T, 6)
    return np.packbits(low.ravel() > np.median(low.ravel()[1:])).tobytes()


def payload(text: str | None) -> bytes:
    """UTF-8 of the text (null: empty) and zeros up to a positive multiple of 64."""
    data = (text or "").encode("utf-8", "replace")
    return data + b"\0" * (max(WIDTH, -(-len(data) // WIDTH) * WIDTH) - len(data))


def with_media(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``media`` (PNG of the text's payload, 64 samples a row) and ``n_bytes``; columns of these names are replaced."""
    scratch.ship(docs.sparkSession)
    names = ["n_bytes", "media"]
    docs = docs.drop(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in scratch.slices(batches, "text"):
            texts = b.column(b.schema.get_field_index("text")).to_pylist()
            made = [write_png(np.frombuffer(payload(t), np.uint8).reshape(-1, WIDTH)) for t in texts]
            sizes = [len((t or "").encode("utf-8", "replace")) for t in texts]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sizes, pa.int64()), pa.array(made, pa.binary())], names=[*b.schema.names, *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{schema}, n_bytes long, media binary" if schema else "n_bytes long, media binary")


def read_media(media: DataFrame) -> DataFrame:
    """doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, hash, error.

    ``media`` has doc_id, n_bytes and media. Bytes that are no sound PNG give nulls and say why in ``error``.
    """
    scratch.ship(media.sparkSession)
    fields = [("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("hash", pa.binary()), ("error", pa.string())]

    def one(data: bytes | None) -> tuple:
        if data is None:
            return (None,) * 7 + ("no media",)
        stored = (len(data), hashlib.sha256(data).hexdigest())
        try:
            image = read_png(data)
        except ValueError as e:
            return (None, None, None, *stored, None, None, str(e))
        raw, mark = image.tobytes(), cosine_hash(image)
        return (len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-WIDTH:]), *stored, mark.hex(), mark, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [one(x) for x in b.column(2).to_pylist()]
            cols = [pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], names=["doc_id", "n_bytes", *(n for n, _ in fields)])

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, hash binary, error string")
