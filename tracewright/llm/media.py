"""Media columns: PNG images built from chunks, read back with checksum tests, and hashed by low-frequency cosines.

``media_columns`` stores a payload losslessly as an 8-bit grey PNG of 64 samples a row, reads the stored bytes back and
hashes the image that it has read. Everything is per row: no shuffle, and a row's cost is linear in its bytes.
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

WIDTH = 64
SIGNATURE = b"\x89PNG\r\n\x1a\n"
GRID, LOW = 32, 8


class DamagedImage(ValueError):
    """The bytes aren't a PNG of the kind that ``read_png`` knows, or a checksum differs."""


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def write_png(samples: np.ndarray, level: int = 1) -> bytes:
    """A grey image (rows x columns, uint8). Each row takes whichever of the filters none, sub and up leaves the smallest residues."""
    rows, columns = samples.shape
    above = np.zeros_like(samples)
    above[1:] = samples[:-1]
    left = np.zeros_like(samples)
    left[:, 1:] = samples[:, :-1]
    options = np.stack([samples, samples - left, samples - above])
    cost = np.abs(options.view(np.int8).astype(np.int16)).sum(axis=2)
    kinds = cost.argmin(axis=0)
    lines = np.empty((rows, columns + 1), np.uint8)
    lines[:, 0] = kinds
    lines[:, 1:] = options[kinds, np.arange(rows)]
    head = struct.pack(">IIBBBBB", columns, rows, 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + _chunk(b"IEND", b"")


def chunks(stored: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(kind, data) of each chunk; raises DamagedImage at a false checksum or a cut file."""
    if stored[:8] != SIGNATURE:
        raise DamagedImage("no PNG signature")
    at = 8
    while at < len(stored):
        if at + 12 > len(stored):
            raise DamagedImage("cut inside a chunk's head")
        (size,) = struct.unpack_from(">I", stored, at)
        kind, data = stored[at + 4 : at + 8], stored[at + 8 : at + 8 + size]
        if len(data) < size or at + 12 + size > len(stored):
            raise DamagedImage("cut inside a chunk")
        if struct.unpack_from(">I", stored, at + 8 + size)[0] != zlib.crc32(data, zlib.crc32(kind)):
            raise DamagedImage(f"checksum of {kind!r}")
        yield kind, data
        at += 12 + size


def _average_row(line: np.ndarray, above: np.ndarray) -> np.ndarray:
    out, last = [], 0
    for x, up in zip(line.tolist(), above.tolist(), strict=True):
        last = (x + (last + up) // 2) & 255
        out.append(last)
    return np.array(out, np.uint8)


def _paeth_row(line: np.ndarray, above: np.ndarray) -> np.ndarray:
    out, last, corner = [], 0, 0
    for x, up in zip(line.tolist(), above.tolist(), strict=True):
        guess = last + up - corner
        by_left, by_up, by_corner = abs(guess - last), abs(guess - up), abs(guess - corner)
        near = last if by_left <= by_up and by_left <= by_corner else up if by_up <= by_corner else corner
        last, corner = (x + near) & 255, up
        out.append(last)
    return np.array(out, np.uint8)


def unfilter(kinds: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Samples of filtered lines. Sub rows are running sums along the row; a run of up rows is one running sum down the columns."""
    out = lines.copy()
    sub = kinds == 1
    out[sub] = np.cumsum(lines[sub], axis=1, dtype=np.uint8)
    starts = np.flatnonzero(np.r_[True, kinds[1:] != kinds[:-1]]) if len(kinds) else []
    for start, stop in zip(starts, [*starts[1:], len(kinds)], strict=True):
        kind = kinds[start]
        if kind == 2:
            above = out[start - 1 : start] if start else np.zeros((1, lines.shape[1]), np.uint8)
            out[start:stop] = np.cumsum(np.concatenate([above, lines[start:stop]]), axis=0, dtype=np.uint8)[1:]
        elif kind in (3, 4):
            for row in range(start, stop):
                above = out[row - 1] if row else np.zeros(lines.shape[1], np.uint8)
                out[row] = (_average_row if kind == 3 else _paeth_row)(lines[row], above)
        elif kind > 4:
            raise DamagedImage(f"filter {kind}")
    return out


def read_png(stored: bytes) -> np.ndarray:
    """The samples of an 8-bit grey PNG without interlace."""
    head, data, ended = None, [], False
    for kind, body in chunks(stored):
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            data.append(body)
        elif kind == b"IEND":
            ended = True
    if head is None or head[2:] != (8, 0, 0, 0, 0) or not ended:
        raise DamagedImage("not an 8-bit grey image without interlace, or no end")
    columns, rows = head[:2]
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8)
    if lines.size != rows * (columns + 1):
        raise DamagedImage("number of samples")
    lines = lines.reshape(rows, columns + 1)
    return unfilter(lines[:, 0], lines[:, 1:])


_COSINES = np.cos(np.pi * (2 * np.arange(GRID)[None, :] + 1) * np.arange(LOW)[:, None] / (2 * GRID))


def _means(x: np.ndarray, axis: int) -> np.ndarray:
    n = x.shape[axis]
    if n <= GRID:
        return x.take(np.arange(GRID) * n // GRID, axis)
    edges = np.arange(GRID) * n // GRID
    shape = [1, 1]
    shape[axis] = GRID
    return np.add.reduceat(x, edges, axis) / np.diff(np.r_[edges, n]).reshape(shape)


def cosine_hash(samples: np.ndarray) -> bytes:
    """64 bits: which of the 8 x 8 lowest cosine coefficients of the 32 x 32 mean image are above their median."""
    small = _means(_means(samples.astype(np.float64), 0), 1)
    low = np.round(_COSINES @ small @ _COSINES.T, 6).ravel()
    return np.packbits(low > np.median(low[1:])).tobytes()


def padded(raw: bytes) -> bytes:
    return raw + bytes(WIDTH - len(raw) % WIDTH if len(raw) % WIDTH or not raw else 0)


_OUT = pa.schema(
    [
        ("n_bytes", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_sha256", pa.string()),
        ("tail_crc32", pa.int64()),
        ("media_bytes", pa.int64()),
        ("media_sha256", pa.string()),
        ("feature", pa.string()),
    ]
)


def _digest(raw: bytes) -> tuple[bytes, tuple]:
    payload = padded(raw)
    stored = write_png(np.frombuffer(payload, np.uint8).reshape(-1, WIDTH))
    samples = read_png(stored)
    back = samples.tobytes()
    return stored, (
        len(raw),
        len(back),
        hashlib.sha256(back).hexdigest(),
        zlib.crc32(back[-WIDTH:]),
        len(stored),
        hashlib.sha256(stored).hexdigest(),
        cosine_hash(samples).hex(),
    )


def media_columns(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_media: bool = False) -> DataFrame:
    """One row per row of df: id_col, sizes and digests of what was stored and read back, and the image's hash.

    With keep_media the PNG itself follows as a binary column ``media``. A null text is an empty payload (64 zero bytes);
    a null id stays null; repeated rows give repeated results; an empty table gives none; a very long text is one tall image;
    other columns are ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [_digest(x or b"") for x in batch.column(1).to_pylist()]
            arrays = [pa.array([m[1][k] for m in made], kind.type) for k, kind in enumerate(_OUT)]
            names = [id_col, *_OUT.names]
            if keep_media:
                arrays.append(pa.array([m[0] for m in made], pa.binary()))
                names.append("media")
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    rows = df.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").cast("binary").alias("raw"))
    schema = f"`{id_col}` long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return rows.mapInArrow(work, schema + ", media binary" * keep_media)
