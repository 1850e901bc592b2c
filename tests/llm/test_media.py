import hashlib
import struct
import zlib

import numpy as np
import pytest

from tracewright.llm import media


@pytest.mark.parametrize("rows", [1, 2, 31, 33, 200])
def test_png_round_trip(rows):
    samples = np.random.default_rng(rows).integers(0, 256, (rows, 64), np.uint8)
    samples[::3] = 65
    assert (media.read_png(media.write_png(samples)) == samples).all()


def test_every_filter_is_undone():
    draw = np.random.default_rng(1)
    samples = draw.integers(0, 256, (20, 64), np.uint8)
    lines = []
    for r in range(20):
        kind = int(draw.integers(0, 5))
        line = [kind]
        for c in range(64):
            left, up, corner = (int(samples[r, c - 1]) if c else 0), (int(samples[r - 1, c]) if r else 0), (int(samples[r - 1, c - 1]) if r and c else 0)
            p = left + up - corner
            nearest = min((left, up, corner), key=lambda x: abs(p - x))
            line.append((int(samples[r, c]) - (0, left, up, (left + up) // 2, nearest)[kind]) & 255)
        lines.append(bytes(line))
    head = struct.pack(">IIBBBBB", 64, 20, 8, 0, 0, 0, 0)
    data = zlib.compress(b"".join(lines))
    stored = media.SIGNATURE + media._chunk(b"IHDR", head) + media._chunk(b"tEXt", b"k\0v") + media._chunk(b"IDAT", data[:50]) + media._chunk(b"IDAT", data[50:]) + media._chunk(b"IEND", b"")
    assert (media.read_png(stored) == samples).all()


def test_damage_is_found():
    stored = media.write_png(np.zeros((3, 64), np.uint8))
    for at in (2, 20, 45, len(stored) - 3):
        with pytest.raises(media.DamagedImage):
            media.read_png(stored[:at] + bytes([stored[at] ^ 1]) + stored[at + 1 :])
    with pytest.raises(media.DamagedImage):
        media.read_png(stored[:-5])


def test_media_columns(frame, odd_rows):
    rows = media.media_columns(frame(odd_rows), keep_media=True).collect()
    assert len(rows) == len(odd_rows)
    want = {}
    for i, t in odd_rows:
        raw = (t or "").encode()
        payload = raw + bytes(-len(raw) % 64) if raw else bytes(64)
        want.setdefault((i, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:])), 0)
    assert {tuple(r)[:5] for r in rows} == set(want)
    for r in rows:
        assert media.read_png(bytes(r["media"])).tobytes()[: r["n_bytes"]] and r["media_bytes"] == len(r["media"]) if r["n_bytes"] else r["payload_bytes"] == 64
        assert hashlib.sha256(bytes(r["media"])).hexdigest() == r["media_sha256"] and len(r["feature"]) == 16
    assert media.media_columns(frame([(1, "x")]).limit(0)).count() == 0


def test_hash_is_stable_under_small_changes():
    draw = np.random.default_rng(5)
    image = np.add.outer(np.linspace(0, 120, 96), np.linspace(0, 120, 64)).astype(np.uint8)
    other = np.clip(image + draw.integers(-2, 3, image.shape), 0, 255).astype(np.uint8)
    far = draw.integers(0, 256, image.shape, np.uint8)
    bits = lambda a, b: sum(bin(x ^ y).count("1") for x, y in zip(a, b, strict=True))
    # a plane has few coefficients that matter; noise decides the signs of the others
    assert bits(media.cosine_hash(image), media.cosine_hash(image)) == 0
    assert bits(media.cosine_hash(image), media.cosine_hash(other)) <= bits(media.cosine_hash(image), media.cosine_hash(far))
