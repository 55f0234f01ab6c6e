import hashlib
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexweave.llm import gif


def slow_decode(stream, depth, size):
    """Code by code, from the format's description."""
    clear, out, last = 1 << depth, b"", b""
    table, width, bits, at = [], depth + 1, int.from_bytes(stream, "little"), 0
    table = [bytes([i]) for i in range(clear)] + [b"", b""]
    while at + width <= 8 * len(stream) and len(out) < size:
        code = bits >> at & (1 << width) - 1
        at += width
        if code == clear:
            table, width, last = table[: clear + 2], depth + 1, b""
            continue
        if code == clear + 1:
            break
        if code < len(table):
            piece = table[code]
        elif code == len(table) and last:
            piece = last + last[:1]
        else:
            break
        if last and len(table) < 4096:
            table.append(last + piece[:1])
        out, last = out + piece, piece
        if len(table) >= 1 << width and width < 12:
            width += 1
    return out[:size]


@settings(max_examples=80, deadline=None)
@given(st.binary(min_size=1, max_size=3000))
def test_codes_round_trip(data):
    codes = gif.lzw_encode(data)
    assert gif.lzw_decode(codes, 8, len(data)) == data == slow_decode(codes, 8, len(data))


@settings(max_examples=80, deadline=None)
@given(st.binary(min_size=1, max_size=400), st.integers(2, 8))
def test_any_stream_decodes_like_the_description(stream, depth):
    assert gif.lzw_decode(stream, depth, 5000) == slow_decode(stream, depth, 5000)


def test_long_inputs():
    rng = np.random.default_rng(3)
    for data in (bytes(rng.integers(0, 256, 60000, dtype=np.uint8)), b"a" * 200000, b"abc" * 30000):
        assert gif.lzw_decode(gif.lzw_encode(data), 8, len(data)) == data


def picture(frames, size=(4, 3), palette=((10, 20, 30), (200, 100, 50), (0, 255, 0), (1, 2, 3))):
    """frames: (left, top, w, h, pixels, disposal, transparent or None, delay, interlaced, local palette or None)."""
    out = b"GIF89a" + struct.pack("<HHBBB", *size, 0x80 | 1, 0, 0) + bytes(v for c in palette for v in c)
    for left, top, w, h, pixels, disposal, clear, delay, laced, local in frames:
        out += b"\x21\xf9\x04" + struct.pack("<BHB", disposal << 2 | (clear is not None), delay, clear or 0) + b"\0"
        out += b"\x21\xfe\x03abc\0"
        out += b"\x2c" + struct.pack("<HHHHB", left, top, w, h, laced << 6 | (0x80 | 1 if local else 0)) + (bytes(v for c in local for v in c) if local else b"")
        out += b"\x02" + gif._sub_blocks(gif.lzw_encode(bytes(pixels), 2))
    return out + b"\x3b"


def test_disposal_transparency_palettes_interlacing():
    full = [0] * 12
    media = picture([(0, 0, 4, 3, full, 1, None, 5, 0, None), (1, 1, 2, 1, [1, 3], 2, 3, 6, 0, None), (0, 0, 1, 1, [2], 3, None, 7, 0, None), (0, 0, 4, 3, [1] * 4 + [0] * 4 + [2] * 4, 0, None, 8, 1, ((9, 9, 9), (8, 8, 8), (7, 7, 7), (6, 6, 6)))])
    a, b, c, d = gif.decode(media)
    assert [f.delay for f in (a, b, c, d)] == [5, 6, 7, 8]
    assert (a.canvas[..., :3] == (10, 20, 30)).all() and (a.canvas[..., 3] == 255).all()
    assert tuple(b.canvas[1, 1]) == (200, 100, 50, 255) and tuple(b.canvas[1, 2]) == (10, 20, 30, 255)
    assert tuple(c.canvas[1, 1]) == (0, 0, 0, 0) and tuple(c.canvas[0, 0]) == (0, 255, 0, 255)
    assert [int(d.canvas[y, 0, 0]) for y in range(3)] == [8, 7, 9]
    assert sum(gif.histogram(a)) == 36


def test_not_a_gif():
    with pytest.raises(ValueError):
        list(gif.decode(b"PNG"))
    assert list(gif.decode(b"GIF89a" + struct.pack("<HHBBB", 1, 1, 0, 0, 0))) == []


def test_columns(spark):
    texts = [None, "", "short", "é" * 400, "x" * 576, "word and another " * 9000, "short"]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, media int").repartition(2)
    stored = gif.encode_column(df)
    assert stored.columns == ["doc_id", "text", "media", "n_bytes", "_media"]
    back = {r["doc_id"]: r for r in gif.decode_column(stored, "_media").collect()}
    digest = {r["doc_id"]: r for r in gif.digests(stored, "_media").collect()}
    for i, t in enumerate(texts):
        n, padded = gif.pad(t)
        assert bytes(back[i]["payload"]) == padded and len(padded) % 576 == 0 and padded and n == len((t or "").encode())
        assert digest[i]["payload_sha256"] == hashlib.sha256(padded).hexdigest() and digest[i]["tail_crc32"] == zlib.crc32(padded[-32:]) and digest[i]["payload_bytes"] == len(padded)
        assert sum(back[i]["frames"][0]["histogram"]) == 3 * back[i]["frames"][0]["width"] * min(64, len(padded) // 576)
    assert digest[2]["media_sha256"] == digest[6]["media_sha256"] and len(back[5]["frames"]) > 3
    bad = spark.createDataFrame([(None,), (bytearray(b"no"),)], "media binary")
    assert [r["payload"] for r in gif.decode_column(bad).collect()] == [None, None]
    assert gif.encode_column(df.filter("false")).count() == 0
