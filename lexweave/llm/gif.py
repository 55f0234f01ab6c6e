"""GIF media columns: a codec for animated 8-bit images and the DataFrame operators around it.

The decoder reads LZW code streams, applies global and local palettes, interlacing, transparency and the three disposal
methods, and yields composed frames with their display times. The encoder writes what the decoder reads: bytes become
grey samples of frames 576 wide, compressed by LZW with dictionary resets.

Defined cases: a null text is stored like an empty one; a media value that is null or no GIF decodes to no frames
(``decode_column`` gives null); a truncated code stream leaves the rest of its frame at the background; repeated rows
and equal texts give equal bytes; a very long text is many frames, decoded one at a time; an empty table gives an empty one;
extra columns pass through, also where they have the names of ours.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .common import add_columns, fresh, table

WIDTH = 576
#: Rows of one stored frame; long payloads become several timed frames.
ROWS = 64
DELAY_CS = 4
# Fixed values of the file format: magic, block introducers, and the interlace passes as (first row, step).
MAGIC = (b"GIF87a", b"GIF89a")
IMAGE, EXTENSION, TRAILER, CONTROL = 0x2C, 0x21, 0x3B, 0xF9
PASSES = ((0, 8), (4, 8), (2, 4), (1, 2))
GREY = bytes(v for i in range(256) for v in (i, i, i))


@dataclass
class Frame:
    """A composed canvas (height x width x RGBA) shown for delay hundredths of a second."""

    delay: int
    canvas: np.ndarray
    left: int
    top: int
    width: int
    height: int


def _pack(value: np.ndarray, widths: np.ndarray) -> bytes:
    """Codes as a little-endian bit stream, each with its own width."""
    at = np.arange(12, dtype=np.uint32)
    bits = (value[:, None] >> at) & 1
    return np.packbits(bits[at < widths[:, None]].astype(np.uint8), bitorder="little").tobytes()


def lzw_encode(data: bytes, depth: int = 8) -> bytes:
    """LZW codes of data, starting with a clear code, cleared whenever 4096 codes are in use."""
    clear = 1 << depth
    codes, widths = [clear], [np.array([depth + 1], np.int64)]
    seen: dict[int, int] = {}
    # Width of the k-th code after a clear: the reader has one entry less than the codes it has read.
    entries = np.maximum(clear + 1 + np.arange(4096 - clear + 2), clear + 2)
    width_at = np.minimum(12, np.floor(np.log2(np.minimum(entries, 4096))).astype(np.int64) + 1)
    # Codes are held shifted, ready to be joined with the next byte.
    start, free, full, at_clear, none = 1, (clear + 2) << 8, 4096 << 8, clear << 8, None
    codes[0] = at_clear
    find, put = seen.get, codes.append
    prefix = data[0] << 8 if data else -1
    for b in memoryview(data)[1:]:
        code = find(prefix | b)
        if code is not none:
            prefix = code
            continue
        put(prefix)
        if free < full:
            seen[prefix | b] = free
            free += 256
        else:
            put(at_clear)
            widths.append(width_at[: len(codes) - start])
            start = len(codes)
            seen.clear()
            free = (clear + 2) << 8
        prefix = b << 8
    if prefix >= 0:
        put(prefix)
    put((clear + 1) << 8)
    widths.append(width_at[: len(codes) - start])
    return _pack(np.array(codes, np.uint32) >> np.uint32(8), np.concatenate(widths))


@cache
def _schedule(depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Widths of the codes after a clear, as a reader sees them, and the bit offset of each; 12 bits once the table is full."""
    entries = np.minimum(np.maximum((1 << depth) + 1 + np.arange(4200), (1 << depth) + 2), 4096)
    widths = np.minimum(12, np.floor(np.log2(entries)).astype(np.int64) + 1)
    return widths, np.concatenate(([0], np.cumsum(widths)))


def _expand(codes: np.ndarray, clear: int) -> tuple[np.ndarray, bool]:
    """The samples of the codes after one clear, and whether a code names an entry that is not there yet (they end before it).

    The entry that the j-th code adds is its own output and the sample after it, so a later code that names this entry
    copies from the j-th code's output on. Lengths and samples are found by following such links, doubling each time.
    """
    at = np.arange(len(codes))
    literal = codes < clear
    up = np.where(literal, at, codes.astype(np.int64) - (clear + 2))
    broken = np.flatnonzero(~literal & ((up >= at) | (up < 0)))
    if len(broken):
        n = broken[0]
        codes, at, literal, up = codes[:n], at[:n], literal[:n], up[:n]
    hops, to = (~literal).astype(np.int64), up
    while not literal[to].all():
        hops, to = hops + hops[to], to[to]
    lengths = hops + 1
    starts = np.cumsum(lengths) - lengths
    shift = starts - starts[up]
    source = np.arange(int(lengths.sum())) - np.repeat(shift, lengths)
    values = np.zeros(len(source), np.uint8)
    values[starts[literal]] = codes[literal]
    while True:
        further = source[source]
        if np.array_equal(further, source):
            return values[source], len(broken) > 0
        source = further


def lzw_decode(stream: bytes, depth: int, size: int) -> bytes:
    """At most size samples of an LZW code stream; stops at the end code or at a broken code.

    Code widths depend only on the number of codes since the last clear, so a stretch of codes is cut out of the bits at
    once.
    """
    clear = 1 << depth
    by = np.frombuffer(stream + b"\0\0\0\0", np.uint8).astype(np.uint32)
    total, bit, made = 8 * len(stream), 0, 0
    out: list[np.ndarray] = []
    widths, offsets = _schedule(depth)
    while made < size and bit < total:
        parts, ended = [], False
        w, o = widths, offsets
        while bit < total:
            n = int(np.searchsorted(o[1:], total - bit, "right"))
            at = bit + o[:n]
            low = at >> 3
            codes = ((by[low] | by[low + 1] << np.uint32(8) | by[low + 2] << np.uint32(16)) >> (at & 7).astype(np.uint32)) & ((1 << w[:n]) - 1).astype(np.uint32)
            stops = np.flatnonzero((codes == clear) | (codes == clear + 1))
            stop = int(stops[0]) if len(stops) else n
            parts.append(codes[:stop])
            if stop < n:
                ended = codes[stop] == clear + 1
                bit += int(o[stop + 1])
                break
            bit = total if n < len(w) else bit + int(o[n])
            # No clear came: the table is full and codes stay 12 bits wide.
            w, o = np.full(4200, 12, np.int64), np.arange(4201) * 12
        codes = np.concatenate(parts) if len(parts) > 1 else parts[0] if parts else np.zeros(0, np.uint32)
        if len(codes):
            piece, broken = _expand(codes, clear)
            out.append(piece)
            made += len(piece)
            ended = ended or broken
        if ended:
            break
    return np.concatenate(out).tobytes()[:size] if out else b""


def _sub_blocks(data: bytes) -> bytes:
    full, rest = divmod(len(data), 255)
    cut = b"".join(b"\xff" + data[i * 255 : i * 255 + 255] for i in range(full))
    return cut + (bytes([rest]) + data[full * 255 :] if rest else b"") + b"\0"


def encode(samples: bytes, width: int = WIDTH, rows: int = ROWS, delay: int = DELAY_CS) -> bytes:
    """A grey animation whose frames, in order, hold the samples; their number must be a positive multiple of width."""
    if not samples or len(samples) % width:
        raise ValueError(f"the payload must be a positive multiple of {width} samples")
    per = width * rows
    height = min(rows, len(samples) // width)
    out = [MAGIC[1], struct.pack("<HHBBB", width, height, 0xF7, 0, 0), GREY]
    for at in range(0, len(samples), per):
        part = samples[at : at + per]
        out.append(bytes([EXTENSION, CONTROL, 4, 1 << 2]) + struct.pack("<H", delay) + b"\0\0")
        out.append(bytes([IMAGE]) + struct.pack("<HHHHB", 0, 0, width, len(part) // width, 0) + b"\x08")
        out.append(_sub_blocks(lzw_encode(part)))
    out.append(bytes([TRAILER]))
    return b"".join(out)


def decode(media: bytes):
    """Yield the composed frames of a GIF; raises ValueError if it is none."""
    if media[:6] not in MAGIC or len(media) < 13:
        raise ValueError("not a GIF")
    width, height, flags, background = struct.unpack_from("<HHBB", media, 6)
    at = 13

    def palette(bits: int, at: int) -> np.ndarray:
        table = np.zeros((256, 3), np.uint8)
        n = 2 << bits
        got = np.frombuffer(media[at : at + 3 * n], np.uint8)
        table[: len(got) // 3] = got[: len(got) // 3 * 3].reshape(-1, 3)
        return table

    shared = None
    if flags & 0x80:
        shared = palette(flags & 7, at)
        at += 3 * (2 << (flags & 7))
    canvas = np.zeros((height, width, 4), np.uint8)
    delay, disposal, clear_index = 0, 0, None

    def blocks(at: int) -> tuple[bytes, int]:
        parts = []
        while at < len(media) and media[at]:
            parts.append(media[at + 1 : at + 1 + media[at]])
            at += 1 + media[at]
        return b"".join(parts), at + 1

    while at < len(media) and media[at] != TRAILER:
        kind = media[at]
        if kind == EXTENSION:
            body, after = blocks(at + 2)
            if media[at + 1 : at + 2] == bytes([CONTROL]) and len(body) >= 4:
                disposal, delay = body[0] >> 2 & 7, body[1] | body[2] << 8
                clear_index = body[3] if body[0] & 1 else None
            at = after
            continue
        if kind != IMAGE or at + 10 > len(media):
            break
        left, top, w, h, own = struct.unpack_from("<HHHHB", media, at + 1)
        at += 10
        colours = shared
        if own & 0x80:
            colours = palette(own & 7, at)
            at += 3 * (2 << (own & 7))
        if colours is None:
            colours = np.zeros((256, 3), np.uint8)
        depth = media[at] if at < len(media) else 8
        stream, at = blocks(at + 1)
        pixels = lzw_decode(stream, min(max(depth, 1), 8), w * h)
        index = np.frombuffer(pixels, np.uint8)
        drawn = np.zeros(w * h, bool)
        drawn[: len(index)] = True
        index = np.concatenate([index, np.zeros(w * h - len(index), np.uint8)]).reshape(h, w)
        drawn = drawn.reshape(h, w)
        if own & 0x40:
            order = np.concatenate([np.arange(first, h, step) for first, step in PASSES]) if h else np.zeros(0, int)
            placed, shown = np.empty_like(index), np.empty_like(drawn)
            placed[order], shown[order] = index, drawn
            index, drawn = placed, shown
        if clear_index is not None:
            drawn = drawn & (index != clear_index)
        before = canvas.copy() if disposal == 3 else None
        box = canvas[top : top + h, left : left + w]
        visible = drawn[: box.shape[0], : box.shape[1]]
        shown = np.concatenate((colours, np.full((256, 1), 255, np.uint8)), 1)[index[: box.shape[0], : box.shape[1]]]
        if visible.all():
            box[:] = shown
        else:
            box[visible] = shown[visible]
        yield Frame(delay, canvas.copy(), left, top, w, h)
        if disposal == 2:
            box[:] = 0
        elif disposal == 3:
            canvas = before
        delay, disposal, clear_index = 0, 0, None


def samples(frames: list[Frame]) -> bytes:
    """What encode() stored: the grey values of each frame's own box, in order."""
    return b"".join(np.ascontiguousarray(f.canvas[f.top : f.top + f.height, f.left : f.left + f.width, 0]).tobytes() for f in frames)


def histogram(frame: Frame, bins: int = 8) -> list[int]:
    """Visible pixels by red, green and blue level: 3 x bins counts."""
    seen = frame.canvas[..., 3] > 0
    shown = frame.canvas.reshape(-1, 4) if seen.all() else frame.canvas[seen]
    return [int(n) for channel in range(3) for n in np.bincount(shown[:, channel], minlength=256).reshape(bins, -1).sum(1)]


def pad(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    short = -len(raw) % WIDTH if raw else WIDTH
    return len(raw), raw + b"\xff" * short


def encode_column(docs: DataFrame, column: str = "text") -> DataFrame:
    """docs with n_bytes and media: the text's UTF-8 bytes, padded with 255, as a GIF."""
    size, media = fresh(docs, "n_bytes", "media")

    def run(texts):
        padded = [pad(t) for t in texts]
        return [[n for n, _ in padded], [encode(p) for _, p in padded]]

    return add_columns(docs, [column], f"`{size}` long, `{media}` binary", run)


FRAME_DDL = "array<struct<frame:int,delay_cs:int,width:int,height:int,histogram:array<int>>>"


def decode_column(df: DataFrame, column: str = "media") -> DataFrame:
    """df with payload (samples of all frames) and frames (time and colour histogram of each); null for no GIF."""
    payload, frames = fresh(df, "payload", "frames")

    def run(media):
        out = [[], []]
        for m in media:
            stored, told = [], []
            try:
                for i, f in enumerate(decode(m or b"")):
                    stored.append(samples([f]))
                    told.append({"frame": i, "delay_cs": f.delay, "width": f.width, "height": f.height, "histogram": histogram(f)})
            except ValueError:
                stored = told = None
            out[0].append(None if told is None else b"".join(stored))
            out[1].append(told)
        return out

    return add_columns(df, [column], f"`{payload}` binary, `{frames}` {FRAME_DDL}", run)


DIGESTS = {"payload_bytes": "long", "payload_sha256": "string", "tail_crc32": "long", "media_bytes": "long", "media_sha256": "string", "feature": "string"}


def digests(df: DataFrame, column: str = "media") -> DataFrame:
    """Sizes, digests and a feature of what a media column decodes to, frame by frame; null for no GIF."""

    def run(media):
        out = [[], [], [], [], [], []]
        for m in media:
            stored, hist, n, delay = [], 0, 0, 0
            try:
                for f in decode(m or b""):
                    stored.append(samples([f]))
                    hist, n, delay = np.array(histogram(f)) + hist, n + 1, delay + f.delay
            except ValueError:
                row = (None,) * 6
            else:
                p = b"".join(stored)
                feature = f"frames={n};cs={delay};hist=" + ",".join(map(str, hist if n else ()))
                row = (len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(m), hashlib.sha256(m).hexdigest(), feature)
            for made, value in zip(out, row, strict=True):
                made.append(value)
        return out

    names = fresh(df, *DIGESTS)
    return add_columns(df, [column], ", ".join(f"`{n}` {k}" for n, k in zip(names, DIGESTS.values(), strict=True)), run)


def op6_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(encode_column(docs)).drop("text", "media")
