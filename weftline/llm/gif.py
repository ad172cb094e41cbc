"""GIF images as numpy arrays: the LZW code stream, palettes, disposal, transparency and frame times.

Between two clear codes the width of the n-th code depends on n alone, so a run of codes is unpacked at once. A
dictionary code repeats what stands in the output from where its parent code began, one sample longer: lengths
and samples follow from pointers that are doubled until each reaches a literal. No loop visits single samples.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

CLEAR, END, FIRST = 256, 257, 258  # fixed values of the format for 8-bit samples
TABLE = 4096


def _widths(n: int, first: int, least: int) -> np.ndarray:
    """Bits of the codes 0 .. n-1 after a clear code."""
    entries = first + np.maximum(np.arange(n) - 1, 0)
    return np.clip(np.floor(np.log2(entries)).astype(np.int64) + 1, least, 12)


_WIDTHS_8 = _widths(TABLE, FIRST, 9)


def lzw_encode(samples: bytes) -> bytes:
    """The code stream of 8-bit samples: clear first, and again when the table is nearly full."""
    codes: list[int] = [CLEAR]
    starts = [0]
    emit = codes.append
    table: dict[int, int] = {}
    known = table.get
    free = FIRST
    current = samples[0]
    for sample in samples[1:]:
        key = current << 8 | sample
        code = known(key)
        if code is None:
            emit(current)
            table[key] = free
            free += 1
            current = sample
            if free == TABLE - 1:
                starts.append(len(codes))
                emit(CLEAR)
                table.clear()
                free = FIRST
        else:
            current = code
    emit(current)
    emit(END)
    values = np.array(codes, np.uint32)
    # A clear code still has the width of the run it ends; the codes after it count anew.
    number = np.arange(1, len(values))
    last_clear = np.array(starts)[np.searchsorted(starts, number) - 1]
    widths = np.concatenate([_WIDTHS_8[:1], _WIDTHS_8[number - last_clear - 1]])
    at = np.cumsum(widths) - widths
    out = np.zeros((int(at[-1]) + int(widths[-1]) + 7 >> 3) + 2, np.uint8)
    byte, shifted = at >> 3, values << (at & 7).astype(np.uint32)
    for lane in range(3):  # codes have 9 bits at least, so no two of them begin in one byte
        out[byte + lane] |= (shifted >> np.uint32(8 * lane)).astype(np.uint8)
    return out[:-2].tobytes()


def lzw_decode(stream: bytes, least_bits: int, n_samples: int) -> np.ndarray:
    """n_samples samples (fewer, if the stream ends early) of a code stream with any clear codes, or none."""
    clear = 1 << least_bits
    end, first = clear + 1, clear + 2
    raw = np.frombuffer(stream + b"\0\0\0", np.uint8).astype(np.uint32)
    total = 8 * len(stream)
    parts, got, bit = [], 0, 0
    while got < n_samples and bit < total:
        span = TABLE
        while True:
            widths = _WIDTHS_8[:span] if least_bits == 8 and span <= TABLE else _widths(span, first, least_bits + 1)
            at = bit + np.cumsum(widths) - widths
            fits = int(np.searchsorted(at + widths, total, side="right"))
            at, used = at[:fits], widths[:fits]
            byte = at >> 3
            word = raw[byte] | raw[byte + 1] << 8 | raw[byte + 2] << 16
            codes = (word >> (at & 7).astype(np.uint32) & (1 << used.astype(np.uint32)) - 1).astype(np.int64)
            stops = np.flatnonzero((codes == clear) | (codes == end))
            if len(stops) or fits < span:
                break
            span *= 4  # the table is full and the writer goes on without a clear code
        n = int(stops[0]) if len(stops) else fits
        if n:
            parts.append(_strings(codes[:n], clear, first))
            got += len(parts[-1])
        if not len(stops) or codes[n] == end:
            break
        bit = int(at[n] + used[n])
    return np.concatenate(parts)[:n_samples] if parts else np.empty(0, np.uint8)


def _strings(codes: np.ndarray, clear: int, first: int) -> np.ndarray:
    """The samples of the codes between two clear codes."""
    n = len(codes)
    literal = codes < clear
    here = np.arange(n)
    parent = np.where(literal, here, codes - first)
    if (bad := ~literal & ((parent < 0) | (parent >= here))).any():
        n = int(np.flatnonzero(bad)[0])  # a broken stream ends where it breaks
        codes, literal, here, parent = codes[:n], literal[:n], here[:n], parent[:n]
    if literal.all():
        return codes.astype(np.uint8)
    root, length = parent.copy(), (~literal).astype(np.int64)
    while True:
        further = root[root]
        length = length + length[root]
        if (further == root).all():
            break
        root = further
    # length now counts steps to the literal, doubled evenly: a root adds nothing to it
    size = length + 1
    begin = np.cumsum(size) - size
    shift = np.where(literal, 0, begin - begin[parent])
    source = np.arange(int(begin[-1] + size[-1]), dtype=np.int32) - np.repeat(shift, size).astype(np.int32)
    while True:
        further = source[source]
        if np.array_equal(further, source):
            break
        source = further
    values = np.zeros(len(source), np.uint8)
    values[begin[literal]] = codes[literal]
    return values[source]


@dataclass
class Frame:
    delay_ms: int
    left: int
    top: int
    samples: np.ndarray  # the stored palette indices of the frame's own rectangle
    palette: np.ndarray  # (n, 3)
    canvas: np.ndarray  # (height, width, 4): what is shown, composed by the rules of disposal


def _colours(data: bytes, at: int, n: int) -> np.ndarray:
    """n bytes of a palette."""
    if at + n > len(data):
        raise Broken("cut off in a palette")
    return np.frombuffer(data, np.uint8, n, at).reshape(-1, 3)


def _sub_blocks(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while at < len(data) and (n := data[at]):
        parts.append(data[at + 1 : at + 1 + n])
        at += n + 1
    return b"".join(parts), at + 1


MOST_PIXELS = 1 << 26  # of a canvas or a frame; what says that it is larger is taken for broken


class Broken(ValueError):
    """Bytes that are no GIF, or a GIF that breaks off; the frames before that are whole."""


def decode(data: bytes, compose: bool = True) -> Iterator[Frame]:
    """The frames one after another, so that only one of them and the canvas are held. Disposal 2 clears a frame's rectangle before the next one, 3 brings back what was there before."""
    try:
        yield from _frames(data, compose)
    except (struct.error, IndexError) as e:
        raise Broken("cut off") from e


def _frames(data: bytes, compose: bool) -> Iterator[Frame]:
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise Broken("not a GIF")
    width, height, flags, _, _ = struct.unpack("<HHBBB", data[6:13])
    at = 13
    shared = np.zeros((0, 3), np.uint8)
    if flags & 0x80:
        n = 3 << (flags & 7) + 1
        shared, at = _colours(data, at, n), at + n
    if width * height > MOST_PIXELS:
        raise Broken("too large")
    canvas = np.zeros((height, width, 4) if compose else (0, 0, 4), np.uint8)
    delay, disposal, transparent = 0, 0, None
    while at < len(data):
        kind = data[at]
        if kind == 0x3B:
            break
        if kind == 0x21:
            label = data[at + 1]
            body, at = _sub_blocks(data, at + 2)
            if label == 0xF9 and len(body) >= 4:
                packed, hundredths, index = struct.unpack("<BHB", body[:4])
                delay, disposal, transparent = 10 * hundredths, packed >> 2 & 7, index if packed & 1 else None
            continue
        if kind != 0x2C:
            raise Broken(f"unknown block {kind}")
        left, top, w, h, flags = struct.unpack("<HHHHB", data[at + 1 : at + 10])
        at += 10
        palette = shared
        if flags & 0x80:
            n = 3 << (flags & 7) + 1
            palette, at = _colours(data, at, n), at + n
        if w * h > MOST_PIXELS:
            raise Broken("too large")
        stream, after = _sub_blocks(data, at + 1)
        samples = lzw_decode(stream, data[at], w * h)
        at = after
        if len(samples) < w * h:
            samples = np.pad(samples, (0, w * h - len(samples)))
        picture = samples.reshape(h, w)
        if flags & 0x40:  # interlaced: every 8th row, those between, then every 4th and 2nd
            rows = np.concatenate([np.arange(s, h, d) for s, d in ((0, 8), (4, 8), (2, 4), (1, 2))])
            straight = np.empty_like(picture)
            straight[rows] = picture
            picture = straight
        if compose:
            before = canvas.copy() if disposal == 3 else None
            own = canvas[top : top + h, left : left + w]
            seen = picture[: own.shape[0], : own.shape[1]]
            rgba = np.dstack([palette[np.minimum(seen, len(palette) - 1)], np.full(seen.shape, 255, np.uint8)]) if len(palette) else own
            own[...] = rgba if transparent is None else np.where((seen == transparent)[..., None], own, rgba)
        yield Frame(delay, left, top, picture.reshape(-1), palette, canvas.copy() if compose else canvas)
        if compose:
            if disposal == 2:
                own[...] = 0
            elif disposal == 3:
                canvas = before
        delay, disposal, transparent = 0, 0, None


def _palettes() -> list[bytes]:
    """Grey, and three whose channels run against each other; all are one to one, so samples stay what they are."""
    i = np.arange(256, dtype=np.uint8)
    return [np.stack(c, 1).tobytes() for c in ((i, i, i), (i, ~i, i ^ 0x55), (~i, i ^ 0xAA, i), (i ^ 0x33, i, ~i))]


PALETTES = _palettes()
DISPOSALS = (1, 2, 3, 1)  # stays, is cleared, is taken back
TRANSPARENT = 0x20  # in every second frame, where what was there before shows through


def encode(samples: bytes, width: int, rows: int, delay_ms: int) -> bytes:
    """Samples as a GIF of frames of the given width and at most `rows` rows, shown one after another.

    The first frame has the shared grey palette, and later ones take their own palettes, ways of disposal, transparency and times in turn. None of these
    touches the samples, which come back as they were.
    """
    height = min(rows, len(samples) // width)
    parts = [b"GIF89a", struct.pack("<HHBBB", width, height, 0xF7, 0, 0), PALETTES[0]]
    for k, at in enumerate(range(0, len(samples), width * rows)):
        frame, own = samples[at : at + width * rows], k % len(PALETTES)
        parts.append(b"\x21\xf9\x04" + struct.pack("<BHB", DISPOSALS[k % len(DISPOSALS)] << 2 | k & 1, delay_ms // 10 * (1 + k % 3), TRANSPARENT if k & 1 else 0) + b"\0")
        parts.append(b"\x2c" + struct.pack("<HHHHB", 0, 0, width, len(frame) // width, 0x87 if own else 0) + (PALETTES[own] if own else b"") + b"\x08")
        stream = lzw_encode(frame)
        parts += [bytes([len(b)]) + b for b in (stream[k : k + 255] for k in range(0, len(stream), 255))]
        parts.append(b"\0")
    return b"".join([*parts, b"\x3b"])
