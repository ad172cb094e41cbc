"""GIF codec and media columns: round trips, and the rules of frames on a hand-made image."""

import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from weftline.llm import gif, op1_gif


@pytest.mark.parametrize("letters", [1, 2, 7, 256])
@pytest.mark.parametrize("n", [1, 2, 3, 300, 20_000])
def test_lzw_round_trip(letters, n):
    data = bytes(random.Random(n * letters).choices(range(letters), k=n))
    assert gif.lzw_decode(gif.lzw_encode(data), 8, n).tobytes() == data


def plain_decode(stream, bits, n):
    """One code after another, by the book."""
    clear, end = 1 << bits, (1 << bits) + 1
    table, width, out, previous, at = None, bits + 1, [], None, 0
    value = int.from_bytes(stream, "little")
    while len(out) < n:
        code = value >> at & (1 << width) - 1
        at += width
        if code == clear:
            table, width, previous = [bytes([k]) for k in range(clear)] + [b"", b""], bits + 1, None
            continue
        if code == end:
            break
        entry = table[code] if code < len(table) else previous + previous[:1]
        if previous is not None and len(table) < 4096:
            table.append(previous + entry[:1])
        if len(table) == 1 << width and width < 12:
            width += 1
        out += entry
        previous = entry
    return bytes(out[:n])


def test_decoders_agree():
    rng = random.Random(1)
    for _ in range(20):
        data = bytes(rng.choices(range(9), k=rng.randint(1, 9000)))
        stream = gif.lzw_encode(data)
        assert plain_decode(stream, 8, len(data)) == data == gif.lzw_decode(stream, 8, len(data)).tobytes()


def pack(codes, bits):
    """Codes of growing width, without a later clear code."""
    value, at, width, free = 0, 0, bits + 1, (1 << bits) + 2
    first = True
    for c in codes:
        value |= c << at
        at += width
        if c == 1 << bits:
            width, free, first = bits + 1, (1 << bits) + 2, True
            continue
        if not first and free < 4096:
            free += 1
            if free == 1 << width and width < 12:
                width += 1
        first = False
    return value.to_bytes((at + 7) // 8, "little")


def test_small_code_size_and_full_table():
    rng = random.Random(2)
    codes = [4] + [rng.randrange(4) for _ in range(9000)] + [5]
    stream = pack(codes, 2)
    assert gif.lzw_decode(stream, 2, 9000).tolist() == codes[1:-1]


def frame(samples, w, h, left=0, top=0, disposal=0, transparent=None, delay=5, flags=0):
    control = b"\x21\xf9\x04" + struct.pack("<BHB", disposal << 2 | (transparent is not None), delay, transparent or 0) + b"\0"
    stream = pack([4, *samples, 5], 2)
    return control + b"\x2c" + struct.pack("<HHHHB", left, top, w, h, flags) + b"\x02" + bytes([len(stream)]) + stream + b"\0"


def image(*frames, w=2, h=2):
    palette = bytes([0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255])
    return b"GIF89a" + struct.pack("<HHBBB", w, h, 0x91, 0, 0) + palette + b"".join(frames) + b"\x3b"


def colours(canvas):
    names = {(0, 0, 0, 0): ".", (0, 0, 0, 255): "k", (255, 0, 0, 255): "r", (0, 255, 0, 255): "g", (0, 0, 255, 255): "b"}
    return "".join(names[tuple(p)] for p in canvas.reshape(-1, 4).tolist())


def test_disposal_and_transparency():
    data = image(
        frame([1, 1, 1, 1], 2, 2),  # stays
        frame([2, 3], 2, 1, transparent=3),  # green at the left, the red shows through at the right
        frame([3], 1, 1, left=1, top=1, disposal=3),  # blue, taken back afterwards
        frame([0], 1, 1, top=1, disposal=2),  # black, cleared afterwards
        frame([3], 1, 1, left=1, top=0, delay=7),
    )
    found = list(gif.decode(data))
    assert [colours(f.canvas) for f in found] == ["rrrr", "grrr", "grrb", "grkr", "gb.r"]
    assert [f.delay_ms for f in found] == [50, 50, 50, 50, 70]


def test_interlaced():
    rows = [0, 2, 1, 3]  # stored order of 4 rows: 0, 4th.., 2, then 1 and 3
    data = image(frame([1, 3, 2, 0], 1, 4, flags=0x40), w=1, h=4)
    assert next(gif.decode(data)).samples.tolist() == [1, 2, 3, 0] and rows


def test_cut_off_stream_fills_up():
    data = gif.encode(bytes(range(64)) * 4, 64, 256, 40)
    assert len(next(gif.decode(data[:-40])).samples) == 256


def test_payloads_come_back(spark, docs, texts):
    rows = op1_gif.digest(op1_gif.to_media(docs)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        raw = (dict(texts)[r["doc_id"]] or "").encode()
        payload = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    by_text = {}
    for r in rows:
        by_text.setdefault(dict(texts)[r["doc_id"]] or "", set()).add((r["media_sha256"], r["feature"]))
    assert all(len(v) == 1 for v in by_text.values())
    assert max(r["n_frames"] for r in rows) > 1


def test_frames_table(spark):
    media = spark.createDataFrame([(1, bytearray(image(frame([1, 1, 2, 3], 2, 2), frame([0], 1, 1)))), (2, None)], "doc_id long, media binary")
    rows = op1_gif.frames(media).orderBy("frame").collect()
    assert [(r["id"], r["frame"], r["start_ms"], sum(r["histogram"])) for r in rows] == [(1, 0, 0, 4), (1, 1, 50, 1)]
    assert rows[0]["histogram"][np.array([3 * 16]).item()] == 2  # two red samples


def plain_frames(data):
    """A GIF drawn pixel by pixel, by the book: (start, delay, canvas as rows of RGBA tuples, the frame's samples)."""
    width, height, flags = struct.unpack("<HHB", data[6:11])
    at, shared = 13, []
    if flags & 0x80:
        n = 2 << (flags & 7)
        shared = [tuple(data[13 + 3 * k : 16 + 3 * k]) for k in range(n)]
        at += 3 * n
    canvas, clock, out = [[(0, 0, 0, 0)] * width for _ in range(height)], 0, []

    def blocks(at):
        body = b""
        while data[at]:
            body += data[at + 1 : at + 1 + data[at]]
            at += data[at] + 1
        return body, at + 1

    while data[at] != 0x3B:
        if data[at] == 0x21:
            body, at = blocks(at + 2)
            packed, hundredths, index = struct.unpack("<BHB", body)
            continue
        left, top, w, h, flags = struct.unpack("<HHHHB", data[at + 1 : at + 10])
        at, palette = at + 10, shared
        if flags & 0x80:
            n = 2 << (flags & 7)
            palette = [tuple(data[at + 3 * k : at + 3 * k + 3]) for k in range(n)]
            at += 3 * n
        bits = data[at]
        stream, at = blocks(at + 1)
        samples = plain_decode(stream, bits, w * h)
        before = [list(r) for r in canvas]
        for k, s in enumerate(samples):
            if not (packed & 1 and s == index):
                canvas[top + k // w][left + k % w] = (*palette[s], 255)
        out.append((clock, 10 * hundredths, [list(r) for r in canvas], samples))
        clock += 10 * hundredths
        if packed >> 2 & 7 == 2:
            for y in range(top, top + h):
                canvas[y][left : left + w] = [(0, 0, 0, 0)] * w
        elif packed >> 2 & 7 == 3:
            canvas = before
    return out


def plain_boxes(canvas):
    found = [0] * 64
    for row in canvas:
        for r, g, b, a in row:
            if a:
                found[16 * (r >> 6) + 4 * (g >> 6) + (b >> 6)] += 1
    return found


def test_stored_media_are_drawn_as_by_the_book(spark):
    """Palettes, transparency, all ways of disposal and times of what the query stores, against a plain decoder of the stored bytes."""
    rng = random.Random(8)
    texts = ["", "short", " ".join(rng.choice(["one", "two", "été", " "]) for _ in range(900)), "word " * 700]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    media = op1_gif.to_media(docs, rows=8).cache()
    stored = {r["doc_id"]: bytes(r["media"]) for r in media.collect()}
    frames = {}
    for r in op1_gif.frames(media).collect():
        frames.setdefault(r["id"], {})[r["frame"]] = r
    for r in op1_gif.digest(media).collect():
        plain = plain_frames(stored[r["doc_id"]])
        assert b"".join(p[3] for p in plain)[: r["n_bytes"]] == texts[r["doc_id"]].encode()
        assert [(f["start_ms"], f["delay_ms"], list(f["histogram"])) for f in r["frames"]] == [(start, delay, plain_boxes(canvas)) for start, delay, canvas, _ in plain]
        for k, (start, delay, canvas, samples) in enumerate(plain):
            f = frames[r["doc_id"]][k]
            assert (f["start_ms"], f["delay_ms"], bytes(f["samples"])) == (start, delay, samples)
            assert bytes(f["rgba"]) == bytes(v for row in canvas for pixel in row for v in pixel) and list(f["shown"]) == plain_boxes(canvas)
    assert len(frames[3]) > 5 and len({tuple(f["shown"]) for f in frames[3].values()}) > 3
    assert any(0 in {a for row in canvas for *_, a in row} for *_, canvas, _ in plain_frames(stored[2]))  # something was cleared


def test_no_rows(no_docs):
    assert op1_gif.digest(op1_gif.to_media(no_docs)).count() == 0


def test_broken_media_and_missing_ids(spark):
    """Bytes that are no GIF have no frames, those of a GIF that breaks off come first, and a giant is not drawn."""
    good = gif.encode(bytes(range(256)) * 2, 64, 4, 40)
    giant = good[:6] + b"\xff\xff\xff\xff" + good[10:]
    rows = spark.createDataFrame([(1, good), (2, b""), (3, b"GIF89a"), (4, b"no picture"), (5, good[: len(good) * 3 // 4]), (6, giant), (None, good), (2**53 + 1, good), (7, None)], "doc_id long, media binary").coalesce(1)
    found = {}
    for r in op1_gif.frames(rows).collect():
        found.setdefault(r["id"], []).append(r["frame"])
    assert found[1] == found[None] == found[2**53 + 1] == [0, 1] and found[5][:1] == [0] and not {2, 3, 4, 6, 7} & set(found)
    docs = spark.createDataFrame([(None, "a"), (2**53 + 1, "b")], "doc_id long, text string").coalesce(1)
    assert {r["doc_id"] for r in op1_gif.digest(op1_gif.to_media(docs)).collect()} == {None, 2**53 + 1}
