"""Media columns: documents and any bytes as GIF columns, and GIF columns as timed frames with colour histograms.

Each row is encoded and decoded on its own inside its task; nothing is shuffled, and a lost task repeats.

Defined cases: a null or empty text is a payload of 64 zero bytes with n_bytes 0; a very long text becomes many
frames, which are decoded one at a time; equal texts give equal values; repeated rows stay, and so do rows without doc_id;
a media value that is null, empty or no GIF has no frames, one that breaks off has those before the break, and one that says that a picture is larger than
MOST_PIXELS breaks there; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import gif
from .common import NO_ID, doc_texts, with_ids

WIDTH = 64  # payloads are whole rows of so many samples
ROWS = 256
DELAY_MS = 40
BINS = 4  # of each colour channel


def histogram(samples: np.ndarray, palette: np.ndarray) -> np.ndarray:
    """Samples by colour in BINS ** 3 boxes of the colour cube, by way of the counts of palette entries."""
    boxes = (palette.astype(np.int64) * BINS >> 8) @ np.array([BINS * BINS, BINS, 1])
    counts = np.bincount(samples, minlength=len(palette))[: len(palette)]
    return np.bincount(boxes, weights=counts, minlength=BINS**3).astype(np.int64)


def shown(canvas: np.ndarray) -> np.ndarray:
    """The same for what a composed canvas shows: its pixels that aren't see-through."""
    boxes = (canvas[..., :3].reshape(-1, 3).astype(np.int64) * BINS >> 8) @ np.array([BINS * BINS, BINS, 1])
    return np.bincount(boxes[canvas[..., 3].reshape(-1) > 0], minlength=BINS**3)


def to_media(docs: DataFrame, width: int = WIDTH, rows: int = ROWS, delay_ms: int = DELAY_MS) -> DataFrame:
    """(doc_id, n_bytes, media): the UTF-8 bytes of each text, zero-padded to whole rows, as the samples of a GIF."""

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1000):  # media of some rows at a time
                part = batch.iloc[at : at + 1000]
                payloads = [x.encode() for x in part["text"]]
                padded = [p + bytes(-len(p) % width or (0 if p else width)) for p in payloads]
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "n_bytes": [len(p) for p in payloads], "media": [gif.encode(p, width, rows, delay_ms) for p in padded]})

    return with_ids(doc_texts(docs).mapInPandas(encoded, "doc_id long, n_bytes long, media binary"))


def frames(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """One row for each frame of each media value: its time, place, stored samples, shown RGBA canvas, and the colour histograms of its own samples and of the canvas."""

    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, data in zip(batch["id"], batch["media"]):
                if data is None:
                    continue
                clock = 0
                try:
                    for k, f in enumerate(gif.decode(data)):
                        row = (key, k, clock, f.delay_ms, f.left, f.top, f.canvas.shape[1], f.canvas.shape[0], f.samples.tobytes(), f.canvas.tobytes(), histogram(f.samples, f.palette).tolist(), shown(f.canvas).tolist())
                        yield pd.DataFrame([row], columns=["id", "frame", "start_ms", "delay_ms", "left", "top", "width", "height", "samples", "rgba", "histogram", "shown"])
                        clock += f.delay_ms
                except gif.Broken:
                    continue

    schema = "id long, frame int, start_ms long, delay_ms long, left int, top int, width int, height int, samples binary, rgba binary, histogram array<long>, shown array<long>"
    rows = media.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(media_col).cast("binary").alias("media"))
    return with_ids(rows.mapInPandas(decoded, schema), "id")


def digest(media: DataFrame) -> DataFrame:
    """What the stored bytes hold, read back and drawn frame by frame: checksums, a feature of times and colours, and the timed frames with their histograms.

    Each frame is composed on the canvas by its palette, transparency and the disposal of the one before; histograms are of what is then seen.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, n_bytes, data in zip(batch["doc_id"], batch["n_bytes"], batch["media"]):
                sha, tail, size, clock, timed = hashlib.sha256(), b"", 0, 0, []
                for f in gif.decode(data):
                    samples = f.samples.tobytes()
                    sha.update(samples)
                    tail, size = samples[-64:], size + len(samples)  # frames are whole rows of 64 samples
                    timed.append({"start_ms": clock, "delay_ms": f.delay_ms, "histogram": shown(f.canvas)})
                    clock += f.delay_ms
                colours = sum((t["histogram"] for t in timed), np.zeros(BINS**3, np.int64))
                feature = f"{len(timed)}f{clock}ms{colours.sum()}px:" + "-".join(map(str, colours[np.arange(BINS) * (BINS * BINS + BINS + 1)]))
                rows.append((doc_id, n_bytes, size, sha.hexdigest(), zlib.crc32(tail), len(data), hashlib.sha256(data).hexdigest(), feature, len(timed), timed))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_frames", "frames"])

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_frames int, frames array<struct<start_ms:bigint,delay_ms:bigint,histogram:array<bigint>>>"
    rows = media.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "n_bytes", "media")
    return with_ids(rows.mapInPandas(read, schema))
