"""Best-fit packing: documents into fixed-length sequences with a bounded number of open bins.

Each task reads its documents once, as a stream. A fixed number of bins is open at a time; a bitset holds one
bit for each amount of free space that some open bin has, so the tightest bin that still takes an item is found
by a shift and a lowest-set-bit test. When one bin too many is open, the fullest closes. No shuffle, no state
beyond the open bins, and a lost task repeats with the same result.

Defined cases: a null or empty text is the separator alone (one token); equal or repeated rows are packed one by
one, as given; the text <|endoftext|> is the token of that name; a document of more than `length` tokens is cut into pieces of `length`, the first piece taking
the remainder; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import doc_texts, with_ids
from .tokens import BYTE_BPE, encoder

SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
#: Sequences are numbered from the task's number times this.
SEQUENCES_A_TASK = 1 << 40


class OpenBins:
    """Bounded-space best fit. place(size) gives (bin number, offset)."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most, self.open, self.made = capacity, most, 0, 0
        self.bits = 0
        self.with_space: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _put(self, free: int, number: int) -> None:
        self.with_space[free].append(number)
        self.bits |= 1 << free
        self.open += 1

    def _take(self, free: int) -> int:
        number = self.with_space[free].pop()
        if not self.with_space[free]:
            self.bits ^= 1 << free
        self.open -= 1
        return number

    @staticmethod
    def _lowest(bits: int) -> int:
        return (bits & -bits).bit_length() - 1

    def place(self, size: int) -> tuple[int, int]:
        fitting = self.bits >> size
        if fitting:
            free = size + self._lowest(fitting)
            number = self._take(free)
        else:
            free, number = self.capacity, self.made
            self.made += 1
        if free > size:
            self._put(free - size, number)
            if self.open > self.most:
                self._take(self._lowest(self.bits))  # the fullest closes
        return number, self.capacity - free


def pieces_of(n: int, length: int) -> list[tuple[int, int]]:
    """(start, size) of the pieces of n tokens: all but the first have `length`."""
    first = n % length or length
    return [(0, first), *((s, length) for s in range(first, n, length))]


def pack(docs: DataFrame, length: int = 1024, open_bins: int = 2048, separator: int = 2, vocabulary: str = BYTE_BPE) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most `length` tokens.

    docs needs doc_id and text. Within an Arrow batch the pieces are placed from the longest to the shortest,
    which leaves little for the bounded set of bins to waste; across batches placing is online.
    """
    if length < 1 or open_bins < 1:
        raise ValueError("length and open_bins must be at least 1")

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe, bins = encoder(vocabulary), OpenBins(length, open_bins)
        base = TaskContext.get().partitionId() * SEQUENCES_A_TASK
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.append(bpe.encode_added(text), np.uint32(separator)).astype("<u4")
                raw = memoryview(ids).cast("B")
                rows += [(doc_id, k, s, n, zlib.crc32(raw[4 * s : 4 * (s + n)])) for k, (s, n) in enumerate(pieces_of(len(ids), length))]
            sizes = np.array([r[3] for r in rows], np.int64)
            places = np.empty((len(rows), 2), np.int64)
            for i in np.argsort(-sizes, kind="stable").tolist():
                places[i] = bins.place(rows[i][3])
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            out["sequence_id"], out["offset"] = base + places[:, 0], places[:, 1]
            yield out

    return with_ids(doc_texts(docs).mapInPandas(packed, SCHEMA))
