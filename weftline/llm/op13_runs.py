"""Periodic runs of words, found online by catchers over completed power-of-two blocks.

Words are appended one at a time. When the number of words reaches a multiple of L = 2, 4, 8 and so on, the last L words are a completed block,
and its catcher waits for that block to come again p words later, for the periods (2 * L - 1) / 3 <= p < (4 * L - 1) / 3.
These ranges hold every period once, and a run of four periods or more always has a whole aligned block of its period's size in it
with the block's copy a period later. A catcher is asked only when the last two words are those its block ends with; then the
suffix is compared with the block, and equality is a new square's sign: the run's start is found by comparing backwards (less than
a block), and from then on every appended word is compared with the word a period before, until one differs and the run ends. Squares inside a run that
is open, at multiples of its period, merge into that run and open no other one. Blocks that end at the same word share an entry, and entries past
their largest block's range are swept away, so two blocks of each size wait at most: n words take O(n log n) steps at worst, and hardly
more than a table lookup a word where nothing repeats.

Defined cases: a null or empty text has no words and no runs; words are compared as bytes; rows without doc_id are texts like others
(and never periodic by the rule of planted()); repeated rows give repeated rows; an empty table gives no rows; only doc_id and text are read.
Memory grows with a text's words (some 30 bytes each), not with the table.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .op11_simhash import pieces

LEAST_EXPONENT = 4
LEAST_LENGTH = 6
SWEEP = 1024  # words after which spent catchers are looked for
_JOINED = 1 << 16  # words that are joined at once


def block_size(period: int) -> int:
    """The size of the blocks whose catchers see squares of this period."""
    return 1 << ((3 * period + 1) // 2).bit_length() - 1


class Runs:
    """Runs of a growing sequence of word numbers: append() words, then finish().

    A run is (start, length, period): a stretch with this smallest period, at least LEAST_EXPONENT periods and LEAST_LENGTH words long.
    """

    def __init__(self) -> None:
        self.words: list[int] = []
        self._raw = bytearray()  # the words again, 4 bytes each, to compare stretches
        self._ends: dict[int, list[int]] = {}  # two words -> where blocks end with them: each end stands for the blocks of all sizes that divide it
        self._open: dict[int, int] = {}  # period -> start
        self._closed: list[tuple[int, int, int]] = []

    def append(self, new: list[int]) -> None:
        for at in range(0, len(new), SWEEP):
            self._append(new[at : at + SWEEP])
            n = len(self.words)
            self._ends = {pair: live for pair, ends in self._ends.items() if (live := self._live(ends, n))}

    @staticmethod
    def _live(ends: list[int], n: int) -> list[int]:
        """Those whose largest block may still come again."""
        return [e for e in ends if 3 * (n + 1 - e) < 4 * (e & -e) - 1]

    def _append(self, new: list[int]) -> None:
        words, raw, ends, opened = self.words, self._raw, self._ends, self._open
        n = len(words)
        codes = np.array([words[-1] if words else -1, *new], np.int64)
        words += new
        raw += codes[1:].astype("<i4").tobytes()
        for pair in (codes[:-1] << 32 | codes[1:]).tolist():
            n += 1
            if opened:
                word = words[n - 1]
                ended = [p for p in opened if words[n - 1 - p] != word]
                if ended:
                    self._close(ended, n - 1)
            found = ends.get(pair)
            if found is not None:
                for e in found:
                    p = n - e
                    size = block_size(p)
                    if not e % size and raw[4 * (e - size) : 4 * e] == raw[4 * (n - size) : 4 * n]:
                        self._square(e - size, p)
                ends[pair] = found = self._live(found, n)
                if not n & 1:
                    found.append(n)
            elif not n & 1:
                ends[pair] = [n]

    def _square(self, start: int, p: int) -> None:
        """The block at `start` came again p words later."""
        words, opened = self.words, self._open
        for q, s in opened.items():
            if p % q == 0 and s <= start:
                return
        while start > 0 and words[start - 1] == words[start - 1 + p]:
            start -= 1
        opened[p] = start

    def _close(self, periods: list[int], end: int) -> None:
        """The stretches of these periods end before place `end`; of several that are one stretch, the smallest period is its own."""
        stretches: dict[int, int] = {}
        for p in periods:
            start = self._open.pop(p)
            stretches[start] = min(p, stretches.get(start, p))
        for start, p in stretches.items():
            if end - start >= max(LEAST_LENGTH, LEAST_EXPONENT * p):
                self._closed.append((start, end - start, p))

    def finish(self) -> list[tuple[int, int, int]]:
        """All runs by start, then period."""
        self._close(list(self._open), len(self.words))
        return sorted(self._closed, key=lambda r: (r[0], r[2]))


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length / period; of equal ones that with the smallest start, then period."""
    found = None
    for start, length, period in runs:  # by start, then period
        if found is None or length * found[2] > found[1] * period:
            found = start, length, period
    return found


def collapsed(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: of each run only its first period, unless another run drops them."""
    dropped = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    return np.cumsum(dropped)[:n] == 0


def numbered(text: bytes) -> tuple[list[int], list[bytes]]:
    """(the number of each word, the different words)."""
    known: dict[bytes, int] = {}
    numbers: list[int] = []
    for piece in pieces(text):
        numbers += [known.setdefault(w, len(known)) for w in piece.split()]
    return numbers, list(known)


Change = Callable[[int | None, list[int]], list[int]]


def planted(doc_id: int | None, words: list[int]) -> list[int]:
    """The query's rule: a tenth of the documents, chosen by the CRC of their id, repeat a stretch from some word on to their end."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + (period * -(-(n - a) // p))[: n - a]


OUT = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def periodic(docs: DataFrame, change: Change | None = None) -> DataFrame:
    """Runs of each text: their number, the strongest, and digests of all runs and of the text without repetitions. One pass, no shuffle.

    change: rewrites a document's words before they are searched.
    """

    def row(doc_id: int | None, text: bytes) -> tuple:
        numbers, words = numbered(text)
        if change is not None:
            numbers = change(doc_id, numbers)
        finder = Runs()
        for at in range(0, len(numbers), _JOINED):
            finder.append(numbers[at : at + _JOINED])
        runs = finder.finish()
        best = strongest(runs)
        listed, left = hashlib.sha256(), hashlib.sha256()
        for run in runs:
            listed.update(b"%d,%d,%d\n" % run)
        kept = np.flatnonzero(collapsed(len(numbers), runs))
        for at in range(0, len(kept), _JOINED):
            part = b" ".join(words[numbers[k]] for k in kept[at : at + _JOINED])
            left.update(b" " + part if at else part)
        shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        return doc_id, len(runs), *shown, listed.hexdigest(), left.hexdigest()

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        for batch in batches:
            rows = [row(i.as_py(), t.as_py() or b"") for i, t in zip(batch.column(0), batch.column(1))]
            columns = zip(*rows) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in OUT.split(", ")])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return texts.mapInArrow(emit, OUT)
