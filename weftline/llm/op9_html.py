"""Main text of pages by a recurrent block labeller: a bidirectional LSTM in numpy over each page's leaf blocks.

A page is the sequence of its leaf blocks. A block's vector holds its tag path (hashed: the elements right around it by their distance,
the others as a bag), the names in class, id and role attributes of its own branch below body (hashed by pieces of letters, so that
related names are near each other; those of the nearest elements apart from the rest), its words (hashed, all of them), and
measures: length, links, punctuation, place in the page, and which share of the page's plain text the elements around it hold. One LSTM
reads the sequence forwards and one backwards, so every block is classified with the whole page around it. No list of names or
elements takes part in the labelling.

There are no labels for pages, so the network learns from pages that html_layouts lays out at random, whose labels are known
because the layout made them. Their words come from a bounded, documented sample of the pages' own blocks (MATERIAL_PAGES,
MATERIAL_BLOCKS of each page, MATERIAL_LETTERS of each block). Scripts, styles and the other elements whose content isn't text are cut by the scanner.

Learning happens on the driver over the laid out pages; the weights, of fixed size, are broadcast, and pages are labelled
in one pass without a shuffle. No page is shortened: a long one is read in stretches that hand the networks' states on, so the memory for vectors is bounded;
the blocks themselves take memory in proportion to the page, and so does the time, however deep it nests.

Defined cases: a null or empty html has the text ''; markup that is broken or cut off is read as far as it goes; equal
pages give equal texts; repeated rows stay, and so do rows without page_id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html_blocks import Block, Element, blocks
from .html_layouts import labelled

MATERIAL_PAGES, MATERIAL_BLOCKS, MATERIAL_LETTERS = 200, 10, 400
TRAINING_PAGES, TRAINING_STEPS, TRAINING_LENGTH = 2000, 500, 40
NEAR_TAGS, FAR_TAGS, NEAR_NAMES, FAR_NAMES, WORD_BUCKETS, MEASURES = 48, 24, 64, 32, 64, 19
PATH = NEAR_TAGS + FAR_TAGS + NEAR_NAMES + FAR_NAMES
INPUT, HIDDEN = PATH + WORD_BUCKETS + MEASURES, 24
WORDLESS = 0.5  # of the stretches are learnt from without their words, so that a page's result doesn't hang on them
NEAREST = 3  # elements around a block whose names are told apart from the others'
TOGETHER_BLOCKS = 1 << 13  # blocks, padding included, that are labelled at once

_ENDS = frozenset(".!?…:")
MOST_WORDS, MOST_PATHS = 200_000, 5_000  # in a worker's caches


def _bucket(key: str, buckets: int) -> int:
    return zlib.crc32(key.encode("utf-8", "replace")) % buckets


def _pieces(name: str) -> list[str]:
    """A name, and its pieces of three letters."""
    return [name, *(name[k : k + 3] for k in range(len(name) - 2) if len(name) > 3)]


def inner(e: Element | None) -> Element | None:
    """The element itself, or the first around it that isn't around every block."""
    while e is not None and e.tag in ("html", "body"):
        e = e.parent
    return e


class WordBuckets(dict):
    """The bucket of each word that was asked for; begins anew when it holds MOST_WORDS."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        found = self[word] = _bucket(word, WORD_BUCKETS)
        return found


class Place:
    """A path of tags and names, known by its last element and the place around it; what holds for whole paths is summed up on the way down."""

    __slots__ = ("up", "tag", "depth", "tags", "far", "near", "known", "inside")

    def __init__(self, up: "Place | None" = None, tag: str = "", names: tuple[str, ...] = ()):
        self.up, self.tag, self.depth = up, tag, up.depth + 1 if up else 0
        self.known: np.ndarray | None = None
        self.inside: dict[tuple[str, tuple[str, ...]], Place] = {}
        self.near = np.zeros(NEAR_NAMES, np.float32)
        self.tags, self.far = (up.tags.copy(), up.far.copy()) if up else (np.zeros(FAR_TAGS, np.float32), np.zeros(FAR_NAMES, np.float32))
        if up:
            self.tags[_bucket(tag, FAR_TAGS)] += 1
            pieces = [p for n in names for p in _pieces(n)]
            for p in pieces:
                self.near[_bucket(p, NEAR_NAMES)] += 1 / np.sqrt(len(pieces))
                self.far[_bucket(p, FAR_NAMES)] += 1 / np.sqrt(len(pieces))

    def vector(self) -> np.ndarray:
        if self.known is None:
            found = np.zeros(PATH, np.float32)
            found[NEAR_TAGS : NEAR_TAGS + FAR_TAGS] = self.tags
            at, distance = self, 0
            while at.up and distance < NEAREST:
                found[_bucket(f"{distance}<{at.tag}", NEAR_TAGS)] += 1
                found[NEAR_TAGS + FAR_TAGS : NEAR_TAGS + FAR_TAGS + NEAR_NAMES] += at.near
                at, distance = at.up, distance + 1
            found[NEAR_TAGS + FAR_TAGS + NEAR_NAMES :] = at.far
            self.known = np.minimum(found, 2)
        return self.known


@dataclass
class Vectors:
    """Vectors of blocks, with bounded caches of places and hashed words for each worker."""

    root: Place = field(default_factory=Place)
    places: int = 0
    words: WordBuckets = field(default_factory=WordBuckets)

    def place(self, up: Place, tag: str, names: tuple[str, ...]) -> Place:
        found = up.inside.get((tag, names))
        if found is None:
            self.places += 1
            found = up.inside[tag, names] = Place(up, tag, names)
        return found

    def page(self, page: list[Block]) -> "PageVectors":
        if self.places >= MOST_PATHS:
            self.root, self.places = Place(), 0
        return PageVectors(self, page)

    def of(self, page: list[Block]) -> np.ndarray:
        return self.page(page).rows(0, len(page))


@dataclass(slots=True)
class Inside:
    """What an element holds, and where it is."""

    up: "Inside | None"
    place: Place
    plain: int = 0  # characters outside links
    blocks: int = 0
    linked: int = 0  # blocks that are mostly links
    largest: float = 0.0  # share of the page's plain text that it or any element around it holds
    around: tuple[float, ...] | None = None


class PageVectors:
    """The vectors of a page, made for a stretch of blocks at a time; sums go up the tree once and largest shares down."""

    def __init__(self, make: Vectors, page: list[Block]):
        self.make, self.page = make, page
        self.total = 0
        found: dict[int, Element] = {}
        for b in page:
            e = inner(b.element)
            while e is not None and e.number not in found:
                found[e.number] = e
                e = inner(e.parent)
        self.inside: dict[int, Inside] = {}
        for number in sorted(found):  # from the root down
            e = found[number]
            up = inner(e.parent)
            above = self.inside[up.number] if up is not None else None
            self.inside[number] = Inside(above, make.place(above.place if above else make.root, e.tag, e.names))
        for b in page:
            if b.raw:
                continue
            own = len(b.text) - min(b.linked, len(b.text))
            self.total += own
            e = inner(b.element)
            if e is not None:
                x = self.inside[e.number]
                x.plain += own
                x.blocks += 1
                x.linked += 2 * b.linked > len(b.text)
        for x in reversed(self.inside.values()):
            if x.up:
                x.up.plain += x.plain
                x.up.blocks += x.blocks
                x.up.linked += x.linked
        total = max(1, self.total)
        for x in self.inside.values():
            x.largest = max(x.plain / total, x.up.largest if x.up else 0.0)

    def around(self, own: Inside | None) -> tuple[float, ...]:
        """Of the elements around a block's own one: their shares of the page's plain text, how much of them is linked, and the largest share of any."""
        above = own.up if own else None
        if above is None:
            return 0.0, 1.0, 1.0, 1.0, 1.0, 0.0, 0.0
        if above.around is None:
            total, near, x = max(1, self.total), [], above
            while x and len(near) < 4:
                near.append(x)
                x = x.up
            shares = [x.plain / total for x in near] + [1.0] * (4 - len(near))
            linked = [x.linked / x.blocks if x.blocks else 0.0 for x in near[:2]] + [0.0] * (2 - len(near))
            above.around = (above.largest, *shares, *linked)
        return above.around

    def rows(self, begin: int, end: int) -> np.ndarray:
        out = np.zeros((end - begin, INPUT), np.float32)
        size, total = len(self.page), max(1, self.total)
        for k in range(begin, end):
            b, row = self.page[k], out[k - begin]
            e = inner(b.element)
            own = self.inside[e.number] if e is not None else None
            place = own.place if own else self.make.root
            row[:PATH] = place.vector()
            words = b.text.lower().split()  # at least one, as blocks aren't blank
            hashed = np.bincount(list(map(self.make.words.__getitem__, words)), minlength=WORD_BUCKETS)
            row[PATH : PATH + WORD_BUCKETS] = np.sqrt(hashed / len(words))
            n = len(b.text)
            largest, *around = self.around(own)
            largest = max(largest, own.plain / total if own else 1.0)
            row[PATH + WORD_BUCKETS :] = (
                np.log1p(n) / 8, min(1, b.linked / n), sum(map(b.text.count, ".,;:!?")) / len(words), b.text.rstrip("\"”»)")[-1:] in _ENDS, any(map(str.isdigit, b.text[:40])),
                k == 0, k == size - 1, k / size, np.log1p(size) / 8, place.depth / 16, n / total, largest, *around, b.raw,
            )
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Lstm:
    """One direction. Inputs are (time, pages, INPUT); pages shorter than the longest are masked."""

    def __init__(self, rng: np.random.Generator):
        self.w = rng.normal(0, 0.15, (INPUT + HIDDEN, 4 * HIDDEN)).astype(np.float32)
        self.b = np.zeros(4 * HIDDEN, np.float32)
        self.b[HIDDEN : 2 * HIDDEN] = 1  # remember at first

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False, state: list[np.ndarray] | None = None):
        """state: what was remembered of earlier stretches; what is remembered now takes its place."""
        n = x.shape[1]
        h, c = state if state else (np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32))
        driven = x @ self.w[:INPUT] + self.b
        out, saved = np.empty((len(x), n, HIDDEN), np.float32), []
        for t in range(len(x)):
            z = driven[t] + h @ self.w[INPUT:]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            c_new = f * c + i * g
            tanh_c = np.tanh(c_new)
            m = mask[t][:, None]
            if keep:
                saved.append((h, c, i, f, o, g, tanh_c, m))
            h, c = np.where(m, o * tanh_c, h), np.where(m, c_new, c)
            out[t] = h
        if state is not None:
            state[:] = h, c
        return out, saved

    def backward(self, x: np.ndarray, saved: list, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d_z = np.empty((len(x), x.shape[1], 4 * HIDDEN), self.w.dtype)
        d_h, d_c = np.zeros_like(d_out[0]), np.zeros_like(d_out[0])
        for t in range(len(x) - 1, -1, -1):
            _, c, i, f, o, g, tanh_c, m = saved[t]
            d_h = d_h + d_out[t]
            own_h, own_c = np.where(m, d_h, 0), np.where(m, d_c, 0)
            d_cell = own_c + own_h * o * (1 - tanh_c**2)
            d_z[t] = np.hstack([d_cell * g * i * (1 - i), d_cell * c * f * (1 - f), own_h * tanh_c * o * (1 - o), d_cell * i * (1 - g**2)])
            d_h = d_z[t] @ self.w[INPUT:].T + np.where(m, 0, d_h)
            d_c = d_cell * f + np.where(m, 0, d_c)
        read = np.concatenate([x, np.stack([s[0] for s in saved])], axis=2)
        # One product a step of time: small ones run on one core, and the driver has others' work to leave room for.
        return np.matmul(read.transpose(0, 2, 1), d_z).sum(0), d_z.sum((0, 1))


class Labeller:
    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.ahead, self.back = Lstm(rng), Lstm(rng)
        self.v, self.bias = rng.normal(0, 0.1, 2 * HIDDEN).astype(np.float32), np.zeros(1, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.ahead.w, self.ahead.b, self.back.w, self.back.b, self.v, self.bias]

    @staticmethod
    def _stacked(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.array([len(p) for p in pages])
        x = np.zeros((sizes.max(), len(pages), INPUT), np.float32)
        for k, p in enumerate(pages):
            x[: len(p), k] = p
        mask = np.arange(len(x))[:, None] < sizes
        # The backward reading begins at each page's own end.
        turned = np.where(mask, sizes - 1 - np.arange(len(x))[:, None], np.arange(len(x))[:, None])
        return x, mask, turned

    def probabilities(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        x, mask, turned = self._stacked(pages)
        column = np.arange(len(pages))
        a, _ = self.ahead.forward(x, mask)
        b, _ = self.back.forward(x[turned, column], mask)
        p = _sigmoid(np.concatenate([a, b[turned, column]], 2) @ self.v + self.bias)
        return [p[: len(q), k] for k, q in enumerate(pages)]

    def of_long(self, page: PageVectors, stretch: int = TOGETHER_BLOCKS) -> np.ndarray:
        """Probabilities of one page, of which only a stretch of vectors is held at a time."""
        size = len(page.page)
        z = np.full(size, self.bias[0], np.float32)
        always = np.ones((stretch, 1), bool)
        for lstm, v, turn in ((self.ahead, self.v[:HIDDEN], 1), (self.back, self.v[HIDDEN:], -1)):
            state: list[np.ndarray] = []
            for begin in range(0, size, stretch):
                end = min(begin + stretch, size)
                a, b = (begin, end) if turn == 1 else (size - end, size - begin)
                h, _ = lstm.forward(page.rows(a, b)[::turn, None], always[: b - a], state=state)
                z[a:b] += (h[:, 0] @ v)[::turn]
        return _sigmoid(z)

    def learn(self, pages: list[tuple[np.ndarray, np.ndarray]], steps: int, seed: int = 12, batch: int = 24, rate: float = 0.02) -> None:
        """Adam on the cross-entropy of blocks, by ever smaller steps; long pages by stretches."""
        rng = np.random.default_rng(seed)
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.parameters()]
        for step in range(1, steps + 1):
            chosen = []
            for k in rng.integers(0, len(pages), batch):
                x, y = pages[k]
                at = rng.integers(0, max(1, len(x) - TRAINING_LENGTH + 1))
                x, y = x[at : at + TRAINING_LENGTH], y[at : at + TRAINING_LENGTH]
                if rng.random() < WORDLESS:
                    x = x.copy()
                    x[:, PATH : PATH + WORD_BUCKETS] = 0
                chosen.append((x, y))
            x, mask, turned = self._stacked([c[0] for c in chosen])
            column = np.arange(batch)
            y = np.zeros(mask.shape, np.float32)
            for k, c in enumerate(chosen):
                y[: len(c[1]), k] = c[1]
            reversed_x = x[turned, column]
            a, saved_a = self.ahead.forward(x, mask, keep=True)
            b, saved_b = self.back.forward(reversed_x, mask, keep=True)
            both = np.concatenate([a, b[turned, column]], 2)
            d = np.where(mask, _sigmoid(both @ self.v + self.bias) - y, 0) / mask.sum()
            d_both = d[..., None] * self.v
            gradients = [*self.ahead.backward(x, saved_a, d_both[..., :HIDDEN]), *self.back.backward(reversed_x, saved_b, d_both[..., HIDDEN:][turned, column])]
            gradients += [(d[..., None] * both).sum((0, 1)), np.array([d.sum()])]
            for p, g, (m, s) in zip(self.parameters(), gradients, moments):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                p -= rate * (1.05 - step / steps) * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-7)


def material(pages: DataFrame, most: int = MATERIAL_PAGES) -> list[str]:
    """Texts of some blocks of at most `most` pages, chosen by a hash of page_id."""

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for page_id, text in zip(batch["page_id"], batch["html"]):
                page = [b.text[:MATERIAL_LETTERS] for b in blocks(text) if not b.raw]
                found += [(page_id, t) for t in page[:: -(-len(page) // MATERIAL_BLOCKS) or 1]]
            yield pd.DataFrame(found, columns=["page_id", "text"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).where("page_id is not null")
    ids = rows.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(most)
    some = rows.join(F.broadcast(ids), "page_id").groupBy("page_id").agg(F.min("html").alias("html"))
    return [r["text"] for r in some.mapInPandas(texts, "page_id long, text string").orderBy("page_id", "text").collect()]


def fit(pages: DataFrame, steps: int = TRAINING_STEPS, seed: int = 5) -> Labeller:
    """A labeller learnt from pages laid out with the words of a sample of these."""
    words, rng, make = material(pages), np.random.default_rng(seed), Vectors()
    laid_out = [labelled(rng, words) for _ in range(min(TRAINING_PAGES, 4 * steps))]
    labeller = Labeller()
    labeller.learn([(make.of(page).astype(np.float16), y) for page, y in laid_out if page], steps)
    return labeller


def main_blocks(labeller: Labeller, make: Vectors, pages: list[list[Block]]) -> list[list[Block]]:
    """The blocks of main text of each page. Pages are read together with others of about their length."""
    out: list[list[Block]] = [[] for _ in pages]
    order = sorted((k for k, p in enumerate(pages) if p), key=lambda k: len(pages[k]))
    while order:  # the longest first
        group = order[-max(1, min(64, TOGETHER_BLOCKS // len(pages[order[-1]]))) :]
        del order[-len(group) :]
        found = labeller.probabilities([make.of(pages[k]) for k in group]) if len(pages[group[-1]]) <= TOGETHER_BLOCKS else [labeller.of_long(make.page(pages[k])) for k in group]
        for k, p in zip(group, found):
            out[k] = [b for b, q in zip(pages[k], p) if q >= 0.5 and not b.raw]
    return out


def extract(pages: DataFrame, labeller: Labeller) -> DataFrame:
    """(page_id, url, text, n_chars): the blocks that the labeller takes for main text, in page order, one a line."""
    shared = pages.sparkSession.sparkContext.broadcast(labeller)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labeller, make = shared.value, Vectors()
        for batch in batches:
            for at in range(0, len(batch), 64):
                part = batch.iloc[at : at + 64]
                texts = ["\n".join(b.text for b in found) for found in main_blocks(labeller, make, [blocks(h) for h in part["html"]])]
                yield pd.DataFrame({"page_id": part["page_id"].to_numpy(), "url": part["url"].to_numpy(), "text": texts, "n_chars": [len(t) for t in texts]})

    # As text, ids come through pandas unharmed where others are null.
    rows = pages.select(F.col("page_id").cast("string").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    found = rows.mapInPandas(read, "page_id string, url string, text string, n_chars long")
    return found.withColumn("page_id", F.col("page_id").cast("long"))


def query(pages: DataFrame) -> DataFrame:
    return extract(pages, fit(pages))
