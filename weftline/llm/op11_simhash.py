"""SimHash near-duplicates by tiled exact comparison of 64-bit fingerprints.

Documents become fingerprints in one pass; equal fingerprints are one node from there on, so no group of copies meets
in one task. Nodes lie in tiles of at most about TILE fingerprints whose population counts are equal: the count of the whole
fingerprint, or of each of its 2, 4 or 8 parts where there are more nodes (tile_parts() weighs comparisons against tile pairs; every choice
gives the same links). Differing bits change a part's count by one each, so two tiles whose counts differ by more than RADIUS
in sum hold no link, and the pair is skipped. The others are compared exactly: exclusive-or of all against all and a
bit count, in numpy. A tile pair gives a forest of its links, never pairs; a fingerprint has at most 2,080 others within two bits, so forests
stay small too. Components come from alternating stars.

Defined cases: a null text is an empty one; without words the fingerprint is zero, which links like any other; fewer words than
a shingle make one shingle of them all; equal texts, repeated rows and repeated ids are linked by fingerprint, not by id; a row
without doc_id gets its fingerprint and no component, and links nothing; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components

SHINGLE = 3
SEED = 42
RADIUS = 2
TILE = 1024
PIECE = 1 << 20  # bytes of a text that are split into words at once
HOT = 1000  # a fingerprint with more than one in so many of the documents is looked up by broadcast: there are fewer than HOT
_SPACE = re.compile(rb"[ \t-\r]")


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """The text in pieces that end at white space, so that no word is cut."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + size)
        to = cut.start() if cut else len(text)
        yield text[at:to]
        at = to


def _hashes(words: list[bytes], size: int, seed: int) -> np.ndarray:
    """Of each run of `size` neighbouring words, joined by blanks."""
    n = len(words) - size + 1
    joined = map(b" ".join, zip(*(words[k:] for k in range(size))))
    return np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in joined), np.uint64, n)


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit k is set if it is in more than half of the shingles' hashes."""
    ones, n, held = np.zeros(64, np.int64), 0, []
    for piece in pieces(text):
        held += piece.lower().split()  # bytes: only A-Z change, and only ASCII white space parts words
        if len(held) >= shingle:
            h = _hashes(held, shingle, seed)
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            n += len(h)
            held = held[len(held) - shingle + 1 :]
    if n == 0:
        return xxhash.xxh64_intdigest(b" ".join(held), seed) if held else 0
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp): fp holds the 64 bits as a signed number. One pass, no shuffle."""

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py() or b"", shingle, seed) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return texts.mapInArrow(emit, "doc_id long, fp long")


def offsets(parts: int, radius: int = RADIUS) -> list[tuple[int, ...]]:
    """All changes of `parts` counts that sum to at most `radius`."""
    found = [()]
    for _ in range(parts):
        found = [(*f, d) for f in found for d in range(-radius, radius + 1) if sum(map(abs, f)) + abs(d) <= radius]
    return found


def tile_parts(n: int, tile: int = TILE) -> int:
    """Into how many parts fingerprints are cut for their counts: the cheapest for n of them, if their bits are like coin tosses."""

    def cost(parts: int) -> float:
        variance = 16 / parts  # of a part's count
        near = len(offsets(parts))
        share = min(1.0, near / (4 * np.pi * variance) ** (parts / 2))  # of all pairs, those that are compared
        cells = (2 * np.pi * np.e * variance) ** (parts / 2)
        compared = n * n * share / 2
        return compared * 4e-9 + max(compared / tile**2, cells * near / 2) * 5e-5

    return min((1, 2, 4, 8), key=cost)


def _linked_roots(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> tuple[np.ndarray, np.ndarray] | None:
    """(node, root) of the links between two tiles, for nodes that aren't their own root."""
    near = np.bitwise_count(a[:, None] ^ b[None, :]) <= radius
    if same:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    if not len(i):
        return None
    nodes, at = np.unique(np.concatenate([a[i], b[j]]), return_inverse=True)
    i, j, root = at[: len(i)], at[len(i) :], np.arange(len(nodes))
    while True:
        least = np.minimum(root[i], root[j])
        after = root.copy()
        np.minimum.at(after, i, least)
        np.minimum.at(after, j, least)
        np.minimum.at(after, root[i], least)  # hook the roots too, so that paths shorten fast
        np.minimum.at(after, root[j], least)
        after = after[after]
        if (after == root).all():
            break
        root = after
    m = root != np.arange(len(nodes))
    return nodes[m], nodes[root[m]]


def links(nodes: DataFrame, parts: int, tile: int = TILE, radius: int = RADIUS) -> DataFrame:
    """(a, b): a forest of the links of each pair of tiles that can hold any. nodes: fp, each once."""
    width = 64 // parts
    base = width + 2 * radius + 1  # so wide that a neighbour's code is no other cell's
    counts = [F.bit_count(F.shiftrightunsigned("fp", k * width).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))) for k in range(parts)]
    code = sum(((c + radius).cast("long") * base**k for k, c in enumerate(counts)), F.lit(0).cast("long"))
    coded = nodes.select("fp", code.alias("cell"))
    sizes = coded.groupBy("cell").agg(F.count("*").alias("n"))
    if parts <= 4:  # 17 ** 4 cells at most; so a cell's nodes needn't meet in one task before they are dealt to shares
        sizes = F.broadcast(sizes)
    shares = F.greatest(F.lit(1), F.ceil(F.col("n") / tile)).cast("int")
    placed = coded.join(sizes, "cell").select("cell", F.pmod(F.xxhash64("fp"), shares).cast("int").alias("share"), "fp")
    # A tile's size is bounded by the even spread of hashes over shares.
    tiles = written(placed.groupBy("cell", "share").agg(F.collect_list("fp").alias("fps")), "tiles")
    names = tiles.select("cell", "share")
    near = F.array(*(F.lit(sum(d * base**k for k, d in enumerate(o))).cast("long") for o in offsets(parts, radius)))
    pairs = names.select("cell", "share", F.explode(near).alias("o")).select(F.col("cell").alias("a_cell"), F.col("share").alias("a_share"), (F.col("cell") + F.col("o")).alias("b_cell"))
    pairs = pairs.join(names.select(F.col("cell").alias("b_cell"), F.col("share").alias("b_share")), "b_cell")
    pairs = pairs.where("b_cell > a_cell or (b_cell = a_cell and b_share >= a_share)")
    met = pairs.join(tiles.select(F.col("cell").alias("a_cell"), F.col("share").alias("a_share"), F.col("fps").alias("a")), ["a_cell", "a_share"])
    met = met.join(tiles.select(F.col("cell").alias("b_cell"), F.col("share").alias("b_share"), F.col("fps").alias("b")), ["b_cell", "b_share"])
    met = met.select("a", "b", ((F.col("a_cell") == F.col("b_cell")) & (F.col("a_share") == F.col("b_share"))).alias("same"))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, same in zip(*batch.columns):
                found = _linked_roots(a.values.to_numpy().view(np.uint64), b.values.to_numpy().view(np.uint64), same.as_py(), radius)
                if found is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in found], ["a", "b"])

    return met.mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE, parts: int | None = None) -> DataFrame:
    """(doc_id, fingerprint, component_id): a component is named by its smallest doc_id."""
    marked = written(fingerprints(docs, shingle), "fingerprints")
    nodes = written(marked.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")), "fingerprint-nodes")
    n, n_docs = nodes.agg(F.count("*"), F.coalesce(F.sum("copies"), F.lit(0))).first()
    joined = components(links(nodes.select("fp"), parts or tile_parts(n, tile), tile, radius))
    named = nodes.join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = written(named.join(least, "component").select("fp", "component_id", "copies"), "fingerprint-classes")
    # A hot fingerprint's rows meet their class without a shuffle; all others meet it by fingerprint.
    hot = F.broadcast(classes.where(F.col("copies") > n_docs / HOT).select("fp", "component_id"))
    rest = marked.join(hot.select("fp"), "fp", "left_anti").join(classes.select("fp", "component_id"), "fp", "left")
    found = marked.join(hot, "fp").select("doc_id", "fp", "component_id").unionByName(rest.select("doc_id", "fp", "component_id"))
    bits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", bits.alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
