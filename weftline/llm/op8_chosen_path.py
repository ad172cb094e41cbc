"""N-gram Jaccard join by chosen paths, with exact verification.

A document is its set of SHINGLE-word shingles; equal sets are one node. Sets carry a MinHash sketch, whose
coordinates are sampled shared tokens. Each of RUNS runs puts a set on the path of one coordinate's value;
paths with more than SMALL sets are split again by further chosen coordinates (CHILDREN for each set and level), so
similar sets go on together and others part. Before a split, sets are held against the path's root: those somewhat like it
join its component at once, and go on only if a set unlike it is there that they might still be linked to, which the triangle
inequality of Jaccard distance rules out for sets close to the root. So groups of copies aren't split again and again. Small buckets are
compared by brute force on sketches, far below the threshold to lose nothing; what no split divides is joined whole. RUNS runs miss a pair at the
threshold with a probability of (1 - threshold) ** RUNS, 1e-7, where its paths are small, and of about (1 - threshold * 0.96 ** LEVELS) ** RUNS, 5e-6, where they are split LEVELS times.

The components that candidates form are then verified exactly: sets of a component meet in pairs of blocks of
BLOCK sets, so no task holds a large component, and each pair's Jaccard similarity comes from integer counts.
What is emitted from a block pair is a root and a number of links for each set, never a pair.

Sets are told apart by their contents, never by doc_id, which may repeat: rows of one doc_id with other texts are documents of their own.

Defined cases: words are split at white space after lower-casing; a text of fewer words than a shingle has one
shingle of them all; a null or empty text has no shingles, links to nothing and is a class of its own;
equal texts and repeated rows link to each other; a class is named by the smallest doc_id of its sets, but an id that is the smallest of several sets names only the one with
the smallest key, and the others go by a number from 2 ** 62 on, made of their hash, which names a class of only such sets; deduplicated() keeps a row of each class's naming set, that with
its smallest doc_id, of those with one id that with the smallest text hash, and of equal rows one;
rows without doc_id take no part (class null, no links, and deduplicated() keeps them); an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_texts, written
from .components import components

SHINGLE = 5
THRESHOLD = 0.8
COORDINATES = 64
RUNS = 10
SMALL = 128
CHILDREN = 2
LEVELS = 3
SKETCH_MARGIN = 0.25  # five deviations of the sketch's estimate
LOOSE = 0.30  # an estimate from which on a set of a large path joins its root's component
BLOCK = 256
SET_BYTES = 5  # of a shingle's hash, within a component
CACHE = 300_000
OTHERS = 1 << 62  # from here on are the nodes of sets whose smallest doc_id names another set


class Shingler:
    """Hashed shingle sets of texts, with a bounded cache of word hashes."""

    def __init__(self, size: int = SHINGLE):
        self.size, self.cache = size, {}

    def _word(self, word: str) -> int:
        found = self.cache.get(word)
        if found is None:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            found = self.cache[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, text: str) -> np.ndarray:
        """Sorted different hashes."""
        words = text.lower().split()
        if not words:
            return np.empty(0, np.uint64)
        w = np.fromiter(map(self._word, words), np.uint64, len(words))
        n = max(1, len(w) - self.size + 1)
        h = np.zeros(n, np.uint64)
        for k in range(min(self.size, len(w))):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + w[k : k + n]
        h ^= h >> np.uint64(32)
        return np.unique(h * np.uint64(0xC2B2AE3D27D4EB4F))


_A = np.random.default_rng(5).integers(0, 1 << 31, COORDINATES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, COORDINATES) 32-bit MinHash values of sets that are not empty."""
    h = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), COORDINATES), np.uint32)
    for t in range(COORDINATES):
        v = h * _A[t]
        v ^= v >> np.uint32(15)
        v *= np.uint32(0x2C1B3C6D)
        v ^= v >> np.uint32(13)
        out[:, t] = np.minimum.reduceat(v, starts)
    return out


def text_mark(text: Column) -> Column:
    """Tells the texts of one doc_id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def set_key(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits of a set's sorted hashes as two numbers."""
    a, b = np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), np.int64)
    return int(a), int(b)


def sketched(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, t: the text's mark, k1, k2: a 128-bit key of the set, sketch: a byte a coordinate, paths: a value for each run).

    A row without words has a key of its own, from its id and text, and neither sketch nor paths.
    """

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(shingle)
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                sets = [shingler.of(t) for t in part["text"]]
                full = [s for s in sets if len(s)]
                m = iter(minhashes(full)) if full else iter(())
                rows = []
                for doc_id, mark, s in zip(part["doc_id"], part["t"], sets):
                    if not len(s):
                        rows.append((doc_id, mark, *set_key(np.array([doc_id, mark, -1], np.int64)), None, None))
                        continue
                    values = next(m)
                    paths = (values[:RUNS].astype(np.uint64) << np.uint64(16) | np.arange(RUNS, dtype=np.uint64)).astype(np.int64)
                    rows.append((doc_id, mark, *set_key(s), values.astype(np.uint8).tobytes(), paths))
                yield pd.DataFrame(rows, columns=["doc_id", "t", "k1", "k2", "sketch", "paths"])

    return doc_texts(docs).withColumn("t", text_mark(F.col("text"))).mapInPandas(emit, "doc_id long, t long, k1 long, k2 long, sketch binary, paths array<long>")


def _root(parent: np.ndarray, a: int) -> int:
    while parent[a] != a:
        parent[a] = parent[parent[a]]
        a = parent[a]
    return a


def _roots(linked: np.ndarray) -> np.ndarray:
    """The smallest index that each row of a symmetric matrix of links connects to."""
    parent = np.arange(len(linked))
    for a, b in zip(*np.nonzero(np.triu(linked, 1))):
        x, y = _root(parent, a), _root(parent, b)
        parent[max(x, y)] = min(x, y)
    return np.array([_root(parent, a) for a in range(len(parent))])


def _compare_buckets(batches: Iterator[pd.DataFrame], least: float) -> Iterator[pd.DataFrame]:
    """Rows sorted by path, buckets of bounded size: an edge from each set to a root of those similar by sketch."""

    def edges(group: pd.DataFrame) -> pd.DataFrame | None:
        group = group.drop_duplicates("node")
        if len(group) < 2:
            return None
        nodes = group["node"].to_numpy()
        order = np.argsort(nodes)
        sketch = np.frombuffer(b"".join(group["sketch"]), np.uint8).reshape(len(group), -1)[order]
        alike = (sketch[:, None, :] == sketch[None, :, :]).sum(2) >= least * sketch.shape[1]
        root = _roots(alike)
        m = root != np.arange(len(root))
        return pd.DataFrame({"a": nodes[order][m], "b": nodes[order][root[m]]}) if m.any() else None

    rest = None
    for batch in batches:
        batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        path = batch["path"].to_numpy()
        cuts = np.flatnonzero(path[1:] != path[:-1]) + 1
        found = [e for a, b in zip([0, *cuts[:-1]], cuts) if b - a > 1 and (e := edges(batch.iloc[a:b])) is not None] if len(cuts) else []
        rest = batch.iloc[cuts[-1] :] if len(cuts) else batch
        if found:
            yield pd.concat(found)
    if rest is not None and (e := edges(rest)) is not None:
        yield e


def _against_roots(large: DataFrame, sketches: DataFrame) -> DataFrame:
    """(path, node, root, alike): the share of coordinates that a set has in common with its path's smallest node."""
    roots = large.groupBy("path").agg(F.min("node").alias("root"))
    roots = written(roots.join(sketches.withColumnsRenamed({"node": "root", "sketch": "root_sketch"}), "root"), "roots")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch[c]), np.uint8).reshape(len(batch), -1) for c in ("sketch", "root_sketch"))
            yield batch[["path", "node", "root"]].assign(alike=(a == b).mean(1))

    return large.join(sketches, "node").join(roots, "path").mapInPandas(compare, "path long, node long, root long, alike double")


def candidates(nodes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b): edges that connect all sets similar enough (and some others). nodes: (node, sketch, paths), one row a set."""
    paths = nodes.select("node", F.explode("paths").alias("path"))
    sketches = nodes.select("node", "sketch")
    small, near, whole = [], [], None
    for level in range(LEVELS + 1):
        sizes = written(paths.groupBy("path").count().where("count > 1"), "path-sizes")
        paths = written(paths.join(sizes, "path"), "paths")
        small.append(paths.where(F.col("count") <= SMALL).select("path", "node"))
        large = paths.where(F.col("count") > SMALL).select("path", "node")
        if large.isEmpty():
            break
        if level == LEVELS:
            whole = large
            break
        rooted = written(_against_roots(large, sketches), "path-roots")
        near.append(rooted.where(F.col("alike") >= LOOSE).select(F.col("node").alias("a"), F.col("root").alias("b")).where("a <> b"))
        strangers = written(rooted.where(F.col("alike") < LOOSE).groupBy("path").agg(F.count("*").alias("n")), "path-strangers")
        # A set linked to a stranger is at most LOOSE + (1 - threshold) similar to the root; estimates are off by less than half a margin.
        going = rooted.where(F.col("alike") < LOOSE + 1 - threshold + SKETCH_MARGIN).join(strangers.select("path"), "path", "left_semi")
        # Every path chooses its own coordinates.
        chosen = F.transform(F.sequence(F.lit(1), F.lit(CHILDREN)), lambda k: F.pmod(F.xxhash64("path", k), F.lit(COORDINATES)).cast("int"))
        child = F.transform(chosen, lambda c: F.xxhash64("path", c, F.substring(F.hex("sketch"), 2 * c + 1, F.lit(2))))
        paths = going.select("path", "node").join(sketches, "node").select("node", F.explode(F.array_distinct(child)).alias("path"))
        paths = written(paths, "child-paths")  # read twice: to be counted, and to be joined with the counts
    buckets = small[0]
    for s in small[1:]:
        buckets = buckets.unionByName(s)
    least = threshold - SKETCH_MARGIN
    sorted_ = buckets.join(sketches, "node").repartition("path").sortWithinPartitions("path")
    edges = sorted_.mapInPandas(lambda batches: _compare_buckets(batches, least), "a long, b long")
    for e in near:
        edges = edges.unionByName(e)
    if whole is not None:
        root = written(whole.groupBy("path").agg(F.min("node").alias("b")), "copy-roots")
        edges = edges.unionByName(whole.join(root, "path").select(F.col("node").alias("a"), "b").where("a <> b"))
    return edges.distinct()


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    """Adds `set`, the document's shingle hashes cut to SET_BYTES, in place of its text; rows of the same doc_id that are of another set are left out."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(shingle)

        def cut(text: str, k1: int, k2: int) -> bytes | None:
            found = shingler.of(text)
            if set_key(found) == (k1, k2):
                return np.unique(found >> np.uint64(64 - 8 * SET_BYTES)).view(np.uint8).reshape(-1, 8)[:, :SET_BYTES].tobytes()

        for batch in batches:
            out = batch.drop(columns=["text", "k1", "k2"])
            out["set"] = [cut(*row) for row in zip(batch["text"], batch["k1"], batch["k2"])]
            yield out[out["set"].notna()]

    return docs.mapInPandas(emit, "node long, copies long, component long, n_blocks int, share int, set binary")


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Numbers of shared elements of all pairs, by products of slices of the incidence matrix."""
    element, index = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(index, kind="stable")
    index, row = index[order], row[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for a in range(0, len(element), 8192):
        lo, hi = np.searchsorted(index, [a, a + 8192])
        m = np.zeros((len(sets), min(8192, len(element) - a)), np.float32)
        m[row[lo:hi], index[lo:hi] - a] = 1
        out += m @ m.T
    return np.rint(out).astype(np.int64)


def verified(members: DataFrame, docs: DataFrame, threshold: float, shingle: int) -> DataFrame:
    """(node, root, links, n_blocks) for each block pair that a set is in. members: (node, doc_id: one that has the set, k1, k2, copies, component)."""
    counted = written(members.groupBy("component").count(), "component-sizes")
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    placed = members.join(counted, "component").select("doc_id", "node", "k1", "k2", "copies", "component", blocks.alias("n_blocks"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("share"))
    texts = doc_texts(docs).join(placed, "doc_id").select("node", "k1", "k2", "copies", "component", "n_blocks", "share", "text")
    others = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    met = _sets(texts, shingle).withColumn("other", others).withColumns({"i": F.least("share", "other"), "j": F.greatest("share", "other")})

    def check(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("node").sort_values("node")
        raw = [np.frombuffer(s, np.uint8).reshape(-1, SET_BYTES) for s in frame["set"]]
        sets = [np.pad(r, ((0, 0), (0, 8 - SET_BYTES))).copy().view("<u8")[:, 0] for r in raw]
        size = np.array([len(s) for s in sets])
        both = _intersections(sets)
        linked = both >= threshold * (size[:, None] + size[None, :] - both) - 1e-9
        np.fill_diagonal(linked, False)
        share = frame["share"].to_numpy()
        if frame["i"].iloc[0] != frame["j"].iloc[0]:  # pairs within one block are another task's
            linked &= share[:, None] != share[None, :]
        nodes = frame["node"].to_numpy()
        return pd.DataFrame({"node": nodes, "root": nodes[_roots(linked)], "links": linked @ frame["copies"].to_numpy(), "n_blocks": frame["n_blocks"].to_numpy()})

    return met.groupBy("component", "i", "j").applyInPandas(check, "node long, root long, links long, n_blocks int")


def _classes(docs: DataFrame, threshold: float, shingle: int) -> tuple[DataFrame, DataFrame]:
    """(sketched(docs), a row a set: k1, k2, doc_id: its smallest, node, root: the smallest node of its class, n_links)."""
    sketches = written(sketched(docs, shingle), "sketches")
    sets = sketches.groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("k1", "k2")) == 1
    other = F.xxhash64("k1", "k2").bitwiseAND(F.lit(OTHERS - 1)).bitwiseOR(F.lit(OTHERS))
    sets = written(sets.withColumn("node", F.when(first, F.col("doc_id")).otherwise(other)), "sets")
    own = ["k1", "k2", "doc_id"]
    nodes = sketches.where("sketch is not null").join(sets.select(*own, "node"), own).dropDuplicates(own).select("node", "sketch", "paths")
    nodes = written(nodes, "nodes")
    members = components(candidates(nodes, threshold)).join(sets.select("node", *own, "copies"), "node")
    checked = written(verified(members, docs, threshold, shingle), "verified")
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    alone = checked.where("n_blocks = 1").select("node", "root")
    spread = checked.where("n_blocks > 1 and node <> root")
    found = alone
    if not spread.isEmpty():
        found = alone.unionByName(components(spread.select("node", "root"), "node", "root").withColumnRenamed("component", "root"))
    classes = sets.join(found, "node", "left").join(links, "node", "left")
    return sketches, written(classes.select(*own, "node", F.coalesce("root", "node").alias("root"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links")), "classes")


def join(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, class_id, n_links): links count all documents at the threshold or above."""
    nameless = docs.where("doc_id is null").select(F.col("doc_id").cast("long"), F.lit(None).cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    sketches, classes = _classes(docs.where("doc_id is not null"), threshold, shingle)
    keyed = sketches.select("doc_id", "k1", "k2").join(classes.select("k1", "k2", F.col("root").alias("class_id"), "n_links"), ["k1", "k2"])
    return keyed.select("doc_id", "class_id", "n_links").unionByName(nameless)


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of each class, all columns kept."""
    sketches, classes = _classes(docs.where("doc_id is not null"), THRESHOLD, SHINGLE)
    naming = classes.where("node = root").select("k1", "k2", "doc_id")
    kept = sketches.join(naming, ["k1", "k2", "doc_id"]).groupBy("k1", "k2", "doc_id").agg(F.min("t").alias("_t")).select(F.col("doc_id").alias("_id"), "_t")
    rows = docs.where("doc_id is not null").withColumns({"_id": F.col("doc_id").cast("long"), "_t": text_mark(F.col("text").cast("string"))})
    one = rows.join(kept, ["_id", "_t"], "left_semi").dropDuplicates(["_id", "_t"]).select(*docs.columns)
    return one.unionByName(docs.where("doc_id is null"))
