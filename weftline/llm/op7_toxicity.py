"""Toxicity by class-conditional Kneser-Ney models over words, and over the beginnings of words.

Two models, one for each class, give a word after another one the probability of its class's bigrams; what these leave over goes
half to the bigrams of both classes together, half to the class's words, and from there to the words of both classes. Below the bigrams
a word counts as often as different words precede it in the class. A second pair of models does the same with the
first PREFIX letters of words, for inflected and rare forms. A class's log-likelihood of a word
is drawn to that of the shared backoff as far as the n-gram is known from few contexts (TRUSTED), and counts from what the class leaves over for unknown words;
so a word that no class knows is as likely in both.

A document has two log-likelihoods a word, by the ordinary and the toxic model (A_WORD). Their difference is the log ratio of the document; a logistic curve
over such length-normalised differences (of the whole document, of its most toxic windows, and of its most toxic words) makes them a score between 0 and 1.
The curve is fitted on rows whose half its models did not count.

The counts come from every labelled row outside the held-out fold, rare n-grams too, and stay tables. Documents are read once, into blocks of
numbered words. A block sends its different n-grams to buckets, packed; buckets add the counts of all blocks up, and tell blocks what
they ask. Common words and passages weigh no more than an entry a block. Only sums of counts pass through the driver, and a bounded sample (MOST rows of each class)
on which the logistic curve is fitted. Words are known by 32-bit hashes, asked pairs by SPARE bits more than it takes to number all pairs, so that about one unknown pair
in 2**SPARE is taken for another one.

Defined cases: a null or empty text, or one without words, has log-likelihoods of 0 and scores by the curve at 0 ratios; equal texts score equally;
repeated rows stay, and so do rows without doc_id, which have no label; of several labels of a doc_id the largest counts;
without labels of both classes every score is 0; empty tables give no rows; other columns, among them lang and source, are never read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucketed, held_out, swept, written
from .packing import from_steps, packed, steps, unpacked

MOST = {0: 4000, 1: 2000}  # rows of each class that the logistic curve is fitted on; the counts come from all rows
WINDOW, SHORT_WINDOW = 8, 2
TOP = 3
PREFIX = 4
WORD = re.compile(r"\w+")
TRUSTED, TRUSTED_PAIRS = 3.0, 10.0  # contexts at which a word's, and uses at which a pair's own ratio counts half
BLOCK_WORDS = 1_000_000  # of the documents of a block; a longer document is a block of its own
STRETCH_WORDS = 200_000  # of a block that are judged at once
BUCKET_ENTRIES = 1_000_000  # that a bucket's task has at once, about
WAVES = 3  # in which blocks ask, so that only a part of the questions and answers is on disk at a time
SPARE = 12
CACHED_WORDS = 500_000
LOW32 = np.uint64(0xFFFFFFFF)
HALF = np.uint64(32)

PAIRS, WORDS, PREFIXES, SPELLED = 0, 1, 2, 3
#: Which rows a model counts: all, or those of one half.
ALL_ROWS, HALVES = 0, (1, 2)
#: Columns of counts. Pairs: uses by class and half. Words: by class the different words before it (in all rows and each half), its
#: uses as a word before (in each half), and the different words after it (in all rows and each half). Beginnings: sums of the first of these.
WIDTH = {PAIRS: 4, WORDS: 16, PREFIXES: 6}

_keys: dict[str, int] = {}


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def word_key(word: str) -> int:
    """64 bits: a hash of the beginning above a hash of the word."""
    key = _keys.get(word)
    if key is None:
        if len(_keys) >= CACHED_WORDS:
            _keys.clear()
        key = _keys[word] = (zlib.crc32(word[:PREFIX].encode("utf-8", "replace")) << 32) | zlib.crc32(word.encode("utf-8", "replace"))
    return key


def share(hashes: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """The bucket of hashes of so many bits, by the first 32 of them."""
    return ((hashes >> np.uint64(bits - 32)) * np.uint64(buckets) >> HALF).astype(np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _different(keys: np.ndarray) -> np.ndarray:
    """Sorted different keys; np.unique() takes four times as long for so many."""
    keys = np.sort(keys)
    return keys[np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))] if len(keys) else keys


# Documents as blocks of numbered words.


@dataclass
class Sequences:
    """length: words of each document; code: the place of each word in vocabulary (keys); kind: of each document 0, or for rows to learn from 1 + 2 * label + half."""

    doc_id: np.ndarray
    known_id: np.ndarray
    text_key: np.ndarray
    kind: np.ndarray
    length: np.ndarray
    vocabulary: np.ndarray
    code: np.ndarray

    @staticmethod
    def read(data: bytes, labels: list | None = None) -> "Sequences":
        """labels: (doc_id, label) of the rows to learn from. Equal texts are in one half."""
        doc_id, known_id, text_key, length, vocabulary, code = unpacked(data)
        vocabulary = from_steps(vocabulary)
        doc_id, known_id, kind = doc_id.view(np.int64), known_id.astype(bool), np.zeros(len(doc_id), np.int64)
        if labels is not None and len(labels):
            of = {r["doc_id"]: r["label"] for r in labels}
            label = np.array([of.get(i, -1) if k else -1 for i, k in zip(doc_id.tolist(), known_id)])
            kind = np.where(label >= 0, 1 + 2 * label + (text_key & np.uint64(1)).astype(np.int64), 0)
        return Sequences(doc_id, known_id, text_key.view(np.int64), kind, length.astype(np.int64), vocabulary, code.astype(np.int64))

    def pairs(self, chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(places of the second word of each pair, pairs: the first word's hash above the second's)"""
        doc = np.repeat(np.arange(len(self.length)), self.length)
        follows = doc[1:] == doc[:-1]
        if chosen is not None:
            follows &= chosen[doc[1:]]
        at = np.flatnonzero(follows) + 1
        word = self.vocabulary[self.code] & LOW32
        return at, word[at - 1] << HALF | word[at]


def _block(rows: list[tuple], keys: list[np.ndarray]) -> bytes:
    every = np.concatenate(keys) if keys else np.empty(0, "u8")
    vocabulary, code, uses = np.unique(every, return_inverse=True, return_counts=True)
    order = np.argsort(-np.frexp(uses)[1], kind="stable")  # common words get small numbers; words about as common stay sorted, with short distances (that wrap between the groups)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    ids, known, text_key = (np.array(c, np.int64).view("u8") for c in zip(*rows))
    return packed(ids, known, text_key, np.array([len(k) for k in keys]), steps(vocabulary[order]), place[code])


BLOCK = "block long, n long, ids array<long>, data binary"


def sequenced(docs: DataFrame) -> DataFrame:
    """(block, n, ids, data): the words of all documents, read once, bucketed by block."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base, made = TaskContext.get().partitionId() << 32, 0
        found, keys, size = [], [], 0

        def block() -> pd.DataFrame:
            return pd.DataFrame({"block": [base + made], "n": [size], "ids": [[f[0] for f in found if f[1]]], "data": [_block(found, keys)]})

        for batch in batches:
            for doc_id, known, text, text_key in zip(batch["id"], batch["known"], batch["text"], batch["text_key"]):
                found.append((doc_id, known, text_key))
                keys.append(np.fromiter(map(word_key, words(text)), np.uint64))
                size += len(keys[-1])
                if size >= BLOCK_WORDS:
                    yield block()
                    found, keys, size, made = [], [], 0, made + 1
        if found:
            yield block()

    # Ids come through pandas unharmed where others are null, as their nulls travel apart.
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(F.coalesce(doc_id, F.lit(0)).cast("long").alias("id"), doc_id.isNotNull().alias("known"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    return bucketed(rows.mapInPandas(build, BLOCK), "block", max(8, -(-total // (8 * BLOCK_WORDS))), "sequences")


def labelled(blocks: DataFrame, labels: DataFrame) -> DataFrame:
    """The blocks with the labels (doc_id, label) of their rows to learn from. Ids meet labels, so that no text is moved for it."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label")).where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("label").alias("label"))
    found = blocks.select("block", F.explode("ids").alias("doc_id")).distinct().join(usable, "doc_id")
    by_block = found.groupBy("block").agg(F.collect_list(F.struct("doc_id", "label")).alias("labels"))
    return blocks.join(written(by_block, "toxicity-labels"), "block", "left").select("block", "n", "labels", "data")


# Counts.


def _cut(block: int, kind: int, bucket: np.ndarray, columns: list[np.ndarray]) -> list[tuple]:
    """Rows (kind, bucket, block, data) of columns whose first is sorted."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = [*np.flatnonzero(np.diff(bucket, prepend=-1)).tolist(), len(bucket)]
    out = []
    for a, b in zip(cuts, cuts[1:]):
        first, *others = (c[order[a:b]] for c in columns)
        out.append((kind, int(bucket[a]), block, packed(steps(first), *others)))
    return out


def _added(frame: pd.DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Different keys of packed rows, and the sums of their `width` columns."""
    rows = [unpacked(d) for d in frame["data"]]
    keys = np.concatenate([from_steps(r[0]) for r in rows] or [np.empty(0, "u8")])
    keys, at = np.unique(keys, return_inverse=True)
    counts = np.stack([np.bincount(at, np.concatenate([r[1 + k] for r in rows] or [np.empty(0)]), len(keys)) for k in range(width)], axis=1)
    return keys, counts.astype(np.int64)


def _first_of(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Different keys of packed rows, and one value of each."""
    rows = [unpacked(d) for d in frame["data"]]
    keys, at = np.unique(np.concatenate([from_steps(r[0]) for r in rows] or [np.empty(0, "u8")]), return_index=True)
    return keys, np.concatenate([r[1] for r in rows] or [np.empty(0, "u8")])[at]


def by_rows(uses: np.ndarray) -> np.ndarray:
    """Uses by class and half, (n, 2, 2), as uses by class in all rows and in each half, (n, 2, 3)."""
    return np.concatenate([uses.sum(2, keepdims=True), uses], axis=2)


def _spread(counts: np.ndarray) -> list[int]:
    """For each column the numbers of 1 and 2, and of other numbers above 0, and the sum."""
    flat = counts.reshape(len(counts), 6)
    return np.stack([(flat == 1).sum(0), (flat == 2).sum(0), (flat > 0).sum(0), flat.sum(0)]).ravel().astype(np.int64).tolist()


@dataclass
class Level:
    """Of one kind of n-gram and one choice of rows, by class: the discount, the different n-grams and the sum of their counts."""

    discount: np.ndarray
    different: np.ndarray
    total: np.ndarray

    @staticmethod
    def of(spread: np.ndarray, rows: int) -> "Level":
        one, two, different, total = spread.reshape(4, 2, 3)[:, :, rows].astype(float)
        return Level(np.where(one > 0, one / np.maximum(one + 2 * two, 1), 0.5), different, total)

    @property
    def freed(self) -> np.ndarray:
        return self.discount * self.different / np.maximum(self.total, 1)


@dataclass
class Tables:
    """Counts of n-grams as tables of packed buckets, which grow with the corpus and stay in Spark, and their sums, which don't."""

    tables: dict[int, DataFrame]
    n_buckets: dict[int, int]
    bits: int  # of a pair's hash
    levels: dict[tuple[int, int], Level]  # by kind and choice of rows
    different: dict[int, int]  # words and beginnings that either class has


ENTRIES = "kind int, bucket int, block long, data binary"


def _dealt(df: DataFrame, buckets: int) -> DataFrame:
    """Rows by bucket, so many tasks as there are buckets."""
    return df.repartition(max(1, min(buckets, 20_000)), "bucket")


def _sums(df: DataFrame, column: str) -> np.ndarray:
    row = df.agg(*(F.sum(F.element_at(column, k + 1)).alias(f"s{k}") for k in range(24)), F.sum("n").alias("n")).first()
    return np.array([x or 0 for x in row], np.int64)


def counted(blocks: DataFrame) -> Tables | None:
    """Every n-gram of the rows to learn from, the rare ones too; None where a class has none."""
    size = blocks.agg(F.sum("n").alias("n")).first()["n"] or 0
    buckets = -(-size // BUCKET_ENTRIES) or 1
    word_buckets = -(-buckets // 4)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, data, labels in zip(batch["block"], batch["data"], batch["labels"]):
                s = Sequences.read(data, labels)
                at, pair = s.pairs(s.kind > 0)
                kind = np.repeat(s.kind, s.length)
                different, index = np.unique(pair, return_inverse=True)
                uses = np.bincount(index * 4 + kind[at] - 1, minlength=4 * len(different)).reshape(-1, 4)
                out = _cut(block, PAIRS, share(mixed(different), 64, buckets), [different, *uses.T])
                spelled = s.vocabulary[np.flatnonzero(np.bincount(s.code[kind > 0], minlength=len(s.vocabulary)))]
                spelled = spelled[np.unique(spelled & LOW32, return_index=True)[1]]
                out += _cut(block, SPELLED, (spelled & LOW32).astype(np.int64) % buckets, [spelled & LOW32, spelled >> HALF])
                yield pd.DataFrame(out, columns=["kind", "bucket", "block", "data"])

    def add_pairs(frame: pd.DataFrame) -> pd.DataFrame:
        """The pairs of a bucket, and how the words that fall to it are spelled."""
        bucket = int(frame["bucket"].iloc[0])
        keys, uses = _added(frame[frame["kind"] == PAIRS], WIDTH[PAIRS])
        spelled, beginning = _first_of(frame[frame["kind"] == SPELLED])
        out = [(PAIRS, bucket, len(keys), _spread(by_rows(uses.reshape(-1, 2, 2))), packed(steps(keys), *uses.T)), (SPELLED, bucket, 0, None, packed(steps(spelled), beginning))]
        return pd.DataFrame(out, columns=["kind", "bucket", "n", "spread", "data"])

    shape = "bucket int, n long, spread array<long>, data binary"
    entries = blocks.where("labels is not null").select("block", "data", "labels").mapInPandas(emit, ENTRIES)
    pairs_and_words = bucketed(_dealt(entries, buckets).groupBy("bucket").applyInPandas(add_pairs, "kind int, " + shape), "bucket", max(1, min(buckets, 20_000)), "toxicity_pairs")  # asked bucket by bucket
    pairs = pairs_and_words.where(F.col("kind") == PAIRS)
    sums = {PAIRS: _sums(pairs, "spread")}

    def words_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for kind, bucket, data in zip(batch["kind"], batch["bucket"], batch["data"]):
                distances, *uses = unpacked(data)
                if kind == SPELLED:
                    spelled = from_steps(distances)
                    yield pd.DataFrame(_cut(bucket, SPELLED, spelled.astype(np.int64) % word_buckets, [spelled, *uses]), columns=["kind", "bucket", "block", "data"])
                    continue
                pair = from_steps(distances)
                uses = by_rows(np.stack(uses, axis=1).astype(np.int64).reshape(-1, 2, 2))
                ids, at = np.unique(np.concatenate([pair & LOW32, pair >> HALF]), return_inverse=True)
                word, before = at[: len(pair)], at[len(pair) :]
                values = []
                for c in (0, 1):
                    values += [np.bincount(word, uses[:, c, r] > 0, len(ids)) for r in range(3)]
                    values += [np.bincount(before, uses[:, c, r], len(ids)) for r in HALVES]
                    values += [np.bincount(before, uses[:, c, r] > 0, len(ids)) for r in range(3)]
                yield pd.DataFrame(_cut(bucket, WORDS, ids.astype(np.int64) % word_buckets, [ids, *(v.astype("u8") for v in values)]), columns=["kind", "bucket", "block", "data"])

    found = pairs_and_words.select("kind", "bucket", "data").mapInPandas(words_of, ENTRIES)

    def add_words(frame: pd.DataFrame) -> pd.DataFrame:
        """The words of a bucket, and what they add to their beginnings. Words that are never part of a pair are left out."""
        bucket = int(frame["bucket"].iloc[0])
        keys, values = _added(frame[frame["kind"] == WORDS], WIDTH[WORDS])
        spelled, beginning = _first_of(frame[frame["kind"] == SPELLED])
        contexts = values[:, [0, 1, 2, 8, 9, 10]]
        begun, at = np.unique(beginning[np.searchsorted(spelled, keys)], return_inverse=True)
        sums = [np.bincount(at, contexts[:, k], len(begun)).astype("u8") for k in range(6)]
        out = [(WORDS, bucket, int((contexts[:, [0, 3]].sum(1) > 0).sum()), _spread(contexts), packed(steps(keys), *values.T))]
        out += [(PREFIXES, b, 0, None, d) for _, b, _, d in _cut(bucket, PREFIXES, begun.astype(np.int64) % word_buckets, [begun, *sums])]
        return pd.DataFrame(out, columns=["kind", "bucket", "n", "spread", "data"])

    both = written(_dealt(found, word_buckets).groupBy("bucket").applyInPandas(add_words, "kind int, " + shape), "toxicity-words")

    def add_beginnings(frame: pd.DataFrame) -> pd.DataFrame:
        keys, sums = _added(frame, WIDTH[PREFIXES])
        return pd.DataFrame([(int(frame["bucket"].iloc[0]), int((sums[:, [0, 3]].sum(1) > 0).sum()), _spread(sums), packed(steps(keys), *sums.T))], columns=["bucket", "n", "spread", "data"])

    known = both.where(F.col("kind") == WORDS)
    beginnings = written(both.where(F.col("kind") == PREFIXES).groupBy("bucket").applyInPandas(add_beginnings, shape), "toxicity-beginnings")
    sums |= {WORDS: _sums(known, "spread"), PREFIXES: _sums(beginnings, "spread")}
    levels = {(kind, rows): Level.of(s[:24], rows) for kind, s in sums.items() for rows in (ALL_ROWS, *HALVES)}
    if (levels[PAIRS, ALL_ROWS].total == 0).any():
        return None
    n_pairs = int(sums[PAIRS][24])
    return Tables({PAIRS: pairs, WORDS: known, PREFIXES: beginnings}, {PAIRS: buckets, WORDS: word_buckets, PREFIXES: word_buckets}, max(40, min(62, n_pairs.bit_length() + SPARE)), levels, {k: int(sums[k][24]) for k in (WORDS, PREFIXES)})


# Ratios.


def _shared(counts: np.ndarray, level: Level, different: int) -> np.ndarray:
    """The probability of words by the contexts that both classes have seen."""
    return (counts.sum(1) + 0.5) / (level.total.sum() + 0.5 * (different + 1))


def _single(counts: np.ndarray, level: Level, different: int) -> np.ndarray:
    """(n, 2): probabilities of words by class, from their contexts."""
    shared = _shared(counts, level, different)
    return np.maximum(counts - level.discount, 0) / np.maximum(level.total, 1) + level.freed * shared[:, None]


def _trust(n: np.ndarray, half: float) -> np.ndarray:
    return n / (n + half)


def _smoothed(counts: np.ndarray, level: Level, different: int) -> tuple[np.ndarray, np.ndarray]:
    """(n, 2): log-likelihoods of words by class, drawn to the shared backoff as far as few contexts are known; and each class's probabilities."""
    single, shared = _single(counts, level, different), np.log(_shared(counts, level, different))[:, None]
    return shared + (np.log(single / level.freed) - shared) * _trust(counts.sum(1), TRUSTED)[:, None], single


def likelihoods(s: Sequences, at: np.ndarray, uses: np.ndarray, values: np.ndarray, begun: np.ndarray, levels: dict[int, Level], different: dict[int, int], rows: int) -> np.ndarray:
    """(2, words, 2): log-likelihoods for each word of a block, by words and by beginnings, of the ordinary and the toxic model.

    uses (pairs, 2): counts of the pairs whose second words are at `at`; values (vocabulary, 2, 8) and begun (vocabulary, 2, 3): columns of WORDS and PREFIXES.
    """
    level = levels[WORDS]
    own, single = _smoothed(values[:, :, rows].astype(float), level, different[WORDS])
    by_word = own[s.code]
    both = uses.sum(1)
    known = np.flatnonzero(both > 0)  # other pairs change nothing
    at, uses, both = at[known], uses[known], both[known]
    if len(at):
        before, word = s.code[at - 1], s.code[at]
        n = values[:, :, 3] + values[:, :, 4] if rows == ALL_ROWS else values[:, :, 2 + rows]
        n, after, d = n[before].astype(float), values[:, :, 5 + rows][before].astype(float), levels[PAIRS].discount
        left = (d * after + 1) / (n + 1)  # one more for a word that was never seen before another
        p = np.maximum(uses - d, 0) / (n + 1) + left * (both[:, None] / (n.sum(1) + 2)[:, None] + single[word]) / 2
        by_word[at] += (np.log(p / level.freed) - by_word[at]) * _trust(both, TRUSTED_PAIRS)[:, None]
    by_beginning, _ = _smoothed(begun[:, :, rows].astype(float), levels[PREFIXES], different[PREFIXES])
    return np.stack([by_word, by_beginning[s.code]])


#: A document's log-likelihoods a word, by class.
A_WORD = ["ordinary_per_word", "toxic_per_word"]
FEATURES = [f"{name}_{by}" for by in ("words", "beginnings") for name in ("mean", "window", "pair", "top")]


def per_word(by_class: np.ndarray, length: np.ndarray) -> np.ndarray:
    """(documents, 2): log-likelihoods by class, normalised by length; 0 without words."""
    out, has = np.zeros((len(length), 2)), np.flatnonzero(length)
    if len(has):
        size = length[has]
        out[has] = np.add.reduceat(by_class, np.cumsum(size) - size) / size[:, None]
    return out


def evidence(r: np.ndarray, length: np.ndarray) -> np.ndarray:
    """(documents, 4): length-normalised log ratios of each document, of its most toxic WINDOW and pair of words, and of its TOP most toxic words."""
    out = np.zeros((len(length), 4))
    has = np.flatnonzero(length)
    if not len(has):
        return out
    size = length[has]
    start = np.cumsum(size) - size
    doc = np.repeat(np.arange(len(has)), size)
    place = np.arange(len(r)) - start[doc]
    sums = np.concatenate([[0.0], np.cumsum(r)])
    out[has, 0] = np.add.reduceat(r, start) / size
    for column, window in ((1, WINDOW), (2, SHORT_WINDOW)):
        width = np.minimum(window, size)[doc]
        fits = place + width <= size[doc]
        end = np.minimum(np.arange(len(r)) + width, len(r))
        out[has, column] = np.maximum.reduceat(np.where(fits, (sums[end] - sums[:-1]) / width, -np.inf), start)
    rest = r.copy()
    for k in range(TOP):  # the largest that is left, of each document that has so many words
        best = np.maximum.reduceat(rest, start)
        out[has, 3] += np.where(k < size, best, 0.0)
        at = np.flatnonzero(rest == best[doc])
        rest[at[np.diff(doc[at], prepend=-1) > 0]] = -np.inf  # one of equal ones
    out[has, 3] /= np.minimum(TOP, size)
    return out


def stretches(length: np.ndarray, at: np.ndarray) -> list[tuple[slice, slice, slice]]:
    """(documents, their words, their pairs): whole documents of about STRETCH_WORDS words together, so that only some of a block is expanded at a time."""
    ends = np.concatenate([[0], np.cumsum(length)])
    cuts = np.unique(np.concatenate([[0], np.searchsorted(ends, np.arange(STRETCH_WORDS, ends[-1], STRETCH_WORDS)), [len(length)]]))
    pairs = np.searchsorted(at, ends[cuts])
    return [(slice(a, b), slice(int(ends[a]), int(ends[b])), slice(p, q)) for a, b, p, q in zip(cuts[:-1].tolist(), cuts[1:].tolist(), pairs[:-1].tolist(), pairs[1:].tolist())]


def judged(blocks: DataFrame, tables: Tables) -> DataFrame:
    """(doc_id, text_key, label, A_WORD and FEATURES by all rows, half_ + FEATURES by the rows of the other half) of all documents of the blocks.

    label is null where a row is not to be learnt from. A block asks the buckets for its different n-grams; they answer in the order of the question,
    with which n-grams they know and the counts of these.
    """
    n_buckets, spare, bits = tables.n_buckets, np.uint64(64 - tables.bits), tables.bits

    def questions(s: Sequences, kinds: tuple[int, ...], places: bool = False) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
        """By kind: different keys in order, their buckets, and, if asked, the place of each pair or word among them."""
        found = {}
        for kind in kinds:
            keys = mixed(s.pairs()[1]) >> spare if kind == PAIRS else s.vocabulary & LOW32 if kind == WORDS else s.vocabulary >> HALF
            different, index = np.unique(keys, return_inverse=True) if places else (_different(keys), None)
            found[kind] = different, share(different, bits, n_buckets[kind]) if kind == PAIRS else (different % np.uint64(n_buckets[kind])).astype(np.int64), index
        return found

    def asked(kinds: tuple[int, ...]) -> DataFrame:
        def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for block, data in zip(batch["block"], batch["data"]):
                    for kind, (keys, bucket, _) in questions(Sequences.read(data), kinds).items():
                        yield pd.DataFrame(_cut(block, kind, bucket, [keys]), columns=["kind", "bucket", "block", "data"])

        return blocks.select("block", "data").mapInPandas(ask, ENTRIES)

    def told(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for kind in np.unique(right["kind"]):
            rows = [unpacked(d) for d in left.loc[left["kind"] == kind, "data"]]
            if not rows:
                continue
            keys, counts = from_steps(rows[0][0]), np.stack(rows[0][1:], axis=1)
            if kind == PAIRS:
                keys = mixed(keys) >> spare
                order = np.argsort(keys, kind="stable")
                keys, counts = keys[order], counts[order]
            for block, bucket, data in right.loc[right["kind"] == kind, ["block", "bucket", "data"]].itertuples(index=False):
                wanted = from_steps(unpacked(data)[0])
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                known = keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)
                out.append((int(kind), bucket, block, packed(known, *counts[at[known]].T)))
        return pd.DataFrame(out, columns=["kind", "bucket", "block", "data"])

    def answered(kinds: tuple[int, ...]) -> DataFrame:
        n = n_buckets[kinds[0]]
        listed = reduce(DataFrame.unionByName, (tables.tables[kind].select(F.lit(kind).alias("kind"), "bucket", "data") for kind in kinds))
        if kinds != (PAIRS,):  # pairs lie in buckets already
            listed = _dealt(listed, n)
        return listed.groupBy("bucket").cogroup(_dealt(asked(kinds), n).groupBy("bucket")).applyInPandas(told, ENTRIES)

    answers = answered((PAIRS,)).unionByName(answered((WORDS, PREFIXES)))
    by_rows_levels = {rows: {kind: tables.levels[kind, rows] for kind in WIDTH} for rows in (ALL_ROWS, *HALVES)}
    usable = [rows for rows in HALVES if all((level.total > 0).all() for level in by_rows_levels[rows].values())]
    different = tables.different

    def weigh(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for data, labels in zip(left["data"], left["labels"]):
            s = Sequences.read(data, labels)
            counts = {}
            for kind, (keys, bucket, index) in questions(s, (PAIRS, WORDS, PREFIXES), places=True).items():
                found = np.zeros((len(keys), WIDTH[kind]), np.int64)
                order = np.argsort(bucket, kind="stable")
                ends = np.searchsorted(bucket[order], np.arange(n_buckets[kind] + 1))
                for b, answer in right.loc[right["kind"] == kind, ["bucket", "data"]].itertuples(index=False):
                    known, *columns = unpacked(answer)
                    found[order[ends[b] : ends[b + 1]][known.astype(bool)]] = np.stack(columns, axis=1)
                counts[kind] = found[index]
            at, _ = s.pairs()
            uses, values, begun = counts[PAIRS].reshape(-1, 2, 2), counts[WORDS].reshape(-1, 2, 8), counts[PREFIXES].reshape(-1, 2, 3)
            columns = {"id": s.doc_id, "known": s.known_id, "text_key": s.text_key, "kind": s.kind}

            def features(rows: int, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                doc = np.repeat(chosen, s.length)
                mine, length, code, use = (np.cumsum(doc) - 1)[at[doc[at]]], s.length[chosen], s.code[doc], uses[doc[at]]
                found = []
                for docs, words_, pairs_ in stretches(length, mine):
                    own = use[pairs_].sum(2) if rows == ALL_ROWS else use[pairs_, :, rows - 1]
                    part = replace(s, code=code[words_], length=length[docs])
                    of_words = likelihoods(part, mine[pairs_] - words_.start, own, values, begun, by_rows_levels[rows], different, rows)
                    found.append(np.hstack([per_word(of_words[0], part.length), *(evidence(l[:, 1] - l[:, 0], part.length) for l in of_words)]))
                found = np.vstack(found)
                return found[:, :2], found[:, 2:]

            (a_word, whole), other = features(ALL_ROWS, np.ones(len(s.kind), bool)), np.full((len(s.kind), len(FEATURES)), np.nan)
            for rows in usable:  # a document of one half is judged by what the other half says
                chosen = (s.kind > 0) & ((s.kind - 1) % 2 != rows - 1)
                if chosen.any():
                    other[chosen] = features(rows, chosen)[1]
            columns |= {f: a_word[:, k] for k, f in enumerate(A_WORD)}
            columns |= {f: whole[:, k] for k, f in enumerate(FEATURES)} | {f"half_{f}": other[:, k] for k, f in enumerate(FEATURES)}
            out.append(pd.DataFrame(columns))
        return pd.concat(out) if out else pd.DataFrame(columns=names)

    names = ["id", "known", "text_key", "kind", *A_WORD, *FEATURES, *(f"half_{f}" for f in FEATURES)]
    shape = "id long, known boolean, text_key long, kind long, " + ", ".join(f"{f} double" for f in names[4:])
    found = blocks.select("block", "data", "labels").groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(weigh, shape)
    label = F.when(F.col("kind") > 0, F.floor((F.col("kind") - 1) / 2).cast("int"))
    return found.select(F.when(F.col("known"), F.col("id")).alias("doc_id"), "text_key", label.alias("label"), *names[4:])


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 1e-2) -> np.ndarray:
    """Weights (last: intercept) by Newton's method."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (p - y) + ridge * w
        hessian = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    tables: Tables
    curve: np.ndarray


def fitted_curve(features: DataFrame, most: dict[int, int] | None = None) -> np.ndarray:
    """The curve by how the models of one half judge rows of the other half, at most `most` of each class, chosen by a hash of doc_id."""
    columns = [f"half_{f}" for f in FEATURES]
    rows = features.where(F.col("label").isNotNull() & ~F.isnan(columns[0])).select("doc_id", "label", *columns)
    parts = [rows.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id", *columns).limit(n).toPandas() for c, n in (most or MOST).items()]
    if any(len(p) == 0 for p in parts):  # too few rows to halve
        return np.array([0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0, -2.0])
    seen = pd.concat(parts)
    return fit_logistic(seen[columns].to_numpy(float), seen["label"].to_numpy(float))


def learnt(docs: DataFrame, labels: DataFrame, most: dict[int, int] | None = None) -> tuple[Model | None, DataFrame]:
    """The model of all labelled rows, and what it says about every document: (doc_id, text_key, score, A_WORD)."""
    with swept(docs.sparkSession):
        blocks = labelled(sequenced(docs), labels)
        tables = counted(blocks)
        if tables is None:
            return None, docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_key"), F.lit(0.0).alias("score"), *(F.lit(0.0).alias(c) for c in A_WORD))
        waves = [blocks.where(F.pmod(F.xxhash64("block"), F.lit(WAVES)) == k) for k in range(WAVES)]
        features = reduce(DataFrame.unionByName, [written(judged(wave, tables), "toxicity-features") for wave in waves])
        model = Model(tables, fitted_curve(features, most))
    return model, scored(features, model)


def fit(docs: DataFrame, labels: DataFrame, most: dict[int, int] | None = None) -> Model | None:
    return learnt(docs, labels, most)[0]


def scored(features: DataFrame, model: Model) -> DataFrame:
    *weights, intercept = map(float, model.curve)
    z = sum((F.col(f) * w for f, w in zip(FEATURES, weights)), F.lit(intercept))
    z = F.least(F.lit(30.0), F.greatest(F.lit(-30.0), z))
    return features.select("doc_id", "text_key", (1 / (1 + F.exp(-z))).alias("score"), *A_WORD)


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """(doc_id, score, predicted, A_WORD) of every whole text of other documents."""
    blocks = sequenced(docs).withColumn("labels", F.lit(None).cast("array<struct<doc_id:bigint,label:int>>"))
    found = scored(judged(blocks, model.tables), model)
    return found.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *A_WORD)


def kept(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that the model doesn't reject, with all their columns. Scores depend on texts alone, so rejected texts are what is joined."""
    rejected = learnt(docs, labels)[1].where(F.col("score") >= threshold).select(F.col("text_key").alias("_rejected")).distinct()
    return docs.join(rejected, F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))) == F.col("_rejected"), "left_anti")


def query(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    found = learnt(docs, labels)[1]
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *A_WORD)
