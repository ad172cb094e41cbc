"""Suffix dedup by prefix-free parsing: remove bytes covered by strings of SPAN bytes that an earlier document has too.

The parse. A trigger is the TRIGGER-byte window with the smallest rolling hash among those of a SPAN-byte string; the maximal
runs of strings with one trigger make phrases, which overlap by SPAN - 1 bytes, so every SPAN-byte string of
a document lies in just one phrase, and equal texts are cut into equal phrases whatever surrounds them. (A trigger by the
residue of a hash would leave phrases without bound.)

The dictionary and the parse. Blocks of documents send the different phrases of their parse to buckets by trigger, as hashes with the
first document of each. Where a trigger has one phrase in the whole corpus, all suffixes that begin in it are settled: the
phrase is what tells them apart from all others, and the parse's smallest document is their first. Where a trigger has several
phrases, those phrases themselves follow, as bytes: the dictionary. A bucket builds the suffix array of its dictionary to a depth of SPAN,
ranking suffixes by 8 bytes at a time, and combines it with the parse: runs of equal SPAN-byte beginnings, which are neighbours in this
order, get the smallest document of the phrases that they begin in. As equal strings have equal triggers, each bucket's order is a piece of the corpus's one. Blocks
are told what is earlier elsewhere. An entry is sent at most once for each block and phrase, however often the phrase occurs,
so hot passages weigh no more than a row a block. A trigger with very many phrases (HOT_PHRASES; a common line in ever other surroundings) would fill
its bucket; its phrases are sent as single suffixes, which are dealt by their own hashes. So no task sees more than its bucket or block.

Blocks are kept as a table bucketed by block, so the three passes over the text don't shuffle it.

Strings that are called equal by their bytes are. Phrases of a trigger that is alone with one phrase are told apart by hashes: 64 bits of the phrase, 40 and the bucket's
of the trigger, so that of 10**14 different phrases less than one in 10**6 runs has any two mistaken for each other.

Defined cases: a null or empty text has no bytes (its kept_sha256 is that of nothing); texts shorter than SPAN lose nothing;
rows with the same doc_id are not earlier than each other; rows without doc_id come after all others; matches never cross documents; an empty table
gives no rows; other columns, if asked for, come along as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bucketed, written
from .packing import packed, unpacked

SPAN = 50
TRIGGER = 20
BLOCK_BYTES = 4 << 20
CHUNK_BYTES = 1 << 19  # of which the arrays of one step are made
BLOCKS = "block long, data binary"
KEYS = "bucket int, block long, n int, width int, data binary"
LAST = (1 << 63) - 1  # stands for no doc_id
#: Multipliers of the hashes: odd 64-bit numbers without structure.
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * M1
    x ^= x >> np.uint64(32)
    x *= M2
    x ^= x >> np.uint64(29)
    return x


def _trigger_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the TRIGGER bytes from each position on."""
    n = len(data) - TRIGGER + 1
    words = np.ndarray(shape=(len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    h = words[:n] * M2
    h ^= words[8 : 8 + n] * M3
    h ^= h >> np.uint64(31)
    h += words[TRIGGER - 8 : TRIGGER - 8 + n] * M1
    return _mix(h)


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    have, low = 1, h
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[: len(h) - width + 1], low[width - have :])
    return low


@dataclass
class Parse:
    """The phrases of some documents. starts: first suffix of each phrase in the data; sizes: its number of suffixes."""

    starts: np.ndarray
    sizes: np.ndarray
    triggers: np.ndarray
    phrases: np.ndarray
    documents: np.ndarray  # doc_id of each phrase
    suffixes: np.ndarray  # a fingerprint of the SPAN bytes from each position on


def parse(data: np.ndarray, ends: np.ndarray, ids: np.ndarray) -> Parse:
    """data: the bytes of documents one after another; ends: where each ends."""
    empty = np.empty(0, np.int64)
    if len(data) < SPAN:
        return Parse(empty, empty, empty.astype("u8"), empty.astype("u8"), empty, empty.astype("u8"))
    h = _trigger_hashes(data)
    low = _sliding_min(h, SPAN - TRIGGER + 1)
    n = len(low)
    suffixes = _mix(h[:n] + h[SPAN - TRIGGER >> 1 :][:n] * M3 ^ h[SPAN - TRIGGER :][:n] * M1)
    inside = np.ones(n + SPAN, bool)
    for back in range(1, SPAN):  # no suffix of SPAN bytes begins in a document's last SPAN - 1 ones
        inside[ends[ends >= back] - back] = False
    inside = inside[:n]
    first = np.empty(n, bool)
    first[0] = True
    np.not_equal(low[1:], low[:-1], out=first[1:])
    first[1:] |= ~inside[:-1]
    first &= inside
    starts = np.flatnonzero(first)
    if not len(starts):
        return Parse(empty, empty, empty.astype("u8"), empty.astype("u8"), empty, suffixes)
    run = np.cumsum(first) - 1
    sizes = np.bincount(run[inside], minlength=len(starts))
    place = (np.arange(n) - starts[np.maximum(run, 0)]).astype(np.uint64)
    weighed = np.where(inside, suffixes * (place * np.uint64(2) + np.uint64(1)), np.uint64(0))
    phrases = _mix(np.add.reduceat(weighed, starts) + sizes.astype(np.uint64))
    # Minima are small numbers: mixed once more, they spread over all buckets.
    return Parse(starts, sizes, _mix(low[starts]), phrases, ids[np.searchsorted(ends, starts, side="right")], suffixes)


# Blocks: some documents, packed.


def pack_block(ids: list[int], texts: list[bytes], others: bytes) -> bytes:
    """others: the documents' other columns as an Arrow stream."""
    head = np.array([len(ids), len(others)], "<i8").tobytes() + np.array(ids, "<i8").tobytes() + np.array([len(t) for t in texts], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(texts) + others)


def unpack_block(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """(ids, ends, bytes, others)"""
    raw = zstandard.ZstdDecompressor().decompress(data)
    n, rest = np.frombuffer(raw, "<i8", 2).tolist()
    ids, sizes = np.frombuffer(raw, "<i8", 2 * n, 16).reshape(2, n)
    at, total = 16 + 16 * n, int(sizes.sum())
    return ids, np.cumsum(sizes), np.frombuffer(raw, np.uint8, total, at), raw[at + total : at + total + rest]


def _stream(batches: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batches[0].schema) as stream:
        for b in batches:
            stream.write_batch(b)
    return sink.getvalue().to_pybytes()


def blocked(docs: DataFrame, carry: list[str]) -> DataFrame:
    """Documents as a table of blocks, bucketed by block in the shared folder. The columns `carry` travel under the names x0, x1 and so on."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0
        ids, texts, others, size = [], [], [], 0

        def block() -> pa.RecordBatch:
            data = pack_block(ids, texts, _stream(others) if carry else b"")
            return pa.RecordBatch.from_arrays([pa.array([base + made], pa.int64()), pa.array([data], pa.binary())], ["block", "data"])

        for batch in batches:
            rows, begun = list(zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())), 0
            for k, (doc_id, text) in enumerate(rows):
                ids.append(doc_id)
                texts.append(text.encode())
                size += len(texts[-1])
                if size >= BLOCK_BYTES or k == len(rows) - 1:
                    others.append(batch.slice(begun, k + 1 - begun).select(range(2, batch.num_columns)))
                    begun = k + 1
                if size >= BLOCK_BYTES:
                    yield block()
                    ids, texts, others, size, made = [], [], [], 0, made + 1
        if ids:
            yield block()

    others = [F.col(c).alias(f"x{k}") for k, c in enumerate(carry)]
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *others)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return bucketed(rows.mapInArrow(build, BLOCKS), "block", max(8, min(100_000, -(-total // (2 * BLOCK_BYTES)))), "blocks")


def _pieces(ids: np.ndarray, ends: np.ndarray, data: np.ndarray) -> Iterator[tuple[int, Parse]]:
    """Parses of a block by chunks: (offset of the chunk, its parse). A longer document is a chunk of its own, parsed in overlapping steps."""
    begin, k = 0, 0
    while k < len(ids):
        last = int(np.searchsorted(ends, begin + CHUNK_BYTES, side="right"))
        if last > k:
            to = int(ends[last - 1])
            yield begin, parse(np.ascontiguousarray(data[begin:to]), ends[k:last] - begin, ids[k:last])
            begin, k = to, last
            continue
        to = int(ends[k])
        for at in range(begin, to, CHUNK_BYTES):
            stop = min(at + CHUNK_BYTES + SPAN - 1, to)
            yield at, parse(np.ascontiguousarray(data[at:stop]), np.array([stop - at]), ids[k : k + 1])
        begin, k = to, k + 1


# Keys: (key, value, document) entries as fixed-width bytes, sorted by key.


def _bytes_of(x: np.ndarray, width: int) -> np.ndarray:
    return np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width]


def _number(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, : raw.shape[1]] = raw
    return out.view("<u8")[:, 0]


def _doc_width(documents: np.ndarray) -> int:
    return 8 if not len(documents) or documents.min() < 0 else max(1, (int(documents.max()).bit_length() + 7) // 8)


def _smallest(keys: np.ndarray, documents: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(different keys in order, smallest document of each, index of each input's key)"""
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    new = np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]) if len(keys) else np.empty(0, bool)
    starts = np.flatnonzero(new)
    index = np.empty(len(keys), np.int64)
    index[order] = np.cumsum(new) - 1
    return sorted_keys[starts], np.minimum.reduceat(documents[order], starts) if len(starts) else documents[:0], index


def _by_bucket(block: int, bits: int, keys: np.ndarray, columns: list[np.ndarray], width: int) -> pd.DataFrame:
    """Rows for sorted keys, cut where their first `bits` bits change."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(keys)]]) if len(keys) else np.array([0])
    raw = np.hstack(columns) if len(keys) else None
    return pd.DataFrame([(int(bucket[a]), block, int(b - a), width, raw[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])], columns=["bucket", "block", "n", "width", "data"])


KEY, PHRASE = 5, 8  # bytes that are sent of a trigger and a phrase, besides the bucket
HOT_PHRASES = 1000  # of a trigger, from which on its suffixes are dealt one by one


@dataclass
class Settled:
    """What a block knows of its triggers: different ones, the first document and the one phrase of each (odd; or twice the number of its phrases), and each phrase's trigger."""

    parses: list[tuple[int, Parse]]
    triggers: np.ndarray
    documents: np.ndarray
    phrase: np.ndarray
    index: np.ndarray


def settle(ids: np.ndarray, ends: np.ndarray, data: np.ndarray, bits: int) -> Settled:
    parses = list(_pieces(ids, ends, data))
    join = lambda name: np.concatenate([getattr(p, name) for _, p in parses]) if parses else np.empty(0, "u8")
    # As much of a trigger as is sent, so that this block and the bucket mean the same by it.
    triggers = join("triggers").astype("u8") & ~np.uint64((1 << 64 - bits - 8 * KEY) - 1)
    phrases = join("phrases").astype("u8") >> np.uint64(64 - 8 * PHRASE) | np.uint64(1)
    keys, documents, index = _smallest(triggers, join("documents").astype(np.int64))
    order = np.argsort(index, kind="stable")
    starts = np.searchsorted(index[order], np.arange(len(keys)))
    one = np.minimum.reduceat(phrases[order], starts) if len(keys) else phrases
    most = np.maximum.reduceat(phrases[order], starts) if len(keys) else phrases
    mixed = np.flatnonzero((one != most)[index]) if len(keys) else index
    pairs = np.unique(np.stack([index[mixed].astype("u8"), phrases[mixed]], axis=1), axis=0) if len(mixed) else np.empty((0, 2), "u8")
    different = np.bincount(pairs[:, 0].astype(np.int64), minlength=len(keys)).astype("u8")
    return Settled(parses, keys, documents, np.where(different > 1, different * np.uint64(2), one), index)


def _sent_key(keys: np.ndarray, bits: int, width: int) -> np.ndarray:
    """The `width` bytes after the bucket's bits."""
    return (keys << np.uint64(bits)) >> np.uint64(64 - 8 * width)


def trigger_keys(blocks: DataFrame, bits: int) -> DataFrame:
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, data in zip(batch["block"], batch["data"]):
                s = settle(*unpack_block(data)[:3], bits)
                width = _doc_width(s.documents)
                yield _by_bucket(block, bits, s.triggers, [_bytes_of(_sent_key(s.triggers, bits, KEY), KEY), _bytes_of(s.phrase, PHRASE), _bytes_of(s.documents.view("u8"), width)], width)

    return blocks.mapInPandas(emit, KEYS)


def answers(keys: DataFrame, buckets: int) -> DataFrame:
    """To each block, of the keys that it shares with others: kind 0 with the first document, or without it 1 where phrases differ, and 2 where very many do."""

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        key, value, document, block = [], [], [], []
        for b, n, width, data in zip(frame["block"], frame["n"], frame["width"], frame["data"]):
            raw = np.frombuffer(data, np.uint8).reshape(n, -1)
            key.append(_number(raw[:, :KEY]))
            value.append(_number(raw[:, KEY : KEY + PHRASE]))
            document.append(_number(raw[:, KEY + PHRASE :]).view(np.int64))
            block.append(np.full(n, b))
        key, value, document, block = map(np.concatenate, (key, value, document, block))
        order = np.lexsort((block, key))
        key, value, document, block = key[order], value[order], document[order], block[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        starts = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        shared = (np.diff(np.append(starts, len(key))) > 1)[group]
        first = np.minimum.reduceat(document, starts)[group]
        low, high = np.minimum.reduceat(value, starts), np.maximum.reduceat(value, starts)
        counts = np.where(value & np.uint64(1), np.uint64(1), value >> np.uint64(1)).astype(np.int64)
        several = ((low != high) | (low & np.uint64(1) == 0))[group]
        hot = (np.add.reduceat(counts, starts) > HOT_PHRASES)[group]
        out = []
        for kind, told in ((0, shared & ~several & (first < document)), (1, shared & several & ~hot), (2, shared & several & hot)):
            at = np.flatnonzero(told)
            at = at[np.argsort(block[at], kind="stable")]
            cuts = np.concatenate([[0], np.flatnonzero(block[at][1:] != block[at][:-1]) + 1, [len(at)]]) if len(at) else [0]
            for a, b in zip(cuts[:-1], cuts[1:]):
                rows = at[a:b]
                width = _doc_width(first[rows])
                columns = [_bytes_of(key[rows], KEY)] + ([_bytes_of(first[rows].view("u8"), width)] if kind == 0 else [])
                out.append((int(block[rows[0]]), int(frame["bucket"].iloc[0]), kind, len(rows), width, np.hstack(columns).tobytes()))
        return pd.DataFrame(out, columns=["block", "bucket", "kind", "n", "width", "data"])

    return dealt(keys, buckets).groupBy("bucket").applyInPandas(answer, "block long, bucket int, kind int, n int, width int, data binary")


def dealt(keys: DataFrame, buckets: int) -> DataFrame:
    """Rows by bucket, as many tasks as buckets."""
    return keys.repartition(max(1, min(buckets, 20_000)), "bucket")


def _read(answered: pd.DataFrame, kind: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, first documents) told to a block, the keys in full again."""
    keys, documents = [np.empty(0, "u8")], [np.empty(0, np.int64)]
    for bucket, n, data in answered.loc[answered["kind"] == kind, ["bucket", "n", "data"]].itertuples(index=False):
        raw = np.frombuffer(data, np.uint8).reshape(n, -1)
        keys.append(np.uint64(bucket) << np.uint64(64 - bits) | _number(raw[:, :KEY]) << np.uint64(64 - 8 * KEY) >> np.uint64(bits))
        if raw.shape[1] > KEY:
            documents.append(_number(raw[:, KEY:]).view(np.int64))
    return np.concatenate(keys), np.concatenate(documents)


def _resolve(s: Settled, told: pd.DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each phrase of the block: whether its trigger has several, or very many, and otherwise the first document that has it."""
    first, several, hot = s.documents.copy(), s.phrase & np.uint64(1) == 0, np.zeros(len(s.triggers), bool)
    if len(s.triggers):
        keys, documents = _read(told, 0, bits)
        at = np.searchsorted(s.triggers, keys)
        first[at] = np.minimum(first[at], documents)
        several[np.searchsorted(s.triggers, _read(told, 1, bits)[0])] = True
        hot[np.searchsorted(s.triggers, _read(told, 2, bits)[0])] = True
    return (several | hot)[s.index], hot[s.index], first[s.index]


def _spans(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of stretches, one stretch after another."""
    ends = np.cumsum(size)
    return np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


@dataclass
class Dictionary:
    """The stretches of text that a block sends, sorted by bucket: different phrases whose triggers have several, and single suffixes of hot ones."""

    bucket: np.ndarray
    begin: np.ndarray  # in the block's bytes
    size: np.ndarray  # number of suffixes that begin in it
    first: np.ndarray  # the first document of the block that has it
    of_phrase: np.ndarray  # the stretch of each phrase that goes whole
    hot_places: np.ndarray  # of all suffixes that go one by one
    hot_documents: np.ndarray
    of_hot: np.ndarray  # the stretch of each of these


def _different(keys: tuple[np.ndarray, ...], documents: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(one row of each different key in the order of keys, its smallest document, the number of each row's key). The last key leads."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    starts = np.flatnonzero(new)
    index = np.empty(len(order), np.int64)
    index[order] = np.cumsum(new) - 1
    return order[starts], np.minimum.reduceat(documents[order], starts) if len(starts) else documents, index


def dictionary(s: Settled, several: np.ndarray, hot: np.ndarray, bits: int) -> Dictionary:
    join = lambda values, kind=np.int64: np.concatenate(values).astype(kind) if values else np.empty(0, kind)
    begin, size = join([offset + p.starts for offset, p in s.parses]), join([p.sizes for _, p in s.parses])
    documents, phrases = join([p.documents for _, p in s.parses]), join([p.phrases for _, p in s.parses], "u8")
    trigger, whole = s.triggers[s.index], several & ~hot
    one, first, index = _different((phrases[whole], trigger[whole]), documents[whole])
    bucket, starts, sizes = trigger[whole][one] >> np.uint64(64 - bits), begin[whole][one], size[whole][one]
    places = owners = of_hot = np.empty(0, np.int64)
    if hot.any():
        # A suffix's fingerprint decides where it goes; bytes decide what it equals.
        prints = np.zeros(int((begin + size).max()), "u8")
        for offset, p in s.parses:
            at = _spans(p.starts, p.sizes)
            prints[offset + at] = p.suffixes[at]
        places, owners = _spans(begin[hot], size[hot]), np.repeat(documents[hot], size[hot])
        one, early, of_hot = _different((prints[places],), owners)
        of_hot = of_hot + len(bucket)
        bucket, starts, sizes, first = np.append(bucket, prints[places][one] >> np.uint64(64 - bits)), np.append(starts, places[one]), np.append(sizes, np.ones(len(one), np.int64)), np.append(first, early)
    order = np.argsort(bucket, kind="stable")
    moved = np.empty(len(order), np.int64)
    moved[order] = np.arange(len(order))
    return Dictionary(bucket[order].astype(np.int64), starts[order], sizes[order], first[order], moved[index], places, owners, moved[of_hot])


def phrases_sent(blocks: DataFrame, told: DataFrame, bits: int) -> DataFrame:
    """The phrases whose triggers have several, as bytes, to their buckets."""

    def emit(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for block, data in zip(left["block"], left["data"]):
            ids, ends, text, _ = unpack_block(data)
            s = settle(ids, ends, text, bits)
            d = dictionary(s, *_resolve(s, right, bits)[:2], bits)
            cuts = [*np.flatnonzero(np.diff(d.bucket, prepend=-1)).tolist(), len(d.bucket)]
            for a, b in zip(cuts, cuts[1:]):
                raw = text[_spans(d.begin[a:b], d.size[a:b] + SPAN - 1)]
                out.append((int(d.bucket[a]), block, packed(d.size[a:b], d.first[a:b].view("u8")), zstandard.ZstdCompressor(level=3).compress(raw.tobytes())))
        return pd.DataFrame(out, columns=["bucket", "block", "data", "text"])

    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInPandas(emit, "bucket int, block long, data binary, text binary")


def suffix_ranks(raw: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The place of each suffix (equal for equal ones) in the order of their first SPAN bytes, by 8 bytes at a time."""
    padded = np.concatenate([raw, np.zeros(16, np.uint8)])
    word = np.ndarray(shape=(len(padded) - 7,), dtype=">u8", buffer=padded, strides=(1,))
    rank, open_ = np.zeros(len(places), np.int64), np.arange(len(places))
    for depth in range(0, SPAN, 8):
        here = word[places[open_] + depth].astype(np.uint64)
        if depth + 8 > SPAN:  # the last step reads only what is left
            here >>= np.uint64(8 * (depth + 8 - SPAN))
        order = np.lexsort((here, rank[open_])) if depth else np.argsort(here, kind="stable")
        open_, here = open_[order], here[order]
        before, at = rank[open_], np.arange(len(open_))
        other = np.concatenate([[True], before[1:] != before[:-1]])[: len(at)]
        new = other | np.concatenate([[True], here[1:] != here[:-1]])[: len(at)]
        starts = np.flatnonzero(new)
        rank[open_] = before + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(other, at, 0))
        size = np.diff(np.append(starts, len(at)))
        open_ = open_[np.repeat(size > 1, size)]  # the others are settled
        if not len(open_):
            break
    return rank


def ordered(phrases: DataFrame, buckets: int) -> DataFrame:
    """To each block, for every suffix of the phrases that it sent, the first document that has its SPAN bytes: + 1, or 0 where that is the block's own first one with the phrase."""

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        sizes, firsts = zip(*(unpacked(d) for d in frame["data"]))
        size, first = np.concatenate(sizes).astype(np.int64), np.concatenate(firsts).view(np.int64)
        raw = np.frombuffer(b"".join(zstandard.ZstdDecompressor().decompress(t) for t in frame["text"]), np.uint8)
        begin = np.cumsum(size + SPAN - 1) - (size + SPAN - 1)
        rank = suffix_ranks(raw, _spans(begin, size))
        own = np.repeat(first, size)
        earliest = np.full(int(rank.max()) + 1 if len(rank) else 0, LAST)
        np.minimum.at(earliest, rank, own)
        told = np.where(earliest[rank] < own, earliest[rank] + 1, 0)
        ends = np.cumsum([int(s.sum()) for s in sizes])
        return pd.DataFrame([(block, int(frame["bucket"].iloc[0]), packed(t.view("u8"))) for block, t in zip(frame["block"], np.split(told, ends[:-1]))], columns=["block", "bucket", "data"])

    return dealt(phrases, buckets).groupBy("bucket").applyInPandas(answer, "block long, bucket int, data binary")


def _covered(s: Settled, n: int, right: pd.DataFrame, bits: int) -> np.ndarray:
    """Which bytes of a block strings of earlier documents cover."""
    several, hot, first = _resolve(s, right[right["step"] == 0], bits)
    change = np.zeros(n + SPAN + 1, np.int32)
    if not len(several):
        return np.zeros(n, bool)
    begin = np.concatenate([offset + p.starts for offset, p in s.parses])
    size, documents = np.concatenate([p.sizes for _, p in s.parses]), np.concatenate([p.documents for _, p in s.parses])
    gone = ~several & (documents > first)
    np.add.at(change, begin[gone], 1)
    np.add.at(change, begin[gone] + size[gone] - 1 + SPAN, -1)
    d = dictionary(s, several, hot, bits)
    earliest = np.repeat(d.first, d.size)
    starts = np.append(0, np.cumsum(d.size))
    for bucket, data in right.loc[right["step"] == 1, ["bucket", "data"]].itertuples(index=False):
        told = unpacked(data)[0].view(np.int64)
        at = slice(int(starts[np.searchsorted(d.bucket, bucket)]), int(starts[np.searchsorted(d.bucket, bucket, side="right")]))
        earliest[at] = np.where(told > 0, told - 1, earliest[at])
    whole = np.flatnonzero(several & ~hot)
    for k in range(0, len(whole), 1 << 14):  # a bounded number of suffixes at a time
        part, stretch = whole[k : k + (1 << 14)], d.of_phrase[k : k + (1 << 14)]
        gone = np.repeat(documents[part], size[part]) > earliest[_spans(starts[stretch], size[part])]
        gone = _spans(begin[part], size[part])[gone]
        np.add.at(change, gone, 1)
        np.add.at(change, gone + SPAN, -1)
    gone = d.hot_places[d.hot_documents > earliest[starts[d.of_hot]]]
    np.add.at(change, gone, 1)
    np.add.at(change, gone + SPAN, -1)
    return np.cumsum(change[:n]) > 0


def dedup(docs: DataFrame, carry: list[str] | None = None, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text, x0, x1, ...) of every document.

    kept_text, if asked for, leaves characters whole: one that is removed only in part stays. x0, x1, ...: the columns `carry`.
    """
    carry = carry or []
    blocks = blocked(docs, carry)
    n = blocks.count()
    bits = min(20, max(4, (n // 4).bit_length()))  # a bucket has as much as two to four blocks
    told = written(answers(trigger_keys(blocks, bits), 1 << bits), "phrase-answers")
    told_suffixes = ordered(phrases_sent(blocks, told, bits), 1 << bits)
    step = lambda df, k: df.select("block", "bucket", "kind" if k == 0 else F.lit(0).alias("kind"), "n" if k == 0 else F.lit(0).alias("n"), F.lit(k).alias("step"), "data")
    both = step(told, 0).unionByName(step(told_suffixes, 1))
    results = T.StructType([T.StructField(c, t) for c, t in (("doc_id", T.LongType()), ("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept_sha256", T.StringType()), ("kept_text", T.StringType()))])
    names = [f.name for f in results]

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        out, others = [], []
        right = right.to_pandas()
        for data in left.column("data").to_pylist():
            ids, ends, text, stream = unpack_block(data)
            covered = _covered(settle(ids, ends, text, bits), len(text), right, bits)
            for doc_id, a, b in zip(ids.tolist(), np.concatenate([[0], ends[:-1]]), ends):
                gone, own = covered[a:b], text[a:b]
                n_spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                row = (None if doc_id == LAST else doc_id, int(b - a), int(gone.sum()), n_spans, hashlib.sha256(own[~gone].tobytes()).hexdigest())
                out.append((*row, _whole_characters(own, gone) if with_text else None))
            if carry:
                others.append(pa.ipc.open_stream(stream).read_all())
        columns = [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 4 + [pa.string()] * 2)] if out else []
        if not out:
            return pa.table({})
        found = pa.table(dict(zip(names, columns)))
        for k in range(len(carry)):
            found = found.append_column(f"x{k}", pa.concat_tables(others).column(f"x{k}"))
        return found

    schema = T.StructType([*results, *(T.StructField(f"x{k}", docs.schema[c].dataType) for k, c in enumerate(carry))])
    return blocks.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(finish, schema)


def _whole_characters(own: np.ndarray, gone: np.ndarray) -> str:
    """The kept bytes as text; a character goes only if all of its bytes do."""
    if not gone.any():
        return own.tobytes().decode()
    lead = np.flatnonzero((own & 0xC0) != 0x80)
    whole = np.logical_and.reduceat(gone, lead)
    return own[~np.repeat(whole, np.diff(np.append(lead, len(own))))].tobytes().decode()


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents, their columns as they were, with the kept text (and its length, if there is n_chars)."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    found = dedup(docs, carry=others, with_text=True)
    columns = {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": F.col("kept_text")} | {c: F.col(f"x{k}") for k, c in enumerate(others)}
    if "n_chars" in others:
        columns["n_chars"] = F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)
    return found.select(*(columns[c].alias(c) for c in docs.columns))


def query(docs: DataFrame) -> DataFrame:
    return dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
