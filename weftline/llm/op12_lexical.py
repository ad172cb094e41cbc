"""Ranked lexical search of many queries at once, by sharing the partial sums that queries have in common.

A query's score of a document is a sum over its terms, so a set of terms that several queries hold needs summing once. mine() finds such sets: it
takes the pairs of nodes (terms, or sets found before) that most queries share, makes a node of each, and goes on until
no two queries share a pair. The result is a graph whose leaves are terms, whose inner nodes are sums of two nodes, and in which every query is the
sum of a few nodes. Documents are evaluated in blocks: a matrix of accumulators (a row a node, a column a document) is
filled once, level by level, and the queries are combined from it.

Documents are read once into postings (only terms that queries have), one pass over these counts documents by term, another one scores. A task
keeps each query's best rows and gives those; a last window by query puts the tasks' rows in order. Nothing is broadcast but
a chunk of the queries: they are dealt by hash to chunks of about CHUNK_BYTES of text, each with its own passes.

Defined cases: a null or empty text has no terms and no rank; a repeated document or doc_id is a document of its own and ranks for itself;
documents without doc_id rank like others, after equal scores with one; an item without terms has no rows; a repeated item row ranks apart and so
gives its rows again; empty tables give no rows; only doc_id, text, item_id and text are read. N is at most about 10^10 documents of 10^7 terms (64-bit products).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

TOP = 20
CHUNK_BYTES = 1 << 21
WIDTH = 64  # how many of a query's most shared nodes are paired in a round of mining; affects only how much is shared
ROUNDS = 64
BLOCK_BYTES = 1 << 25  # of accumulators
PIECE = 1 << 20
#: Bytes that are no part of a term become blanks, A-Z become a-z.
_PLAIN = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms(text: bytes) -> Counter:
    """How often each term occurs."""
    found, at = Counter(), 0
    text = text.translate(_PLAIN)
    while at < len(text):
        to = text.find(b" ", at + PIECE)
        to = len(text) if to < 0 else to
        found.update(text[at:to].split())
        at = to
    return found


@dataclass(frozen=True)
class Plan:
    """Queries over shared sums. Node k < len(leaf_term) is a term's contribution times leaf_times; node len(leaf_term) + k is left[k] + right[k].

    levels: bounds of inner nodes whose operands are complete before; query q is the sum of roots[starts[q] : starts[q + 1]].
    """

    vocabulary: tuple[bytes, ...]
    leaf_term: np.ndarray
    leaf_times: np.ndarray
    left: np.ndarray
    right: np.ndarray
    levels: tuple[tuple[int, int], ...]
    roots: np.ndarray
    starts: np.ndarray

    def sums(self) -> int:
        """Additions a document: inner nodes, and what is left to add for each query."""
        return len(self.left) + len(self.roots) - (len(self.starts) - 1)


def _shared_pairs(queries: list[list[int]], uses: Counter) -> list[tuple[int, int, list[int]]]:
    """(x, y, queries) of pairs of nodes that at least two queries hold, the most shared first."""
    keys, owners = [], []
    for q, nodes in enumerate(queries):
        best = np.array(sorted(sorted((n for n in nodes if uses[n] > 1), key=lambda n: (-uses[n], n))[:WIDTH]), np.int64)
        if len(best) > 1:
            i, j = np.triu_indices(len(best), 1)
            keys.append(best[i] << 32 | best[j])
            owners.append(np.full(len(i), q))
    if not keys:
        return []
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(key, kind="stable")
    key, owner = key[order], owner[order]
    cuts = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
    size = np.diff(cuts)
    found = np.flatnonzero(size > 1)
    found = found[np.lexsort((key[cuts[found]], -size[found]))]
    return [(int(key[cuts[f]] >> 32), int(key[cuts[f]] & 0xFFFFFFFF), owner[cuts[f] : cuts[f + 1]].tolist()) for f in found]


def mine(items: list[Counter]) -> Plan:
    """The plan of queries that are given as counted terms."""
    vocabulary = sorted(set().union(*items)) if items else []
    at = {t: k for k, t in enumerate(vocabulary)}
    leaves: dict[tuple[int, int], int] = {}
    queries = [[leaves.setdefault((at[t], n), len(leaves)) for t, n in sorted(i.items())] for i in items]
    n_leaves = len(leaves)
    made: list[tuple[int, int]] = []
    levels: list[tuple[int, int]] = []
    for _ in range(ROUNDS):
        uses = Counter(n for q in queries for n in q)
        held = [set(q) for q in queries]
        before = len(made)
        for x, y, owners in _shared_pairs(queries, uses):
            both = [q for q in owners if x in held[q] and y in held[q]]
            if len(both) > 1:
                made.append((x, y))
                for q in both:  # new nodes wait for the next round, so a round is a level
                    held[q] -= {x, y}
                    queries[q] = [n for n in queries[q] if n != x and n != y] + [n_leaves + len(made) - 1]
        if len(made) == before:
            break
        levels.append((before, len(made)))
    pairs = np.array(made, np.int64).reshape(-1, 2)
    leaf = np.array(sorted(leaves, key=leaves.get), np.int64).reshape(-1, 2)
    starts = np.cumsum([0, *(len(q) for q in queries)])
    return Plan(tuple(vocabulary), leaf[:, 0], leaf[:, 1], pairs[:, 0], pairs[:, 1], tuple(levels), np.array([n for q in queries for n in q], np.int64), starts)


def postings(docs: DataFrame, vocabulary: tuple[bytes, ...]) -> DataFrame:
    """(doc_id, n, terms, counts) of documents with a term: all its terms counted in n, those of the vocabulary by number."""
    at = {t: k for k, t in enumerate(vocabulary)}

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n, numbers, counts = [], [], [], []
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                found = terms(text.as_py() or b"")
                if found:
                    known = sorted((at[t], c) for t, c in found.items() if t in at)
                    ids.append(doc_id.as_py())
                    n.append(found.total())
                    numbers.append([k for k, _ in known])
                    counts.append([c for _, c in known])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(numbers, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))], ["doc_id", "n", "terms", "counts"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return texts.mapInArrow(emit, "doc_id long, n long, terms array<int>, counts array<long>")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, lengths) of a list column."""
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def document_counts(found: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term of the vocabulary: a row a term and task is summed, a row a term comes to the driver."""

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(_flat(batch.column(0))[0], minlength=size)
        k = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(df[k])], ["term", "df"])

    out = np.zeros(size, np.int64)
    for row in found.select("terms").mapInArrow(emit, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[row["term"]] = row["df"]
    return out


class Best:
    """Each query's best rows so far: highest score, then rows with a doc_id, then the smallest doc_id."""

    def __init__(self, n_queries: int, top: int):
        self.top, self.floor = top, np.ones(n_queries, np.int64)
        self.query, self.score, self.doc, self.named = (np.empty(0, t) for t in (np.int64, np.int64, np.int64, bool))

    def add(self, scores: np.ndarray, docs: np.ndarray, named: np.ndarray) -> None:
        """scores: a row a query, a column a document."""
        q, d = np.nonzero(scores >= self.floor[:, None])
        self.query, self.score = np.r_[self.query, q], np.r_[self.score, scores[q, d]]
        self.doc, self.named = np.r_[self.doc, docs[d]], np.r_[self.named, named[d]]
        order = np.lexsort((self.doc, ~self.named, -self.score, self.query))
        q = self.query[order]
        first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.empty(0, np.int64)
        place = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
        keep = order[place < self.top]
        self.query, self.score, self.doc, self.named = self.query[keep], self.score[keep], self.doc[keep], self.named[keep]
        full = np.flatnonzero(np.bincount(self.query, minlength=len(self.floor)) == self.top)
        if len(full):
            last = np.searchsorted(self.query, full, "right") - 1
            self.floor[full] = np.maximum(1, self.score[last])


def evaluate(plan: Plan, contributions: np.ndarray) -> np.ndarray:
    """(queries, documents) scores; contributions: a row a term of the vocabulary, a column a document."""
    n_leaves = len(plan.leaf_term)
    acc = np.empty((n_leaves + len(plan.left), contributions.shape[1]), np.int64)
    np.multiply(contributions[plan.leaf_term], plan.leaf_times[:, None], out=acc[:n_leaves])
    for lo, hi in plan.levels:
        np.add(acc[plan.left[lo:hi]], acc[plan.right[lo:hi]], out=acc[n_leaves + lo : n_leaves + hi])
    out = np.zeros((len(plan.starts) - 1, contributions.shape[1]), np.int64)
    full = np.flatnonzero(np.diff(plan.starts))
    for q in full:
        acc[plan.roots[plan.starts[q] : plan.starts[q + 1]]].sum(0, out=out[q])
    return out


def best(found: DataFrame, plan: Plan, weights: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(query, doc_id, score): each task's best rows of every query."""
    width = max(16, BLOCK_BYTES // (8 * (len(plan.vocabulary) + len(plan.leaf_term) + len(plan.left) + len(plan.starts))))

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = Best(len(plan.starts) - 1, top)
        for batch in batches:
            for lo in range(0, batch.num_rows, width):
                part = batch.slice(lo, width)
                n = part.column(1).to_numpy()
                term, sizes = _flat(part.column(2))
                tf = _flat(part.column(3))[0]
                doc = np.repeat(np.arange(part.num_rows), sizes)
                m = 75 + 25 * n * n_docs // n_terms
                contributions = np.zeros((len(plan.vocabulary), part.num_rows), np.int64)
                contributions[term, doc] = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[doc]))
                ids = part.column(0)
                kept.add(evaluate(plan, contributions), ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array(kept.query), pa.array(kept.doc, mask=~kept.named), pa.array(kept.score)], ["query", "doc_id", "score"])

    return found.select("doc_id", "n", "terms", "counts").mapInArrow(emit, "query long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` documents of each item with a score above 0."""
    spark = docs.sparkSession
    asked = items.select(F.col("item_id"), F.col("text").cast("string").cast("binary").alias("text"))
    chunks = max(1, math.ceil((asked.agg(F.sum(F.length("text"))).first()[0] or 0) / chunk_bytes))
    parts = []
    for c in range(chunks):
        rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(chunks)) == c).collect()  # about chunk_bytes
        plan = mine([terms(bytes(r["text"] or b"")) for r in rows])
        found = written(postings(docs, plan.vocabulary), "postings")
        n_docs, n_terms = found.agg(F.count("*"), F.sum("n")).first()
        if not n_docs or not plan.vocabulary:
            continue
        df = document_counts(found, len(plan.vocabulary))
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        w = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        ranked = best(found, plan, weights, n_docs, n_terms, top).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
        names = spark.createDataFrame([(q, r["item_id"]) for q, r in enumerate(rows)], f"query long, item_id {dict(items.dtypes)['item_id']}")
        parts.append(ranked.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"))
    if not parts:
        return items.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).where("false")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: The same by plain joins: terms of all documents, counted, weighed and summed by item.
_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = f"""with d as (select row_number() over () as k, doc_id, {_WORDS} as ws from documents), docs as (select *, len(ws) as n from d where len(ws) > 0),
    whole as (select count(*) as c, sum(n)::bigint as l from docs), tf as (select k, doc_id, n, term, count(*) as tf from (select k, doc_id, n, unnest(ws) as term from docs) group by all),
    asked as (select q, item_id, term, count(*) as times from (select row_number() over () as q, item_id, unnest({_WORDS}) as term from benchmark) group by all),
    df as (select term, count(*) as df from tf group by term), w as (select term, floor(1000 * ln((2 * c + 2)::double / (2 * df + 1)))::bigint as w from df, whole),
    scored as (select q, item_id, k, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * c) // l))))::bigint as score from tf join asked using (term) join w using (term), whole group by all)
    select item_id, rank::int as rank, doc_id, score from (select *, row_number() over (partition by q order by score desc, doc_id) as rank from scored where score > 0) where rank <= {TOP}"""
