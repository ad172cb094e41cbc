"""Exact top-k by inner product as a Voronoi join.

Pivots, a bounded sample that grows with the root of the number of vectors, cut space into cells. Of each cell c a summary is kept: the largest distance r
of its vectors from its pivot p, the largest one of its queries, and the distances and ids of the k + 1 nearest different vec_ids.
A query q scores at most q.p + |q| r with any vector of c, and at least q.p - |q| d with one at distance d. For the queries of a
cell together, whose distances from their own pivot are known, both bounds follow from pivots and summaries alone; the (k + 1)-th largest of
the lower bounds over all summaries, one a vec_id, is a floor under every query's k-th score (one more than k, as a query leaves all rows of
its own vec_id out). Cells whose upper bound is below the floor are never looked at.

Cells are packed into parts of about PART_ROWS vectors, a larger cell being split over several. Vectors move once, to their part. Each query first
goes to a part of its own cell and is solved there; its k-th score raises its floor, and only then is it replicated to
the parts that have a cell which can still matter. Where queries are more than a task should hold, those of neighbouring parts make a chunk,
and a part's vectors are replicated to the chunks that need it. Parts solve by matrix products, a bounded number of vectors and queries
at a time; the local lists merge by a ranked window. The bounds only ever drop vectors that can't be in a result, so results are exact.

Only pivots and summaries, MOST_PIVOTS * (k + 1) numbers at most, pass through the driver and are broadcast.

Defined cases: vectors that are null or empty, or hold null or non-finite components, take no part, and neither do
those without vec_id or of another length than the most common one (the longer of two that are equally common); ties go to the
smaller vec_id; rows with the same vec_id are never each other's candidates; fewer than k candidates give
fewer rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bucketed, written

LEAST_PIVOTS, MOST_PIVOTS = 16, 2048
PART_ROWS = 100_000  # vectors of a part, at most about so many
CHUNK_QUERIES = 200_000  # that may meet a part in one task, about
BLOCK_ROWS = 2_000  # vectors, and queries, of a matrix product
MARGIN = 1e-9  # of a bound's size, for rounding
QUERIES = "part int, chunk int, n int, dtype string, ids binary, vectors binary, cells binary, floors binary"
COLUMNS = [c.split()[0] for c in QUERIES.split(", ")]
SOLVED = QUERIES + ", counts binary, found binary, scores binary"


def scaled(embedding: Column, factor: int = 64) -> Column:
    """floor(factor * x) of each component as a double; null where the vector takes no part."""
    x = embedding.cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.when((F.size(x) > 0) & finite, F.transform(x, lambda v: F.floor(v * factor).cast("double")))


def _kind(top: float) -> str:
    return "<i1" if top < 1 << 7 else "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<f8"


def _packed(matrix: np.ndarray) -> tuple[str, bytes]:
    kind = _kind(np.abs(matrix).max() if matrix.size else 0)
    return kind, matrix.astype(kind).tobytes()


def _matrix(kind: str, data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(n, -1).astype(np.float64)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T, of whole numbers exactly."""
    if a.size and b.size and a.shape[1] * np.abs(a).max() * np.abs(b).max() >= 2**53:
        return a.astype(np.int64) @ b.astype(np.int64).T
    return a @ b.T


def assigned(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(vec_id, is_query, cell, distance, dtype, vector) with the cell of the nearest pivot and the distance from it."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        half = (pivots**2).sum(1) / 2
        for batch in batches:
            v = np.stack(batch["v"].to_numpy())
            cell = np.argmax(v @ pivots.T - half, axis=1)
            distance = np.sqrt(((v - pivots[cell]) ** 2).sum(1))
            kinds = [_kind(t) for t in np.abs(v).max(1)]
            yield pd.DataFrame({"vec_id": batch["vec_id"], "is_query": batch["is_query"], "cell": cell.astype(np.int32), "distance": distance, "dtype": kinds, "vector": [x.astype(k).tobytes() for x, k in zip(v, kinds)]})

    return vectors.mapInPandas(assign, "vec_id long, is_query boolean, cell int, distance double, dtype string, vector binary")


@dataclass
class Summaries:
    """What is known of the cells without looking at their vectors."""

    pivots: np.ndarray
    radius: np.ndarray  # of all vectors; -1 for an empty cell
    query_radius: np.ndarray
    rows: np.ndarray
    near_cell: np.ndarray  # the k + 1 nearest vec_ids of all cells, one after another
    near_distance: np.ndarray
    near_id: np.ndarray
    first_part: np.ndarray
    n_parts: np.ndarray  # of each cell: 1, or more for a cell that is split
    chunk: np.ndarray  # of the queries of each part

    def floor(self, cell: int, k: int) -> float:
        """Under the k-th score of every query of the cell."""
        p, reach = self.pivots[cell], self.query_radius[cell]
        size = np.sqrt((self.pivots**2).sum(1))
        low = (self.pivots @ p - reach * size)[self.near_cell] - (np.sqrt(p @ p) + reach) * self.near_distance
        low -= MARGIN * (np.abs(low) + 1) * len(p)
        order = np.lexsort((self.near_id, -low))
        different = np.sort(np.unique(self.near_id[order], return_index=True)[1])
        return float(low[order[different[k]]]) if len(different) > k else -np.inf

    def most_of_group(self, cell: int) -> np.ndarray:
        """For each cell an upper bound of its vectors' scores with the queries of a cell."""
        p, reach = self.pivots[cell], self.query_radius[cell]
        size, norm = np.sqrt((self.pivots**2).sum(1)), np.sqrt(p @ p) + reach
        high = self.pivots @ p + reach * size + norm * np.maximum(self.radius, 0)
        return np.where(self.radius < 0, -np.inf, high + MARGIN * len(p) * (norm * (size + np.maximum(self.radius, 0)) + 1))

    def most(self, q: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """(queries, cells): upper bounds of the scores of single queries."""
        p, radius, norm = self.pivots[cells], np.maximum(self.radius[cells], 0), np.sqrt((q**2).sum(1))[:, None]
        return q @ p.T + norm * radius + MARGIN * p.shape[1] * (norm * (np.sqrt((p**2).sum(1)) + radius) + 1)


def summarised(data: DataFrame, pivots: np.ndarray, k: int, part_rows: int) -> Summaries:
    sizes = data.groupBy("cell").agg(F.count("*").alias("rows"), F.max("distance").alias("radius"), F.max(F.when(F.col("is_query"), F.col("distance"))).alias("query_radius"), F.count_if("is_query").alias("queries")).toPandas()
    nearest = data.groupBy("cell", "vec_id").agg(F.min("distance").alias("distance"))
    place = F.row_number().over(Window.partitionBy("cell").orderBy("distance", "vec_id"))
    nearest = nearest.withColumn("place", place).where(F.col("place") <= k + 1).select("cell", "vec_id", "distance").toPandas()
    n = len(pivots)
    radius, query_radius, rows, queries = np.full(n, -1.0), np.zeros(n), np.zeros(n, np.int64), np.zeros(n)
    radius[sizes["cell"]], rows[sizes["cell"]], queries[sizes["cell"]] = sizes["radius"], sizes["rows"], sizes["queries"]
    query_radius[sizes["cell"]] = sizes["query_radius"].fillna(0)
    first, parts, part, filled = np.zeros(n, np.int64), np.ones(n, np.int64), 0, 0
    for cell in _neighbourly(pivots):  # cells near each other share a part
        if filled and filled + rows[cell] > part_rows:
            part, filled = part + 1, 0
        first[cell], parts[cell] = part, max(1, -(-rows[cell] // part_rows))
        part, filled = part + parts[cell] - 1, filled + rows[cell] if parts[cell] == 1 else part_rows
    of_part = np.zeros(part + 1)
    for cell in range(n):
        of_part[first[cell] : first[cell] + parts[cell]] += queries[cell] / parts[cell]
    chunk = (np.cumsum(of_part) // CHUNK_QUERIES).astype(np.int64)
    order = np.lexsort((nearest["vec_id"], nearest["distance"], nearest["cell"]))
    return Summaries(pivots, radius, query_radius, rows, nearest["cell"].to_numpy()[order], nearest["distance"].to_numpy()[order], nearest["vec_id"].to_numpy()[order], first, parts, chunk)


def _neighbourly(pivots: np.ndarray) -> list[int]:
    """All pivots in an order where each is followed by the nearest one that is left."""
    left, at, out = np.ones(len(pivots), bool), 0, []
    for _ in range(len(pivots)):
        out.append(at)
        left[at] = False
        distance = np.where(left, ((pivots - pivots[at]) ** 2).sum(1), np.inf)
        at = int(np.argmin(distance))
    return out


def _best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, id, score) of the k best of each row, ties to the smaller id, without rows' own ids; in order."""
    allowed = ids[None, :] != own[:, None]
    if scores.shape[1] > k:
        lowest = np.iinfo(np.int64).min if scores.dtype.kind == "i" else -np.inf
        masked = np.where(allowed, scores, lowest)
        least = np.partition(masked, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        allowed &= masked >= least[:, None]
    row, column = np.nonzero(allowed)
    return _ranked(row, ids[column], scores[row, column].astype(np.int64), k)


def _ranked(row: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores, row))
    row, ids, scores = row[order], ids[order], scores[order]
    new = np.flatnonzero(np.diff(row, prepend=-1))
    place = np.arange(len(row)) - np.repeat(new, np.diff(np.append(new, len(row))))
    return row[place < k], ids[place < k], scores[place < k]


def sent(part: np.ndarray, chunk: int, row: np.ndarray, q: np.ndarray, ids: np.ndarray, cells: np.ndarray, floors: np.ndarray) -> pd.DataFrame:
    """Queries (rows of q) packed by the parts that they go to."""
    out = []
    order = np.argsort(part, kind="stable")
    part, row = part[order], row[order]
    for p in np.unique(part):
        own = row[np.searchsorted(part, p) : np.searchsorted(part, p, side="right")]
        for a in range(0, len(own), BLOCK_ROWS):
            at = own[a : a + BLOCK_ROWS]
            dtype, vectors = _packed(q[at])
            out.append((int(p), chunk, len(at), dtype, ids[at].tobytes(), vectors, cells[at].astype("<i4").tobytes(), floors[at].tobytes()))
    return pd.DataFrame(out, columns=["part", "chunk", "n", "dtype", "ids", "vectors", "cells", "floors"])


def solver(k: int, known: Summaries):
    """Solves the queries of a part with its vectors; a query's floor becomes its k-th score, if that is higher."""

    def solve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        right = right.sort_values("cell", kind="stable")
        blocks = []
        for cell, part in right.groupby("cell"):
            for a in range(0, len(part), BLOCK_ROWS):
                some = part.iloc[a : a + BLOCK_ROWS]
                blocks.append((cell, some["vec_id"].to_numpy(), np.stack([np.frombuffer(v, d) for v, d in zip(some["vector"], some["dtype"])]).astype(np.float64)))
        for part, chunk, n, dtype, ids, vectors, cells, floors in left[COLUMNS].itertuples(index=False):
            q, own, floor = _matrix(dtype, vectors, n), np.frombuffer(ids, "<i8"), np.frombuffer(floors, "<f8").copy()
            row, found, scores = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
            pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for cell, b_ids, b in blocks:
                able = np.flatnonzero(known.most(q, np.array([cell]))[:, 0] >= floor)
                if len(able):
                    r, i, s = _best(_products(q[able], b), b_ids, own[able], k)
                    pending.append((able[r], i, s))
                if len(pending) >= 8:
                    row, found, scores = _merged([(row, found, scores), *pending], k)
                    floor = _raised(floor, row, scores, k)
                    pending = []
            row, found, scores = _merged([(row, found, scores), *pending], k)
            floor = _raised(floor, row, scores, k)
            out.append((part, chunk, n, dtype, ids, vectors, cells, floor.tobytes(), np.bincount(row, minlength=n).astype("<i4").tobytes(), found.tobytes(), scores.tobytes()))
        return pd.DataFrame(out, columns=[*COLUMNS, "counts", "found", "scores"])

    return solve


def _merged(lists: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _ranked(*(np.concatenate(c) for c in zip(*lists)), k)


def _raised(floor: np.ndarray, row: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Ties at the floor still count: the smaller vec_id wins."""
    ends = np.searchsorted(row, np.arange(len(floor)), side="right")
    full = np.bincount(row, minlength=len(floor)) >= k
    return np.where(full, np.maximum(floor, scores[np.maximum(ends - 1, 0)] if len(scores) else floor), floor)


def voronoi(vectors: DataFrame, is_query: Column, k: int, pivots: int | None, part_rows: int) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """(solved at home, the queries as they are replicated to other parts, solved there)"""
    lengths = vectors.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        return None
    n = lengths[0]["count"]
    vectors = vectors.where(F.size("v") == lengths[0]["d"])
    chosen = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots or int(np.clip(np.sqrt(n) / 2, LEAST_PIVOTS, MOST_PIVOTS))).collect()
    pivot = np.unique(np.array([r["v"] for r in chosen]), axis=0)
    data = written(assigned(vectors.select("vec_id", "v", F.coalesce(is_query, F.lit(False)).alias("is_query")), pivot), "cells")
    known = summarised(data, pivot, k, part_rows)
    n_parts = int((known.first_part + known.n_parts).max())
    spark = vectors.sparkSession
    places = spark.createDataFrame(pd.DataFrame({"cell": np.arange(len(pivot)), "first": known.first_part, "parts": known.n_parts}), "cell int, first int, parts int")
    placed = data.join(F.broadcast(places), "cell").withColumn("part", (F.col("first") + F.pmod(F.xxhash64("vec_id", "vector"), F.col("parts"))).cast("int"))
    parts = bucketed(placed.select("part", "cell", "vec_id", "dtype", "vector").repartition(n_parts, "part"), "part", n_parts, "parts")
    shared = spark.sparkContext.broadcast(known)

    def to_home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, floors = shared.value, {}
        for batch in batches:
            q = np.stack([np.frombuffer(v, d) for v, d in zip(batch["vector"], batch["dtype"])]).astype(np.float64)
            cells, ids = batch["cell"].to_numpy(), batch["vec_id"].to_numpy().astype("<i8")
            for c in np.unique(cells):
                if c not in floors:
                    floors[c] = known.floor(c, k)
            home = known.first_part[cells] + ids % known.n_parts[cells]
            yield sent(home, 0, np.arange(len(q)), q, ids, cells, np.array([floors[c] for c in cells], "<f8"))

    asked = data.where("is_query").select("vec_id", "cell", "dtype", "vector").mapInPandas(to_home, QUERIES)
    columns = "part", "cell", "vec_id", "dtype", "vector"
    solve = solver(k, known)
    at_home = written(asked.groupBy("part").cogroup(parts.select(*columns).groupBy("part")).applyInPandas(solve, SOLVED), "home")

    def elsewhere(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, groups = shared.value, {}
        last = known.first_part + known.n_parts - 1
        for batch in batches:
            for home, _, n, dtype, ids, vectors, cells, floors in batch[COLUMNS].itertuples(index=False):
                q, ids, cells, floor = _matrix(dtype, vectors, n), np.frombuffer(ids, "<i8"), np.frombuffer(cells, "<i4"), np.frombuffer(floors, "<f8")
                needed = np.zeros((n, n_parts + 1), np.int32)
                for group in np.unique(cells):
                    if group not in groups:
                        groups[group] = known.most_of_group(group)
                    own = np.flatnonzero(cells == group)
                    open_cells = np.flatnonzero(groups[group] >= floor[own].min())
                    able = known.most(q[own], open_cells) >= floor[own][:, None]
                    for k_, cell in enumerate(open_cells):  # all parts of the cell
                        needed[own, known.first_part[cell]] += able[:, k_]
                        needed[own, last[cell] + 1] -= able[:, k_]
                needed = np.cumsum(needed[:, :n_parts], axis=1) > 0
                needed[:, home] = False
                row, part = np.nonzero(needed)
                yield sent(part, int(known.chunk[home]), row, q, ids, cells, floor)

    replicated = at_home.mapInPandas(elsewhere, QUERIES)
    if known.chunk.max() == 0:
        return at_home, replicated, replicated.groupBy("part").cogroup(parts.select(*columns).groupBy("part")).applyInPandas(solve, SOLVED)
    replicated = written(replicated, "replicated")
    meetings = replicated.select("part", F.col("chunk").alias("with_chunk")).distinct()
    meet = parts.join(meetings, "part").select("part", F.col("with_chunk").alias("chunk"), *columns[1:])
    return at_home, replicated, replicated.groupBy("part", "chunk").cogroup(meet.groupBy("part", "chunk")).applyInPandas(solve, SOLVED)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, pivots: int | None = None, part_rows: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k highest products with other rows. vectors: (vec_id, v array<double>)."""
    made = voronoi(vectors, is_query, k, pivots, part_rows or PART_ROWS)
    if made is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    at_home, _, away = made

    def lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, counts, found, scores in zip(batch["ids"], batch["counts"], batch["found"], batch["scores"]):
                query_id = np.repeat(np.frombuffer(ids, "<i8"), np.frombuffer(counts, "<i4"))
                yield pd.DataFrame({"query_id": query_id, "vec_id": np.frombuffer(found, "<i8"), "score": np.frombuffer(scores, "<i8")})

    found = at_home.unionByName(away).select("ids", "counts", "found", "scores").mapInPandas(lists, "query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(embeddings: DataFrame) -> DataFrame:
    v = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), scaled(F.col("embedding")).alias("v")).where("v is not null and vec_id is not null")
    return top_k(v, F.col("vec_id") % 20 == 0)


SQL = """
with valid as (select vec_id, list_transform(embedding, lambda x: floor(x::double * 64)) as v from embeddings
    where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
    from valid q join valid c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0)
select query_id, rank, vec_id, score from
    (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored) where rank <= 20"""
