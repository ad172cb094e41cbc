"""SimHash tiles, shared lexical search and periodic runs, held against plain versions."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

from weftline.llm import op11_simhash, op12_lexical, op13_runs, registry
from weftline.llm.common import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


# 11


def plain_fingerprint(text):
    words = WORD.findall((text or "").encode().lower())
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """{(doc_id, fingerprint): smallest doc_id reachable}."""
    nodes = sorted({f for i, f in rows if i is not None})
    parent = {f: f for f in nodes}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a, b in itertools.combinations(nodes, 2):
        if (a ^ b).bit_count() <= 2:
            parent[root(a)] = root(b)
    least = {}
    for i, f in rows:
        if i is not None:
            least[root(f)] = min(i, least.get(root(f), i))
    return sorted((i if i is not None else -1, f"{f:016x}", None if i is None else least[root(f)]) for i, f in rows)


def found_components(df):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.select("doc_id", "fingerprint", "component_id").collect())


def test_fingerprint():
    rng = random.Random(1)
    for _ in range(50):
        text = "".join(rng.choice("aAé  \t\n\x0b\x1cÄ") for _ in range(rng.randint(0, 60)))
        assert op11_simhash.fingerprint(text.encode()) == plain_fingerprint(text)
    long = " ".join(rng.choice(["Aa", "bb", "cc"]) for _ in range(500))
    assert op11_simhash.fingerprint(long.encode()) == plain_fingerprint(long)
    assert [b"".join(op11_simhash.pieces(t, 7)) for t in (b"ab  cd\nef gh", b"", b"x" * 30, b" ")] == [b"ab  cd\nef gh", b"", b"x" * 30, b" "]


def test_fingerprint_in_pieces(monkeypatch):
    text = "One two  three\tfour five six SEVEN " * 9
    whole = op11_simhash.fingerprint(text.encode())
    cut = op11_simhash.pieces
    for size in (1, 5, 16, 40):
        monkeypatch.setattr(op11_simhash, "pieces", lambda t, s=size: cut(t, s))
        assert op11_simhash.fingerprint(text.encode()) == whole == plain_fingerprint(text)


@pytest.mark.parametrize("parts", [None, 1, 2, 4, 8])
def test_simhash_components(spark, docs, texts, parts):
    found = op11_simhash.near_duplicates(docs, tile=4, parts=parts)
    assert found_components(found) == plain_components([(i, plain_fingerprint(t)) for i, t in texts])


def test_simhash_edge_ids(spark):
    """Ids of several texts, rows without id, the ends of the range, and links through a chain."""
    base = plain_fingerprint("x y z")
    rows = [(5, "alpha beta gamma delta"), (5, "x y z"), (7, "x y z"), (9, "alpha beta gamma delta"), (None, "x y z"), (None, "only here"), (-(1 << 63), "one one one"), ((1 << 63) - 1, "two two two"), (3, None)]
    found = op11_simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found_components(found) == plain_components([(i, plain_fingerprint(t)) for i, t in rows]) and base


@pytest.mark.parametrize("parts", [1, 2, 4, 8])
def test_links_of_planted_fingerprints(spark, parts):
    """Pairs at two bits in any place are found, those at three are not, whatever the tiles."""
    rng = random.Random(parts)
    marks = [rng.getrandbits(64) for _ in range(40)] + [0, (1 << 64) - 1]
    marks += [m ^ (1 << a) ^ (1 << b) for m in marks[:20] for a, b in [rng.sample(range(64), 2)]] + [m ^ 7 for m in marks[20:40]]
    marks = sorted(set(marks))
    nodes = spark.createDataFrame([(m - (1 << 64) if m >> 63 else m,) for m in marks], "fp long")
    edges = {(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in op11_simhash.links(nodes, parts, tile=8).collect()}
    assert all((a ^ b).bit_count() <= 2 for a, b in edges)  # so few that each component is a pair or a star
    near = {frozenset(p) for p in itertools.combinations(marks, 2) if (p[0] ^ p[1]).bit_count() <= 2}
    assert {frozenset(e) for e in edges} == near


def test_linked_roots_of_dense_tiles():
    a = np.arange(64, dtype=np.uint64)
    nodes, roots = op11_simhash._linked_roots(a, a, True, 2)
    assert sorted(nodes) == list(range(1, 64)) and set(roots) == {0}


def test_tile_parts_grow():
    found = [op11_simhash.tile_parts(10**k) for k in range(2, 11)]
    assert found == sorted(found) and found[0] == 1 and found[-1] == 8
    assert len(op11_simhash.offsets(8)) == 145 and op11_simhash.offsets(1) == [(-2,), (-1,), (0,), (1,), (2,)]


def test_simhash_of_no_documents(no_docs):
    assert op11_simhash.near_duplicates(no_docs).count() == 0


# 12


def plain_search(docs, items):
    def words(text):
        text = "".join(chr(ord(c) | 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)

    counted = [(i, Counter(words(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counted:
            m = 75 + 25 * c.total() * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in words(text) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(scored)[:20], 1)]
    return sorted(out, key=str)


def found_search(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


ITEMS = [(1, "The of and the THE is"), (2, "of and the"), (3, None), (4, "nowhere-at-all"), (5, "one two three é"), (6, "and of the is to in"), (7, "of and the"), (8, "a\x00b_c one")]


@pytest.mark.parametrize("chunk", [1 << 21, 8])
def test_search(spark, docs, texts, chunk):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("rank", op12_lexical.F.lit("clash"))
    assert found_search(op12_lexical.search(docs, items, chunk_bytes=chunk)) == plain_search(texts, ITEMS)


def test_search_rows_without_id(spark):
    rows = [(None, "red fox"), (4, "red fox"), (4, "red fox"), (2, "red fox jumps"), (None, None), (9, "...")] + [(100 + k, "blue") for k in range(30)]
    items = [(1, "fox red"), (2, "blue blue"), (3, "blue blue")]
    found = op12_lexical.search(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert found_search(found) == plain_search(rows, items)


def test_search_sql(spark):
    """The query against its SQL, as DuckDB runs it."""
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    found = registry.op12_shared_search(spark, SF).select("item_id", "rank", "doc_id", "score").toPandas()
    assert sorted(map(tuple, found.to_numpy().tolist())) == sorted(con.sql(op12_lexical.SQL).fetchall())


def test_mined_plans_share_and_stay_right():
    rng = np.random.default_rng(2)
    items = [Counter(str(t).encode() for t in np.minimum(rng.zipf(1.3, rng.integers(0, 30)), 60)) for _ in range(80)]
    plan = op12_lexical.mine(items)
    values = rng.integers(0, 10**9, (len(plan.vocabulary), 7))
    at = {t: k for k, t in enumerate(plan.vocabulary)}
    expected = np.array([sum((n * values[at[t]] for t, n in i.items()), np.zeros(7, np.int64)) for i in items])
    assert (op12_lexical.evaluate(plan, values) == expected).all()
    assert plan.sums() < sum(max(0, len(i) - 1) for i in items)
    once = [Counter(set(i)) for i in items]
    assert op12_lexical.mine(once).sums() < 0.7 * sum(max(0, len(i) - 1) for i in once)
    copies = op12_lexical.mine([Counter(a=1, b=2, c=1)] * 5)
    assert copies.sums() == 2  # the whole set is summed once
    assert len(op12_lexical.mine([]).vocabulary) == 0


def test_terms_in_pieces(monkeypatch):
    text = "A-b é\x7fc_d 9Z 9z, ".encode() * 20
    whole = op12_lexical.terms(text)
    monkeypatch.setattr(op12_lexical, "PIECE", 3)
    assert op12_lexical.terms(text) == whole == Counter({b"a": 20, b"b": 20, "é".encode(): 20, b"c": 20, b"d": 20, b"9z": 40})


def test_search_of_nothing(spark, docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert op12_lexical.search(no_docs, items).count() == 0 and op12_lexical.search(docs, items.where("false")).count() == 0
    assert op12_lexical.search(docs, items.where("item_id in (3, 4)")).count() == 0


# 13


def plain_runs(words):
    n, found = len(words), {}
    for p in range(1, n // 4 + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(6, 4 * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def test_runs_against_plain_ones():
    rng = random.Random(7)
    for _ in range(1500):
        n, letters = rng.randint(0, 150), rng.choice([1, 2, 2, 3, 6])
        words = [rng.randrange(letters) for _ in range(n)]
        for _ in range(rng.randint(0, 3)):
            if n > 8:
                a, p = rng.randrange(n), rng.randint(1, 30)
                for k in range(a + p, rng.randint(a, n)):
                    words[k] = words[k - p]
        finder, step = op13_runs.Runs(), rng.randint(1, 40)
        for k in range(0, n, step):
            finder.append(words[k : k + step])
        assert finder.finish() == plain_runs(words)


@pytest.mark.parametrize("p", [1, 2, 3, 5, 8, 21, 341, 342, 700, 1500])
def test_long_periods_at_every_exponent(p):
    rng = random.Random(p)
    block = [rng.randrange(10**6) for _ in range(p)]
    for length in (4 * p - 1, 4 * p, 4 * p + 1, 9 * p + p // 2):
        words = [rng.randrange(10**6, 10**7) for _ in range(rng.randint(0, 50))]
        start = len(words)
        words += (block * 10)[:length] + [-1]
        finder = op13_runs.Runs()
        finder.append(words)
        assert finder.finish() == ([(start, length, p)] if length >= max(6, 4 * p) else [])


def test_entries_are_swept():
    finder = op13_runs.Runs()
    finder.append(list(range(100_000)))
    assert finder.finish() == [] and sum(map(len, finder._ends.values())) < 40


def test_block_sizes_cover_periods():
    for p in range(1, 2000):
        size = op13_runs.block_size(p)
        assert 2 * size - 1 <= 3 * p < 4 * size - 1


def plain_periodic(doc_id, text):
    words = WORD.findall((text or "").encode())
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
    gone = {k for s, length, p in runs for k in range(s + p, s + length)}
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    digest = hashlib.sha256("".join(f"{s},{length},{p}\n" for s, length, p in runs).encode()).hexdigest()
    return (doc_id, len(runs), *shown, digest, hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest())


def test_periodic(spark, docs, texts):
    found = op13_runs.periodic(docs, op13_runs.planted)
    assert found.columns == [c.split()[0] for c in op13_runs.OUT.split(", ")]
    assert sorted(map(tuple, found.collect()), key=str) == sorted((plain_periodic(i, t) for i, t in texts), key=str)


def test_periodic_edges(spark):
    rows = [(None, "a a a a a a"), (1, None), (2, ""), (3, " \x0b\t "), (4, "a a a a a"), (5, "a a a a a a"), (-7, "x y x y x y x y z z"), (30, "b" * 100), (30, "b" * 100), (11, "q w " * 300)]
    found = op13_runs.periodic(spark.createDataFrame(rows, "doc_id long, text string"), op13_runs.planted)
    assert sorted(map(tuple, found.collect()), key=str) == sorted((plain_periodic(i, t) for i, t in rows), key=str)
    assert op13_runs.periodic(spark.createDataFrame(rows[:1], "doc_id long, text string")).first()["n_runs"] == 1


def test_periodic_query(spark):
    rows = table(spark, SF, "documents").select("doc_id", "text").collect()
    found = registry.op13_periodic_runs(spark, SF).collect()
    assert sorted(map(tuple, found), key=str) == sorted((plain_periodic(i, t) for i, t in rows), key=str)


def test_periodic_of_no_documents(no_docs):
    assert op13_runs.periodic(no_docs).count() == 0
