"""Suffix dedup and chosen-path join against brute force."""

import hashlib
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import components, op4_suffixes, op8_chosen_path


def words(rng, n):
    return " ".join("".join(rng.choice(["th", "er", "on", "an", "re", "ti", "es"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def suffix_truth(texts, span=50):
    rows = [(i, (t or "").encode()) for i, t in texts]
    first = {}
    for i, b in rows:
        for s in range(len(b) - span + 1):
            first[b[s : s + span]] = min(i, first.get(b[s : s + span], i))
    out = []
    for i, b in rows:
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - span + 1):
            if first[b[s : s + span]] < i:
                gone[s : s + span] = True
        n_spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(b), int(gone.sum()), n_spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out)


def test_suffixes(docs, texts):
    assert sorted(map(tuple, op4_suffixes.query(docs).collect())) == suffix_truth(texts)


def test_suffixes_of_hot_triggers(spark, docs, texts, monkeypatch):
    """Suffixes that are dealt one by one give the same result, in many blocks."""
    monkeypatch.setattr(op4_suffixes, "HOT_PHRASES", 1)
    monkeypatch.setattr(op4_suffixes, "BLOCK_BYTES", 2000)
    rng = random.Random(5)
    line = words(rng, 12)
    more = [(1000 + i, f"{words(rng, 3 + i % 9)} {line} {words(rng, 9)}") for i in range(60)]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string")).repartition(5)
    assert sorted(map(tuple, op4_suffixes.query(rows).collect())) == suffix_truth(texts + more)


def test_ranks_of_suffixes():
    rng = np.random.default_rng(2)
    raw = rng.integers(0, 2, 4000).astype(np.uint8)
    raw[1000:1200] = raw[:200]
    places = rng.permutation(len(raw) - op4_suffixes.SPAN)
    by_bytes = {b: k for k, b in enumerate(sorted({raw[p : p + op4_suffixes.SPAN].tobytes() for p in places}))}
    assert np.unique(op4_suffixes.suffix_ranks(raw, places), return_inverse=True)[1].tolist() == [by_bytes[raw[p : p + op4_suffixes.SPAN].tobytes()] for p in places]


def test_rows_without_doc_id_come_last(spark):
    text = "a passage that is long enough to be found again, and then some more of it"
    rows = spark.createDataFrame([(None, text), (3, text), (None, text), (2**53 + 1, "short")], "doc_id long, text string").coalesce(1)
    found = sorted((str(r["doc_id"]), r["n_removed"]) for r in op4_suffixes.query(rows).collect())
    assert found == sorted([("None", len(text)), ("None", len(text)), ("3", 0), (str(2**53 + 1), 0)])


def test_parse_is_independent_of_surroundings():
    rng = np.random.default_rng(1)
    shared = rng.integers(97, 100, 4000).astype(np.uint8)
    other = rng.integers(97, 100, 500).astype(np.uint8)
    a = op4_suffixes.parse(shared, np.array([4000]), np.array([1]))
    both = op4_suffixes.parse(np.concatenate([other, shared]), np.array([500, 4500]), np.array([0, 1]))
    m = both.documents == 1
    assert (both.starts[m] - 500 == a.starts).all() and (both.phrases[m] == a.phrases).all() and (both.triggers[m] == a.triggers).all()
    assert a.sizes.sum() == 4000 - 49  # every suffix in just one phrase


def test_empty_text_before_another():
    data = np.frombuffer(bytes(range(60)), np.uint8)
    p = op4_suffixes.parse(data, np.array([0, 60]), np.array([1, 2]))
    assert p.starts[0] == 0 and p.sizes.sum() == 11 and set(p.documents) == {2}


def test_long_documents_are_parsed_in_steps(monkeypatch):
    monkeypatch.setattr(op4_suffixes, "CHUNK_BYTES", 300)
    rng = np.random.default_rng(2)
    data = rng.integers(97, 101, 2000).astype(np.uint8)
    pieces = list(op4_suffixes._pieces(np.array([5]), np.array([2000]), data))
    begun = np.concatenate([np.concatenate([np.arange(s, s + n) for s, n in zip(p.starts, p.sizes)]) + at for at, p in pieces])
    assert sorted(begun.tolist()) == list(range(2000 - 49))


def test_kept_text_has_whole_characters(spark):
    docs = spark.createDataFrame([(1, "ab" + "é" * 40 + "cd", "x"), (2, "zz" + "é" * 40 + "yy", None)], "doc_id long, text string, note string")
    rows = {r["doc_id"]: r for r in op4_suffixes.deduplicated(docs).collect()}
    assert rows[1]["text"] == "ab" + "é" * 40 + "cd" and rows[1]["note"] == "x"
    assert rows[2]["text"] == "zzyy" and rows[2]["note"] is None


def test_all_columns_stay(docs):
    rows = docs.withColumns({"at": F.expr("timestamp'2020-01-02 03:04:05.123456'"), "plain": F.expr("timestamp_ntz'2020-01-02 03:04:05.123456'"), "many": F.expr("array(named_struct('k', decimal(1.25), 'm', map('a', 1)))"), "x0": F.lit(1.5), "raw": F.expr("X'00ff'")})
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("int"))
    out = op4_suffixes.deduplicated(rows)
    assert out.schema.simpleString() == rows.schema.simpleString() and out.count() == rows.count()
    others = [c for c in rows.columns if c not in ("text", "n_chars")]
    assert sorted(map(str, out.select(others).collect())) == sorted(map(str, rows.select(others).collect()))


def jaccard_truth(texts, threshold=0.8):
    sets = []
    for i, t in texts:
        w = (t or "").lower().split()
        sets.append((i, {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()))
    links, root = Counter(), {i: i for i, _ in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for (k, (a, x)), (m, (b, y)) in combinations(enumerate(sets), 2):
        if x and y and len(x & y) >= threshold * len(x | y) - 1e-9:
            links[k] += 1
            links[m] += 1
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return {i: (find(i), links[k]) for k, (i, _) in enumerate(sets)}


def test_join(docs, texts):
    rows = op8_chosen_path.join(docs).collect()
    assert len(rows) == len(texts)
    truth = jaccard_truth(texts)
    for r in rows:
        assert (r["class_id"], r["n_links"]) == truth[r["doc_id"]], r


def test_large_groups(spark, monkeypatch):
    """Groups beyond the sizes that one bucket and one block take, chains, and strangers that share a passage."""
    import random

    monkeypatch.setattr(op8_chosen_path, "SMALL", 8)
    monkeypatch.setattr(op8_chosen_path, "BLOCK", 16)
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for k in range(60):
        w = list(base)
        w[rng.randrange(120)] = f"x{k}"
        rows.append((k, " ".join(w)))
    chain = [f"c{rng.randrange(10**6)}" for _ in range(200)]
    rows += [(100 + k, " ".join(chain[4 * k : 4 * k + 120])) for k in range(20)]
    boiler = " ".join(f"b{k}" for k in range(40))
    rows += [(200 + k, boiler + " " + " ".join(f"s{rng.randrange(10**6)}" for _ in range(60))) for k in range(40)]
    rows = rows[::-1]
    found = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in op8_chosen_path.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == jaccard_truth(rows)


def test_one_of_each_class_stays(docs, texts):
    truth = jaccard_truth(texts)
    out = op8_chosen_path.deduplicated(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted({i for i, (c, _) in truth.items() if c == i})


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    import random

    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 130)]
    root = {n: n for e in edges for n in e}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in edges:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    found = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {n: find(n) for n in root if any(n in e and e[0] != e[1] for e in edges)}


def test_no_rows(no_docs):
    assert op4_suffixes.query(no_docs).count() == 0
    assert op8_chosen_path.join(no_docs).count() == 0


def test_join_leaves_rows_without_doc_id_alone(spark):
    docs = spark.createDataFrame([(None, "one two three four five six"), (2**53 + 1, "one two three four five six"), (None, "x")], "doc_id long, text string").coalesce(1)
    assert sorted(map(str, op8_chosen_path.join(docs).collect())) == sorted([f"Row(doc_id={2**53 + 1}, class_id={2**53 + 1}, n_links=0)", *["Row(doc_id=None, class_id=None, n_links=0)"] * 2])
    assert op8_chosen_path.deduplicated(docs).count() == 3


A, B, C = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")


def test_rows_of_one_id_with_other_texts(spark):
    """Sets are told apart by their texts: nothing is lost, and strangers that share an id aren't joined."""
    rows = [(5, A), (5, B), (7, B), (9, A), (5, A), (3, ""), (3, None), (3, " "), (4, C), (4, C.replace("c7", "x") + " y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("root", op8_chosen_path.F.lit("clash"))
    found = {}
    for r in op8_chosen_path.join(docs).where("doc_id in (5, 7, 9)").collect():
        found.setdefault(r["class_id"], []).append((r["doc_id"], r["n_links"]))
    assert sorted(sorted(rows) for rows in found.values()) == [[(5, 1), (7, 1)], [(5, 2), (5, 2), (9, 2)]]
    assert min(found) == 5 and max(found) >= 1 << 62
    kept = op8_chosen_path.deduplicated(docs)
    assert kept.columns == docs.columns
    texts = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert texts.count((5, A)) == 1 and texts.count((5, B)) == 1 and not {(7, B), (9, A)} & set(texts)
    assert len([t for t in texts if t[0] == 3]) == 2  # null and empty are one text, a blank is another
    assert len(texts) == 2 + 2 + len({t for t in texts if t[0] == 4})


def test_classes_without_an_id_of_their_own(spark):
    found = op8_chosen_path.join(spark.createDataFrame([(1, A), (1, B), (1, C), (2, C)], "doc_id long, text string")).collect()
    names = [r["class_id"] for r in found]
    assert len(set(names)) == 3 and sum(n == 1 for n in names) >= 1 and len({n for n in names if n >= 1 << 62}) == 2
    assert len({r["class_id"] for r in found if r["n_links"]}) == 1


def test_same_ids_in_large_groups(spark, monkeypatch):
    """Many rows under few ids, in components of several blocks: as many links as with ids of their own."""
    import random

    monkeypatch.setattr(op8_chosen_path, "SMALL", 8)
    monkeypatch.setattr(op8_chosen_path, "BLOCK", 16)
    rng = random.Random(6)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    texts = []
    for k in range(50):
        w = list(base)
        w[rng.randrange(120)] = f"x{k}"
        texts.append(" ".join(w))
    own = {r["doc_id"]: r["n_links"] for r in op8_chosen_path.join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    shared = op8_chosen_path.join(spark.createDataFrame([(k % 7, t) for k, t in enumerate(texts)], "doc_id long, text string")).collect()
    assert sorted(r["n_links"] for r in shared) == sorted(own.values()) and max(own.values()) > 20
