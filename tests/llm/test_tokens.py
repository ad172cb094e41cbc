"""Packing and separator scan against plain recomputations with the `tokenizers` library."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from weftline.llm import op6_separators, op10_packing


@pytest.fixture(scope="module")
def ids(texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return {i: t.encode(x or "", add_special_tokens=False).ids for i, x in texts}


def test_pieces(docs, texts, ids):
    rows = op10_packing.pack(docs).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for i in {i for i, _ in texts}:
        own = [*ids[i], 2]
        copies = sum(1 for j, _ in texts if j == i)
        n = -(-len(own) // 1024)
        assert sorted(r["piece"] for r in by_doc[i]) == sorted(list(range(n)) * copies)
        for r in by_doc[i]:
            part = np.array(own[r["start"] : r["start"] + r["length"]], "<u4")
            assert r["ids_crc32"] == zlib.crc32(part.tobytes()) and (r["length"] == 1024 or r["piece"] == 0)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024


def test_added_token_in_texts(spark):
    """Packing has the library's default ids; the separator scan reads the added token's text as plain, as its id separates documents."""
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>\n", "x<|endoftext|", " <|ENDOFTEXT|> ", "é<|endoftext|>é  <|endoftext|>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert t.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    expected = [np.array([*t.encode(x, add_special_tokens=False).ids, 2], "<u4") for x in texts]
    found = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in op10_packing.pack(docs).collect()}
    assert found == {k: (len(e), zlib.crc32(e.tobytes())) for k, e in enumerate(expected)}
    t.encode_special_tokens = True
    scanned = {r["doc_id"]: r["n_tokens"] for r in op6_separators.scan(op6_separators.write_flat(docs)).collect()}
    assert scanned == {k: len(t.encode(x, add_special_tokens=False).ids) for k, x in enumerate(texts)}


def test_packing_is_tight(spark):
    docs = spark.createDataFrame([(k, "word " * (k % 700)) for k in range(600)], "doc_id long, text string").coalesce(1)
    rows = op10_packing.pack(docs).collect()
    assert len({r["sequence_id"] for r in rows}) <= -(-sum(r["length"] for r in rows) // 1024) * 1.01 + 1


def test_open_bins_are_bounded():
    bins = op10_packing.OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]  # the third bin closes, being the fullest
    assert bins.open == 2
    assert bins.place(2) == (1, 7)  # best fit: the tighter of the two that are left
    assert bins.place(4) == (0, 6)


def plain_best_fit(batches, length, most):
    """(bin, offset) of each size, batch by batch the longest first: all open bins are looked through, the tightest one that fits takes it (of equal ones the last filled)."""
    out, free, filled, made, clock = [], {}, {}, 0, 0
    for sizes in batches:
        places = [None] * len(sizes)
        for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
            fits = [b for b in free if free[b] >= sizes[k]]
            if fits:
                b = min(fits, key=lambda b: (free[b], -filled[b]))
            else:
                b, made = made, made + 1
                free[b] = length
            places[k] = (b, length - free[b])
            free[b] -= sizes[k]
            clock += 1
            filled[b] = clock
            if not free[b]:
                del free[b]
            elif len(free) > most:
                del free[min(free, key=lambda b: (free[b], -filled[b]))]  # the fullest closes
        out.append(places)
    return out


@pytest.mark.parametrize("most", [1, 3, 40])
def test_places_by_plain_best_fit(spark, texts, ids, most):
    """Every place that the query gives, over several Arrow batches in a task, against a search through all open bins."""
    length, rows = 64, [(k, t) for k, (_, t) in enumerate(texts)]
    known = {k: ids[i] for k, (i, _) in enumerate(texts)}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        found = op10_packing.pack(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), length, most).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    pieces = []
    for k, _ in rows:
        n = len(known[k]) + 1
        pieces.append([n - length * (-(-n // length) - 1)] + [length] * (-(-n // length) - 1))
    batches = [[(k, p, size) for k in range(a, min(a + 20, len(rows))) for p, size in enumerate(pieces[k])] for a in range(0, len(rows), 20)]
    places = plain_best_fit([[size for *_, size in b] for b in batches], length, most)
    expected = {(k, p): (size, *place) for b, at in zip(batches, places) for (k, p, size), place in zip(b, at)}
    assert {(r["doc_id"], r["piece"]): (r["length"], r["sequence_id"], r["offset"]) for r in found} == expected


@pytest.mark.parametrize("block", [7, 64, 1 << 18])
def test_scan(docs, texts, ids, block):
    found = op6_separators.scan(op6_separators.write_flat(docs, block_tokens=block)).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in found) == sorted((i, len(ids[i])) for i, _ in texts)
    files = defaultdict(list)
    for r in found:
        files[r["file_id"]].append((r["doc_no"], r["start"], r["n_tokens"]))
        assert r["complete"]
    for rows in files.values():
        at = 0
        for k, (no, start, n) in enumerate(sorted(rows)):
            assert (no, start) == (k, at)
            at += n + 1


def test_flat_files_without_last_separator(spark, tmp_path):
    e = op6_separators.END_OF_DOCUMENT
    np.array([1, 2, e, e, 3, e, 4, 5], "<u2").tofile(tmp_path / "a.bin")
    np.array([e], "<u2").tofile(tmp_path / "b.bin")
    for block in (1, 3, 100):
        rows = op6_separators.scan(op6_separators.read_flat(spark, str(tmp_path), block)).collect()
        assert sorted((r["start"], r["n_tokens"], r["complete"]) for r in rows) == sorted([(0, 2, True), (3, 0, True), (4, 1, True), (6, 2, False), (0, 0, True)])


def test_no_rows(no_docs):
    assert op10_packing.pack(no_docs).count() == 0
    assert op6_separators.scan(op6_separators.write_flat(no_docs)).count() == 0


def test_rows_without_doc_id(spark):
    """They stay, and leave the other ids whole."""
    docs = spark.createDataFrame([(None, "one two"), (2**53 + 1, "three four five")], "doc_id long, text string").coalesce(1)
    assert {r["doc_id"] for r in op10_packing.pack(docs).collect()} == {None, 2**53 + 1}
    assert {r["doc_id"] for r in op6_separators.scan(op6_separators.write_flat(docs)).collect()} == {None, 2**53 + 1}
