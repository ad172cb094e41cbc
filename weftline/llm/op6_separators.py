"""Token counts by separator scan: find the documents of flat token files that have no index.

A flat file is one long run of little-endian 16-bit token ids in which an end-of-document id closes each
document; blocks of a fixed number of tokens cut through documents. Every block is searched on its own
with one vectorised comparison, and a prefix scan over the blocks of a file (sums of tokens and of separators,
and the last separator seen) stitches the documents that cross block borders.

Defined cases: a null or empty text is a document of 0 tokens; tokens after a file's last separator form one
more document with complete = false; a block without any separator only passes its tokens on; repeated rows are
documents of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import NO_ID, doc_texts, written
from .tokens import BYTE_BPE, encoder

#: The id that ends a document; the vocabulary's own ids stop just below it.
END_OF_DOCUMENT = 50_256
BLOCK_TOKENS = 1 << 18
BLOCKS = "file_id long, block_no long, data binary, doc_ids array<long>"


def write_flat(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, vocabulary: str = BYTE_BPE) -> DataFrame:
    """Tokenise documents into flat files, one for each task, kept as blocks in the shared folder.

    doc_ids names the documents whose separators a block holds: the scan doesn't read it to find documents, only
    to name them.
    """

    def flat(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe, file_id, block_no = encoder(vocabulary), TaskContext.get().partitionId(), 0
        if bpe.n_vocab > END_OF_DOCUMENT:
            raise ValueError("the vocabulary's ids reach the separator")
        parts: list[np.ndarray] = []
        held, ended = 0, []  # ended: (position after the separator, doc_id)

        def blocks(last: bool) -> Iterator[pd.DataFrame]:
            nonlocal parts, held, ended, block_no
            run = np.concatenate(parts) if parts else np.empty(0, "<u2")
            cut = 0
            while len(run) - cut >= block_tokens or last and cut < len(run):
                to = min(cut + block_tokens, len(run))
                yield pd.DataFrame({"file_id": [file_id], "block_no": [block_no], "data": [run[cut:to].tobytes()], "doc_ids": [[d for at, d in ended if cut < at <= to]]})
                block_no, cut = block_no + 1, to
            parts, held, ended = [run[cut:]], len(run) - cut, [(at - cut, d) for at, d in ended if at > cut]

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                parts.append(np.append(bpe.encode(text), np.uint32(END_OF_DOCUMENT)).astype("<u2"))
                held += len(parts[-1])
                ended.append((held, doc_id))
                if held >= block_tokens:
                    yield from blocks(last=False)
        yield from blocks(last=True)

    return written(doc_texts(docs).mapInPandas(flat, BLOCKS), "flat-tokens")


def read_flat(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of real flat files (little-endian uint16, up to Spark's 2 GB a binary value), numbered by a hash of their path."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file_id, content in zip(batch["file_id"], batch["content"]):
                size = 2 * block_tokens
                for k in range(0, len(content), size):
                    yield pd.DataFrame({"file_id": [file_id], "block_no": [k // size], "data": [content[k : k + size]], "doc_ids": [None]})

    files = spark.read.format("binaryFile").load(path).select(F.xxhash64("path").alias("file_id"), "content")
    return files.mapInPandas(cut, BLOCKS)


def scan(blocks: DataFrame, separator: int = END_OF_DOCUMENT) -> DataFrame:
    """Every document of the flat files: file_id, doc_no, start, n_tokens (separator excluded), complete, doc_id."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            runs = [np.frombuffer(x, "<u2") for x in batch["data"]]
            out = batch[["file_id", "block_no", "doc_ids"]].copy()
            out["n_tokens"] = [len(x) for x in runs]
            out["ends"] = [np.flatnonzero(x == separator).astype(np.int32) for x in runs]
            yield out

    found = blocks.mapInPandas(search, "file_id long, block_no long, doc_ids array<long>, n_tokens long, ends array<int>")
    # The prefix scan sees three numbers a block; its sums then come back to the blocks' separators.
    file = Window.partitionBy("file_id").orderBy("block_no")
    before = file.rowsBetween(Window.unboundedPreceding, -1)
    sums = found.select("file_id", "block_no", "n_tokens", F.size("ends").alias("n_ends"), F.when(F.size("ends") > 0, F.element_at("ends", -1)).alias("own_last"))
    sums = sums.select(
        "file_id",
        "block_no",
        "own_last",
        F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"),
        F.coalesce(F.sum("n_ends").over(before), F.lit(0)).alias("docs_before"),
        F.lead("block_no").over(file).isNull().alias("is_last"),
    )
    sums = sums.withColumn("last_end", F.col("base") + F.col("own_last") + 1)
    sums = sums.withColumn("carried_from", F.coalesce(F.max("last_end").over(before), F.lit(0))).drop("own_last")
    scanned = found.join(sums, ["file_id", "block_no"])
    # A file's last block may close with tokens that no separator follows.
    ends = F.transform("ends", lambda e: F.struct((F.col("base") + e).alias("end"), F.lit(True).alias("complete")))
    stop = F.col("base") + F.col("n_tokens")
    tail = F.when(F.col("is_last") & (F.coalesce("last_end", "carried_from") < stop), F.array(F.struct(stop.alias("end"), F.lit(False).alias("complete"))))
    scanned = scanned.withColumn("all_ends", F.concat(ends, F.coalesce(tail, F.array().cast("array<struct<end:bigint,complete:boolean>>"))))
    each = scanned.select("file_id", "docs_before", "carried_from", "all_ends", "doc_ids", F.posexplode("all_ends").alias("k", "doc"))
    start = F.when(F.col("k") == 0, F.col("carried_from")).otherwise(F.expr("all_ends[k - 1].end + 1"))
    return each.select(
        F.expr(f"nullif(get(doc_ids, k), {NO_ID + 1} - 1)").alias("doc_id"),
        "file_id",
        (F.col("docs_before") + F.col("k")).alias("doc_no"),
        start.alias("start"),
        (F.col("doc.end") - start).alias("n_tokens"),
        F.col("doc.complete").alias("complete"),
    )
