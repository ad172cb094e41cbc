"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HELD_OUT_FOLDS = 5
NO_ID = -(1 << 63)  # stands for no doc_id, so that ids stay whole numbers where pandas meets nulls


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one only where the session names none (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    own = spark.sparkContext.getCheckpointDir()
    if own is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-weftline-"))
        own = spark.sparkContext.getCheckpointDir()
    return own.rstrip("/")


def written(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Write a DataFrame to the shared folder and read it back: cuts the lineage, and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/weftline-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


SWEEPING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Meanwhile what a job has shuffled leaves the disk when the job ends, not when the driver's memory is cleaned. For steps that are written one after another."""
    before = spark.conf.get(SWEEPING, None)
    spark.conf.set(SWEEPING, "true")
    try:
        yield
    finally:
        spark.conf.unset(SWEEPING) if before is None else spark.conf.set(SWEEPING, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the fold that no classifier learns from."""
    return F.crc32(doc_id.cast("string")) % HELD_OUT_FOLDS == 0


def doc_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with null texts as empty ones and null ids as NO_ID; other columns, whatever their names, are left behind."""
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def with_ids(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The ids of doc_texts() as they were: null for NO_ID."""
    return df.withColumn(id_col, F.when(F.col(id_col) != NO_ID, F.col(id_col)))


def labelled_sample(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str, most: dict[int, int]) -> DataFrame:
    """At most most[c] rows of each class c for training, chosen by a hash of doc_id: (doc_id, label, text).

    Rows of the held-out fold and rows without a label never take part. The ids, at most most[0] + most[1] of
    them, are few enough to broadcast.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    usable = usable.where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    parts = [usable.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most[c]) for c in (0, 1)]
    ids = parts[0].unionByName(parts[1])
    return doc_texts(docs).join(F.broadcast(ids), "doc_id")


def bucketed(df: DataFrame, column: str, buckets: int, label: str) -> DataFrame:
    """df written to the shared folder in buckets of a column, so that joins and groups by it don't shuffle it.

    The table's name leaves the catalog at once; its files stay, as those of written() do.
    """
    spark = df.sparkSession
    name = f"weftline_{label}_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, column).option("compression", "none").option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name)
    found = spark.table(name)
    found.schema  # analysed while the catalog has the table
    spark.sql(f"drop table {name}")
    return found
