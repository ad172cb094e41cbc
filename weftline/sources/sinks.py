"""Writers: partitioned tables, and an upsert for plain Parquet folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FORECAST_KEY = ("run_date", "key", "month", "horizon", "model")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it; a local one only where nothing is named (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-weftline-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def kept(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared folder and read back: it is made once, however often it is read, and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/weftline-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, kind: str = "parquet", mode: str = "overwrite") -> None:
    writer = df.write.mode(mode).format(kind)
    if kind == "csv":
        writer = writer.option("header", True)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def merged(existing: DataFrame | None, new: DataFrame, key: tuple[str, ...] = FORECAST_KEY) -> DataFrame:
    """Old and new rows, one for each key; the new one wins."""
    rows = new.withColumn("_new", F.lit(1))
    if existing is not None:
        rows = rows.unionByName(existing.withColumn("_new", F.lit(0)), allowMissingColumns=True)
    others = [F.col(c) for c in new.columns if c not in key]
    newest = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("_new"), *others))
    return rows.withColumn("_place", newest).where("_place = 1").drop("_new", "_place")


def upsert(spark: SparkSession, path: str, new: DataFrame, version: int, key: tuple[str, ...] = FORECAST_KEY) -> str:
    """Write version `version` of a table: the version before it with `new` merged in. Returns the new version's path.

    A folder can't be overwritten while it is read, so versions stand side by side and readers take the path they are given.
    """
    from weftline.sources.files import read_optional

    existing = read_optional(spark, f"{path}/v{version - 1}", kind="parquet") if version else None
    to = f"{path}/v{version}"
    merged(existing, new, key).write.mode("errorifexists").parquet(to)
    return to
