"""Versioned tables: data folders that count only once they are committed, partition-wise upserts, and checks made while writing.

A table is a folder with `data/version=<v>/` and `commits/version=<v>/`. A version's data are written first and its commit, one row, last; readers take
versions from the commits, so what a failed or stopped writer left is never read, and the next attempt writes over it. Versions may have
different columns. All is done by Spark's readers and writers, so a table may live in any store that Spark reaches.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weftline.sources.files import read_optional, union_of
from weftline.sources.sinks import FORECAST_KEY, kept, merged


class CheckFailed(ValueError):
    """What was written doesn't hold what it should."""


def counted(df: DataFrame, checks: dict[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """df with an observation of its rows and of how many break each check (a condition that bad rows fulfil), made by whatever action reads it."""
    seen = Observation()
    metrics = [F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in (checks or {}).items()]
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *metrics), seen


def write_checked(df: DataFrame, path: str, checks: dict[str, Column] | None = None, partition_by: Iterable[str] = (), mode: str = "overwrite") -> int:
    """Write and check in one job; raises CheckFailed, with what failed, after the data are written. Returns the number of rows."""
    rows, seen = counted(df, checks)
    rows.write.mode(mode).partitionBy(*partition_by).parquet(path)
    found = seen.get
    broken = {name: found[name] for name in checks or {} if found[name]}
    if broken:
        raise CheckFailed(f"{path}: " + ", ".join(f"{n} rows break {name}" for name, n in broken.items()))
    return found["n_rows"]


def write_union(parts: Iterable[DataFrame], path: str) -> int:
    """Write the rows of all parts, and hold their number against the parts' own, in one job."""
    each = [counted(p) for p in parts]
    n = write_checked(union_of(p for p, _ in each), path)
    expected = sum(seen.get["n_rows"] for _, seen in each)
    if n != expected:
        raise CheckFailed(f"the union has {n} rows, its parts {expected}")
    return n


def unique(df: DataFrame, *keys: str) -> DataFrame:
    """df, whose rows are told apart by the keys: reading it fails at a key that comes twice. One grouping, no second reading."""
    others = [c for c in df.columns if c not in keys]
    label = F.concat_ws(", ", *(F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys))
    once = F.when(F.count("*") == 1, F.any_value(F.struct(*others))).otherwise(F.raise_error(F.concat(F.lit("more than one row of "), F.first(label))))
    return df.groupBy(*keys).agg(once.alias("_rest")).select(*(F.col(c) if c in keys else F.col(f"_rest.{c}") for c in df.columns))


# Versions


def versions(spark: SparkSession, path: str) -> DataFrame:
    """(version, n_rows, columns) of what is committed, columns as a JSON schema; no rows where there is no table."""
    found = read_optional(spark, f"{path}/commits", kind="parquet", schema="n_rows long, columns string, version string")
    if found is None:
        return spark.range(0).select(F.lit("").alias("version"), F.col("id").alias("n_rows"), F.lit("").alias("columns"))
    return found.select("version", "n_rows", "columns")


def publish(df: DataFrame, path: str, version: str, partition_by: Iterable[str] = (), checks: dict[str, Column] | None = None) -> int:
    """Write a new version and commit it if it passes its checks. A committed version never changes: publishing it again raises."""
    spark = df.sparkSession
    if not versions(spark, path).where(F.col("version") == version).isEmpty():
        raise ValueError(f"version {version} of {path} is committed already")
    n = write_checked(df, f"{path}/data/version={version}", checks, partition_by)
    commit = spark.range(0, 1, 1, 1).select(F.lit(n).cast("long").alias("n_rows"), F.lit(df.schema.json()).alias("columns"))  # no Python worker for one row
    commit.write.mode("overwrite").parquet(f"{path}/commits/version={version}")
    return n


def read_version(spark: SparkSession, path: str, version: str) -> DataFrame | None:
    """One committed version in the columns it was written with; None where there is none."""
    row = versions(spark, path).where(F.col("version") == version).first()
    if row is None:
        return None
    schema = StructType.fromJson(json.loads(row["columns"]))
    return spark.read.schema(schema).parquet(f"{path}/data/version={version}").select(*schema.fieldNames())


def read_versions(spark: SparkSession, path: str, wanted: Iterable[str] | None = None) -> DataFrame | None:
    """The rows of all committed versions (or of those wanted that are there) with `version`; columns that a version lacks are null."""
    there = sorted(r["version"] for r in versions(spark, path).collect())  # a row a version
    parts = [read_version(spark, path, v).withColumn("version", F.lit(v)) for v in there if wanted is None or v in set(wanted)]
    return union_of(parts) if parts else None


# Upserts


def upsert_partitions(spark: SparkSession, path: str, new: DataFrame, key: tuple[str, ...] = FORECAST_KEY, partition: str = "month") -> None:
    """Merge rows into a table partitioned by one of the key's columns: only partitions that the new rows touch are read and written again.

    Merged rows are staged in the shared folder, as a folder can't be read while it is replaced; then they replace their partitions, and all other files stay
    as they are. A first call makes the table.
    """
    if partition not in key:
        raise ValueError(f"{partition} isn't part of the key, so rows could move between partitions")
    existing = read_optional(spark, path, kind="parquet")
    if existing is not None:
        types = dict(new.dtypes)
        existing = existing.withColumns({c: F.col(c).cast(t) for c, t in types.items() if c in existing.columns})
        existing = existing.join(F.broadcast(new.select(partition).distinct()), partition, "left_semi")  # a row a partition
    staged = kept(merged(existing, new, key), "upsert")
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
