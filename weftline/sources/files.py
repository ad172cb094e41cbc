"""Split files: discovery, union with provenance, optional and required inputs, column variants."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Names that mean the same column in files of different origin.
VARIANTS = {"predicted": "predicted_units", "forecast_units": "predicted_units", "forecastunits": "predicted_units", "predictedunits": "predicted_units", "actual": "actual_units", "actualunits": "actual_units", "unitssold": "actual_units", "monthstart": "month", "horizonmonths": "horizon", "stylecodedesc": "style", "stylecolordesc": "color", "hasactual": "has_actual"}


def read_splits(spark: SparkSession, pattern: str | list[str], schema: StructType | str | None = None, kind: str = "csv") -> DataFrame:
    """All files that the pattern matches, with `source_file`; where none does, the pattern with _ for blanks is tried, and then it raises."""
    reader = spark.read.format(kind)
    if kind == "csv":
        reader = reader.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        found = reader.load(pattern)
    except AnalysisException as e:
        other = pattern.replace(" ", "_") if isinstance(pattern, str) else [p.replace(" ", "_") for p in pattern]
        if e.getCondition() != "PATH_NOT_FOUND" or other == pattern:
            raise
        found = reader.load(other)
    return found.withColumn("source_file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))


def listed(splits: DataFrame) -> DataFrame:
    """The source files in order, with their rows."""
    return splits.groupBy("source_file").agg(F.count("*").alias("n_rows")).orderBy("source_file")


def whole_union(parts: Iterable[DataFrame]) -> DataFrame:
    """union_of(), written to the shared folder and held against the number of its parts' rows while it is."""
    from weftline.sources import sinks, versions

    parts = list(parts)
    path = f"{sinks.shared_dir(parts[0].sparkSession)}/weftline-union-{uuid.uuid4().hex}"
    versions.write_union(parts, path)
    return parts[0].sparkSession.read.schema(union_of(parts).schema).parquet(path)


def read_lookups(spark: SparkSession, folder: str, names: Iterable[str] = ("item", "size", "style", "color"), kind: str = "csv") -> dict[str, DataFrame]:
    """The lookup tables of a folder by name; one that is missing raises."""
    return {name: read_splits(spark, f"{folder}/{name}*", kind=kind).drop("source_file") for name in names}


def union_of(parts: Iterable[DataFrame]) -> DataFrame:
    """Rows of all parts; a column that some lack is null there."""
    parts = list(parts)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def coverage(df: DataFrame, year: str = "acct_year") -> DataFrame:
    """Rows and years of each source file."""
    return df.groupBy("source_file").agg(F.count("*").alias("n_rows"), F.concat_ws(",", F.sort_array(F.collect_set(F.col(year).cast("string")))).alias("years"))


def read_first(spark: SparkSession, paths: list[str], **options: object) -> DataFrame:
    """The first path that exists: a newer file before an older one."""
    for path in paths:
        found = read_optional(spark, path, **options)
        if found is not None:
            return found
    raise FileNotFoundError(", ".join(paths))


def read_optional(spark: SparkSession, path: str, kind: str = "csv", schema: StructType | str | None = None) -> DataFrame | None:
    """None where the path doesn't exist."""
    reader = spark.read.format(kind)
    if kind == "csv":
        reader = reader.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.load(path)
        df.schema  # noqa: B018 - a missing path shows here
        return df
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def require(df: DataFrame, columns: Iterable[str], name: str = "table") -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{name} lacks {', '.join(missing)}")
    return df


def normalised(df: DataFrame) -> DataFrame:
    """Column variants under one name; has_actual as a boolean."""
    lowered = {c: c.lower().replace("_", "") for c in df.columns}
    known = {k.replace("_", ""): v for k, v in VARIANTS.items()}
    renamed = df.withColumnsRenamed({c: known[low] for c, low in lowered.items() if low in known and known[low] not in df.columns})
    if "has_actual" in renamed.columns:
        renamed = renamed.withColumn("has_actual", F.lower(F.col("has_actual").cast("string")) == "true")
    return renamed
