"""Places and running sums over a whole table without bringing it into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.sources.sinks import kept


def placed(df: DataFrame, order: list[Column], running: dict[str, str] | None = None) -> DataFrame:
    """df with `place` (from 1 on) in an order without ties, and running sums {new column: column}.

    Rows are range-partitioned by the order, numbered and summed within their partitions, and shifted by what the partitions before them
    hold: only that table, a row a partition, is put in order in one task. The partitioned rows are written to the shared folder, so that both readings see the same ones, whatever executors are lost.
    """
    running = running or {}
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()})
    parts = kept(parts, "placed")
    sums = parts.groupBy("_part").agg(F.count("*").alias("_n"), *(F.sum(c).alias(f"_{name}") for name, c in running.items()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_before{c}") for c in ["_n", *(f"_{name}" for name in running)]))
    w = Window.partitionBy("_part").orderBy("_row")
    rows = parts.join(F.broadcast(offsets), "_part")  # a row a partition
    out = rows.withColumn("place", (F.row_number().over(w) + F.col("_before_n")).cast("long"))
    for name, c in running.items():
        out = out.withColumn(name, F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, 0)) + F.col(f"_before_{name}"))
    return out.select(*df.columns, "place", *running)
