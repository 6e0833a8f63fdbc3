"""Row numbers in a global order, without a task that sorts or counts all rows of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import settle


def numbered(rows: DataFrame, by: list[str], order: str, name: str = "at") -> DataFrame:
    """rows with their place (from 0) in the order of a column of any type within `by`, null first; equal values are in any order.

    Rows are dealt to ranges at sampled splitters, whatever their spread or type, and written in order once; a range's rows are numbered as
    they lie, and counts of the ranges before carry the numbers on. Equal values are told apart, so that no value has to fit one range.
    """
    key = F.struct(*(F.col(c).alias(f"k{i}") for i, c in enumerate(by))) if by else F.struct(F.lit(0).alias("k0"))
    marked = rows.withColumn("__key", key).withColumn("__nth", F.monotonically_increasing_id())
    placed = marked.repartitionByRange("__key", order, "__nth").sortWithinPartitions("__key", order, "__nth").drop("__nth")
    placed = settle(placed.withColumn("__range", F.spark_partition_id()).withColumn("__placed", F.monotonically_increasing_id()), "numbered")
    # a row for each key and range that it lies in
    counts = placed.groupBy("__key", "__range").agg(F.count(F.lit(1)).alias("__n"), F.min("__placed").alias("__first"))
    before = F.sum("__n").over(Window.partitionBy("__key").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    ahead = counts.select("__key", "__range", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"))
    return placed.join(ahead, ["__key", "__range"]).withColumn(name, F.col("__placed") + F.col("__shift")).drop("__key", "__range", "__placed", "__shift")
