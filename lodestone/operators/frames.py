"""Running sums, as-of joins and frames over time by ranges of time: a key with most rows is many tasks' work.

Rows are dealt to ranges of (key, time) at sampled splitters and written once. Within a range a window does the work; what a range hands on (a sum, the
last row) is a row a key and range, and is carried on by a window over those. Equal times of a key lie in one range, as frames by time need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import settle


def _before():
    return Window.partitionBy("__key").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)


def in_ranges(rows: DataFrame, by: list[str], ts: str) -> DataFrame:
    """rows with __key and __range: ranges follow (by, ts)."""
    key = F.struct(*(F.col(c).alias(f"k{i}") for i, c in enumerate(by))) if by else F.struct(F.lit(0).alias("k0"))
    placed = rows.withColumn("__key", key).repartitionByRange("__key", ts).withColumn("__range", F.spark_partition_id())
    return settle(placed, "ranges")


def _carried(placed: DataFrame, made: Column, what: Column) -> DataFrame:
    """(__key, __range, __ahead): `made` by key and range, and `what` a window over earlier ranges makes of it."""
    return placed.groupBy("__key", "__range").agg(made.alias("__one")).select("__key", "__range", what.alias("__ahead"))


def running_sum(rows: DataFrame, by: list[str], ts: str, value: str, name: str = "running") -> DataFrame:
    """rows with the sum of `value` (a whole or decimal number) over the rows of the key up to their time, those of equal time included."""
    placed = in_ranges(rows, by, ts)
    ahead = _carried(placed, F.sum(value), F.sum("__one").over(_before()))
    inner = F.sum(value).over(Window.partitionBy("__key", "__range").orderBy(ts).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    out = placed.withColumn("__inner", inner).join(ahead, ["__key", "__range"])
    both = F.when(F.col("__inner").isNull() & F.col("__ahead").isNull(), None).otherwise(F.coalesce("__inner", F.lit(0)) + F.coalesce("__ahead", F.lit(0)))
    return out.withColumn(name, both).drop("__key", "__range", "__inner", "__ahead")


def as_of(left: DataFrame, right: DataFrame, by: list[str], ts: str, take: list[str], tie: str | None = None, strict: bool = False) -> DataFrame:
    """left with the columns `take` of the last row of `right` of the same key at or before its time (before it, with `strict`); null where there is none. Of right rows of equal time the one of largest `tie` counts."""
    payload = F.struct(*(F.col(c).alias(c) for c in take))
    order = F.lit(0) if tie is None else F.col(tie)
    a = left.select(*by, ts, F.struct(*(F.col(f"`{c}`").alias(c) for c in left.columns)).alias("__left"), F.lit(0 if strict else 1).alias("__side"))
    b = right.where(F.col(ts).isNotNull()).select(*by, ts, payload.alias("__right"), F.lit(1 if strict else 0).alias("__side"), order.alias("__tie"))
    placed = in_ranges(a.unionByName(b, allowMissingColumns=True), by, ts)
    ahead = _carried(placed, F.max_by("__right", F.when(F.col("__right").isNotNull(), F.struct(ts, "__tie"))), F.last("__one", ignorenulls=True).over(_before()))
    w = Window.partitionBy("__key", "__range").orderBy(ts, "__side", "__tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = placed.withColumn("__inner", F.last("__right", ignorenulls=True).over(w)).where("__left is not null").join(ahead, ["__key", "__range"])
    got = F.when(F.col(ts).isNotNull(), F.coalesce("__inner", "__ahead"))
    return met.select("__left.*", *(got[c].alias(c) for c in take))


def recent_sum(rows: DataFrame, by: list[str], ts: str, value: str, span: int, name: str = "recent") -> DataFrame:
    """rows with the sum of `value` over the rows of the key from `span` before their time (a whole number) up to it, both ends included: a running sum less the running sum before the span."""
    total = running_sum(rows, by, ts, value, "__upto")
    steps = total.groupBy(*by, ts).agg(F.max("__upto").alias("__past"))
    shifted = total.withColumn("__now", F.col(ts)).withColumn(ts, F.col(ts) - F.lit(span))
    met = as_of(shifted, steps, by, ts, ["__past"], strict=True)
    return met.withColumn(name, F.col("__upto") - F.coalesce("__past", F.lit(0))).withColumn(ts, F.col("__now")).drop("__upto", "__past", "__now")
