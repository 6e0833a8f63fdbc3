"""Percentile rules that operators name explicitly; they differ on small samples. Order statistics come from distributed selection.

linear      between neighbours at p * (n - 1)
inclusive   linear at ceil(100 p) hundredths: the cut points of 100 inclusive quantiles
index_floor sorted[int(n * p)], null past the end unless clamped
nearest     sorted[ceil(p * n) - 1]
index_span  sorted[int(p * (n - 1))]
middle      sorted[n // 2]

Selection counts values in ranges and narrows to the range that holds a rank, round by round: in a round, rows within the open ranges of their group are
counted in SPLIT parts with their least and largest value, which are the next range. A rank is found when its range holds one value.
No round sorts a group or holds its values, and partial counts come first, so a key with most rows is spread over all tasks.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import settle

SPLIT = 1024
#: Open ranges that are broadcast; more are joined by a shuffle.
MOST = 1 << 18
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

_RANKS = {
    "index_floor": lambda n, p: F.floor(n * p),
    "index_span": lambda n, p: F.floor((n - 1) * p),
    "nearest": lambda n, p: n - 1 if p >= 1 else F.greatest(F.ceil(n * p) - 1, F.lit(0)),
    "middle": lambda n, p: F.floor(n / 2),
}


def linear(col, p: float) -> Column:
    return F.percentile(col, F.lit(p))


def nearest(col, p: float) -> Column:
    name = col if isinstance(col, str) else col._jc.toString()
    return F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {name})")


def _part(whole: bool) -> Column:
    """The part (0 to SPLIT - 1) of the range lo..hi that a value lies in; it never falls as the value rises, and parts lo from hi."""
    v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
    if whole:
        return F.expr(f"cast((cast(v AS decimal(38, 0)) - lo) * {SPLIT} div (cast(hi AS decimal(38, 0)) - lo + 1) AS int)")
    # halves, as hi - lo may be beyond a double; what is not finite has parts of its own
    share = F.floor((v / 2 - lo / 2) / (hi / 2 - lo / 2) * SPLIT)
    inside = F.greatest(F.lit(0), F.least(share, F.lit(SPLIT - 1))).cast("int")
    inside = F.when(v == lo, 0).when(v == hi, SPLIT - 1).otherwise(inside)
    infinite = F.lit(float("inf"))
    ends = F.isnan(lo) | F.isnan(hi) | (lo == -infinite) | (hi == infinite) | (hi == -infinite) | (lo == infinite)
    # a range with ends that are not finite is told apart first: below zero, over zero, and the ends
    coarse = F.when(v == -infinite, 0).when(F.isnan(v), 5).when(v == infinite, 4).when(v < 0, 1).when(v == 0, 2).otherwise(3)
    return F.when(ends, coarse).otherwise(inside)


def select_ranks(df: DataFrame, keys: list[str], value: str, ranks: dict[str, Column], clamp: bool = False) -> DataFrame:
    """keys, n (values that are not null) and, for each of `ranks`, the value at that place (from 0; a column over n) in ascending order; null past the ends, or the end's value with `clamp`.

    Groups without a value are left out; null keys are a group. Values are numbers; NaN is the largest. Runs a few jobs over two columns at once.
    """
    kind = df.schema[value].dataType
    whole = isinstance(kind, _WHOLE)
    group = F.struct(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys))) if keys else F.struct(F.lit(0).alias("k0"))
    rows = df.where(F.col(value).isNotNull()).select(group.alias("g"), F.col(value).cast("long" if whole else "double").alias("v"))
    base = settle(rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")), "groups")
    place = lambda c: F.greatest(F.lit(0), F.least(c.cast("long"), F.col("n") - 1)) if clamp else c.cast("long")
    asked = F.explode(F.array(*(F.struct(F.lit(name).alias("name"), place(c).alias("rank")) for name, c in ranks.items())))
    open_ = base.select("g", "n", "lo", "hi", asked.alias("a")).select("g", "a.name", "a.rank", "lo", "hi", F.lit(0).cast("long").alias("below")).where((F.col("rank") >= 0) & (F.col("rank") < F.col("n")))
    found = [open_.where("lo = hi")]
    open_ = open_.where("lo < hi")
    at = ["g", "lo", "hi"]
    while not open_.isEmpty():
        ranges = open_.select(*at).distinct()
        ranges = F.broadcast(ranges) if ranges.limit(MOST + 1).count() <= MOST else ranges
        counts = rows.join(ranges, "g").where("v >= lo and v <= hi").groupBy(*at, _part(whole).alias("part")).agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("least"), F.max("v").alias("most"))
        # a window of at most SPLIT rows
        ahead = F.coalesce(F.sum("c").over(Window.partitionBy(*at).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        near = open_.join(counts.withColumn("ahead", ahead), at).where("rank - below >= ahead and rank - below < ahead + c")
        near = settle(near.select("g", "name", "rank", F.col("least").alias("lo"), F.col("most").alias("hi"), (F.col("below") + F.col("ahead")).alias("below")), "ranks")
        found.append(near.where("lo = hi"))
        open_ = near.where("lo < hi")
    got = reduce(DataFrame.unionByName, found).groupBy("g").agg(*(F.max(F.when(F.col("name") == name, F.col("lo"))).alias(name) for name in ranks))
    out = base.select("g", "n").join(got, "g", "left")
    return out.select(*(F.col(f"g.k{i}").alias(k) for i, k in enumerate(keys)), "n", *(F.col(name).cast(kind).alias(name) for name in ranks))


def order_statistics(df: DataFrame, keys: list[str], value: str, ps: dict[str, tuple[str, float]], clamp: bool = False) -> DataFrame:
    """keys and a column for each of `ps`, name to (rule, p)."""
    n = F.col("n")
    ranks: dict[str, Column] = {}
    made: dict[str, Column] = {}
    for i, (name, (rule, p)) in enumerate(ps.items()):
        if rule in _RANKS:
            ranks[f"r{i}"] = _RANKS[rule](n, p)
            made[name] = F.col(f"r{i}")
        elif rule in ("linear", "inclusive"):
            at = (n - 1) * (math.ceil(p * 100) / 100 if rule == "inclusive" else p)
            ranks[f"r{i}"], ranks[f"s{i}"] = F.floor(at), F.ceil(at)
            low, high, share = F.col(f"r{i}").cast("double"), F.col(f"s{i}").cast("double"), at - F.floor(at)
            made[name] = F.when(share == 0, low).otherwise(low * (1 - share) + high * share)
        else:
            raise ValueError(f"no such rule: {rule}")
    return select_ranks(df, keys, value, ranks, clamp).select(*keys, *(c.alias(name) for name, c in made.items()))


def by_index(df: DataFrame, keys: list[str], value: str, ps: dict[str, float], rule: str = "index_floor", clamp: bool = False) -> DataFrame:
    """A row for each group with the order statistics named in `ps`, all by one rule."""
    return order_statistics(df, keys, value, {name: (rule, p) for name, p in ps.items()}, clamp)
