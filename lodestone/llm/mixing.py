"""Mixing sources to target weights: exact quotas split among output shards by a multivariate-hypergeometric tree. DataFrame functions only.

1. Documents fall into blocks by a hash of doc_id, so a source of any size is many small blocks. Sizes are summed by block, then by source.
2. Targets: sources weigh 5, 2, 1, repeating, and share `share` times all words, each at most `most` times its own. The level at which
   the capped shares add up is found from the sources in order of the level at which each is full.
3. A source gives its blocks whole as many times as its target holds its size, then blocks in permuted order until
   the rest is reached; one block is left within, and one document in it.
4. The blocks that a source gives are its quota. A tree halves the shards; at each node the left half draws from each source in turn, hypergeometrically
   given what was drawn before, so that quotas stay exact. Shards then take disjoint runs of each source's permuted
   blocks, and documents are put in order within a shard by a hash.
Blocks are ordered within buckets of their order hash, and sums of buckets carry the order on, so no task sorts all blocks of a source.
Documents meet their block's row by one join, whose partitioning the order within a block reuses.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, settle

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK_DOCS = 256
SHARD_WORDS = 1_000_000
#: Rows in a bucket of a running order, in the mean.
BUCKET = 4096
#: Levels of the tree between two that deal its nodes anew.
DEAL_EVERY = 6
SEED = 11
GAP = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def _uniform(*keys) -> Column:
    """A number in (0, 1) from a hash."""
    return (F.pmod(F.xxhash64(*keys), F.lit(1 << 52)).cast("double") + 0.5) / F.lit(float(1 << 52))


def _ln_factorial(n: Column) -> Column:
    n = n.cast("double")
    return F.when(n < 2, F.lit(0.0)).otherwise(n * F.ln(n) - n + F.ln(n * F.lit(2 * math.pi)) / 2 + 1 / (n * 12) - 1 / (n * n * n * 360) + 1 / (n * n * n * n * n * 1260))


def _ln_choose(n: Column, k: Column) -> Column:
    return _ln_factorial(n) - _ln_factorial(k) - _ln_factorial(n - k)


def _let(value: Column, f) -> Column:
    """f of a value that is computed once, and named once in the plan."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """How many of `draws` out of `total` are among the `good`, by inverting the distribution at u; walks within 12 deviations of the mean."""

    def moments(a):
        mean = F.when(a["t"] > 0, a["d"] * a["g"] / a["t"]).otherwise(F.lit(0.0))
        var = F.when(a["t"] > 1, a["d"] * a["g"] / a["t"] * (1 - a["g"] / a["t"]) * (a["t"] - a["d"]) / (a["t"] - 1)).otherwise(F.lit(0.0))
        return _let(F.struct(mean.alias("mean"), F.sqrt(var).alias("dev")), lambda m: ends(a, m))

    def ends(a, m):
        low = F.greatest(F.lit(0.0), a["d"] + a["g"] - a["t"], F.floor(m["mean"] - 12 * m["dev"] - 1).cast("double"))
        high = F.least(a["g"], a["d"], F.ceil(m["mean"] + 12 * m["dev"] + 1).cast("double"))
        return _let(F.struct(low.alias("low"), high.alias("high")), lambda e: F.when(e["high"] <= e["low"], e["low"]).otherwise(walk(a, e)).cast("long"))

    def walk(a, e):
        p = F.exp(_ln_choose(a["g"], e["low"]) + _ln_choose(a["t"] - a["g"], a["d"] - e["low"]) - _ln_choose(a["t"], a["d"]))
        state = F.struct(p.alias("p"), F.lit(0.0).alias("sum"), e["low"].alias("x"), F.lit(False).alias("done"))

        def step(s, k):
            k = k.cast("double")
            done = s["sum"] + s["p"] >= a["u"]
            ratio = (a["g"] - k) * (a["d"] - k) / ((k + 1) * (a["t"] - a["g"] - a["d"] + k + 1))
            go = F.struct((s["p"] * ratio).alias("p"), (s["sum"] + s["p"]).alias("sum"), F.least(k + 1, e["high"]).alias("x"), F.lit(False).alias("done"))
            stop = F.struct(s["p"].alias("p"), s["sum"].alias("sum"), k.alias("x"), F.lit(True).alias("done"))
            return F.when(s["done"], s).when(done, stop).otherwise(go)

        return F.aggregate(F.sequence(e["low"].cast("long"), e["high"].cast("long")), state, step)["x"]

    return _let(F.struct(total.cast("double").alias("t"), good.cast("double").alias("g"), draws.cast("double").alias("d"), u.alias("u")), moments)


def _draw(seed: int, level: int):
    def draw(s, x):
        n = hypergeometric(s["left"], x, s["need"], _uniform(F.lit(seed), F.lit(level), F.col("shard"), s["i"]))
        return _let(n, lambda n: F.struct((s["left"] - x).alias("left"), (s["need"] - n).alias("need"), F.concat(s["got"], F.array(n)).alias("got"), (s["i"] + 1).alias("i")))

    return draw


def split_quotas(quotas: DataFrame, levels: int, seed: int = SEED) -> DataFrame:
    """quotas: one row with `q`, an array of counts. Gives (shard, q): 2**levels rows whose arrays add up to it, drawn without replacement."""
    nodes = quotas.select(F.lit(0).cast("long").alias("shard"), "q")
    for level in range(levels):
        if level and level % DEAL_EVERY == 0:
            nodes = settle(nodes, "nodes").repartition(min(1 << level, int(quotas.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "shard")
        whole = F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x)
        need = F.floor((whole + F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "shard"), F.lit(2))) / 2).cast("long")
        start = F.struct(whole.alias("left"), need.alias("need"), F.array().cast("array<long>").alias("got"), F.lit(0).cast("long").alias("i"))
        drawn = nodes.select("shard", "q", F.aggregate("q", start, _draw(seed, level))["got"].alias("a"))
        halves = F.array(F.struct((F.col("shard") * 2).alias("shard"), F.col("a").alias("q")), F.struct((F.col("shard") * 2 + 1).alias("shard"), F.zip_with("q", "a", lambda x, y: x - y).alias("q")))
        nodes = drawn.select(F.explode(halves).alias("n")).select("n.*")
    return settle(nodes, "quotas")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size) with rank (0 on, by code point, null last), weight and target."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    s = sources.withColumn("rank", rank).withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size").cast("double") * most)
    everything = Window.partitionBy()
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(by_fill), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_fill), F.lit(0.0)))
    s = s.withColumn("level", level)
    # the level that counts is that of the first source that it does not fill, the largest such one
    s = s.withColumn("level", F.max(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))).over(everything))
    target = F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return s.select("source", "source_size", F.col("rank").cast("long").alias("rank"), "weight", target.alias("target"))


def _running(rows: DataFrame, value: str, order: list[str], bucket: Column, what: str) -> DataFrame:
    """rows with `before`: the sum of `value` over the rows of the same rank that come earlier. bucket: a number that rises with the order; only rows of one bucket are sorted together."""
    rows = settle(rows.withColumn("g", bucket), what)
    sums = rows.groupBy("rank", "g").agg(F.sum(value).alias("v"))
    sums = sums.select("rank", "g", F.coalesce(F.sum("v").over(Window.partitionBy("rank").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    inner = Window.partitionBy("rank", "g").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(settle(sums, "buckets"), ["rank", "g"]).withColumn("before", F.col("ahead") + F.coalesce(F.sum(value).over(inner), F.lit(0))).drop("g", "ahead")


def _bucket(h: Column, n: int) -> Column:
    """One of n buckets of like width in the order of a 64-bit hash."""
    return F.floor((h.cast("double") / F.lit(2.0**64) + 0.5) * n).cast("long")


def plan(sized: DataFrame, seed: int = SEED, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Of rows with __s, __n (source, and whether it is null), __b (block) and __size: a row for each block with what is to be taken of it. No document is touched."""
    source = F.when(~F.col("__n"), F.col("__s")).alias("source")
    blocks = settle(sized.groupBy("__s", "__n", "__b").agg(F.sum("__size").alias("words")), "blocks")
    s = targets(blocks.groupBy(source).agg(F.sum("words").alias("source_size")))
    full = F.when(F.col("source_size") > 0, F.floor(F.round("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    s = settle(s.withColumn("full", full).withColumn("rest", F.round("target").cast("long") - F.col("full") * F.col("source_size")), "targets")
    parts = max(1, blocks.count() // BUCKET)
    rows = blocks.join(s, source.eqNullSafe(F.col("source"))).drop("source").withColumn("o", F.xxhash64(F.lit(seed), "rank", "__b"))
    rows = _running(rows, "words", ["o", "__b"], _bucket(F.col("o"), parts), "ordered")
    passes = (F.col("full") + (F.col("before") < F.col("rest")).cast("long")).cast("int")
    given = settle(rows.withColumn("passes", passes), "given")
    each = given.filter("passes > 0").select("rank", "__b", F.explode(F.sequence(F.lit(1), F.col("passes"))).alias("pass"), F.lit(1).alias("one"))
    each = _running(each.withColumn("o", F.xxhash64(F.lit(seed + 1), "rank", "__b", "pass")), "one", ["o", "__b", "pass"], _bucket(F.col("o"), parts), "passes")
    each = each.select("rank", "__b", "pass", (F.col("before") + 1).cast("long").alias("at"))
    total = s.agg(F.sum("target")).first()[0] or 0.0
    levels = max(0, math.ceil(math.log2(max(1.0, total / shard_words))))
    # one row of a count for each source
    counts = given.groupBy("rank").agg(F.sum("passes").cast("long").alias("n")).filter("n > 0")
    row = counts.agg(F.sort_array(F.collect_list(F.struct("rank", "n"))).alias("c")).select(F.transform("c", lambda x: x["n"]).alias("q"), F.transform("c", lambda x: x["rank"]).alias("ranks"))
    row = settle(row, "quota")
    shards = split_quotas(row.select("q"), levels, seed)
    # a shard takes a run of each source's permuted blocks
    runs = shards.withColumn("one", F.lit(1)).join(row.select("ranks", F.lit(1).alias("one")), "one")
    runs = runs.select("shard", F.explode(F.arrays_zip("ranks", "q")).alias("x")).select("shard", F.col("x.ranks").alias("rank"), F.col("x.q").alias("n")).filter("n > 0")
    runs = _running(runs, "n", ["shard"], F.floor(F.col("shard") / F.lit(BUCKET)).cast("long"), "runs")
    at = runs.select("rank", "shard", F.explode(F.sequence(F.col("before") + 1, F.col("before") + F.col("n"))).alias("at"))
    placed = each.join(at, ["rank", "at"]).groupBy("rank", "__b").agg(F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("p"))
    out = given.join(placed.select("rank", "__b", F.transform("p", lambda x: x["shard"]).alias("shards")), ["rank", "__b"], "left")
    out = out.select("__s", "__n", "__b", F.col("source_size").alias("__source_size"), F.col("target").alias("__target"), F.col("full").alias("__full"), F.col("rest").alias("__rest"), F.col("before").alias("__before"), F.coalesce("shards", F.array().cast("array<long>")).alias("__shards"))
    return settle(out, "plan")


def _sized(docs: DataFrame, block_docs: int, seed: int) -> DataFrame:
    blocks = max(1, docs.count() // block_docs)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    made = {
        "__size": F.regexp_count(text, F.lit(WORD)).cast("long"), "__b": F.pmod(F.xxhash64(F.lit(seed), "doc_id", text), F.lit(blocks)),
        "__s": F.coalesce("source", F.lit("")), "__n": F.col("source").isNull(), "__o": F.xxhash64(F.lit(seed + 2), "doc_id", text),
    }
    return docs.select("*", *(c.alias(n) for n, c in made.items()))


def _mixed(sized: DataFrame, seed: int, shard_words: int) -> DataFrame:
    """The sized rows with __source_size, __target, __taken and __shards."""
    by = ["__s", "__n", "__b"]
    out = sized.join(plan(sized.select(*by, "__size"), seed, shard_words), by)
    inner = Window.partitionBy(*by).orderBy("__o", "doc_id", "__size").rowsBetween(Window.unboundedPreceding, -1)
    part = F.greatest(F.lit(0), F.least("__size", F.col("__rest") - F.col("__before") - F.coalesce(F.sum("__size").over(inner), F.lit(0))))
    return out.withColumn("__taken", F.col("__full") * F.col("__size") + part)


def mix(docs: DataFrame, seed: int = SEED, block_docs: int = BLOCK_DOCS, shard_words: int = SHARD_WORDS, with_text: bool = True) -> DataFrame:
    """The documents (doc_id, source, text; other columns stay) with size, source_size, target, taken (words the mix takes of the document, repeats counted) and shards (the output shard of each time it is taken).

    Words are runs of characters other than 0x20 and 0x09 to 0x0D; null and empty texts have none, and nothing is taken of them.
    Null is a source of its own, last in order. At most one document of a source is taken in part; the others whole, as
    often as their block is. Blocks are drawn by doc_id and text, so rows without doc_id are spread too. Repeated rows are documents
    each (which of equal rows is cut does not matter). An empty table gives no rows. Columns of the input that have the
    names of results are left out; materialise() keeps them. Without with_text the text is left out, and words are counted once.
    Reruns over the same rows agree.
    """
    prepare(docs.sparkSession)
    made = ("size", "source_size", "target", "taken", "shards")
    kept = [c for c in docs.columns if c not in made and (with_text or c != "text")]
    sized = _sized(docs.select(*dict.fromkeys((*kept, "text"))), block_docs, seed)
    if not with_text:
        sized = settle(sized.drop("text"), "sized")
    return _mixed(sized, seed, shard_words).select(*(F.col(f"`{c}`") for c in kept), *(F.col(f"__{c}").alias(c) for c in made))


def materialise(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself, in the columns of `docs` whatever their names and values: each document as often as it is taken, the one in part cut after its words (n_chars follows), in shuffled order within each shard."""
    prepare(docs.sparkSession)
    m = _mixed(_sized(docs, BLOCK_DOCS, seed), seed, SHARD_WORDS).filter("__taken > 0")
    times = F.sequence(F.lit(1), F.ceil(F.col("__taken") / F.col("__size")).cast("int"))
    m = m.withColumn("__pass", F.explode(times))
    words = F.least(F.col("__size"), F.col("__taken") - (F.col("__pass") - 1) * F.col("__size"))
    m = m.withColumn("__words", words).withColumn("__shard", F.element_at("__shards", F.col("__pass")))
    # a text is cut where its first words end; the split is made for the one document of a source alone
    lead = F.when(F.substring("text", 1, 1).rlike("[\\x20\\x09-\\x0D]"), 1).otherwise(0)
    tail = F.when(F.col("__words") < F.col("__size"), F.element_at(F.split("text", GAP, F.col("__words").cast("int") + lead + 1), -1))
    cut = F.when(tail.isNull(), F.col("text")).otherwise(F.substring("text", F.lit(1), (F.length("text") - F.length(tail)).cast("int")))
    m = m.withColumn("__text", cut)
    made = {"text": F.col("__text"), "n_chars": F.when(F.col("__words") < F.col("__size"), F.length("__text")).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None}
    m = m.withColumn("__order", F.xxhash64(F.lit(seed + 3), "__o", "__pass"))
    kinds = dict(docs.dtypes)
    m = m.select("__shard", "__order", *(made[c].cast(kinds[c]).alias(c) if c in made else F.col(f"`{c}`") for c in docs.columns))
    return m.repartition("__shard").sortWithinPartitions("__shard", "__order").drop("__shard", "__order")


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix(docs, with_text=False).select("doc_id", "size", "source_size", "target", "taken", "shards")
