"""Line dedup: maximal repeated runs of lines, by a suffix array over line IDs. DataFrame functions only.

1. A suffix starts at each line that is not blank; its first symbol is the line's 128-bit ID. Prefix doubling ranks suffixes by their first
   1, 2, 4, ... lines: level k + 1 ranks the pairs (rank of this suffix at level k, rank of the suffix 2**k lines on). The distinct
   pairs are sorted by range over the cluster, and their places in that order are the ranks, so equal ranks are equal lines. Suffixes
   whose prefix is found once are resolved and leave; doubling ends when all are.
2. Suffixes that share their first L lines and no more are a longest-common-prefix interval of length L. In it, every suffix but the first
   place has an earlier copy of L lines. For each suffix the longest such interval is found from its last level downwards: if
   it is not first among those that share L + d lines (d = 2**k-1, ..., 2, 1), L grows by d. Those that share L lines and
   are first at L + 2d, with the interval's own first place, are all that need to be compared, so each suffix is in one group a step.
3. The maximal repeated run from a suffix is that interval's length. Runs of `min_words` words or more go, but for the first place.
   Each line holds a word, so a longer run is covered by its parts of min_words lines or fewer: to delete, doubling stops at that many lines.
Groups are counted with map-side aggregation and written out, so each join back has two plain sides, which Spark splits where one group is large.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ONE_TASK, only_task, prepare, settle

MIN_WORDS = 10
GAP = "[\\x20\\x09-\\x0D]+"
FULL = "[^\\x20\\x09-\\x0D]"
#: A document is a doc_id (those without one come last) and a text.
DOC = ("key", "sub")
PLACE = ("key", "sub", "ord")
FIRST = ("fk", "fs", "fo")


def _key(docs: DataFrame) -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("key"), F.xxhash64(F.col("text").cast("string")).alias("sub")]


def suffixes(docs: DataFrame, min_words: int) -> DataFrame:
    """(key, sub, ord, line, last, h1, h2, words): lines that are not blank, in order, with their places and IDs; words stop at min_words."""
    lines = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("line"), x.alias("x")))
    some = docs.select(*_key(docs), F.posexplode(F.filter(lines, lambda s: s["x"].rlike(FULL))).alias("ord", "s"))
    words = F.size(F.filter(F.split("s.x", GAP, min_words + 2), lambda x: x != ""))
    return some.select(*PLACE, F.col("s.line").alias("line"), F.col("s.line").alias("last"), F.xxhash64("s.x").alias("h1"), F.xxhash64(F.lit(7), "s.x").alias("h2"), F.least(words, F.lit(min_words)).alias("words"))


def _groups(rows: DataFrame, by: list[str], whole: bool) -> DataFrame:
    """Of groups found at two places or more: their keys, rank (their place in the order of their keys) and first place."""
    place = F.struct(*PLACE)
    seen = only_task(rows, whole).groupBy(*by).agg(F.min(place).alias("first"), F.max(place).alias("end")).filter("first <> end")
    seen = seen.select(*by, *(F.col(f"first.{p}").alias(f) for p, f in zip(PLACE, FIRST)))
    seen = seen if whole else seen.repartitionByRange(*by)
    return only_task(settle(seen.sortWithinPartitions(*by).withColumn("rank", F.monotonically_increasing_id()), "ranks"), whole)


def _same(a: tuple, b: tuple) -> Column:
    return reduce(lambda x, y: x & y, (F.col(i) == F.col(j) for i, j in zip(a, b)))


def levels(docs: DataFrame, min_words: int, most: int | None = None) -> list[tuple[DataFrame, int]]:
    """Up to the level of `most` lines, if given: level k has (key, sub, ord, line, last, words, rank, fk, fs, fo) of the suffixes whose first 2**k lines are found again, with the first place of these lines; and its number of rows."""
    rows = settle(suffixes(docs, min_words), "suffixes")
    out: list[tuple[DataFrame, int]] = []
    by, whole = ["h1", "h2"], rows.count() <= ONE_TASK
    while True:
        found = only_task(rows, whole).join(_groups(rows, by, whole), by).select(*PLACE, "line", "last", "words", "rank", *FIRST)
        # rows that are repeated whole are one document
        found = settle(found if out else found.distinct(), "level")
        n = found.count()
        if not n:
            return out
        whole = n <= ONE_TASK
        out.append((found, n))
        if most is not None and 1 << len(out) > most:
            return out
        on = found.select(*DOC, F.col("ord").alias("at"), F.col("last").alias("to"), F.col("words").alias("more"), F.col("rank").alias("r2"))
        rows = only_task(found, whole).withColumn("at", F.col("ord") + F.lit(1 << (len(out) - 1))).join(only_task(on, whole), [*DOC, "at"])
        rows = settle(rows.select(*PLACE, "line", F.col("to").alias("last"), F.least(F.col("words") + F.col("more"), F.lit(min_words)).alias("words"), F.col("rank").alias("r1"), "r2"), "pairs")
        by = ["r1", "r2"]


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, most: int | None = None) -> DataFrame:
    """With `most`, runs of more than that many lines may be given as shorter ones of no fewer lines. (key, sub, ord, line, last, n, words, fk, fs, fo): for each suffix whose first line is found earlier, the longest run of n lines that is, and the first place of that run; words stop at min_words."""
    level = levels(docs, min_words, most)
    names = [*PLACE, "line", "last", "words", "rank", *FIRST, "n"]
    if not level:
        return docs.sparkSession.createDataFrame([], "key long, sub long, ord int, line int, last int, n int, words int, fk long, fs long, fo int")
    later = [x.filter(~_same(PLACE, FIRST)) for x, _ in level]
    held = None
    for k in range(len(level) - 1, -1, -1):
        # what is held at level k lies in that level
        whole = level[k][1] <= ONE_TASK
        here = only_task(later[k], whole)
        here = here if k + 1 == len(level) else here.join(only_task(later[k + 1].select(*PLACE), whole), [*PLACE], "left_anti")
        here = here.withColumn("n", F.lit(1 << k)).select(*names)
        held = here if held is None else only_task(held.unionByName(here), whole)
        if k:
            d = k - 1
            held = only_task(settle(held, "held"), whole)
            heads = held.select("n", "rank", *FIRST).distinct().select("n", "rank", *(F.col(f).alias(p) for p, f in zip(PLACE, FIRST)))
            all_ = only_task(held.select("n", "rank", *PLACE).unionByName(heads), whole).withColumn("at", F.col("ord") + F.col("n"))
            on = only_task(level[d][0], level[d][1] <= ONE_TASK).select(*DOC, F.col("ord").alias("at"), F.col("last").alias("to"), F.col("words").alias("more"), F.col("rank").alias("r2"))
            far = settle(all_.join(on, [*DOC, "at"]).select("n", F.col("rank").alias("r1"), "r2", *PLACE, "to", "more"), "far")
            grown = only_task(far, whole).join(_groups(far, ["n", "r1", "r2"], whole), ["n", "r1", "r2"]).filter(~_same(PLACE, FIRST))
            grown = grown.select(*PLACE, F.struct("to", "more", "rank", *FIRST).alias("g"))
            held = held.join(grown, [*PLACE], "left")
            step = {"last": "g.to", "rank": "g.rank", **{f: f"g.{f}" for f in FIRST}}
            made = {c: F.when(F.col("g").isNotNull(), F.col(x)).otherwise(F.col(c)) for c, x in step.items()}
            made["n"] = F.when(F.col("g").isNotNull(), F.col("n") + F.lit(1 << d)).otherwise(F.col("n"))
            made["words"] = F.when(F.col("g").isNotNull(), F.least(F.col("words") + F.col("g.more"), F.lit(min_words))).otherwise(F.col("words"))
            held = held.select(*(made[c].alias(c) if c in made else F.col(c) for c in names))
    return held.select(*PLACE, "line", "last", "n", "words", *FIRST)


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with `text` less the lines of later copies (n_chars follows where it is a column), and n_lines, n_removed.

    Lines end at a newline; lines of white space alone do not count in runs, and go with the run that they lie in. A line
    goes if it lies in a run of any number of lines, of min_words words or more in all, that also starts earlier, by
    doc_id and line. Null and empty texts stay as they are. Equal rows count as one document and are treated alike; rows of one doc_id
    with unlike texts are documents each, in the order of a hash of the text, as are rows without doc_id, after all others. An
    empty table gives no rows; other columns stay, whatever their names, but for n_lines and n_removed.
    """
    prepare(docs.sparkSession)
    # A line of a longer run lies in a part of it of min_words lines at most that has min_words words, and each such part is found for itself.
    runs = repeated_runs(docs.select("doc_id", F.col("text").cast("string").alias("text")), min_words, min_words).filter(F.col("words") >= min_words)
    gone = runs.select(*DOC, F.explode(F.sequence("line", "last")).alias("at")).groupBy(*DOC).agg(F.sort_array(F.collect_set("at")).alias("__gone"))
    # a flag for each line up to the last that goes: zeros over each gap, then a one
    before = F.transform("__gone", lambda x, j: F.when(j > 0, F.get("__gone", j - 1)).otherwise(F.lit(-1)))
    flags = F.array_join(F.zip_with("__gone", before, lambda x, y: F.concat(F.repeat(F.lit("0"), x - y - 1), F.lit("1"))), "")
    gone = settle(gone.select(F.col("key").alias("__key"), F.col("sub").alias("__sub"), F.size("__gone").cast("long").alias("__k"), F.split(flags, "").alias("__flags")), "gone")
    key, sub = _key(docs)
    out = docs.withColumn("__key", key).withColumn("__sub", sub).join(gone, ["__key", "__sub"], "left")
    marked = F.zip_with(F.split("text", "\n", -1), "__flags", lambda x, f: F.struct(x.alias("x"), f.alias("f")))
    kept = F.filter(marked, lambda s: s["x"].isNotNull() & (F.coalesce(s["f"], F.lit("0")) != "1"))
    text = F.when(F.col("__flags").isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda s: s["x"]), "\n"))
    made = {"text": text, "n_lines": F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long"), "n_removed": F.coalesce("__k", F.lit(0).cast("long"))}
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    out = out.select(*(made[c].alias(c) if c == "text" else F.col(f"`{c}`") for c in names), made["n_lines"].alias("n_lines"), made["n_removed"].alias("n_removed"))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("n_chars")))
    return out


def op4_lines(spark, sf_dir: str) -> DataFrame:
    out = dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"))


#: Each line of a run of ten words or more lies in a part of it of ten lines at most that has ten words too, so runs of 1 to 10 lines stand for all lengths.
OP4_SQL = r"""
WITH t AS (SELECT doc_id, string_split(COALESCE(text, ''), chr(10)) AS ls FROM documents),
x AS (SELECT doc_id, ls, unnest(list_filter(list_transform(range(1, len(ls) + 1), lambda i: {'i': i, 'x': ls[i]}), lambda s: regexp_matches(s.x, '[^ 	-
]'))) AS s FROM t),
n AS (SELECT doc_id, s.i AS i, s.x AS x, row_number() OVER (PARTITION BY doc_id ORDER BY s.i) AS o,
             len(regexp_extract_all(s.x, '[^ 	-
]+')) AS w FROM x),
a AS (SELECT doc_id, list(i ORDER BY o) AS li, list(x ORDER BY o) AS lx, list(w ORDER BY o) AS lw FROM n GROUP BY doc_id),
r AS (
  SELECT doc_id, o, li[o] AS f, li[o + k - 1] AS l, array_to_string(lx[o:o + k - 1], chr(10)) || ':' || k AS name
  FROM (SELECT *, unnest(range(1, len(li) + 1)) AS o FROM a), (SELECT unnest(range(1, 11)) AS k)
  WHERE o + k - 1 <= len(li) AND list_sum(lw[o:o + k - 1]) >= 10),
d AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY doc_id, o) AS c FROM r),
g AS (SELECT doc_id, list_distinct(flatten(list(range(f, l + 1)))) AS gone FROM d WHERE c > 1 GROUP BY doc_id)
SELECT t.doc_id, CAST(len(ls) AS BIGINT) AS n_lines, CAST(COALESCE(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN ls ELSE list_transform(list_filter(range(1, len(ls) + 1), lambda i: NOT list_contains(gone, i)), lambda i: ls[i]) END, chr(10))) AS kept_sha256
FROM t LEFT JOIN g ON t.doc_id = g.doc_id
"""
