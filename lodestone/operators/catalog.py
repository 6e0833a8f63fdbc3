"""The versioned catalog: versions, artifacts, files, validations.

versions (version_id, service, created_at, plan_hash), artifacts (artifact_id, version_id, service, size_bytes, status, fs_relpath), files (file_id,
artifact_id, version_id, relpath, format, size_bytes, cas_relpath), validations (validation_id, file_id, validator, passed, run_at).
Deletes and upserts give the table to write; a table format or a directory swap publishes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordering import numbered
from ..functions.scalars import ratio
from ..sources.shared import settle


def page(df: DataFrame, order: list[Column], limit: int | None = None, offset: int = 0, prefix: tuple[str, str] | None = None, **equal) -> DataFrame:
    """Optional equalities and a prefix, then order, offset and limit."""
    for name, value in equal.items():
        if value is not None:
            df = df.where(F.col(name) == value)
    if prefix:
        df = df.where(F.col(prefix[0]).startswith(prefix[1]))
    df = df.orderBy(*order)
    if offset:
        df = df.offset(offset)
    return df if limit is None else df.limit(limit)


def list_versions(versions: DataFrame, service=None, limit=None, offset=0) -> DataFrame:
    return page(versions, [F.desc("created_at"), F.asc("version_id")], limit, offset, service=service)


def list_files(files: DataFrame, version_id=None, format=None, prefix=None, limit=None, offset=0) -> DataFrame:
    return page(files, [F.asc("relpath"), F.asc("file_id")], limit, offset, ("relpath", prefix) if prefix else None, version_id=version_id, format=format)


def list_validations(validations: DataFrame, validator=None, passed=None, limit=None, offset=0) -> DataFrame:
    return page(validations, [F.desc("run_at"), F.asc("validation_id")], limit, offset, validator=validator, passed=passed)


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    return df.where(F.col(key) == value)


def files_of_artifacts(files: DataFrame, artifacts: DataFrame) -> DataFrame:
    return files.join(artifacts.select("artifact_id", "status"), "artifact_id")


def validations_of_version(validations: DataFrame, files: DataFrame, version_id: str | None = None) -> DataFrame:
    f = files if version_id is None else files.where(F.col("version_id") == version_id)
    return validations.join(f.select("file_id", "version_id"), "file_id")


def validation_failures(validations: DataFrame, files: DataFrame) -> DataFrame:
    """Failed validations with the file that each is of."""
    return validations.where(~F.col("passed")).join(files.select("file_id", "relpath", "version_id"), "file_id")


def artifact_stats(artifacts: DataFrame) -> DataFrame:
    of = lambda s: F.count_if(F.col("status") == s).alias(f"n_{s}")
    return artifacts.agg(F.count(F.lit(1)).alias("total"), F.sum("size_bytes").alias("bytes"), F.avg("size_bytes").cast("long").alias("avg_bytes"), of("fresh"), of("cached"), of("failed"))


def file_stats(files: DataFrame) -> DataFrame:
    return files.groupBy(F.coalesce("format", F.lit("unknown")).alias("format")).agg(F.count(F.lit(1)).alias("n"), F.sum("size_bytes").alias("bytes"), F.avg("size_bytes").cast("long").alias("avg_bytes"))


def validation_summary(validations: DataFrame) -> DataFrame:
    """By validator: totals and the share that passed, in percent."""
    passed = F.count_if("passed")
    return validations.groupBy("validator").agg(F.count(F.lit(1)).alias("total"), passed.alias("passed"), F.count_if(~F.col("passed")).alias("failed"), F.round(100.0 * ratio(passed, F.count(F.lit(1))), 2).alias("pass_percent"))


def version_stats(versions: DataFrame, files: DataFrame, validations: DataFrame) -> DataFrame:
    """By version: files, bytes, formats, files with a failed validation (files never validated do not count as failed)."""
    judged = validations.groupBy("file_id").agg(F.bool_or(~F.col("passed")).alias("bad"))
    f = files.join(judged, "file_id", "left").groupBy("version_id").agg(F.count(F.lit(1)).alias("n_files"), F.sum("size_bytes").alias("bytes"), F.count_distinct("format").alias("n_formats"), F.count_if("bad").alias("files_failed"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return versions.join(f, "version_id", "left").select("version_id", "service", *map(zero, ("n_files", "bytes", "n_formats", "files_failed")))


def storage_usage(files: DataFrame) -> DataFrame:
    """Bytes by version and format, with subtotals (null keys) by a rollup."""
    return files.select("version_id", F.coalesce("format", F.lit("unknown")).alias("format"), "size_bytes").rollup("version_id", "format").agg(F.count(F.lit(1)).alias("n"), F.sum("size_bytes").alias("bytes"))


def latest_summary(files: DataFrame, top: int = 5) -> tuple[DataFrame, DataFrame]:
    """Counts and bytes by format, and the largest files."""
    return file_stats(files), files.select("relpath", "size_bytes", "format", "file_id").orderBy(F.desc("size_bytes"), "file_id").limit(top)


def version_delta(files: DataFrame, a: str, b: str) -> DataFrame:
    """One row: files and bytes added, removed and common from version a to b, net bytes and churn. Each side is cut to its version before the full join."""
    side = lambda v, n: files.where(F.col("version_id") == v).groupBy("relpath").agg(F.sum("size_bytes").alias(n))
    j = side(a, "x").join(side(b, "y"), "relpath", "full_outer")
    added, removed = F.col("x").isNull(), F.col("y").isNull()
    s = lambda c, cond: F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0))
    out = j.agg(F.count_if(added).alias("added"), F.count_if(removed).alias("removed"), F.count_if(~added & ~removed).alias("common"), s("y", added).alias("bytes_added"), s("x", removed).alias("bytes_removed"), (F.coalesce(F.sum("y"), F.lit(0)) - F.coalesce(F.sum("x"), F.lit(0))).alias("net_bytes"))
    return out.withColumn("churn", F.least("added", "removed"))


def added_files(files: DataFrame, a: str, b: str) -> DataFrame:
    cut = lambda v: files.where(F.col("version_id") == v)
    return cut(b).join(cut(a).select("relpath"), "relpath", "left_anti")


def common_files(files: DataFrame, a: str, b: str) -> DataFrame:
    cut = lambda v: files.where(F.col("version_id") == v)
    return cut(b).join(cut(a).select("relpath"), "relpath", "left_semi")


def known_paths(artifacts: DataFrame, files: DataFrame) -> DataFrame:
    return artifacts.select(F.col("fs_relpath").alias("relpath")).unionByName(files.select(F.col("cas_relpath").alias("relpath"))).where("relpath is not null")


def orphans(listing: DataFrame, artifacts: DataFrame, files: DataFrame) -> DataFrame:
    """Listed paths that neither table knows, largest first."""
    return listing.join(known_paths(artifacts, files), "relpath", "left_anti").orderBy(F.desc("size_bytes"), "relpath")


def orphaned_artifacts(artifacts: DataFrame, files: DataFrame) -> DataFrame:
    return artifacts.join(files.select("artifact_id"), "artifact_id", "left_anti")


def orphaned_files(files: DataFrame, validations: DataFrame) -> DataFrame:
    """Files without a passed validation; one row a file."""
    return files.join(validations.where("passed").select("file_id"), "file_id", "left_anti")


def drift(listing: DataFrame, files: DataFrame) -> DataFrame:
    """Catalog against file system: missing, untracked, size differs."""
    d = files.groupBy(F.col("cas_relpath").alias("relpath")).agg(F.max("size_bytes").alias("db_bytes")).where("relpath is not null")
    j = d.join(listing.select("relpath", F.col("size_bytes").alias("fs_bytes")), "relpath", "full_outer")
    kind = F.when(F.col("fs_bytes").isNull(), "missing").when(F.col("db_bytes").isNull(), "untracked").when(F.col("db_bytes") != F.col("fs_bytes"), "size")
    return j.select("relpath", "db_bytes", "fs_bytes", kind.alias("drift")).where("drift is not null")


def beyond_latest(versions: DataFrame, n: int, by_service: bool = True) -> DataFrame:
    """Versions after the newest n (of each service)."""
    w = Window.partitionBy("service") if by_service else Window.partitionBy()
    return versions.withColumn("nth", F.row_number().over(w.orderBy(F.desc("created_at"), "version_id"))).where(F.col("nth") > n)


def older_than(df: DataFrame, ts: str, days: int, now) -> DataFrame:
    return df.where(F.col(ts) < F.lit(now).cast("timestamp") - F.expr(f"interval {days} days"))


def prune(tables: dict[str, DataFrame], gone: DataFrame) -> dict[str, DataFrame]:
    """All tables less the versions in `gone`: the cascade as anti joins."""
    out = {k: v.join(gone.select("version_id"), "version_id", "left_anti") for k, v in tables.items() if k != "validations"}
    if "validations" in tables:
        out["validations"] = tables["validations"].join(out["files"].select("file_id"), "file_id", "left_semi")
    return out


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Rebuild by key: the newest row by `order`, or the new one."""
    both = old.withColumn("__n", F.lit(0)).unionByName(new.withColumn("__n", F.lit(1)))
    w = Window.partitionBy(*keys).orderBy(*([F.desc(order)] if order else []), F.desc("__n"))
    return both.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r", "__n")


def register(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows whose keys are not there yet, once each."""
    return new.dropDuplicates(keys).join(old.select(*keys), keys, "left_anti")


def latest(df: DataFrame, keys: list[str], order: str, *tie: str) -> DataFrame:
    """The last row by key, by aggregation: no sort of whole groups."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(order, *tie)).alias("__v")).select(*keys, "__v.*")


def plan_diff(a: DataFrame, b: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """added, removed or modified (with the changed fields) between two plans."""
    x, y = a.select(key, F.struct(*fields).alias("x")), b.select(key, F.struct(*fields).alias("y"))
    j = x.join(y, key, "full_outer")
    changed = F.array_compact(F.array(*(F.when(~F.col(f"x.{f}").eqNullSafe(F.col(f"y.{f}")), F.lit(f)) for f in fields)))
    kind = F.when(F.col("x").isNull(), "added").when(F.col("y").isNull(), "removed").when(F.size(changed) > 0, "modified")
    return j.select(key, kind.alias("change"), F.when(kind == "modified", F.array_join(changed, ",")).alias("fields")).where("change is not null")


def resume(work: DataFrame, manifest: DataFrame, force: bool = False) -> DataFrame:
    """Work (item_id, input_hash, output_exists) against the last manifest entries: process or skip."""
    done = latest(manifest, ["item_id"], "seq").select("item_id", F.col("status").alias("__s"), F.col("input_hash").alias("__h"))
    skip = F.lit(not force) & F.col("output_exists") & F.col("__s").isin("success", "skip") & (F.col("__h") == F.col("input_hash"))
    return work.join(done, "item_id", "left").withColumn("action", F.when(F.coalesce(skip, F.lit(False)), "skip").otherwise("process")).drop("__s", "__h")


def growth(versions: DataFrame, files: DataFrame) -> DataFrame:
    """Bytes by version in order of time, with the change from the version before, by service."""
    f = files.groupBy("version_id").agg(F.sum("size_bytes").alias("bytes"))
    v = versions.join(f, "version_id", "left").select("service", "version_id", "created_at", F.coalesce("bytes", F.lit(0)).alias("bytes"))
    return v.withColumn("change", F.col("bytes") - F.lag("bytes").over(Window.partitionBy("service").orderBy("created_at", "version_id")))


def since(plans: DataFrame, cutoff, column: str = "last_modified") -> DataFrame:
    """Plans changed at or after the cutoff; those of unknown age stay."""
    return plans.where(F.col(column).isNull() | (F.col(column) >= F.lit(cutoff).cast("timestamp")))


def version_listing(rows: DataFrame) -> DataFrame:
    """Versions by the first time known of downloaded_at, last_modified, mtime, newest first."""
    return rows.withColumn("at", F.coalesce("downloaded_at", "last_modified", "mtime")).orderBy(F.desc_nulls_last("at"), "version_id")


def canonical_triples(triples: DataFrame) -> DataFrame:
    """Distinct (s, p, o) in order; the sort spills. Blank nodes are to be named beforehand."""
    return triples.select("s", "p", "o").distinct().orderBy("s", "p", "o")


def named_blanks(triples: DataFrame) -> DataFrame:
    """Distinct triples in order of (s, p, o), with blank nodes (_:x) renamed _:b0, _:b1, ... in the order in which they are first met there.

    Only the distinct blank nodes are numbered, in ranges of their order; triples are joined to their names. Names follow the labels: see `blank_colours` for what does not.
    """
    rows = triples.select("s", "p", "o").distinct()
    met = rows.select(F.struct("s", "p", "o").alias("at"), F.posexplode(F.array("s", "o")).alias("i", "x")).where(F.col("x").startswith("_:"))
    first = met.groupBy("x").agg(F.min(F.struct("at", "i")).alias("f"))
    names = numbered(first, [], "f").select("x", F.concat(F.lit("_:b"), F.col("at").cast("string")).alias("name"))
    a, b = names.select(F.col("x").alias("s"), F.col("name").alias("__s")), names.select(F.col("x").alias("o"), F.col("name").alias("__o"))
    out = rows.join(a, "s", "left").join(b, "o", "left")
    return out.orderBy("s", "p", "o").select(F.coalesce("__s", "s").alias("s"), "p", F.coalesce("__o", "o").alias("o"))


def _number(x) -> Column:
    """128 bits of SHA-256 as a pair of whole numbers, which add up in any order."""
    h = F.sha2(F.encode(x, "UTF-8"), 256)
    return F.array(*(F.conv(F.substring(h, at, 15), 16, 10).cast("decimal(38,0)") for at in (1, 16)))


def _added(pairs: Column) -> Column:
    return F.concat_ws(":", F.sum(F.get(pairs, F.lit(0))).cast("string"), F.sum(F.get(pairs, F.lit(1))).cast("string"))


def blank_colours(triples: DataFrame) -> DataFrame:
    """(x, colour) of each blank node of (s, p, o): a hash of what surrounds it, whatever it is called.

    In a round a node's colour takes up those of its neighbours, with predicate and direction; sums of hashes are partial first, so
    a node in most triples is no task's burden. Rounds end when they part no more nodes. Nodes that still share a colour look alike from
    everywhere that rounds reach.
    """
    rows = settle(triples.select("s", "p", "o").distinct(), "triples")
    is_blank = lambda c: F.col(c).startswith("_:")
    blanks = rows.where(is_blank("s")).select(F.col("s").alias("x")).union(rows.where(is_blank("o")).select("o")).distinct()
    colours, parts = settle(blanks.withColumn("colour", F.lit("blank")), "colours"), 1 if not blanks.isEmpty() else 0
    while True:
        seen = coloured(rows, colours)
        out = seen.where(is_blank("s")).select(F.col("s").alias("x"), F.concat_ws("\u001f", F.lit(">"), "p", "co").alias("e"))
        into = seen.where(is_blank("o")).select(F.col("o").alias("x"), F.concat_ws("\u001f", F.lit("<"), "p", "cs").alias("e"))
        around = out.union(into).groupBy("x").agg(_added(_number(F.col("e"))).alias("around"))
        new = colours.join(around, "x").select("x", F.sha2(F.encode(F.concat_ws("\u001f", "colour", "around"), "UTF-8"), 256).alias("colour"))
        new = settle(new, "colours")
        now = new.select("colour").distinct().count()
        if now <= parts:
            return new
        colours, parts = new, now


def coloured(rows: DataFrame, colours: DataFrame) -> DataFrame:
    """Triples with cs and co: their ends, or the colours of those that are blank."""
    a, b = (colours.select(F.col("x").alias(c), F.col("colour").alias(f"__{c}")) for c in ("s", "o"))
    out = rows.join(a, "s", "left").join(b, "o", "left")
    return out.select("s", "p", "o", F.coalesce(F.concat(F.lit("_:"), "__s"), F.concat(F.lit("="), "s")).alias("cs"), F.coalesce(F.concat(F.lit("_:"), "__o"), F.concat(F.lit("="), "o")).alias("co"))


def graph_hash(triples: DataFrame) -> DataFrame:
    """One row (n_triples, hash): equal for graphs that differ in the names of blank nodes only."""
    rows = triples.select("s", "p", "o").distinct()
    seen = coloured(rows, blank_colours(triples))
    one = seen.agg(F.count(F.lit(1)).alias("n_triples"), _added(_number(F.concat_ws("\u001f", "cs", "p", "co"))).alias("sum"))
    return one.select("n_triples", F.sha2(F.encode(F.concat_ws(":", F.col("n_triples").cast("string"), F.coalesce("sum", F.lit(""))), "UTF-8"), 256).alias("hash"))


def committed(versions: DataFrame, stages: dict[str, DataFrame]) -> DataFrame:
    """Versions with the first of the stages (in order: download, extract, validate, ...) that has no row for them; null where all are there, so that they may become latest."""
    out = versions
    for name, df in stages.items():
        out = out.join(df.select("version_id", F.lit(1).alias(f"__{name}")).distinct(), "version_id", "left")
    missing = F.coalesce(*(F.when(F.col(f"__{n}").isNull(), F.lit(n)) for n in stages))
    return out.withColumn("stopped_at", missing).drop(*(f"__{n}" for n in stages))


def latest_pointer(done: DataFrame) -> DataFrame:
    """By service the newest version whose stages are all there."""
    return done.where("stopped_at is null").groupBy("service").agg(F.max_by("version_id", F.struct("created_at", "version_id")).alias("version_id"))
