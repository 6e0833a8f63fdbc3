"""Readers: counts from footers, batches, splits, rows by suffix, evaluation sets, manifests of several formats, telemetry records, listings with ignore patterns."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator
from fnmatch import translate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .partitioned import read_table


@contextlib.contextmanager
def _settings(spark: SparkSession, **conf: str):
    names = {k.replace("__", "."): v for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def count_footers(spark: SparkSession, path: str) -> int:
    """Rows by the Parquet footers alone: the count is pushed down to the second version of the source, for this query only."""
    with _settings(spark, spark__sql__sources__useV1SourceList="avro,csv,json,kafka,orc,text", spark__sql__parquet__aggregatePushdown="true"):
        return spark.read.parquet(path).agg(F.count(F.lit(1))).first()[0]


def footers(spark: SparkSession, df: DataFrame) -> DataFrame:
    """(file, rows, row_groups, metadata) of every file of a Parquet table; tasks read the footers, and no rows."""
    names = spark.createDataFrame([(f,) for f in df.inputFiles()], "file string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            files, told = batch.column(0).to_pylist(), []
            for name in files:
                system, path = fs.FileSystem.from_uri(name)
                with system.open_input_file(path) as f:
                    told.append(pq.read_metadata(f))
            meta = [[(k.decode(), v.decode("utf-8", "replace")) for k, v in (m.metadata or {}).items()] for m in told]
            columns = [pa.array(files), pa.array([m.num_rows for m in told], pa.int64()), pa.array([m.num_row_groups for m in told], pa.int32()), pa.array(meta, pa.map_(pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["file", "rows", "row_groups", "metadata"])

    return names.repartition("file").mapInArrow(run, "file string, rows long, row_groups int, metadata map<string,string>")


def problems(spark: SparkSession, path: str, schema: T.StructType, keys: tuple[str, ...] = ()) -> DataFrame:
    """(problem) for all that is wrong with a Parquet dataset: columns that are missing or of another type, any footer without the keys asked for, no rows."""
    df = spark.read.parquet(path)
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    out = [(f"{f.name}: {have.get(f.name, 'missing')}, not {f.dataType.simpleString()}",) for f in schema if have.get(f.name) != f.dataType.simpleString()]
    out += [] if count_footers(spark, path) else [("no rows",)]
    found = spark.createDataFrame(out, "problem string")
    missing = F.explode(F.filter(F.array(*(F.lit(k) for k in keys)).cast("array<string>"), lambda k: ~F.array_contains(F.map_keys("metadata"), k)))
    told = footers(spark, df).select("file", missing.alias("k"))
    return found.unionByName(told.select(F.concat("file", F.lit(": no "), "k", F.lit(" in its footer")).alias("problem")))


def head(df: DataFrame, n: int = 5) -> pa.Table:
    return df.limit(n).toArrow()


def batches(df: DataFrame, size: int) -> Iterator[pa.Table]:
    """Arrow tables of `size` rows; one partition at a time is with the driver."""
    held: list = []
    schema = df.limit(0).toArrow().schema
    make = lambda rows: pa.Table.from_pylist([r.asDict(recursive=True) for r in rows], schema)
    for row in df.toLocalIterator(prefetchPartitions=True):
        held.append(row)
        if len(held) == size:
            yield make(held)
            held = []
    if held:
        yield make(held)


def from_arrow(spark: SparkSession, table: pa.Table) -> DataFrame:
    return spark.createDataFrame(table)


def to_duckdb(df: DataFrame, connection, name: str) -> None:
    """Register a (small) result in a DuckDB connection."""
    connection.register(name, df.toArrow())


def read_rows(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Rows by the path's suffix: .jsonl, .json or .ndjson, .csv, else Parquet."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    reader = spark.read.schema(schema) if schema else spark.read
    if kind in ("jsonl", "json", "ndjson"):
        return reader.json(path)
    return reader.option("header", True).csv(path) if kind == "csv" else reader.parquet(path)


def rows_between(df: DataFrame, start: int, end: int | None, order: str) -> DataFrame:
    """Rows from `start` to before `end` in an order; the ones before are cut off by a top-k, not collected."""
    rows = df.orderBy(order)
    rows = rows.limit(end) if end is not None else rows
    return rows.offset(start)


def splits(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, length) of the byte ranges that tasks read of line-based files."""
    one = spark.read.text(path).select(F.input_file_name().alias("file"), F.input_file_block_start().alias("start"), F.input_file_block_length().alias("length"))
    return one.distinct()


EVALUATION = (
    T.StructType().add("document", T.StructType().add("doc_id", "string").add("namespace", "string").add("chunk_path", "string").add("vector_path", "string").add("metadata", T.MapType(T.StringType(), T.StringType())))
    .add("queries", T.ArrayType(T.StructType().add("query", "string").add("expected_doc_id", "string").add("namespace", "string")))
)


def read_evaluation(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(documents, queries) of an evaluation set in JSON lines."""
    rows = spark.read.schema(EVALUATION).json(path)
    return rows.select("document.*").where("doc_id is not null"), rows.select(F.explode("queries").alias("q")).select("q.*")


def read_sqlite(spark: SparkSession, path: str, table: str, schema: str, size: int = 1 << 20) -> DataFrame:
    """A table of an SQLite file that executors see; a task reads `size` rowids."""
    return read_table(spark, path.removeprefix("file://"), table, schema, size)


def previous_entries(spark: SparkSession, schema: T.StructType, jsonl: str | None = None, csv: str | None = None, sqlite: tuple[str, str] | None = None) -> DataFrame:
    """Manifest entries of earlier runs from all sources that are given, told apart by `origin` (sqlite is first, csv last)."""
    parts = []
    if sqlite:
        parts.append(read_sqlite(spark, *sqlite, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)).withColumn("origin", F.lit("sqlite")))
    if jsonl:
        parts.append(spark.read.schema(schema).json(jsonl).withColumn("origin", F.lit("jsonl")))
    if csv:
        parts.append(spark.read.schema(schema).option("header", True).csv(csv).withColumn("origin", F.lit("csv")))
    if not parts:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("origin", T.StringType())]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def telemetry_records(rows: DataFrame, cutoff=None, tier=None, source=None, ts: str = "ts") -> DataFrame:
    """Records after the cutoff, of a tier and a source, where they are given; the filters reach the scan."""
    if cutoff is not None:
        rows = rows.where(F.col(ts) > F.lit(cutoff).cast("timestamp"))
    for name, want in (("tier", tier), ("source", source)):
        if want is not None:
            rows = rows.where(F.col(name) == F.lit(want))
    return rows


def ignored(relpath, patterns: tuple[str, ...]) -> Column:
    """Whether a file is passed over: its name starts with a dot, or its name or path matches a shell pattern."""
    path = F.col(relpath) if isinstance(relpath, str) else relpath
    name = F.element_at(F.split(path, "/"), -1)
    out = name.startswith(".")
    for p in patterns:
        if p:
            rule = translate(p).removeprefix("(?s:").removesuffix(")\\Z").removesuffix(")\\z")
            out = out | name.rlike(f"(?s)^(?:{rule})$") | path.rlike(f"(?s)^(?:{rule})$")
    return out


def backup(df: DataFrame, path: str) -> dict:
    """A copy of a table with what tells whether it is whole: rows and a sum of row hashes."""
    df.write.mode("errorifexists").parquet(path)
    return checksum(df.sparkSession.read.parquet(path))


def checksum(df: DataFrame) -> dict:
    one = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")).alias("hash")).first()
    return {"rows": one["rows"], "hash": str(one["hash"] or 0)}


def recover(spark: SparkSession, path: str, expected: dict) -> DataFrame:
    """The copy, if it is still what backup() said."""
    df = spark.read.parquet(path)
    if checksum(df) != expected:
        raise ValueError(f"the copy in {path} is not what was saved")
    return df


def dashboard(summary: DataFrame, name: str, keys: list[str], style: str = "json") -> DataFrame:
    """Text lines of a summary's numbers: `json` a record a row, `prometheus` name_metric{key="..."} value, `panel` a title and target for each metric."""
    values = [c for c in summary.columns if c not in keys]
    if style == "json":
        return summary.select(F.to_json(F.struct(*sorted(summary.columns))).alias("line"))
    if style == "panel":
        return summary.sparkSession.createDataFrame([(f'{{"title":"{v}","target":"{name}_{v}"}}',) for v in values], "line string")
    labels = F.concat_ws(",", *(F.concat(F.lit(f'{k}="'), F.coalesce(F.col(k).cast("string"), F.lit("")), F.lit('"')) for k in keys))
    rows = F.array(*(F.struct(F.lit(v).alias("m"), F.col(v).cast("double").alias("v")) for v in values))
    one = summary.select(labels.alias("l"), F.explode(rows).alias("x")).where("x.v is not null")
    return one.select(F.concat(F.lit(f"{name}_"), "x.m", F.lit("{"), "l", F.lit("} "), F.expr("format_number(x.v, '0.######')")).alias("line"))
