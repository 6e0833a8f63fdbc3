"""Parquet datasets of chunks and vectors, JSON lines, listings, manifests: readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import fresh_dir

_S, _I, _L, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.TimestampType()
_FLOATS = T.ArrayType(T.FloatType())
CHUNKS = (
    T.StructType().add("doc_id", _S, False).add("chunk_id", _L, False).add("text", _S, False).add("tokens", _I, False).add("span", T.StructType().add("start", _I).add("end", _I))
    .add("created_at", _TS).add("schema_version", _S).add("section", _S).add("meta", T.MapType(_S, _S))
)
DENSE = T.StructType().add("uuid", _S, False).add("vec", _FLOATS).add("dim", _I).add("created_at", _TS)
SPARSE = T.StructType().add("uuid", _S, False).add("indices", T.ArrayType(_I)).add("weights", _FLOATS).add("created_at", _TS)
LEXICAL = T.StructType().add("uuid", _S, False).add("terms", T.ArrayType(_S)).add("weights", _FLOATS).add("created_at", _TS)
FAMILIES = {"dense": DENSE, "sparse": SPARSE, "lexical": LEXICAL}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in order; an error where one is missing or of another type."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    wrong = [f.name for f in schema if have.get(f.name) != f.dataType.simpleString()]
    if wrong:
        raise ValueError(f"columns do not match the schema: {', '.join(wrong)}")
    return df.select(*(f.name for f in schema))


def write_dataset(df: DataFrame, root: str, schema: T.StructType, mode: str = "append", **where: str) -> None:
    """Parquet (zstd) below root, by year and month of created_at in key=value folders, so that readers prune them."""
    path = "/".join([root.rstrip("/"), *(f"{k}={v}" for k, v in where.items())])
    out = conform(df, schema).withColumn("yyyy", F.date_format("created_at", "yyyy")).withColumn("mm", F.date_format("created_at", "MM"))
    out.write.mode(mode).option("compression", "zstd").partitionBy("yyyy", "mm").parquet(path)


def open_chunks(spark: SparkSession, root: str, columns: list[str] | None = None, where: str | None = None) -> DataFrame:
    return _scan(spark.read.parquet(f"{root.rstrip('/')}/fmt=parquet"), columns, where)


def open_vectors(spark: SparkSession, root: str, family: str, columns: list[str] | None = None, where: str | None = None) -> DataFrame:
    if family not in FAMILIES:
        raise ValueError(f"no vector family {family!r}")
    return _scan(spark.read.parquet(f"{root.rstrip('/')}/family={family}/fmt=parquet"), columns, where)


def _scan(df: DataFrame, columns: list[str] | None, where: str | None) -> DataFrame:
    df = df.where(where) if where else df
    return df.select(*columns) if columns else df


def summarize(df: DataFrame, key: str) -> dict:
    """Files, bytes and rows, rows by month folder, and up to ten ids."""
    files = df.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s")).groupBy("p").agg(F.max("s").alias("s"), F.count(F.lit(1)).alias("n"))
    one = files.agg(F.count(F.lit(1)).alias("files"), F.sum("s").alias("bytes"), F.sum("n").alias("rows")).first()
    months = df.groupBy("yyyy", "mm").count().collect() if {"yyyy", "mm"} <= set(df.columns) else []
    return {**one.asDict(), "months": {f"{r['yyyy']}-{r['mm']}": r["count"] for r in months}, "sample": [r[0] for r in df.select(key).limit(10).collect()]}


def partition_keys(path) -> dict:
    """Columns with family, fmt, yyyy and mm from a file path."""
    return {k: F.nullif(F.regexp_extract(path, f"{k}=([^/]+)", 1), F.lit("")) for k in ("family", "fmt", "yyyy", "mm")}


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, most_errors: int = 0) -> DataFrame:
    """JSON lines by schema; more broken lines than allowed are an error, others are left out. Lines are parsed once: good rows go to the shared folder while broken ones are counted."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    told, target = Observation(), fresh_dir(spark, "jsonl")
    df = spark.read.schema(full).option("mode", "PERMISSIVE").json(path)
    df.observe(told, F.count("_corrupt_record").alias("bad")).where("_corrupt_record is null").drop("_corrupt_record").write.parquet(target)
    if (bad := told.get["bad"]) > most_errors:
        raise ValueError(f"{bad} broken lines in {path}; {most_errors} are allowed")
    return spark.read.schema(schema).parquet(target)


def write_rows(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> None:
    """parquet, json (lines), csv (with a header) or orc."""
    w = df.write.mode(mode)
    (w.option("header", True) if fmt == "csv" else w).format(fmt).save(path)


def listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(relpath, size_bytes, mtime) of the files below root, without their content."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    rel = F.regexp_replace(F.col("path"), "^.*?" + root.rstrip("/").split("/")[-1] + "/", "")
    return df.select(rel.alias("relpath"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("mtime"))


def stage_listing(rows: DataFrame, root: str) -> None:
    """Replace the scopes in `rows` (scope, ...) in a table partitioned by scope; other scopes stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("scope").parquet(root)


def last_entries(manifest: DataFrame, key: str = "doc_id", order: str = "seq") -> DataFrame:
    from ..operators.catalog import latest

    return latest(manifest, [key], order)


def read_jdbc(spark: SparkSession, url: str, table_name: str, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, dbtable=table_name, **options).load()
