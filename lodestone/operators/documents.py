"""Documents: windows, chunks, coalescing, metadata, validation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import numbered
from ..functions.scalars import chunk_uuid, tokenize
from ..sources.shared import ship

#: Documents whose chunks are Python objects at a time.
AT_ONCE = 64

#: Texts that open a section (fixed values).
HEADING_MARKERS = ("#",)
CAPTION_MARKERS = ("Figure caption:", "Table:", "Picture description:", "<!-- image -->")


def sliding_windows(docs: DataFrame, size: int, overlap: int, tokens: Column | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Windows of `size` tokens that start every size - overlap tokens while tokens are left; the last may lie within the one before."""
    if not 0 <= overlap < size:
        raise ValueError("overlap is to be under size")
    t = docs.select(key, (tokens if tokens is not None else tokenize(text)).alias("t")).where(F.size("t") > 0)
    t = t.select(key, "t", F.posexplode(F.sequence(F.lit(0), F.size("t") - 1, F.lit(size - overlap))).alias("chunk", "start"))
    return t.select(key, "chunk", "start", F.slice("t", F.col("start") + 1, F.lit(size)).alias("tokens")).withColumn("n_tokens", F.size("tokens"))


def is_boundary(text, markers: tuple[str, ...] = HEADING_MARKERS + CAPTION_MARKERS) -> Column:
    return F.exists(F.array(*(F.lit(m) for m in markers)), lambda m: F.startswith(F.ltrim(text), m))


def _words(text: str) -> int:
    return len(text.split())


def merge(a: dict, b: dict, count=_words) -> dict:
    """Two neighbours: texts joined by a blank line, refs in order once each, pages sorted, the first offset, the best confidence."""
    text = a["text"].rstrip() + "\n\n" + b["text"].lstrip()
    return {
        "text": text, "tokens": count(text), "offset": min(a["offset"], b["offset"]), "boundary": a["boundary"],
        "refs": list(dict.fromkeys([*a["refs"], *b["refs"]])), "pages": sorted({*a["pages"], *b["pages"]}), "confidence": max(a["confidence"], b["confidence"]),
    }


def coalesce_rows(rows: list[dict], least: int, most: int = 512, count=_words) -> list[dict]:
    """Greedy: a record under `least` tokens takes its followers until it is large enough, the sum would be over `most`, or a section starts."""
    out, i = [], 0
    while i < len(rows):
        cur = rows[i]
        i += 1
        while cur["tokens"] < least and i < len(rows) and not rows[i]["boundary"]:
            joined = merge(cur, rows[i], count)
            if joined["tokens"] > most:
                break
            cur = joined
            i += 1
        out.append(cur)
    return out


def coalesce_small_runs(chunks: DataFrame, least: int, most: int = 512) -> DataFrame:
    """chunks (doc_id, chunk, text, tokens, offset, boundary, refs, pages, confidence) after coalescing within each document, in order of chunk."""

    kinds = {"text": pa.string(), "tokens": pa.int32(), "offset": pa.int32(), "refs": pa.list_(pa.string()), "pages": pa.list_(pa.int32()), "confidence": pa.float64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                docs, numbers, out = [], [], []
                for doc, rows in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    rows.sort(key=lambda r: r["chunk"])
                    for r in rows:
                        r["refs"], r["pages"] = r["refs"] or [], r["pages"] or []
                    rows = coalesce_rows(rows, least, most)
                    docs += [doc] * len(rows)
                    numbers += range(len(rows))
                    out += rows
                columns = [pa.array(docs, pa.int64()), pa.array(numbers, pa.int32()), *(pa.array([r[c] for r in out], k) for c, k in kinds.items())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "chunk", *kinds])

    ship(chunks.sparkSession)
    rows = F.collect_list(F.struct("chunk", "text", "tokens", "offset", "boundary", "refs", "pages", "confidence")).alias("rows")
    whole = chunks.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(rows)
    return whole.mapInArrow(run, "doc_id long, chunk int, text string, tokens int, offset int, refs array<string>, pages array<int>, confidence double")


def _sums_before(numbers: pa.Array) -> pa.Array:
    """For each list of whole numbers the sum of those before each one; one pass over all of them."""
    n, flat = numbers.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), numbers.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(n)
    before = np.append(0, np.cumsum(flat, dtype=np.int64))
    out = before[:-1] - np.repeat(before[ends - n], n)
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(out.astype(np.int32)))


def paragraphs(docs: DataFrame) -> DataFrame:
    """A chunk for each line that is not blank, with its words, offset and whether it opens a section."""
    lines = F.split("text", "\n", -1)
    ship(docs.sparkSession)
    starts = F.arrow_udf(_sums_before, "array<int>")(F.transform(lines, lambda x: F.length(x) + 1))
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", F.posexplode(F.arrays_zip(lines.alias("x"), starts.alias("o"))).alias("chunk", "l"))
    rows = rows.select("doc_id", "chunk", F.col("l.x").alias("text"), F.col("l.o").alias("offset")).where(F.trim("text") != "")
    return rows.withColumn("tokens", F.size(F.filter(F.split("text", "\\s+"), lambda w: w != ""))).withColumn("boundary", is_boundary(F.col("text")))


def with_uuids(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("uuid", chunk_uuid(F.col("doc_id").cast("string"), F.col("offset"), F.col("text")))


def validated(rows: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all rules, and the quarantine with the names of those broken (an unknown outcome breaks a rule)."""
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items())))
    marked = rows.withColumn("broken", broken)
    return marked.where(F.size("broken") == 0).drop("broken"), marked.where(F.size("broken") > 0)


def pairing(chunks: DataFrame, vectors: DataFrame, key: str = "uuid") -> DataFrame:
    """Rows without a partner on either side; empty when each chunk has its vector."""
    a = chunks.join(vectors.select(key), key, "left_anti").select(key, F.lit("no vector").alias("problem"))
    return a.unionByName(vectors.join(chunks.select(key), key, "left_anti").select(key, F.lit("no chunk").alias("problem")))


def sparsity(vectors: DataFrame, weights: str = "weights") -> DataFrame:
    """Share of zero weights and mean number of the others."""
    full = F.size(F.filter(weights, lambda w: w > 0))
    return vectors.agg(F.avg(full).alias("mean_nonzero"), (1 - F.sum(full) / F.sum(F.size(weights))).alias("zero_share"), F.count_if(full == 0).alias("empty_rows"))


def batches(rows: DataFrame, length: str, size: int, key: str) -> DataFrame:
    """Batches of like lengths (to a power of two), so that padding stays small; rows go in the order of an integer key."""
    bucket = F.ceil(F.log2(F.greatest(F.col(length), F.lit(1)).cast("double"))).cast("int")
    out = numbered(rows.withColumn("bucket", bucket), ["bucket"], key, "__at")
    return out.withColumn("batch", F.floor(F.col("__at") / F.lit(size))).drop("__at")


def case_collisions(paths: DataFrame) -> DataFrame:
    from ..functions.scalars import casefold

    return paths.groupBy(casefold(F.col("relpath")).alias("folded")).agg(F.count_distinct("relpath").alias("n")).where("n > 1")


def one_per_path(entries: DataFrame, policy: str = "first_wins") -> DataFrame:
    """Archive entries (relpath, seq): the first or the last of each path, or an error where there are several."""
    if policy == "reject":
        if not entries.groupBy("relpath").count().where("count > 1").isEmpty():
            raise ValueError("a path is there twice")
        return entries
    rest = F.struct(*(c for c in entries.columns if c != "relpath"))
    pick = F.min_by if policy == "first_wins" else F.max_by
    return entries.groupBy("relpath").agg(pick(rest, "seq").alias("__v")).select("relpath", "__v.*")


def refs_and_pages(chunks: DataFrame) -> DataFrame:
    """chunks (doc_id, chunk, items: array of (ref, pages)) with refs once each in order, and pages over 0 once each, sorted."""
    refs = F.array_distinct(F.filter(F.transform("items", lambda x: x["ref"]), lambda r: r.isNotNull() & (r != "")))
    pages = F.flatten(F.transform("items", lambda x: F.coalesce(x["pages"], F.array().cast("array<string>"))))
    pages = F.array_sort(F.array_distinct(F.filter(F.transform(pages, lambda p: p.try_cast("int")), lambda p: p > 0)))
    return chunks.select("doc_id", "chunk", refs.alias("refs"), pages.alias("pages"))


def image_summary(chunks: DataFrame) -> DataFrame:
    """chunks (doc_id, chunk, text, images: array of (captioned, classified, confidence, classes: array of (label, confidence))) with has_caption, has_classification, num_images, the best confidence and the labels."""
    marked = F.exists(F.array(*(F.lit(m) for m in CAPTION_MARKERS[:3])), lambda m: F.contains(F.col("text"), m)) | F.startswith(F.trim("text"), F.lit(CAPTION_MARKERS[3]))
    classes = F.flatten(F.transform("images", lambda x: x["classes"]))
    return chunks.select(
        "doc_id", "chunk", (marked | F.exists("images", lambda x: x["captioned"])).alias("has_caption"), (F.exists("images", lambda x: x["classified"]) | (F.size(classes) > 0)).alias("has_classification"),
        F.size("images").alias("num_images"), F.array_max(F.concat(F.transform("images", lambda x: x["confidence"]), F.transform(classes, lambda c: c["confidence"]))).alias("confidence"),
        F.filter(F.transform(classes, lambda c: c["label"]), lambda x: x.isNotNull()).alias("labels"),
    )


def text_metadata(docs: DataFrame, key: str = "doc_id", text: str = "text", preview: int = 500) -> DataFrame:
    """The first line as title where it is under 200 characters, and the start of the text."""
    first = F.trim(F.split(text, "\n", 2)[0])
    return docs.select(key, F.when(F.length(first) < 200, first).alias("title"), F.substring(text, 1, preview).alias("preview"))


def json_metadata(docs: DataFrame, key: str = "doc_id", body: str = "text", preview: int = 500) -> DataFrame:
    """title (or name), description, keywords and the start of content (or text) of JSON objects; other bodies give nulls."""
    got = lambda *names: F.coalesce(*(F.nullif(F.get_json_object(body, f"$.{n}"), F.lit("")) for n in names))
    return docs.select(key, got("title", "name").alias("title"), got("description").alias("description"), F.from_json(F.get_json_object(body, "$.keywords"), "array<string>").alias("keywords"), F.substring(got("content", "text"), 1, preview).alias("preview"))


#: What each profile takes out, in order; permissive takes nothing (patterns, fixed values).
BALANCED = (r"(?is)<script\b.*?</script>", r"(?is)<style\b.*?</style>")
STRICT = (
    *BALANCED, r"(?is)<iframe\b.*?</iframe>", r"(?i)<link\b[^>]*rel=\s*['\"]?stylesheet[^>]*>", r"(?i)<meta\b[^>]*>", r"(?s)<!--.*?-->",
    r"(?i)\s+on[a-z]+\s*=\s*(\".*?\"|'[^']*'|[^\s>]+)",
)
PROFILES = {"permissive": (), "balanced": BALANCED, "strict": STRICT}


def sanitised(html, profile: str = "balanced") -> Column:
    """HTML under a profile: `permissive` as it is; `balanced` without scripts and styles; `strict` also without frames, style sheet links, meta elements, comments and event handlers."""
    out = F.col(html) if isinstance(html, str) else html
    for pattern in PROFILES[profile.lower()]:
        out = F.regexp_replace(out, pattern, "")
    return out
