"""A corpus pipeline of five stages: toxicity, line dedup, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and is written as Parquet and read again for
the next. All but the last return the columns of `documents`. SQL can express neither the trained classifier nor the seeded
draws of the mix, so ORACLE_SQL is None; the tests compare each stage with a plain version on a small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm import jaccard, lines, mixing, packing, toxicity
from lodestone.llm.common import prepare, settle


#: Words that a packing worker remembers: fewer than alone, as workers also hold what earlier stages left.
WORD_CACHE = 150_000


def not_toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labelled rows of this table that are not held out."""
    prepare(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs, model, keep=tuple(docs.columns))
    return scored.filter("predicted = 0").select(*docs.columns)


def without_repeated_lines(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the lines of later copies of repeated runs; a document that loses all of its text goes."""
    out = lines.dedup(docs)
    return out.filter((F.col("n_removed") == 0) | F.col("text").rlike("[^\\x20\\x09-\\x0D]")).select(*docs.columns)


def one_of_each_group(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest doc_id, of each group that near duplicates join."""
    return jaccard.keep_one(docs).select(*docs.columns)


def mixed(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source weights: documents as often as they are taken."""
    return mixing.materialise(docs).select(*docs.columns)


def packed(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), cache=WORD_CACHE)


STAGES = [
    ("toxicity", not_toxic),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing", mixed),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = settle(docs, "stage")
    return docs
