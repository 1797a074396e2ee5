"""A training corpus from the documents table, in five stages; each stage's result is written as Parquet and read again for the next.

Every stage takes whole texts, keeps the columns of documents whatever else they are called, gives no rows for an empty table, and treats a null text
as empty. Where it matters, each stage says what becomes of nulls, ties and repeated rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import decontaminate, langid, mixing, ngramjoin, sharding, simhash
from docweave.llm.common import fold, shared_dir

SHARDS = 16


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null, or no letter) go; repeated rows each stay or go alike, ties between languages keep a row.

    Without any labelled text no language is known and all rows go.
    """
    return langid.spoken(docs, fold(F.col("doc_id"), 3) != 1)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (fingerprints within three bits, or four fifths of their five-word shingles in common) the row with the smallest doc_id stays (null last; ties by the hash of text and row); of equal rows one.

    Rows that share a doc_id but not their text are no copies and both stay. Null, empty and white-space texts are copies of each other.
    """
    return simhash.one_of_each(docs, ngramjoin.text_classes)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go; null texts hold none, repeated rows stay or go alike. An empty benchmark removes nothing."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice. Rows with equal ids are drawn together; rows without words are not taken; a null source is one of its own."""
    return mixing.repeated(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot; ties (equal texts) go by doc_id, null first, and repeated rows have a slot each. Columns of docs that clash with the stage's own results are kept as <name>_in (or <name>_in_in, ...)."""
    own, names = {"doc_id", "size", "text_crc32", "shard", "slot"}, {c.lower() for c in docs.columns}
    for c in [c for c in docs.columns if c.lower() in own - {"doc_id"}]:
        new = f"{c}_in"
        while new.lower() in names:
            new += "_in"
        names.add(new.lower())
        docs = docs.withColumnRenamed(c, new)
    rest = tuple(c for c in docs.columns if c.lower() not in own)
    return sharding.assign(docs, SHARDS, rest)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mix", mix), ("shard", shard)]

#: XXH64, suffix automata and the latent space have no DuckDB form; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
