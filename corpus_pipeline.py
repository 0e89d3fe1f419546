"""The corpus pipeline: language ID, line dedup, n-gram Jaccard join, decontamination, byte-level BPE."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerlight.llm.bpe import bpe_encode
from peerlight.llm.common import read_table
from peerlight.llm.decontaminate import find_contamination
from peerlight.llm.language import UNKNOWN, identify_language
from peerlight.llm.lines import dedup_lines
from peerlight.llm.ngrams import ngram_jaccard_join
from peerlight.llm.queries import vocabulary
from peerlight.sources.snapshots import materialize, shared_folder

# Ids of documents to leave out are broadcast up to this many (8 bytes each), else joined by a shuffle.
BROADCAST_IDS = 1_000_000


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, and NULL texts, have no language and go; all others stay as they are."""
    return identify_language(docs, carry=docs.columns).filter(F.col("lang_pred") != UNKNOWN).select("carried.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the lines that a document with a smaller id holds; every document stays, if need be empty."""
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    old = [c for c in docs.columns if c not in new]
    return dedup_lines(docs, carry=old).select(*[new[c].alias(c) if c in new else F.col(f"carried.`{c}`") for c in docs.columns])


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8) the document with the smallest id stays; rows without an id stay."""
    joined = ngram_jaccard_join(docs).filter("doc_id is not null")
    gone = materialize(joined.groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).filter("not kept").select("doc_id"))
    return docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone, "doc_id", "left_anti").select(*docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = find_contamination(docs, read_table(spark, sf_dir, "benchmark"), carry=docs.columns)
    return found.filter("n_hit = 0").select("carried.*")


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text and the digest of what they decode to."""
    path, pattern = vocabulary()
    return bpe_encode(docs, path, pattern, decode=True).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("ngram_jaccard", jaccard_stage),
    ("decontamination", benchmark_stage),
    ("byte_bpe", bpe_stage),
]

# Language models and byte-pair merges have no SQL form; tests compare the run with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`, each written to the shared folder and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/peerlight/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
