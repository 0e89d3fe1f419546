"""The contract queries: each applies its operator to a whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerlight.llm.bpe import bpe_encode
from peerlight.llm.collocations import mine_collocations
from peerlight.llm.common import read_table
from peerlight.llm.decontaminate import find_contamination
from peerlight.llm.embeddings import near_duplicate_vectors
from peerlight.llm.htmltext import extract_main_text
from peerlight.llm.language import identify_language
from peerlight.llm.licenses import scan_licenses
from peerlight.llm.lines import dedup_lines
from peerlight.llm.ngrams import ngram_jaccard_join
from peerlight.llm.resampling import importance_resample
from peerlight.llm.secrets import KINDS, scan_secrets
from peerlight.llm.substrings import remove_repeats
from peerlight.llm.warc import warc_round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(query):
    QUERIES[query.__name__] = query
    return query


def vocabulary() -> tuple[str, str]:
    """Rank file and pattern of the public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@register
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc_round_trip(read_table(spark, folder, "pages"))


@register
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = find_contamination(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def joined_spans(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@register
def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_secrets(read_table(spark, folder, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(joined_spans(F.filter("spans", lambda s: s["kind"] != "guess")), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"),
        count("guess").alias("n_guess"),
        F.array_max(F.transform("spans", lambda s: s["cost"])).alias("max_guess_cost"),
    )


@register
def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    return identify_language(read_table(spark, folder, "documents"))


@register
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_lines(read_table(spark, folder, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


@register
def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path, pattern = vocabulary()
    decoded = bpe_encode(read_table(spark, folder, "documents"), path, pattern, decode=True, remembered=500_000)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


@register
def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_jaccard_join(read_table(spark, folder, "documents"))


@register
def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(read_table(spark, folder, "documents")).drop("license_spans")


@register
def op4_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_vectors(read_table(spark, folder, "embeddings")).drop("label")


@register
def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(read_table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@register
def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance_resample(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


@register
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return mine_collocations(read_table(spark, folder, "documents"))


@register
def op13_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract_main_text(read_table(spark, folder, "pages"))
