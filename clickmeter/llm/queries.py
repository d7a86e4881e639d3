"""One query for each operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmeter.llm import (
    alignment,
    bagminhash,
    compressquality,
    decontaminate,
    licenses,
    linededup,
    paragraphs,
    prefixtrie,
    quality,
    sentencepieces,
    suffixdedup,
    tokencounts,
    toolcalls,
)
from clickmeter.llm.common import table


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.verdicts(table(spark, folder, "documents")).drop("p_good")


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"), passages=True)


def op3_bagminhash(spark: SparkSession, folder: str) -> DataFrame:
    return bagminhash.classes(table(spark, folder, "documents"))


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return linededup.report(table(spark, folder, "documents"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokencounts.section_tokens(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepieces.digests(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixdedup.removals(table(spark, folder, "documents"))


def op8_paragraph_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return paragraphs.removals(table(spark, folder, "documents"))


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files: a source's languages are directories, with a thousand ids each below."""
    place = F.concat_ws("/", F.lit(""), "source", "lang", F.expr("cast(doc_id div 1000 as string)"), F.col("doc_id").cast("string"))
    return licenses.scanned(table(spark, folder, "documents").withColumn("path", place))


def op10_chat_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    calls, results = toolcalls.from_dialogues(table(spark, folder, "conversations"))
    return toolcalls.linked(calls, results, toolcalls.DIALOGUE)


def op11_cross_tokenizer(spark: SparkSession, folder: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.aligned(table(spark, folder, "documents"), *paths, public_tokenizers.PATTERN)


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixtrie.nodes(table(spark, folder, "conversations"))


def op13_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return compressquality.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_quality_rules,
        op2_decontamination,
        op3_bagminhash,
        op4_line_dedup,
        op5_token_counts,
        op6_sentencepiece,
        op7_suffix_array_dedup,
        op8_paragraph_dedup,
        op9_license_scan,
        op10_chat_tool_calls,
        op11_cross_tokenizer,
        op12_prefix_trie,
        op13_quality_classifier,
    )
}
