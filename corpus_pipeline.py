"""Documents for training: quality rules, line dedup, near-dedup, decontamination, encoding.

Every stage takes (spark, docs, sf_dir) and returns a frame; it is written and read again as
the docs of the next stage. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmeter.llm import bagminhash, decontaminate, linededup, quality, sentencepieces
from clickmeter.llm.common import prepare, table, written

LEAST_REST = 5  # a document goes if less than this part of it is left
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    prepare(spark)
    return quality.kept(docs).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated runs of lines.

    One of which less than a fifth is left, or no word, goes: at least four fifths of it stand
    in other documents, and the scrap would hide from near-dedup what it is a copy of.
    """
    prepare(spark)
    whole = F.char_length("text").alias("whole")
    rest = linededup.stripped(docs.select(*COLUMNS, whole))
    rest = rest.where(F.col("text").rlike("[^ \\t-\\r]") & (F.char_length("text") * LEAST_REST >= F.col("whole")))
    return rest.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every class of near copies."""
    prepare(spark)
    return bagminhash.kept(docs).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item and no passage of one."""
    return decontaminate.kept(docs, table(spark, sf_dir, "benchmark"), passages=True).select(*COLUMNS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every document and the hash of the text decoded from them."""
    prepare(spark)
    pieces = sentencepieces.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"), "n_differing")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", encoding),
]

#: Signatures, alignment and encoding are not for SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
