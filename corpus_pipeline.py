"""A corpus made ready for training, stage by stage.

Each stage takes (spark, docs, folder) and returns a frame; ``run`` writes it as
Parquet below the shared folder and gives the next stage what it reads back. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicksieve.llm.common import documents, keep_table
from clicksieve.llm.line_crf import fit_on_labels, quality_score
from clicksieve.llm.line_dedup import drop_recurring_lines
from clicksieve.llm.mixing import mix_sources, repeat_copies
from clicksieve.llm.near_dedup import drop_near_duplicates
from clicksieve.llm.sentencepiece_codec import encode_documents

MIN_QUALITY = 0.3


def classify(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose lines are good enough; the others go."""
    field = fit_on_labels(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return docs.filter(quality_score(F.col("text"), field) >= MIN_QUALITY)


def dedup_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without recurring lines; a document that had only such lines goes."""
    cut = drop_recurring_lines(docs)
    whole = (F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return cut.filter(whole).withColumn("n_chars", F.when(F.col("n_dropped") == 0, F.col("n_chars")).otherwise(
        F.length("text"))).select(docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8)."""
    return drop_near_duplicates(docs, width=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Whole copies of documents, so that sources meet their target words."""
    return repeat_copies(mix_sources(docs)).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of each copy, checked by decoding them."""
    coded = encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))
    same = F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), "▁", " ")
    return coded.select("doc_id", "source", "lang", "n_tokens", "ids", same.alias("round_trip"))


STAGES = [
    ("quality classifier", classify),
    ("line dedup", dedup_lines),
    ("minhash near-dedup", dedup_documents),
    ("mixing sources", mix),
    ("sentencepiece", encode),
]

# SQL can't express a fitted field, MinHash or a piece vocabulary.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    for name, stage in STAGES:
        docs = keep_table(stage(spark, docs, folder), name.replace(" ", "-"))
    return docs
