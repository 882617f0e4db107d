"""The corpus pipeline: documents to token ids, stage by stage.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor kept, and returns rows with the columns of
``documents``; the last returns the encoded texts. Between stages rows are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.llm.byte_bpe import digests, multilingual
from vecloom.llm.common import table
from vecloom.llm.decontaminate import drop_contaminated
from vecloom.llm.line_dedup import drop_repeated_lines
from vecloom.llm.ngram_join import drop_near_duplicates
from vecloom.llm.quality import drop_low_quality
from vecloom.session import write_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return drop_low_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; ``n_chars``, where it is, follows the text. All rows stay."""
    kept = drop_repeated_lines(docs)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays. Documents without words stay."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with benchmark text go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as token ids, with digests of the ids and of what they decode to."""
    return digests(docs, multilingual())


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("n-gram Jaccard join", near_dedup),
          ("benchmark decontamination", decontaminate), ("byte-level BPE", encode)]

#: SQL cannot find maximal repeats, near copies or token ids, so the tests hold run() against a plain model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
