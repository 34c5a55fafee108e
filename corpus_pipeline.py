"""From raw documents to packed training sequences: five stages, each written and reread before the next.

Every stage takes the documents its predecessor kept and, but for the last, returns the columns of documents. Where a
stage changes texts, ``n_chars`` follows.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlake.llm import decontamination, line_dedup, order_minhash, packing, quality_rules
from loadlake.llm.common import shared_folder, shipping, table
from loadlake.llm.queries import WORD_TOKENIZER, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def _carried(docs: DataFrame) -> DataFrame:
    """Id and text, with the whole row beside them, so that no column of it can be taken for an operator's own."""
    return docs.select("doc_id", "text", F.struct(*_columns(docs)).alias("row"))


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules' posterior keeps."""
    return quality_rules.judged(_carried(docs)).where("kept").select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that many documents share; a shared line stays in one document."""
    told = line_dedup.deduplicate_lines(_carried(docs))
    text = F.col("deduplicated")["text"]
    columns = [(text if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns]
    return _counted(told.select(*columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest doc_id."""
    return order_minhash.one_of_each(docs).select(*_columns(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of the benchmark."""
    return _counted(decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and place."""
    return packing.pack(docs, tokenizer_path(WORD_TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", shipping(quality)),
    ("line_dedup", shipping(lines)),
    ("near_duplicates", shipping(near_duplicates)),
    ("decontamination", shipping(decontaminate)),
    ("packing", shipping(packed)),
]

#: Fitting votes, alignments and packing have no SQL form; tests compare each stage with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each stage's result is a Parquet table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    home = f"{shared_folder(spark)}/pipeline-{uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{home}/{name}")
        docs = spark.read.parquet(f"{home}/{name}")
    return docs
