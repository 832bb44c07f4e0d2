"""A corpus pipeline of five stages; each works on all its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelathe.llm import decontaminate, mixing, ngram_join, quality, token_files
from pagelathe.llm.common import staged, unpacked
from pagelathe.llm.queries import table, tokenizer_path


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained quality classifier keeps."""
    return unpacked(quality.classify(docs, table(spark, sf_dir, "labels")).where("kept"))


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of every group of the n-gram join."""
    return unpacked(ngram_join.link_documents(docs).where("first"))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    rows = decontaminate.numbered(docs)
    hits = decontaminate.contaminated(rows, table(spark, sf_dir, "benchmark"))
    return unpacked(rows.join(hits.select("no").distinct(), "no", "left_anti"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order of the mix."""
    return unpacked(mixing.mix(docs).repartitionByRange("position").sortWithinPartitions("position"))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order in which the documents were written, by id if they are not from files."""
    try:
        docs = docs.select("doc_id", "text", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("place"))
        order = [F.col("file"), F.col("place")]
    except AnalysisException:
        order = [F.col("doc_id")]
    return token_files.encode_documents(spark, docs, tokenizer_path(), order)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", reject_poor),
    ("near duplicates", keep_one_of_similar),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

#: No SQL: it has no classifier, SimHash or tokenizer.  Tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
