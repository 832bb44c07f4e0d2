"""Inputs with explicit schemas."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelathe.session import scratch_folder
from pagelathe.sources.writers import BASELINE_KEY

PAIRS = "split string, ex_id bigint, translation struct<en:string,tr:string>"
EXAMPLES = "ex_id bigint, src_lang string, tgt_lang string, src string, tgt string"
PREDICTIONS = EXAMPLES + ", hypothesis string"
QA_ITEMS = "qa_id bigint, subject string, question string, choices map<string,string>, answer string"
PAGES = "source string, page_no int, text string"
BASELINES = "key string, score double"
TRAIN_LOG = "run_id string, seq bigint, step bigint, loss double, eval_loss double"
TRACE = "conv_id bigint, turn int, role string, text string"


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """One object per line; blank lines are skipped, malformed ones raise."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_parallel(spark: SparkSession, path: str, fmt: str = "json", split: str | None = None, own_ids: bool = True) -> DataFrame:
    """Parallel corpus as ``split, ex_id, en, tr``; only the two nested fields are read from Parquet.

    Without ``own_ids`` the files need no ids: rows get those of ``with_content_ids``.
    """
    schema = PAIRS if own_ids else PAIRS.replace("ex_id bigint, ", "")
    rows = read_jsonl(spark, path, schema) if fmt == "json" else spark.read.schema(schema).format(fmt).load(path)
    if split is not None:
        rows = rows.where(F.col("split") == split)
    rows = rows.select("split", *(["ex_id"] if own_ids else []), F.col("translation.en").alias("en"), F.col("translation.tr").alias("tr"))
    return rows if own_ids else with_content_ids(rows, "ex_id", "split", "en", "tr").select("split", "ex_id", "en", "tr")


def with_content_ids(df: DataFrame, id_col: str, *content: str) -> DataFrame:
    """Ids for a corpus that has none: 128-bit hash of the content and number of the repeat.

    The same rows get the same ids however they are split over files and tasks.
    Rows are written once; repeats are numbered inside the task that wrote them,
    and only one count per digest and task is summed across tasks, so that a row
    repeated very often is no work of one task.
    """
    spark = df.sparkSession
    texts = [F.col(c).cast("string") for c in content]
    told = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    path = f"{scratch_folder(spark)}/rows-{uuid.uuid4().hex}"
    marked = df.withColumns({"_digest": F.md5(F.concat_ws("|", *told).cast("binary")), "_part": F.spark_partition_id()})
    marked.write.parquet(path)
    rows = spark.read.schema(marked.schema).parquet(path)
    counts = rows.groupBy("_digest", "_part").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("_digest").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_digest", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_digest", "_part").orderBy(F.lit(0)))
    numbered = rows.withColumn("_local", local).join(before, ["_digest", "_part"])
    number = (F.col("_before") + F.col("_local")).cast("string")
    return numbered.withColumn(id_col, F.concat_ws("-", "_digest", number)).drop("_digest", "_part", "_local", "_before")


def read_exam(
    spark: SparkSession, path: str, config: str = "History", split: str = "test", fmt: str = "parquet", schema: str | None = None
) -> tuple[DataFrame, bool]:
    """Rows of one subject and split, and whether subjects still need filtering.

    The files are partitioned by ``config`` and ``split``, so other subjects
    are never opened.  ``all`` (or an empty config) reads every subject.
    """
    reader = spark.read.format(fmt)
    rows = (reader.schema(schema) if schema else reader).load(path).where(F.col("split") == split)
    every = config.lower() in ("all", "")
    return (rows if every else rows.where(F.col("config") == config)), every


def read_qa(spark: SparkSession, path: str) -> DataFrame:
    """QA items from JSON lines, choices as an ordered array of letter and text."""
    rows = read_jsonl(spark, path, QA_ITEMS)
    entries = F.transform(F.map_entries("choices"), lambda e: F.struct(e["key"].alias("letter"), e["value"].alias("text")))
    return rows.withColumn("choices", entries)


def read_baselines(spark: SparkSession, path: str) -> DataFrame | None:
    """Earlier scores as ``key, score`` from one flat JSON object, its numbers only; None if the file is absent."""
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException:
        return None
    entries = text.select(F.explode(F.from_json("value", "map<string,string>")).alias("key", "value"))
    return entries.select("key", F.col("value").try_cast("double").alias("score")).where(F.col("score").isNotNull())


def read_scores(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A score file as ``direction, score, n`` and its nested earlier scores as ``key, score``."""
    entries = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("key", "value"))
    counts = entries.where(F.col("key").endswith("_n")).select(
        F.regexp_replace("key", "_n$", "").alias("direction"), F.col("value").try_cast("bigint").alias("n")
    )
    ours = entries.where((F.col("key") != BASELINE_KEY) & ~F.col("key").endswith("_n"))
    scores = ours.select(F.col("key").alias("direction"), F.col("value").try_cast("double").alias("score")).join(counts, "direction")
    nested = entries.where(F.col("key") == BASELINE_KEY).select(F.explode(F.from_json("value", "map<string,string>")).alias("key", "value"))
    return scores, nested.select("key", F.col("value").try_cast("double").alias("score")).where(F.col("score").isNotNull())


def read_in_order(spark: SparkSession, path: str) -> DataFrame:
    """Rows written by ``write_in_order``, with ``in_order``: whether every file
    holds the positions that follow those of the file before it."""
    rows = spark.read.json(path).withColumn("_file", F.col("_metadata.file_name"))
    by_name = Window.orderBy("_file")
    # One row per file.
    files = rows.groupBy("_file").agg(F.min("position").alias("_low"), F.max("position").alias("_high"), F.count("*").alias("_n"))
    follows = F.col("_low") == F.coalesce(F.lag("_high").over(by_name), F.lit(0)) + 1
    dense = F.col("_high") - F.col("_low") + 1 == F.col("_n")
    checked = files.select("_file", (follows & dense).alias("in_order"))
    return rows.join(F.broadcast(checked), "_file").drop("_file")


def read_kb(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a scan with fewer tasks than cores out to all cores.

    A few large files or row groups would leave text work to a few tasks.
    Scans that already have enough tasks are returned as they are.
    """
    width = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(width) if df.rdd.getNumPartitions() < width else df
