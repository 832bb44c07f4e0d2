"""Outputs: JSON lines, one-object summaries, the chunk table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelathe.session import scratch_folder

# Fixed value: where a score file keeps earlier scores.
BASELINE_KEY = "_baseline_hw2"


def _is_choices(field: T.StructField) -> bool:
    kind = field.dataType
    return (
        isinstance(kind, T.ArrayType)
        and isinstance(kind.elementType, T.StructType)
        and kind.elementType.fieldNames() == ["letter", "text"]
    )


def write_jsonl(df: DataFrame, path: str) -> None:
    """Overwrite with one object per line, nulls included, choices as a letter-to-text object."""
    objects = {f.name: F.map_from_entries(f.name) for f in df.schema.fields if _is_choices(f)}
    df.withColumns(objects).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_summary(df: DataFrame, path: str) -> None:
    """Overwrite with one indented JSON object per row of a small summary, in a single file."""
    fields = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false", "pretty": "true"})
    df.select(fields.alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_kb(chunks: DataFrame, path: str) -> None:
    """Overwrite the chunk table; a rerun replaces it."""
    chunks.write.mode("overwrite").parquet(path)


def write_scores(scores: DataFrame, path: str, baselines: DataFrame | None = None) -> None:
    """Overwrite with one object: ``direction`` to score and ``direction_n`` to row
    count, in the order of directions, and earlier scores (``key, score``) nested below.

    Both inputs hold a row per direction or method, so one object holds them.
    """
    # One-entry objects without their braces keep the types apart: scores as decimals, counts as whole numbers.
    inner = lambda c: F.substr(c, F.lit(2), F.length(c) - 2)
    pair = lambda key, value: inner(F.to_json(F.create_map(key, value), {"ignoreNullFields": "false"}))
    rows = scores.select("direction", F.col("score").cast("double").alias("score"), F.col("n").cast("bigint").alias("n"))
    entry = lambda r: F.concat(pair(r["direction"], r["score"]), F.lit(","), pair(F.concat(r["direction"], F.lit("_n")), r["n"]))
    ours = rows.agg(F.transform(F.sort_array(F.collect_list(F.struct("direction", "score", "n"))), entry).alias("_entries"))
    if baselines is not None:
        known = baselines.groupBy("key").agg(F.max("score").alias("score"))
        nested = known.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "score")))).alias("_known"))
        # One row on either side.
        ours = ours.crossJoin(nested).withColumn(
            "_entries", F.concat("_entries", F.array(pair(F.lit(BASELINE_KEY), F.col("_known"))))
        )
    text = F.concat(F.lit("{"), F.array_join("_entries", ","), F.lit("}"))
    ours.select(text.alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_in_order(df: DataFrame, path: str, order_by: Sequence[str]) -> None:
    """Overwrite with JSON lines in order, each with its ``position``; files in the order of their names.

    Columns that start with an underscore only order and are not written.
    """
    ordered = df.orderBy(*order_by)
    staged = f"{scratch_folder(df.sparkSession)}/in-order-{uuid.uuid4().hex}"
    # Ids ascend over sorted tasks; ranks of files make dense positions of them.
    ordered.withColumn("_id", F.monotonically_increasing_id()).write.parquet(staged)
    rows = df.sparkSession.read.parquet(staged).withColumn("_task", F.shiftright("_id", 33))
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task.
    counts = rows.groupBy("_task").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    offsets = counts.select("_task", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    placed = rows.join(F.broadcast(offsets), "_task").withColumn("position", F.col("_id") - F.col("_first") + F.col("_before") + 1)
    out = placed.select(*[c for c in df.columns if not c.startswith("_")], "position")
    out.repartitionByRange("position").sortWithinPartitions("position").write.mode("overwrite").option("ignoreNullFields", "false").json(path)
