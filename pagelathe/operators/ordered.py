"""Ordered operators that do not hand one key, or all rows, to one task.

A window over a key sends every row of that key to one task.  The functions
here cut a key into segments first, work inside the segments, and carry only
one small row per segment across them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelathe.session import scratch_folder

SEGMENT = "_segment"
SEGMENT_WIDTH = 65_536


def whole_quotient(a: Column, b: Column | int) -> Column:
    """Integer division; floor of ``/`` would pass large ids through a double."""
    return F.call_function("div", a, F.lit(b) if isinstance(b, int) else b)


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None, salts: int = 64
) -> DataFrame:
    """First ``n`` rows of each group in two rounds.

    The first round ranks inside (group, salt), so a hot group is spread over
    ``salts`` tasks and the second round sees at most ``salts * n`` of its
    rows.  For ``n`` up to spark.sql.optimizer.windowGroupLimitThreshold Spark
    also prunes to ``n`` per input partition before each shuffle; beyond it all
    rows are shuffled, so pass the ordering columns alone there.
    """
    salted = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    inner = Window.partitionBy(*keys, "_salt").orderBy(*order)
    outer = Window.partitionBy(*keys).orderBy(*order)
    kept = (
        salted.withColumn("_rank", F.row_number().over(inner))
        .where(F.col("_rank") <= n)
        .drop("_rank", "_salt")
        .withColumn("_rank", F.row_number().over(outer))
        .where(F.col("_rank") <= n)
    )
    return kept.withColumnRenamed("_rank", rank) if rank else kept.drop("_rank")


def with_segments(df: DataFrame, order_by: str, width: int | Column = SEGMENT_WIDTH, name: str = SEGMENT) -> DataFrame:
    """Segment number by value: rows with unique integer order values fill a
    segment with at most ``width`` rows per key."""
    return df.withColumn(name, whole_quotient(F.col(order_by).cast("bigint"), width))


def with_positions(df: DataFrame, keys: Sequence[str], order_by: str, name: str = "position") -> DataFrame:
    """Dense 1-based position of each row within its key (or overall).

    Rows are sorted into even ranges of (key, order) and written once; a row
    then has a place in its range, and only the number of rows per range and key
    crosses ranges.  Values of any type, sparse ones and far outliers give even
    ranges; everything behind reads the written rows, not the input again.
    ``order_by`` is unique within the key, else equal values come in any order.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/ordered-{uuid.uuid4().hex}"
    ranged = df.repartitionByRange(*keys, order_by).sortWithinPartitions(*keys, order_by)
    # Ids count rows within a task, with the task's number in the bits above.
    marked = ranged.withColumn("_id", F.monotonically_increasing_id())
    marked.write.parquet(path)
    rows = spark.read.schema(marked.schema).parquet(path).withColumn("_range", F.shiftright("_id", 33))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*keys, "_range").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    offsets = counts.select(*keys, "_range", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    # Without keys there is one row per range.
    placed = rows.join(offsets if keys else F.broadcast(offsets), [*keys, "_range"])
    position = F.col("_id") - F.col("_first") + F.col("_before") + 1
    return placed.withColumn(name, position.cast("bigint")).drop("_id", "_range", "_first", "_before")


def with_running(df: DataFrame, keys: Sequence[str], order_by: str, value: Column, name: str, how: str = "sum") -> DataFrame:
    """Sum (or ``how="max"``) of ``value`` over the earlier rows of the key, null for the first.

    As in ``with_positions``: even ranges of (key, order), written once; windows
    run inside a range, and one row per range and key crosses ranges.  Keys may be null.
    """
    fold = {"sum": F.sum, "max": F.max}[how]
    both = {"sum": lambda a, b: F.coalesce(a + b, a, b), "max": F.greatest}[how]
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/running-{uuid.uuid4().hex}"
    ranged = df.withColumn("_value", value).repartitionByRange(*keys, order_by).withColumn("_range", F.spark_partition_id())
    ranged.write.parquet(path)
    rows = spark.read.schema(ranged.schema).parquet(path)
    before = lambda order, *parts: Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*keys, "_range").agg(fold("_value").alias("_all"))
    carried = sums.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_range").alias("_r"),
        fold("_all").over(before("_range", *keys)).alias("_carried"),
    )
    local = rows.withColumn("_local", fold("_value").over(before(order_by, *keys, "_range")))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], F.col("_range") == F.col("_r"))
    joined = local.join(carried, same).withColumn(name, both(F.col("_carried"), F.col("_local")))
    return joined.select(*df.columns, name)


def with_blocks(df: DataFrame, position: str, halo: int, block: int = SEGMENT_WIDTH) -> DataFrame:
    """Cut positioned rows into blocks that also see the ``halo`` rows before them.

    Adds ``_block`` and ``_halo``; a row near the end of a block is copied
    into the next one with ``_halo`` true, to be dropped after the window ran.
    """
    at = F.col(position) - 1
    own = whole_quotient(at, block)
    near_end = at % block >= block - halo
    homes = F.when(
        near_end,
        F.array(
            F.struct(own.alias("_block"), F.lit(False).alias("_halo")),
            F.struct((own + 1).alias("_block"), F.lit(True).alias("_halo")),
        ),
    ).otherwise(F.array(F.struct(own.alias("_block"), F.lit(False).alias("_halo"))))
    return df.withColumn("_home", F.explode(homes)).select("*", "_home.*").drop("_home")


def batch_rows(df: DataFrame, n: int, order_by: str) -> DataFrame:
    """Groups of ``n`` consecutive rows in order, the last one short."""
    fields = [c for c in df.columns]
    numbered = with_positions(df, [], order_by, "_position")
    return (
        numbered.withColumn("batch_no", whole_quotient(F.col("_position") - 1, n))
        .groupBy("batch_no")
        .agg(F.sort_array(F.collect_list(F.struct("_position", *fields))).alias("_rows"))
        .select(
            "batch_no",
            F.transform("_rows", lambda r: F.struct(*[r[c].alias(c) for c in fields])).alias("rows"),
            F.size("_rows").cast("bigint").alias("n_rows"),
        )
    )
