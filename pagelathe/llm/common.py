"""Shared helpers: staged tables in the cluster's folder, stable row ids."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelathe.session import scratch_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage so that a lost executor repeats one step, not all, and
    makes row ids given with ``monotonically_increasing_id`` final.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_path(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """A staged table in buckets of a column, so that joins on it need not move it."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = path.rsplit("/", 1)[1].replace("-", "_")
    df.write.option("compression", "zstd").option("path", path).bucketBy(buckets, key).format("parquet").saveAsTable(table)
    return spark.table(table)


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a statement go when it ends, not when the driver happens to collect its garbage.

    For tables that are written and read back; a frame that is run again shuffles again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def joined_hot(rows: DataFrame, found: DataFrame, on: list[str], count: str, share: int = 10_000, by: list[str] | None = None) -> DataFrame:
    """Inner join of ``rows`` with one row per key, whose ``count`` says how many rows have the key.

    Keys that hold more than one row in ``share`` are fewer than ``share``; they
    are told to all tasks, and their one row is copied so often that no copy
    meets many rows.  ``by`` are columns that tell rows of a key apart.
    """
    total = F.lit(found.agg(F.greatest(F.sum(count), F.lit(1))).first()[0])
    copies = F.ceil(F.col(count) * share / total).cast("int")
    hot = F.broadcast(found.where(F.col(count) * share > total).select(*on, copies.alias("_copies")))
    salted = rows.join(hot, on, "left").withColumn("_salt", F.pmod(F.xxhash64(*(by or rows.columns)), F.coalesce("_copies", F.lit(1))).cast("int"))
    copied = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), copies - 1))).drop(count)
    return salted.drop("_copies").join(copied, [*on, "_salt"]).drop("_salt")


def is_empty(df: DataFrame) -> bool:
    return df.limit(1).count() == 0


def packed(df: DataFrame, row: str = "row") -> DataFrame:
    """All columns inside one struct, so that no name can clash with ours."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(row))


def unpacked(df: DataFrame, row: str = "row", *extra: str) -> DataFrame:
    names = df.schema[row].dataType.names
    return df.select(*[F.col(row).getField(n).alias(n) for n in names], *extra)


def store_of(folder: str):
    """File system and path for tasks that write files of a format of their own."""
    from pyarrow import fs

    if "://" in folder:
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder.removeprefix("file:")
