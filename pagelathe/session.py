"""Session and scratch-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the bench; a cluster job brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pagelathe")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="pagelathe-")


def in_buckets(df: DataFrame, name: str, *columns: str) -> DataFrame:
    """``df`` written to the scratch folder in buckets of its columns and read back.

    Joins on exactly these columns move the other side only.  A table grouped by
    them before has one file a bucket.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    written = df.write.option("compression", "zstd").option("path", f"{scratch_folder(spark)}/{table}")
    written.bucketBy(buckets, *columns).format("parquet").saveAsTable(table)
    return spark.table(table)


def shared_files(folder: str, ending: str) -> tuple[fs.FileSystem, list[str]]:
    """File system and paths, in order, of a written table's files, for tasks that read them themselves."""
    store, at = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))
    found = store.get_file_info(fs.FileSelector(at))
    return store, sorted(f.path for f in found if f.is_file and f.path.endswith(ending))
