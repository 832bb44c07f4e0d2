"""Exact dedup with a heavy-hitter split.

A Misra-Gries summary (``approx_top_k``, the frequent-items sketch: mergeable
counters of a fixed number, never below ``n / counters`` in doubt) finds the
digests that may be frequent.  Their exact counts and winners are a table of at
most ``heavy`` rows, which is broadcast, so copies of frequent texts are
settled where they lie.  All other digests are shuffled once; no group among
them can hold more than about ``n / counters`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelathe.llm.common import staged

#: Counters of the Misra-Gries summary and the most digests it may report.
COUNTERS = 65_536
HEAVY = 1_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_digest(text: str = "text"):
    """SHA-256 of the text with A-Z lower-cased, null as empty, as 32 bytes."""
    plain = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return F.unhex(F.sha2(plain.cast("binary"), 256))


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY, counters: int = COUNTERS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays; a null id is below all
    others, and of rows equal in id as well exactly one stays.  A null text is
    an empty text.  An empty table gives an empty result; other columns are not
    read.
    """
    rows = staged(
        docs.select(F.col(id_col).alias("doc_id"), text_digest(text_col).alias("digest")).withColumn("row_no", F.monotonically_increasing_id()),
        "digests",
    )
    # 64 bits of the digest are enough to nominate; groups are of whole digests.
    rows = rows.withColumn("short", F.xxhash64("digest"))
    frequent = rows.selectExpr(f"approx_top_k(short, {heavy}, {counters}) AS top").select(F.explode("top").alias("t")).where("t.count > 1").select(F.col("t.item").alias("short"))
    winners = staged(
        rows.join(F.broadcast(frequent), "short")  # at most ``heavy`` rows
        .groupBy("digest")
        .agg(F.max(F.struct("doc_id", "row_no")).alias("winner"), F.count("*").alias("group_size")),
        "winners",
    )
    # Equal 64 bits of different digests could double a row count of ``heavy`` at most in theory.
    split = rows.join(F.broadcast(winners), "digest", "left")
    settled = split.where("winner IS NOT NULL")
    group = Window.partitionBy("digest")
    rest = (
        rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
        .withColumn("winner", F.max(F.struct("doc_id", "row_no")).over(group))
        .withColumn("group_size", F.count("*").over(group))
    )
    columns = [
        F.col("doc_id"),
        F.col("winner.doc_id").alias("keep_id"),
        F.col("group_size").cast("bigint").alias("group_size"),
        (F.col("winner.row_no") == F.col("row_no")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    ]
    return settled.select(*columns).unionByName(rest.select(*columns))
