"""Connected components of an edge table by alternating large and small stars.

Both star steps are joins and aggregations over edges (Kiveris et al., 2014);
no vertex ever needs its neighbours together, labels and edges never reach the
driver, and every round ends in a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelathe.llm.common import new_folder, remove_folder, staged_path


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of u are tied to the smallest vertex around u."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return (
        edges.join(least, "u")
        .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for every vertex of edges (u bigint, v bigint).

    The component is its smallest vertex.  Loops and null ends are ignored.
    """
    spark = edges.sparkSession
    start = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    path = new_folder(spark, "edges")
    now = staged_path(start, path)
    state = _state(now)
    while state[0]:
        after = new_folder(spark, "edges")
        then = staged_path(_small_star(_large_star(now)), after)
        new = _state(then)
        remove_folder(spark, path)
        now, path = then, after
        if new == state:
            break
        state = new
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
