import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagelathe.operators import retrieval

VEC = "id bigint, embedding array<float>"


def unit(degrees):
    return [math.cos(math.radians(degrees)), math.sin(math.radians(degrees))]


def sides(spark, queries, base):
    q = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in queries], VEC).withColumnRenamed("id", "qa_id")
    b = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in base], VEC).withColumnRenamed("id", "chunk_id")
    return q, b


def found(hits):
    return [(r.qa_id, r.rank, r.chunk_id) for r in hits.orderBy("qa_id", "rank").collect()]


def test_topk_order_ties_and_short_base(spark):
    q, b = sides(spark, [(7, unit(0))], [(4, unit(90)), (3, unit(20)), (2, unit(10)), (1, unit(0)), (9, unit(10))])
    assert found(retrieval.knn_topk(q, b, 3)) == [(7, 1, 1), (7, 2, 2), (7, 3, 9)]
    hits = retrieval.knn_topk(q, b, 50).orderBy("rank").collect()
    assert [r.rank for r in hits] == [1, 2, 3, 4, 5]
    assert abs(hits[-1].distance - math.sqrt(2)) < 1e-6
    assert retrieval.knn_topk(q.limit(0), b, 3).count() == 0


def brute(queries, base, k):
    out = []
    for qi, qv in queries:
        d = [(round(float(((np.float32(qv).astype(float) - np.float32(v).astype(float)) ** 2).sum()), 12), i) for i, v in base]
        out += [(qi, r, i) for r, (_, i) in enumerate(sorted(d)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"max_cells": 40}, {"max_cells": 12, "lot_cells": 20}])
def test_both_plans_match_brute_force_with_hot_copies(spark, options, monkeypatch):
    """A third of the base is one vector; distances tie in bulk and ids decide."""
    monkeypatch.setattr(retrieval, "MATRIX_CELLS", 500)
    monkeypatch.setattr(retrieval, "REFINE_PAIRS", 64)
    rng = np.random.default_rng(3)
    queries = [(i, rng.normal(size=4)) for i in range(40)]
    base = [(i, queries[0][1] if i % 3 == 0 else rng.normal(size=4)) for i in range(100)]
    q, b = sides(spark, queries, base)
    assert found(retrieval.knn_topk(q.repartition(3), b.repartition(7), 5, **options)) == brute(queries, base, 5)


def test_ids_of_any_type_and_one_model_run_per_question(spark):
    q, b = sides(spark, [(i, unit(i)) for i in range(30)], [(i, unit(3 * i)) for i in range(20)])
    runs = spark.sparkContext.accumulator(0)

    def embedded(batches):
        for batch in batches:
            runs.add(len(batch))
            yield batch

    asked = q.repartition(4).mapInPandas(embedded, q.schema)
    named = b.withColumn("chunk_id", F.concat(F.lit("c"), F.lpad(F.col("chunk_id").cast("string"), 3, "0")))
    hits = retrieval.knn_topk(asked.withColumn("qa_id", F.col("qa_id").cast("string")), named, 1, max_cells=16)
    assert {(r.qa_id, r.chunk_id) for r in hits.collect()} == {(str(i), f"c{round(i / 3):03d}") for i in range(30)}
    assert runs.value == 30
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "hashpartitioning(chunk_id" not in plan


def test_context(spark):
    rows = [(1, 2, "bar"), (1, 1, "passage: foo"), (2, 1, "passage: passage: z")]
    hits = spark.createDataFrame(rows, "qa_id bigint, rank int, text string")
    qa = spark.createDataFrame([(1,), (2,), (3,)], "qa_id bigint")
    out = retrieval.attach_context(qa, retrieval.assemble_context(hits)).orderBy("qa_id").collect()
    assert [r.context for r in out] == ["[1] foo\n\n[2] bar", "[1] passage: z", ""]


def test_articles_are_shortened_and_repeats_stay(spark):
    q, b = sides(spark, [(1, unit(0))], [(1, unit(5)), (2, unit(5)), (3, unit(50))])
    articles = b.select(F.col("chunk_id").alias("article_id"), "embedding", F.lit("word " * 1000).alias("text"))
    rows = retrieval.retrieve_articles(q, articles).orderBy("rank").collect()
    assert [r.article_id for r in rows] == [1, 2] and {len(r.text) for r in rows} == {1500}


def test_text_is_joined_with_and_without_a_bound(spark):
    hits = spark.createDataFrame([(1, 1, 5), (2, 1, 5)], "qa_id bigint, rank int, chunk_id bigint")
    chunks = spark.createDataFrame([(5, "five"), (6, "six")], "chunk_id bigint, text string")
    small, large = (retrieval.attach_text(hits, chunks, n) for n in (2, None))
    assert sorted(r.text for r in small.collect()) == sorted(r.text for r in large.collect()) == ["five", "five"]
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_far_lots_are_skipped_and_nothing_is_lost(spark, monkeypatch):
    rng = np.random.default_rng(8)
    queries = [(i, rng.normal(size=3)) for i in range(20)]
    base = [(i, rng.normal(size=3) + (0 if i < 30 else 50 * (i // 30))) for i in range(150)]
    q, b = sides(spark, queries, base)
    assert found(retrieval.knn_topk(q, b.coalesce(1), 4, lot_cells=90)) == brute(queries, base, 4)
    rows, limit = np.array([v for _, v in queries]), np.full(20, 9.0)
    assert retrieval._out_of_reach(rows, limit, np.full(3, 50.0), 4.0)
    assert not retrieval._out_of_reach(rows, limit, np.full(3, 50.0), 84.0)
    assert not retrieval._out_of_reach(rows, np.full(20, np.inf), np.full(3, 50.0), 4.0)
