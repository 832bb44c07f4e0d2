"""Multiple-choice evaluation with and without retrieved context."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelathe.functions.prompts import has_context, qa_messages, render_chat
from pagelathe.functions.text import QUERY_PREFIX, add_prefix
from pagelathe.operators.exams import accuracy, mark_answers
from pagelathe.operators.models import EMBED_BATCH, GENERATE_BATCH, Load, batch_embed, batch_generate, spread
from pagelathe.operators.retrieval import TOP_K, assemble_context, attach_context, retrieve


def with_retrieved_context(qa: DataFrame, kb: DataFrame, load_embedder: Load, k: int = TOP_K, batch: int = EMBED_BATCH) -> DataFrame:
    """Context of the ``k`` nearest chunks; the question alone is the query."""
    queries = batch_embed(spread(qa.select("qa_id", "question"), "qa_id"), load_embedder, add_prefix("question", QUERY_PREFIX), batch=batch)
    return attach_context(qa, assemble_context(retrieve(queries, kb, k)))


def with_qa_prompt(qa: DataFrame, **markers: str) -> DataFrame:
    """Chat prompt per question; an empty context falls back to the zero-shot wording."""
    context = F.col("context") if "context" in qa.columns else F.lit(None).cast("string")
    chat = render_chat(qa_messages("question", "choices", context), open_reply=True, **markers)
    return qa.withColumn("prompt", chat).withColumn("used_context", has_context(context))


def answer_questions(qa: DataFrame, load: Load, batch: int = GENERATE_BATCH) -> DataFrame:
    """Reply, predicted letter and mark for each prompted question."""
    return mark_answers(batch_generate(spread(qa, "qa_id"), load, "prompt", "raw", batch)).drop("prompt")


def evaluate_questions(qa: DataFrame, load: Load, out: str, mode: str, top_k: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Write the answered questions once, then summarise the written table."""
    spark = qa.sparkSession
    answer_questions(with_qa_prompt(qa), load).write.mode("overwrite").parquet(out)
    details = spark.read.parquet(out)
    return details, accuracy(details, mode, top_k)
