"""Translation corpus to examples, predictions and scores."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelathe.operators.models import Load, batch_generate, batch_score, spread
from pagelathe.operators.pairs import build_examples, cap_per_direction, fit_examples, in_direction_order, sample_cap, with_prompt
from pagelathe.operators.scores import attach_baselines, direction_scores
from pagelathe.session import scratch_folder
from pagelathe.sources.readers import EXAMPLES, PREDICTIONS, read_jsonl
from pagelathe.sources.writers import write_jsonl

TRAIN_SAMPLES = 50_000
TEST_LIMIT = 500
# Tokens of a training text and of a prompt.
TRAIN_TOKENS = 512
PROMPT_TOKENS = 1024
SPLITS = ("train", "validation", "test")


def prepare_examples(
    raw: DataFrame,
    out: str,
    train_samples: int = TRAIN_SAMPLES,
    seed: int = 42,
    tokenizer: Load | None = None,
    max_tokens: int = TRAIN_TOKENS,
) -> None:
    """Examples of the three splits as JSON lines; only the training split is capped.

    With a ``tokenizer`` the texts that a model is trained and validated on keep
    the token budget; test examples stay whole, as scores need all of them.
    """
    for split in SPLITS:
        examples = build_examples(raw.where(F.col("split") == split)).drop("split")
        chosen = sample_cap(examples, train_samples, seed) if split == "train" else examples
        fitted = chosen if tokenizer is None or split == "test" else fit_examples(chosen, tokenizer, max_tokens)
        write_jsonl(fitted, f"{out}/{split}")


def predict(
    spark: SparkSession,
    test: str,
    out: str,
    load: Load,
    limit: int = TEST_LIMIT,
    batch: int = 8,
    tokenizer: Load | None = None,
    max_tokens: int = PROMPT_TOKENS,
) -> DataFrame:
    """Translate the capped test split and write the predictions once, in
    direction order; returns the written table.  With a ``tokenizer`` long
    sources are cut inside their prompts."""
    examples = cap_per_direction(read_jsonl(spark, test, EXAMPLES), limit)
    dealt = spread(with_prompt(examples, (tokenizer, max_tokens) if tokenizer else None), "ex_id")
    # Written before it is ordered: sorting looks at its input twice.
    made = f"{scratch_folder(spark)}/predictions-{uuid.uuid4().hex}"
    batch_generate(dealt, load, "prompt", "hypothesis", batch).drop("prompt").write.parquet(made)
    write_jsonl(in_direction_order(spark.read.parquet(made)), out)
    return read_jsonl(spark, out, PREDICTIONS)


def evaluate(predictions: DataFrame, load: Load, baselines: DataFrame | None = None, batch: int = 8) -> DataFrame:
    """Score per direction beside the earlier methods."""
    scored = batch_score(spread(predictions, "ex_id"), load, batch=batch)
    return attach_baselines(direction_scores(scored), baselines)
