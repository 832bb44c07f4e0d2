"""Scores per direction, baselines, training logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelathe.functions.text import direction, format_score
from pagelathe.operators.ordered import SEGMENT_WIDTH, with_blocks, with_positions

# Earlier methods in the comparison, and the directions reported.
BASELINES = ("zero_shot", "maps", "rag")
DIRECTIONS = ("en2tr", "tr2en")


def direction_scores(df: DataFrame, score: str = "seg_score") -> DataFrame:
    """Mean segment score and row count per translation direction."""
    return df.groupBy(direction("src_lang", "tgt_lang").alias("direction")).agg(
        F.avg(score).alias("score"), F.count("*").alias("n")
    )


def attach_baselines(
    scores: DataFrame,
    baselines: DataFrame | None,
    methods: Sequence[str] = BASELINES,
    versus: str = "maps",
    directions: Sequence[str] = DIRECTIONS,
) -> DataFrame:
    """Earlier scores beside ours; missing ones stay null, and so does their delta.

    ``baselines`` has ``key`` (method and direction joined by ``_``) and
    ``score``; without it every baseline is null.
    """
    if baselines is None:
        wide = scores.select("direction", "score", "n", *[F.lit(None).cast("double").alias(m) for m in methods])
    else:
        keyed = [F.concat(F.lit(f"{m}_"), F.col("direction")) for m in methods]
        wanted = scores.select("direction", "score", "n", F.posexplode(F.array(*keyed)).alias("_i", "key"))
        found = baselines.groupBy("key").agg(F.max("score").alias("_base"))
        wide = (
            wanted.join(found, "key", "left")
            .groupBy("direction")
            .agg(
                F.first("score").alias("score"),
                F.first("n").alias("n"),
                *[F.max(F.when(F.col("_i") == i, F.col("_base"))).alias(m) for i, m in enumerate(methods)],
            )
        )
    reported = wide.where(F.col("direction").isin(*directions)) if directions else wide
    return reported.withColumn("delta", F.col("score") - F.col(versus))


def comparison_table(compared: DataFrame, methods: Sequence[str] = BASELINES) -> DataFrame:
    """The comparison as display text: four decimals, signed delta, dash where missing."""
    return compared.select(
        "direction",
        *[format_score(m).alias(m) for m in methods],
        format_score("score").alias("score"),
        format_score("delta", signed=True).alias("delta"),
    )


def training_summary(log: DataFrame) -> DataFrame:
    """Last step, last training loss and last evaluation loss of each run."""
    is_eval = F.col("eval_loss").isNotNull()
    at = lambda condition: F.when(condition, F.col("seq"))
    return log.groupBy("run_id").agg(
        F.max("step").alias("last_step"),
        F.max_by("loss", at(F.col("loss").isNotNull() & ~is_eval)).alias("train_loss"),
        F.max_by("eval_loss", at(is_eval)).alias("eval_loss"),
    )


def _positioned_evals(log: DataFrame) -> DataFrame:
    evals = log.where(F.col("eval_loss").isNotNull()).select("run_id", "seq", "step", "eval_loss")
    return with_positions(evals, ["run_id"], "seq", "eval_no")


def eval_curve(log: DataFrame, tol: float = 0.01, width: int = SEGMENT_WIDTH) -> DataFrame:
    """Per evaluation: change, best so far and its step, within ``tol`` of the best.

    A run is cut into blocks; one row per block carries its best to later ones.
    """
    blocks = with_blocks(_positioned_evals(log), "eval_no", halo=1, block=width)
    inside = Window.partitionBy("run_id", "_block").orderBy("eval_no")
    own = F.when(~F.col("_halo"), F.struct("eval_loss", "eval_no", "step"))
    seen = blocks.withColumns(
        {
            "change": F.col("eval_loss") - F.lag("eval_loss").over(inside),
            "_best": F.min(own).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        }
    ).where(~F.col("_halo"))
    earlier = Window.partitionBy("run_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        seen.groupBy("run_id", "_block")
        .agg(F.min("_best").alias("_own"))
        .select("run_id", "_block", F.min("_own").over(earlier).alias("_before"))
    )
    best = F.when(F.col("_before") <= F.col("_best"), F.col("_before")).otherwise(F.col("_best"))
    return (
        seen.join(carried, ["run_id", "_block"])
        .withColumn("_best", best)
        .select(
            "run_id",
            "eval_no",
            "step",
            "eval_loss",
            "change",
            F.col("_best.eval_loss").alias("best_loss"),
            F.col("_best.step").alias("best_step"),
            (F.col("eval_loss") <= F.col("_best.eval_loss") + F.lit(tol)).alias("in_band"),
        )
    )


def plateaus(log: DataFrame, patience: int = 5, tol: float = 0.02, width: int = SEGMENT_WIDTH) -> DataFrame:
    """Per evaluation: spread of the last ``patience`` losses and whether it is a plateau."""
    blocks = with_blocks(_positioned_evals(log), "eval_no", halo=patience - 1, block=max(width, patience))
    recent = Window.partitionBy("run_id", "_block").orderBy("eval_no").rowsBetween(-(patience - 1), 0)
    spread = F.max("eval_loss").over(recent) - F.min("eval_loss").over(recent)
    full = F.count("*").over(recent) == patience
    return (
        blocks.withColumn("spread", F.when(full, spread))
        .where(~F.col("_halo"))
        .withColumn("plateau", F.coalesce(F.col("spread") <= F.lit(tol), F.lit(False)))
        .drop("_block", "_halo")
    )


def early_stop(log: DataFrame, patience: int = 5, tol: float = 0.02, width: int = SEGMENT_WIDTH) -> DataFrame:
    """First step of each run at which training could have stopped, null if none."""
    first = F.when(F.col("plateau"), F.col("eval_no"))
    return plateaus(log, patience, tol, width).groupBy("run_id").agg(
        F.count("*").alias("n_evals"), F.min_by("step", first).alias("stop_step"), F.min(first).alias("stop_eval_no")
    )
