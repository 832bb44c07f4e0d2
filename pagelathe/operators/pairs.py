"""Parallel-text pairs: strip, filter, expand, sample, cap, render."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelathe.functions.prompts import render_chat, translation_messages
from pagelathe.functions.text import direction, strip_or_empty
from pagelathe.operators.models import Load, fit_tokens
from pagelathe.operators.ordered import top_n_per_group

MIN_CHARS = 5
MAX_CHARS = 2000
SEED = 42
# The two languages of the corpus, source side first.
LANGUAGES = {"en": "English", "tr": "Turkish"}

HASH_PREFIX = 5  # hex digits: 16**5 buckets bound the histogram of sample_cap


def strip_pair(df: DataFrame, left: str = "en", right: str = "tr") -> DataFrame:
    """Null sides become empty, both sides are stripped."""
    return df.withColumns({left: strip_or_empty(left), right: strip_or_empty(right)})


def drop_empty_pairs(df: DataFrame, left: str = "en", right: str = "tr") -> DataFrame:
    return df.where((F.col(left) != "") & (F.col(right) != ""))


def length_band(
    df: DataFrame, left: str = "en", right: str = "tr", min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS
) -> DataFrame:
    """Keep pairs whose shorter and longer side lie within the bounds."""
    return df.where(
        (F.least(F.length(left), F.length(right)) >= min_chars) & (F.greatest(F.length(left), F.length(right)) <= max_chars)
    )


def expand_directions(df: DataFrame, both: bool = True, pair_id: str = "ex_id") -> DataFrame:
    """One row per translation direction; ``ex_id`` becomes 2 * pair + direction.

    Ids that are no integers become text, with the direction behind a point.
    """
    ends = [("en", "tr"), ("tr", "en")] if both else [("en", "tr")]
    whole = isinstance(df.schema[pair_id].dataType, T.IntegralType)
    named = lambda i: (F.col(pair_id) * 2 + i).cast("bigint") if whole else F.concat(F.col(pair_id).cast("string"), F.lit(f".{i}"))
    rows = F.array(
        *[
            F.struct(
                named(i).alias("ex_id"),
                F.lit(LANGUAGES[a]).alias("src_lang"),
                F.lit(LANGUAGES[b]).alias("tgt_lang"),
                F.col(a).alias("src"),
                F.col(b).alias("tgt"),
            )
            for i, (a, b) in enumerate(ends)
        ]
    )
    rest = [c for c in df.columns if c not in {pair_id, "en", "tr"}]
    return df.select(*rest, F.inline(rows))


def build_examples(df: DataFrame, both: bool = True) -> DataFrame:
    """Strip, drop empty, keep the length band, expand: one narrow stage."""
    return expand_directions(length_band(drop_empty_pairs(strip_pair(df))), both)


def sample_cap(df: DataFrame, n: int | None, seed: int = SEED, id_col: str = "ex_id") -> DataFrame:
    """``n`` rows picked by hashed id if there are more than ``n``, else all.

    A histogram of hash prefixes (at most 16**5 rows whatever the data size)
    finds the prefix where the running count reaches ``n``.  Rows beyond it
    never leave the scan; only rows up to it are shuffled, spread over their
    prefixes.  The chosen set depends on ids and seed alone.
    """
    if n is None or n < 0:
        return df
    if n == 0:
        return df.limit(0)
    key = F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.lit(str(seed))))
    keyed = df.withColumn("_key", key).withColumn("_prefix", F.substring("_key", 1, HASH_PREFIX))
    running = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = keyed.groupBy("_prefix").agg(F.count("*").alias("_n")).withColumn("_upto", F.sum("_n").over(running))
    crossing = counts.where(F.col("_upto") >= n)
    room = (F.lit(n) - F.col("_upto") + F.col("_n")).alias("_room")
    cut = crossing.agg(F.min(F.struct("_prefix", room))).scalar()
    last, spare = F.coalesce(cut["_prefix"], F.lit("g")), F.coalesce(cut["_room"], F.lit(0))
    near = keyed.where(F.col("_prefix") <= last)
    ranked = top_n_per_group(near, ["_prefix"], [F.col("_key"), F.col(id_col)], n, rank="_at")
    return ranked.where((F.col("_prefix") < last) | (F.col("_at") <= spare)).drop("_key", "_prefix", "_at")


def cap_per_direction(
    df: DataFrame, n: int = 500, languages: Sequence[str] = tuple(LANGUAGES.values()), order_by: str = "ex_id"
) -> DataFrame:
    """First ``n`` rows of each source language; other languages go.  ``n <= 0`` keeps all rows.

    The id of the n-th row is found on languages and ids alone; texts are read
    once, filtered by it and ranked among no more than ``n`` rows and their ties.
    """
    if n <= 0:
        return df
    known = df.where(F.col("src_lang").isin(*languages))
    ids = top_n_per_group(known.select("src_lang", order_by), ["src_lang"], [F.col(order_by)], n)
    # One row per language.
    last = ids.groupBy("src_lang").agg(F.max(order_by).alias("_last"))
    near = known.join(F.broadcast(last), "src_lang").where(F.col(order_by).isNull() | (F.col(order_by) <= F.col("_last"))).drop("_last")
    return top_n_per_group(near, ["src_lang"], [F.col(order_by)], n).select(df.columns)


def in_direction_order(df: DataFrame, languages: Sequence[str] = tuple(LANGUAGES.values()), order_by: str = "ex_id") -> DataFrame:
    """All rows of the first language, then of the second, each in id order."""
    return direction_place(df, languages).orderBy("_place", order_by).drop("_place")


def with_direction(df: DataFrame) -> DataFrame:
    return df.withColumn("direction", direction("src_lang", "tgt_lang"))


def split_counts(df: DataFrame, *keys: str, totals: bool = False) -> DataFrame:
    """Rows per key combination; ``totals`` adds the subtotals in the same pass."""
    grouped = df.rollup(*keys) if totals else df.groupBy(*keys)
    return grouped.agg(F.count("*").alias("n"))


def training_text(df: DataFrame, **markers: str) -> DataFrame:
    """Source and target as one chat transcript in a single ``text`` column."""
    return df.select(render_chat(translation_messages("src", "src_lang", "tgt_lang", "tgt"), **markers).alias("text"))


def with_prompt(df: DataFrame, budget: tuple[Load, int] | None = None, **markers: str) -> DataFrame:
    """Chat prompt without the target, opened for the reply.

    ``budget`` (tokenizer, tokens) shortens the source inside the prompt, never
    the chat around it; the columns of the row keep their whole texts.
    """
    prompt = lambda src: render_chat(translation_messages(src, "src_lang", "tgt_lang"), open_reply=True, **markers)
    if budget is None:
        return df.withColumn("prompt", prompt("src"))
    load, max_tokens = budget
    shortened = fit_tokens(df.withColumn("_src", F.col("src")), load, max_tokens, ["_src"], prompt(F.lit("")))
    return shortened.withColumn("prompt", prompt("_src")).drop("_src")


def fit_examples(df: DataFrame, load: Load, max_tokens: int, **markers: str) -> DataFrame:
    """Source and target shortened so that their training text keeps a token budget."""
    frame = render_chat(translation_messages(F.lit(""), "src_lang", "tgt_lang", F.lit("")), **markers)
    return fit_tokens(df, load, max_tokens, ["src", "tgt"], frame)


def direction_place(df: DataFrame, languages: Sequence[str] = tuple(LANGUAGES.values()), name: str = "_place") -> DataFrame:
    """Place of the row's source language in the order of ``in_direction_order``."""
    place = F.lit(len(languages))
    for i, language in enumerate(languages):
        place = F.when(F.col("src_lang") == language, i).otherwise(place)
    return df.withColumn(name, place)


def preview(df: DataFrame, columns: Sequence[str] = ("src", "tgt", "hypothesis"), n: int = 3, width: int = 140, order_by: str = "ex_id") -> DataFrame:
    """First ``n`` rows in id order, the long columns cut to ``width``."""
    shown = {c: F.substring(c, 1, width) for c in columns if c in df.columns}
    return df.orderBy(order_by).limit(n).withColumns(shown)
